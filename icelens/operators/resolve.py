"""Names of a report to player ids, by tiers of decreasing certainty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from icelens.functions.text import name_key
from icelens.session import settle


def _only(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Keys with exactly one distinct player, and that player."""
    who = F.struct("player_id", "player")
    return (df.groupBy(*keys).agg(F.min("player_id").alias("_lo"), F.max("player_id").alias("_hi"),
                                  F.min(who).alias(name))
            .where("_lo = _hi").drop("_lo", "_hi"))


def resolve_names(reports: DataFrame, roster: DataFrame, overrides: DataFrame) -> DataFrame:
    """Add player and player_id to report rows; rows no tier can place are dropped.

    Tiers: exact name and team; known overrides; a name unique over all teams; the
    last name, unique in the team, else unique overall. ``reports``: season, team,
    report_name, report_last_name and anything else; ``roster``: season, team, player_id,
    player; ``overrides``: key, team, player_id. Each lookup has one row per key.
    """
    season = ["season"]
    # One listing per (name, team): the smallest id stands for it, as for any duplicate.
    people = (roster.withColumn("key", name_key(F.col("player")))
              .groupBy(*season, "team", "key").agg(F.min(F.struct("player_id", "player")).alias("_p"))
              .select(*season, "team", "key", "_p.*"))
    people = settle(people, "people")  # three lookups read it, and its keys come from Python
    # Keys are worked out once per spelling, and the answer joins back by spelling.
    spelled = (reports.groupBy(*season, "team", "report_name").agg(F.min("report_last_name").alias("last_name"))
               .withColumns({"key": name_key(F.col("report_name")), "last_key": name_key(F.col("last_name"))}))
    spelled = settle(spelled, "spelled")
    names = (spelled.groupBy(*season, "team", "key").agg(F.min_by("last_key", "last_name").alias("last_key"))
             .withColumn("last_key", F.nullif("last_key", F.lit(""))))
    # Every suffix of a name's words, so that last names of several words match too.
    words = F.split("key", " ")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(words)),
                           lambda n: F.array_join(F.slice(words, -n, n), " "))
    tails = people.select(*season, "team", "player_id", "player", F.explode(suffixes).alias("last_key"))
    exact = people.select(*season, "team", "key", F.struct("player_id", "player").alias("t1"))
    by_id = roster.groupBy(*season, "player_id").agg(F.min("player").alias("_name"))
    forced = overrides.select("key", "team", F.col("player_id").alias("_forced"))
    found = (names.join(exact, [*season, "team", "key"], "left")
             .join(forced, ["key", "team"], "left")
             .join(by_id.withColumnRenamed("player_id", "_forced"), [*season, "_forced"], "left")
             .join(_only(people, [*season, "key"], "t2"), [*season, "key"], "left")
             .join(_only(tails, [*season, "team", "last_key"], "t3"), [*season, "team", "last_key"], "left")
             .join(_only(tails, [*season, "last_key"], "t4"), [*season, "last_key"], "left"))
    override: Column = F.when(F.col("_forced").isNotNull(), F.struct(
        F.col("_forced").alias("player_id"), F.coalesce("_name", F.col("_forced").cast("string")).alias("player")))
    hit = F.coalesce("t1", override, "t2", "t3", "t4")
    placed = found.withColumn("_hit", hit).where(F.col("_hit").isNotNull()).select(*season, "team", "key", "_hit")
    answers = (spelled.join(placed, [*season, "team", "key"])
               .select(*season, "team", "report_name", "_hit.player", "_hit.player_id"))
    return reports.join(answers, [*season, "team", "report_name"]).select(*reports.columns, "player", "player_id")
