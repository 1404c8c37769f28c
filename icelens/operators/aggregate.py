"""Season totals per player, game situation by game situation.

One row counts in ``all`` and in its own situation: rows are exploded into their buckets
and grouped once, instead of one filtered pass per situation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from icelens.config import (DEFAULT_RULES, GOALIE_SITUATIONS, ON_GOAL, PERIOD_KEYS, SKATER_SITUATIONS, UNBLOCKED,
                            Rules)
from icelens.functions.labels import buckets, danger
from icelens.operators.attach import tag_strength

PLAYER = ["season", "player_id"]


def preferred(primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """``primary``, plus the ``fallback`` rows of seasons it has nothing for."""
    seasons = primary.select("season").distinct()
    return primary.unionByName(fallback.join(seasons, "season", "left_anti"))


def skater_gp(box: DataFrame, shifts: DataFrame) -> DataFrame:
    """Games played, from box scores where a season has them, otherwise from shifts."""
    def games(df: DataFrame) -> DataFrame:
        return df.select(*PLAYER, "game_id").dropna()

    return preferred(games(box), games(shifts)).groupBy(*PLAYER).agg(F.countDistinct("game_id").alias("gp"))


def goalie_gp(box: DataFrame, shifts: DataFrame) -> DataFrame:
    """Games a goalie took part in; dressed but unused (no ice time) does not count."""
    played = box.where("toi > 0").select(*PLAYER, "game_id").dropna()
    goalies = shifts.where("is_goalie").select(*PLAYER, "game_id").dropna()
    return preferred(played, goalies).groupBy(*PLAYER).agg(F.countDistinct("game_id").alias("gp"))


def player_totals(player_stints: DataFrame) -> DataFrame:
    """Ice time, on-ice results and zone starts per (player, situation)."""
    rows = player_stints.withColumn("situation", F.explode(buckets(F.col("situation"), SKATER_SITUATIONS)))
    total = {n: F.sum(n).alias(n) for n in ("gf", "ga", "xgf", "xga", "sogf", "soga")}
    sums = rows.groupBy(*PLAYER, "situation").agg(
        (F.sum("duration") / 60.0).alias("stint_toi"), *total.values(),
        F.sum("zone_o").alias("off_zone_starts"), F.sum("zone_n").alias("neu_zone_starts"),
        F.sum("zone_d").alias("def_zone_starts"))

    def share(own: str, opp: str) -> Column:
        both = F.col(own) + F.col(opp)
        return F.when(both > 0, F.col(own) / both * 100)

    shooting = F.when(F.col("sogf") > 0, F.col("gf") / F.col("sogf")).otherwise(0.0)
    saving = F.when(F.col("soga") > 0, 1 - F.col("ga") / F.col("soga")).otherwise(0.0)
    return sums.withColumns({"gf_pct": share("gf", "ga"), "xgf_pct": share("xgf", "xga"), "pdo": shooting + saving})


def skater_toi(totals: DataFrame, box: DataFrame) -> DataFrame:
    """Minutes per (player, situation); ``all`` prefers the box score of the season."""
    stint = totals.select(*PLAYER, "situation", F.col("stint_toi").alias("toi"))
    boxed = (box.groupBy(*PLAYER).agg(F.sum("toi").alias("toi"))
             .select(*PLAYER, F.lit("all").alias("situation"), "toi"))
    return stint.where("situation <> 'all'").unionByName(preferred(boxed, stint.where("situation = 'all'")))


CREDITS = ("goals", "first_assists", "second_assists", "hits", "hits_taken", "giveaways", "takeaways",
           "penalties_drawn", "total_penalties", "ixg")


def credited(shots: DataFrame, goals: DataFrame, possession: DataFrame, penalties: DataFrame,
             rules: Rules = DEFAULT_RULES) -> DataFrame:
    """One row per (event, player it counts for, statistic), from every event source."""
    def rows(df: DataFrame, *pairs: tuple[str, Column, Column]) -> DataFrame:
        entries = F.array(*[F.struct(F.lit(metric).alias("metric"), who.cast("long").alias("player_id"),
                                     value.cast("double").alias("value")) for metric, who, value in pairs])
        return (df.select(*PERIOD_KEYS, F.col("sec").cast("long").alias("sec"), "team", F.explode(entries).alias("_e"))
                .select(*PERIOD_KEYS, "sec", "team", "_e.*").where(F.col("player_id").isNotNull()))

    one = F.lit(1.0)
    kind = F.col("event_type")
    counted = penalties.where(F.col("minutes").isin(*rules.attributable_minutes))
    return (
        rows(shots.where(kind.isin(*UNBLOCKED)),
             ("goals", F.when(kind == "goal", F.col("shooter_id")), one), ("ixg", F.col("shooter_id"), F.col("xg")))
        .unionByName(rows(goals, ("first_assists", F.col("assist1_id"), one),
                          ("second_assists", F.col("assist2_id"), one)))
        .unionByName(rows(possession, ("hits", F.when(kind == "hit", F.col("player_id")), one),
                          ("hits_taken", F.when(kind == "hit", F.col("hittee_id")), one),
                          ("giveaways", F.when(kind == "giveaway", F.col("player_id")), one),
                          ("takeaways", F.when(kind == "takeaway", F.col("player_id")), one)))
        .unionByName(rows(counted, ("penalties_drawn", F.col("drew_player_id"), one),
                          ("total_penalties", F.col("penalty_player_id"), one))))


def event_totals(credits: DataFrame, stints: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Individual counts and individual xG per (player, situation), one pass over all events."""
    tagged = tag_strength(credits, stints, rules)
    rows = tagged.withColumn("situation", F.explode(buckets(F.col("strength"), SKATER_SITUATIONS)))
    return rows.groupBy(*PLAYER, "situation").agg(
        *[F.coalesce(F.sum(F.when(F.col("metric") == m, F.col("value"))), F.lit(0.0)).alias(m) for m in CREDITS])


def goalie_toi(goalie_stints: DataFrame) -> DataFrame:
    rows = goalie_stints.withColumn("situation", F.explode(buckets(F.col("situation"), GOALIE_SITUATIONS)))
    return rows.groupBy(*PLAYER, "situation").agg((F.sum("duration") / 60.0).alias("toi"))


def goalie_shots(tagged: DataFrame, toi: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """What each goalie faced, per situation and danger tier.

    ``tagged`` shots carry the shooter's strength, so a goalie's 4v5 is the shooter's 5v4.
    Counts are over shots on goal, xG over every unblocked attempt.
    """
    own = F.when(F.col("strength") == "5v4", "4v5").when(F.col("strength") == "5v5", "5v5").otherwise("-")
    shots = (tagged.where(F.col("event_type").isin(*UNBLOCKED) & F.col("goalie_id").isNotNull())
             .withColumns({"situation": F.explode(buckets(own, GOALIE_SITUATIONS)),
                           "tier": danger(F.col("xg"), rules),
                           "sog": F.col("event_type").isin(*ON_GOAL).cast("int"),
                           "scored": (F.col("event_type") == "goal").cast("int")}))
    sums = [F.sum("sog").alias("shots_against"), F.sum("scored").alias("goals_against"),
            F.coalesce(F.sum("xg"), F.lit(0.0)).alias("xg_against"),
            F.sum("is_rebound").alias("rebound_attempts_against"),
            F.coalesce(F.sum(F.col("xg") * F.col("is_rebound")), F.lit(0.0)).alias("rebound_xg_against")]
    for tier in ("HD", "MD", "LD"):
        here, low = F.col("tier") == tier, tier.lower()
        sums += [F.coalesce(F.sum(F.when(here, F.col("sog"))), F.lit(0)).alias(f"{low}_shots_against"),
                 F.coalesce(F.sum(F.when(here, F.col("scored"))), F.lit(0)).alias(f"{low}_goals_against"),
                 F.coalesce(F.sum(F.when(here, F.col("xg"))), F.lit(0.0)).alias(f"{low}_xg_against")]
    out = shots.groupBy("season", F.col("goalie_id").alias("player_id"), "situation").agg(*sums)
    out = out.join(toi.withColumnRenamed("toi", "_toi"), [*PLAYER, "situation"], "left")
    saves = {f"{p}saves": F.col(f"{p}shots_against") - F.col(f"{p}goals_against") for p in ("", "hd_", "md_", "ld_")}
    return out.withColumns(saves).withColumns({
        "sv_pct": F.when(F.col("shots_against") > 0, F.col("saves") / F.col("shots_against")),
        "gaa": F.when(F.col("_toi") > 0, F.col("goals_against") / (F.col("_toi") / 60.0)),
    }).drop("_toi")


def game_gsax(shots: DataFrame) -> DataFrame:
    """Goals saved above expected per goalie and game."""
    return (shots.where(F.col("event_type").isin(*UNBLOCKED) & F.col("goalie_id").isNotNull())
            .groupBy("season", F.col("goalie_id").alias("player_id"), "game_id")
            .agg(F.count_if(F.col("event_type").isin(*ON_GOAL)).alias("shots_against"),
                 F.count_if(F.col("event_type") == "goal").alias("goals_against"),
                 F.sum("xg").alias("xg_against"))
            .withColumn("gsax", F.col("xg_against") - F.col("goals_against")))


def start_quality(logs: DataFrame, gsax: DataFrame, gp: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Share of a goalie's games that were great, quality, bad or awful starts.

    Games without a GSAx count for no level but stay in the games played; the two bad
    levels are negated so that more is always better.
    """
    value = F.col("gsax")
    levels = {"gre": value >= rules.great_start, "qal": value >= rules.quality_start,
              "bad": value < rules.quality_start, "awf": value <= rules.awful_start}
    counts = (logs.select(*PLAYER, "game_id").join(gsax.select(*PLAYER, "game_id", "gsax"), [*PLAYER, "game_id"], "left")
              .groupBy(*PLAYER).agg(*[F.count_if(test).alias(f"_{n}") for n, test in levels.items()]))
    sign = {"gre": 1, "qal": 1, "bad": -1, "awf": -1}
    return (gp.select(*PLAYER, "gp").join(counts, PLAYER, "left")
            .select(*PLAYER, *[(F.try_divide(F.col(f"_{n}"), F.col("gp")) * sign[n]).alias(f"{n}_score") for n in levels]))


def goalie_record(logs: DataFrame) -> DataFrame:
    """Wins, losses, overtime losses and shutouts."""
    return logs.groupBy(*PLAYER).agg(
        F.count_if(F.col("result") == "W").alias("w"), F.count_if(F.col("result") == "L").alias("l"),
        F.count_if(F.col("result") == "O").alias("ot_so"), F.coalesce(F.sum("shutouts"), F.lit(0)).alias("shutouts"))


def toi_totals(stats: DataFrame) -> DataFrame:
    """Minutes and games per (player, situation), forwards and defence pooled."""
    return stats.groupBy(*PLAYER, "situation").agg(F.sum("toi").alias("toi"), F.sum("gp").alias("gp"))


def calibration(scored: DataFrame, group: str = "season", label: str = "goal", p: str = "xg") -> DataFrame:
    """Relative gap of predicted and actual totals per group, and the largest of all."""
    per = scored.groupBy(group).agg(F.sum(label).alias("actual"), F.sum(p).alias("predicted"))
    per = per.withColumn("error", F.when(F.col("actual") > 0, F.abs(F.col("predicted") - F.col("actual")) / F.col("actual")))
    return per.crossJoin(F.broadcast(per.agg(F.max("error").alias("max_error"))))  # one row


def weighted_r2(rows: DataFrame, keys: list[str], y: str, prediction: str, weight: str) -> DataFrame:
    """Weighted R² per key from one pass of moments; null when the weighted variance is 0."""
    w, v, e = F.col(weight), F.col(y), F.col(y) - F.col(prediction)
    sums = rows.groupBy(*keys).agg(F.sum(w * e * e).alias("res"), F.sum(w).alias("w"),
                                   F.sum(w * v).alias("wy"), F.sum(w * v * v).alias("wyy"))
    total = F.col("wyy") - F.col("wy") * F.col("wy") / F.col("w")
    return sums.select(*keys, F.when(total > 1e-12 * F.col("wyy"), 1 - F.col("res") / total).alias("r2"))
