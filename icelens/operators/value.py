"""Wins above replacement: conversion, shrinkage, replacement level, components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from icelens.config import DEFAULT_RULES, UNBLOCKED, Rules

PLAYER = ["season", "player_id"]
# component -> situation whose minutes it uses
COMPONENTS = {"evo": "5v5", "evd": "5v5", "ppl": "5v4", "pkl": "4v5"}
BUCKETS = ("5v5", "5v4", "4v5")


def credibility(n: Column, k: float) -> Column:
    return n / (n + k)


def goals_to_wins(standings: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Marginal wins per goal at each season's scoring level."""
    return standings.groupBy("season").agg(
        (F.lit(rules.pythagorean) / (4 * (F.sum("goals_for") / F.sum("gp")))).alias("g2w"))


def replacement_rates(rated: DataFrame, group: list[str], threshold: Column, limit: int) -> DataFrame:
    """Minutes-weighted mean rate of the rows below a team's top ``threshold`` by minutes.

    ``rated``: group columns, player_id, team, toi, rate. Only the top ``limit`` rows of each
    team are ever ranked (kept per task before the shuffle); all others are in the pool.
    """
    rows = rated.where(F.col("rate").isNotNull() & (F.col("toi") > 0))
    nth = F.row_number().over(W.partitionBy(*group, "team").orderBy(F.col("toi").desc(), F.col("player_id")))
    top = (rows.withColumn("_nth", nth).where(F.col("_nth") <= limit)
           .where(F.col("_nth") <= threshold).select(*group, "player_id", "team"))
    pool = rows.join(top, [*group, "player_id", "team"], "left_anti")
    return pool.groupBy(*group).agg((F.sum(F.col("rate") * F.col("toi")) / F.sum("toi")).alias("replacement"))


def component_rows(stats: DataFrame, rates: DataFrame) -> DataFrame:
    """Skater minutes and rates, one row per (player, component)."""
    long = rates.select(*PLAYER, F.explode(F.array(*[
        F.struct(F.lit(c).alias("component"), F.lit(s).alias("situation"), F.col(f"{c}_rapm").alias("rate"))
        for c, s in COMPONENTS.items()])).alias("_r")).select(*PLAYER, "_r.component", "_r.rate")
    minutes = (stats.where(F.col("position").isin("F", "D"))
               .select(*PLAYER, "position", "team", "situation", "toi", "gp")
               .withColumn("component", F.explode(
                   F.when(F.col("situation") == "5v5", F.array(F.lit("evo"), F.lit("evd")))
                   .when(F.col("situation") == "5v4", F.array(F.lit("ppl")))
                   .when(F.col("situation") == "4v5", F.array(F.lit("pkl"))))))
    return minutes.join(long, [*PLAYER, "component"], "left")


def replacement_levels(rows: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Replacement rate of each (season, component, position), all in one pass."""
    threshold = F.lit(None).cast("int")
    for (situation, position), n in rules.team_rank.items():
        threshold = F.when((F.col("situation") == situation) & (F.col("position") == position), n).otherwise(threshold)
    return replacement_rates(rows.withColumn("_cut", threshold), ["season", "component", "position"], F.col("_cut"),
                             max(rules.team_rank.values()))


def finishing_impact(shots: DataFrame, keys: list[str], rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Goals above expected of each shooter, shrunk toward 0 by the number of shots."""
    return (shots.where(F.col("event_type").isin(*UNBLOCKED) & F.col("shooter_id").isNotNull())
            .groupBy("season", F.col("shooter_id").alias("player_id"), *keys)
            .agg(F.count_if(F.col("event_type") == "goal").alias("goals"), F.sum("xg").alias("xg"),
                 F.count("*").alias("shots"))
            .withColumn("finishing", (F.col("goals") - F.col("xg")) * credibility(F.col("shots"), rules.finishing_k)))


def penalty_impact(tagged: DataFrame, g2w: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Wins from penalties drawn less taken, by the penalised player's strength before it."""
    signed = F.array(F.struct(F.col("drew_player_id").alias("player_id"), F.col("minutes").alias("net")),
                     F.struct(F.col("penalty_player_id").alias("player_id"), (-F.col("minutes")).alias("net")))
    price = F.create_map(*[F.lit(x) for pair in rules.penalty_goal_minutes.items() for x in pair])
    sums = (tagged.where(F.col("minutes").isin(*rules.attributable_minutes) & F.col("strength").isin(*BUCKETS))
            .select("season", "strength", F.explode(signed).alias("_s")).select("season", "strength", "_s.*")
            .where(F.col("player_id").isNotNull())
            .groupBy(*PLAYER, "strength").agg(F.sum("net").alias("net"), F.count("*").alias("n")))
    return sums.join(g2w, "season").select(
        *PLAYER, "strength", (F.col("net") * price[F.col("strength")] * F.col("g2w")
                              * credibility(F.col("n"), rules.penalty_k)).alias("penalty_war"))


def component_war(rows: DataFrame, levels: DataFrame, g2w: DataFrame) -> DataFrame:
    """Season-total and per-game wins of each component; an unknown rate is replacement level."""
    joined = (rows.join(levels, ["season", "component", "position"], "left").join(g2w, "season")
              .fillna(0.0, ["replacement"]))
    rate = F.coalesce("rate", "replacement")
    total = (rate - F.col("replacement")) * (F.col("toi") / 60.0) * F.col("g2w")
    return joined.select(*PLAYER, "position", "component", total.alias("war_total"),
                         F.when(F.col("gp") > 0, total / F.col("gp")).alias("war"))


def skater_war(stats: DataFrame, rates: DataFrame, standings: DataFrame, tagged_shots: DataFrame,
               tagged_penalties: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Four on-ice components, finishing and penalties, per game and as season totals."""
    g2w = goals_to_wins(standings, rules)
    rows = component_rows(stats, rates)
    parts = component_war(rows, replacement_levels(rows, rules), g2w)
    pieces = [F.coalesce(F.sum(F.when(F.col("component") == c, F.col(v))), F.lit(0.0)).alias(f"{c}_{v}")
              for c in COMPONENTS for v in ("war", "war_total")]
    wide = parts.groupBy(*PLAYER, "position").agg(*pieces)
    fin = (finishing_impact(tagged_shots.where(F.col("strength").isin(*BUCKETS)), ["strength"], rules)
           .join(g2w, "season").select(*PLAYER, "strength", (F.col("finishing") * F.col("g2w")).alias("v"),
                                       F.lit("fin").alias("kind")))
    pen = penalty_impact(tagged_penalties, g2w, rules).select(
        *PLAYER, "strength", F.col("penalty_war").alias("v"), F.lit("pen").alias("kind"))
    extra = fin.unionByName(pen).groupBy(*PLAYER).agg(*[
        F.sum(F.when((F.col("kind") == k) & (F.col("strength") == b), F.col("v"))).alias(f"{k}_war_{b}_total")
        for k in ("fin", "pen") for b in BUCKETS])
    gp = stats.where("situation = 'all'").select(*PLAYER, F.col("gp").alias("_gp"))
    names = [f"{k}_war_{b}" for k in ("fin", "pen") for b in BUCKETS]
    out = (wide.join(extra, PLAYER, "left").join(gp, PLAYER, "left")
           .fillna(0.0, [f"{n}_total" for n in names])
           .withColumns({n: F.when(F.col("_gp") > 0, F.col(f"{n}_total") / F.col("_gp")) for n in names}))

    def total(items: list[str]) -> Column:
        result = F.col(items[0])
        for item in items[1:]:
            result = result + F.col(item)
        return result

    out = out.withColumns({f"{k}_war{t}": total([f"{k}_war_{b}{t}" for b in BUCKETS])
                           for k in ("fin", "pen") for t in ("", "_total")})
    six = [*COMPONENTS, "fin", "pen"]
    return out.withColumns({f"tot_war{t}": total([f"{c}_war{t}" for c in six]) for t in ("", "_total")}).drop("_gp")


def goalie_war(stats: DataFrame, standings: DataFrame, tagged_shots: DataFrame,
               rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Even-strength and short-handed wins of goalies from shrunk goals saved above expected.

    A season without any tagged shot uses the xG stored in the statistics.
    """
    g2w = goals_to_wins(standings, rules)
    situation = F.when(F.col("strength") == "5v4", "4v5").otherwise("5v5")
    raw = (tagged_shots.where(F.col("event_type").isin(*UNBLOCKED) & F.col("goalie_id").isNotNull()
                              & F.col("strength").isin("5v5", "5v4"))
           .groupBy("season", F.col("goalie_id").alias("player_id"), situation.alias("situation"))
           .agg(F.sum("xg").alias("xga"), F.count_if(F.col("event_type") == "goal").alias("ga"), F.count("*").alias("n")))
    covered = raw.select("season").distinct().withColumn("_covered", F.lit(True))
    rows = (stats.where(F.col("situation").isin("5v5", "4v5"))
            .join(raw, [*PLAYER, "situation"], "left").join(covered, "season", "left"))
    shrunk = (F.col("xga") - F.col("ga")) * credibility(F.col("n"), rules.goalie_k)
    stored = ((F.col("xg_against") - F.col("goals_against"))
              * F.try_divide(F.col("shots_against"), F.col("shots_against") + rules.goalie_k))
    gsax = F.coalesce(F.when(F.col("_covered"), shrunk).otherwise(stored), F.lit(0.0))
    rows = rows.select(*PLAYER, "team", "situation", "toi", "gp",
                       F.when(F.col("toi") > 0, gsax * 60 / F.col("toi")).otherwise(0.0).alias("rate"))
    level = replacement_rates(rows, ["season", "situation"], F.lit(rules.goalie_team_rank), rules.goalie_team_rank)
    total = (F.col("rate") - F.col("replacement")) * (F.col("toi") / 60.0) * F.col("g2w")
    wars = (rows.join(level, ["season", "situation"], "left").join(g2w, "season")
            .withColumn("total", total)
            .withColumns({"war": F.when(F.col("gp") > 0, F.col("total") / F.col("gp")),
                          "part": F.when(F.col("situation") == "5v5", "evs").otherwise("pkl")}))
    out = wars.groupBy(*PLAYER).agg(*[
        F.coalesce(F.sum(F.when(F.col("part") == p, F.col(src))), F.lit(0.0)).alias(f"{p}_{name}")
        for p in ("evs", "pkl") for src, name in (("war", "war"), ("total", "war_total"))])
    return out.withColumns({"tot_war": F.col("evs_war") + F.col("pkl_war"),
                            "tot_war_total": F.col("evs_war_total") + F.col("pkl_war_total")})


def shrunk_prior(rates: DataFrame, minutes: DataFrame, off: str, dfn: str, off_situation: str, def_situation: str,
                 rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Minutes-weighted earlier rates of each player, pulled to 0 by a fixed amount of minutes.

    One row per (season the prior is for, player, role). ``def`` is negated back to the
    sign of the fit. ``rates``: season, player_id, off and dfn columns; ``minutes``:
    season, player_id, situation, toi.
    """
    from icelens.functions.clock import shift_season
    long = rates.select(*PLAYER, F.explode(F.array(
        F.struct(F.lit("off").alias("role"), F.lit(off_situation).alias("situation"), F.col(off).alias("rate")),
        F.struct(F.lit("def").alias("role"), F.lit(def_situation).alias("situation"), (-F.col(dfn)).alias("rate")))
    ).alias("_r")).select(*PLAYER, "_r.*").where(F.col("rate").isNotNull())
    weighted = long.join(minutes.where("toi > 0"), [*PLAYER, "situation"])
    later = F.explode(F.array(*[shift_season(F.col("season"), k) for k in range(1, rules.prior_seasons + 1)]))
    k = F.when(F.col("role") == "off", rules.prior_minutes.get(off_situation, 500.0)) \
         .otherwise(rules.prior_minutes.get(def_situation, 500.0))
    return (weighted.select("player_id", "role", "rate", "toi", later.alias("season"))
            .groupBy("season", "player_id", "role")
            .agg(F.sum(F.col("rate") * F.col("toi")).alias("s"), F.sum("toi").alias("t"))
            .select("season", "player_id", "role", (F.col("s") / (F.col("t") + k)).alias("prior")))


def merge_scores(even: DataFrame, special: DataFrame) -> DataFrame:
    """Both fits' coefficients, one row per player; a role a player never had scores 0 in its own fit.

    Each input: season, player_id, off_coef, def_coef (null where absent).
    """
    def tidy(df: DataFrame, off: str, dfn: str) -> DataFrame:
        return df.select(*PLAYER, F.coalesce("off_coef", F.lit(0.0)).alias(off),
                         (-F.coalesce("def_coef", F.lit(0.0))).alias(dfn))

    return tidy(even, "evo_rapm", "evd_rapm").join(tidy(special, "ppl_rapm", "pkl_rapm"), PLAYER, "full_outer")
