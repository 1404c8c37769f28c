"""Attaching events to intervals by the clock.

Spark has no as-of join. Events are first reduced to distinct seconds per period (a
bounded number of rows), those ticks are placed among the intervals with one window, and
the placed ticks are joined back to the events on (period, second) -- a plain equi-join
that splits even a hot period by its seconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from icelens.config import DEFAULT_RULES, ON_GOAL, PERIOD_KEYS, UNBLOCKED, Rules
from icelens.functions.clock import absolute_second
from icelens.functions.labels import shot_strength


def _placed(marks: DataFrame, ticks: DataFrame, start: str, end: str, mode: str) -> DataFrame:
    """Intervals and ticks on one timeline; ``at`` is the start of the interval a row belongs to.

    Columns stay flat and numeric comparisons do all the work, so the only costs are one
    exchange by period and one sort.
    """
    line = (marks.withColumns({"sec": F.col(start).cast("long"), "_s": F.col(start).cast("long"),
                               "_e": F.col(end).cast("long")})
            .unionByName(ticks.withColumn("sec", F.col("sec").cast("long")), allowMissingColumns=True))
    period = W.partitionBy(*PERIOD_KEYS).orderBy("sec")
    before = period.rangeBetween(W.unboundedPreceding, -1)
    whole = period.rangeBetween(W.unboundedPreceding, W.unboundedFollowing)
    line = line.withColumns({
        "_prev": F.last("_s", ignorenulls=True).over(before),
        "_prev_end": F.last("_e", ignorenulls=True).over(before),
        "_own": F.max("_s").over(period.rangeBetween(0, 0)),
        "_head": F.min("_s").over(whole), "_tail": F.max("_s").over(whole),
    })
    sec, prev, prev_end, own = F.col("sec"), F.col("_prev"), F.col("_prev_end"), F.col("_own")
    hit = {
        "tile": F.coalesce(prev, own),
        "clamp": F.coalesce(prev, F.col("_head")),
        "gap": (F.when(own.isNotNull(), F.when(prev_end == sec, prev).otherwise(own))
                .when(prev.isNull(), F.col("_head"))
                .when((prev == F.col("_tail")) | (sec < prev_end), prev)),
    }[mode]
    return (line.withColumn("at", F.coalesce("_s", hit)).where(F.col("at").isNotNull())
            .drop("_prev", "_prev_end", "_own", "_head", "_tail", "_e"))


def locate(ticks: DataFrame, intervals: DataFrame, start: str, end: str, mode: str,
           carry: tuple = ()) -> DataFrame:
    """The interval each distinct second of ``ticks`` belongs to.

    A second on the start of an interval belongs to the one that is ending. Beyond that:

    * ``tile``  -- seconds before the first start match nothing;
    * ``clamp`` -- they match the first interval, and gaps match the interval before them;
    * ``gap``   -- they match the first interval, gaps match nothing, a second on a start
      goes to the previous interval only if the two touch, and everything after the last
      start matches the last interval.

    Returns period keys, ``sec``, ``at`` (the interval's start) and the ``carry`` columns.
    Ticks may repeat. Intervals must not overlap within a period.
    """
    distinct = ticks.where(F.col("sec").isNotNull()).select(*PERIOD_KEYS, "sec").distinct()
    line = _placed(intervals.select(*PERIOD_KEYS, start, end, *carry), distinct, start, end, mode)
    same = W.partitionBy(*PERIOD_KEYS, "at")
    return (line.withColumns({c: F.max(c).over(same) for c in carry})
            .where(F.col("_s").isNull()).select(*PERIOD_KEYS, "sec", "at", *carry))


def add_sums(intervals: DataFrame, events: DataFrame, measures: dict[str, Column], mode: str,
             start: str = "start_sec", end: str = "end_sec") -> DataFrame:
    """Sum events onto the interval they fall in, apart for its two teams.

    ``measures`` maps a name to an aggregate over ``events``; the result has ``a_<name>``
    and ``b_<name>``. Events are summed per (second, team) first, then travel on the
    intervals' timeline: ``intervals`` is computed once and nothing is joined.
    """
    per_second = (events.where(F.col("sec").isNotNull())
                  .groupBy(*PERIOD_KEYS, "sec", F.col("team").alias("_team"))
                  .agg(*[agg.alias(f"_{name}") for name, agg in measures.items()]))
    line = _placed(intervals, per_second, start, end, mode)
    # Both names are the same on every interval of a period.
    whole, same = W.partitionBy(*PERIOD_KEYS), W.partitionBy(*PERIOD_KEYS, "at")
    line = line.withColumns({"_ta": F.max("team_a").over(whole), "_tb": F.max("team_b").over(whole)})
    sums = {f"{side}_{name}": F.coalesce(F.sum(F.when(F.col("_team") == F.col(f"_t{side}"), F.col(f"_{name}")))
                                         .over(same), F.lit(0))
            for name in measures for side in "ab"}
    return (line.withColumns(sums).where(F.col("_s").isNotNull())
            .select(*intervals.columns, *sums))


def tag_strength(events: DataFrame, stints: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Add ``strength``: the skater counts seen from the event's team, ``unknown`` if none."""
    carry = ("team_a", "team_b", "a_n", "b_n", "a_goalie_on", "b_goalie_on")
    at = locate(events.select(*PERIOD_KEYS, "sec"), stints, "start_sec", "end_sec", "clamp", carry)

    def seen_from(own: str, opp: str) -> Column:
        return shot_strength(F.col(f"{own}_n"), F.col(f"{opp}_n"), F.col(f"{own}_goalie_on"),
                             F.col(f"{opp}_goalie_on"), F.col("game_id"), rules)

    label = (F.when(F.col("team") == F.col("team_a"), seen_from("a", "b"))
             .when(F.col("team") == F.col("team_b"), seen_from("b", "a")).otherwise("unknown"))
    return (events.join(at, [*PERIOD_KEYS, "sec"], "left")
            .withColumn("strength", label).drop("at", *carry))


def attach_shots(stints: DataFrame, shots: DataFrame) -> DataFrame:
    """Add ``a_xg``/``b_xg`` (unblocked shots) and ``a_sog``/``b_sog`` (goals and saves) of each stint."""
    return add_sums(stints, shots.where(F.col("event_type").isin(*UNBLOCKED)), {
        "xg": F.sum("xg"), "sog": F.count(F.when(F.col("event_type").isin(*ON_GOAL), 1))}, "gap")


def attach_xg(stints: DataFrame, shots: DataFrame) -> DataFrame:
    """Add ``a_xg``/``b_xg``: expected goals of the unblocked shots in each stint."""
    return add_sums(stints, shots.where(F.col("event_type").isin(*UNBLOCKED)), {"xg": F.sum("xg")}, "gap")


def attach_shots_on_goal(stints: DataFrame, shots: DataFrame) -> DataFrame:
    """Add ``a_sog``/``b_sog``: goals and saved shots in each stint."""
    on_goal = shots.where(F.col("event_type").isin(*ON_GOAL))
    return add_sums(stints, on_goal, {"sog": F.count("*")}, "gap")


GAME = ["game_id", "season"]


def attach_score_state(stints: DataFrame, goals: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Goal difference before each stint began, capped, with six up/down indicators a side.

    Each stint asks once per team on a (game, team) timeline of goals per second, then the
    two answers meet again on the stint.
    """
    def at(sec: str) -> Column:
        return absolute_second(F.col("period"), F.col(sec), rules.period_seconds).cast("long").alias("at")

    side = F.explode(F.array(F.struct(F.lit("a").alias("_side"), F.col("team_a").alias("_team")),
                             F.struct(F.lit("b").alias("_side"), F.col("team_b").alias("_team"))))
    asks = stints.select("*", at("start_sec"), side.alias("_x")).select(*stints.columns, "at", "_x.*")
    ticks = (goals.where(F.col("sec").isNotNull()).select(*GAME, F.col("team").alias("_team"), at("sec"))
             .groupBy(*GAME, "_team", "at").agg(F.count("*").alias("_g")))
    earlier = W.partitionBy(*GAME, "_team").orderBy("at").rangeBetween(W.unboundedPreceding, -1)
    answered = (asks.unionByName(ticks, allowMissingColumns=True)
                .withColumn("_before", F.coalesce(F.sum("_g").over(earlier), F.lit(0)))
                .where(F.col("_side").isNotNull()))
    pair = W.partitionBy(*PERIOD_KEYS, "start_sec")
    out = (answered.withColumns({
        "ga": F.max(F.when(F.col("_side") == "a", F.col("_before"))).over(pair),
        "gb": F.max(F.when(F.col("_side") == "b", F.col("_before"))).over(pair)})
        .where("_side = 'a'").select(*stints.columns, "ga", "gb"))
    cap = rules.score_cap
    diff = F.least(F.greatest(F.col("ga") - F.col("gb"), F.lit(-cap)), F.lit(cap)).cast("int")
    steps = {"a_score_state": diff, "b_score_state": -diff}
    for name, state in (("a", diff), ("b", -diff)):
        steps |= {f"{name}_up1": (state == 1).cast("int"), f"{name}_up2": (state == 2).cast("int"),
                  f"{name}_up3": (state >= 3).cast("int"), f"{name}_down1": (state == -1).cast("int"),
                  f"{name}_down2": (state == -2).cast("int"), f"{name}_down3": (state <= -3).cast("int")}
    return out.withColumns(steps).drop("ga", "gb")


def attach_shot_score_state(shots: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Goal difference before each shot, from the goals among the given shots.

    Zero in games that do not show exactly two teams. Unknown clocks count as second 0.
    """
    at = absolute_second(F.coalesce(F.col("period"), F.lit(1)), F.coalesce(F.col("sec"), F.lit(0)),
                         rules.period_seconds).cast("long")
    timed = shots.withColumn("_abs", at)
    ticks = (timed.where(F.col("team").isNotNull()).groupBy(*GAME, "_abs", "team")
             .agg(F.count(F.when(F.col("event_type") == "goal", 1)).alias("g")))
    teams = (ticks.select(*GAME, "team").distinct().groupBy(*GAME)
             .agg(F.count("*").alias("_n"), F.min("team").alias("_a"), F.max("team").alias("_b"))
             .where("_n = 2").drop("_n"))
    per_second = (ticks.join(teams, GAME).groupBy(*GAME, "_abs", "_a", "_b")
                  .agg(F.sum(F.when(F.col("team") == F.col("_a"), F.col("g")).otherwise(-F.col("g")))
                       .alias("lead")))
    earlier = W.partitionBy(*GAME).orderBy("_abs").rangeBetween(W.unboundedPreceding, -1)
    state = per_second.withColumn("lead", F.coalesce(F.sum("lead").over(earlier), F.lit(0)))
    cap = rules.score_cap
    seen = F.when(F.col("team") == F.col("_a"), F.col("lead")).when(F.col("team") == F.col("_b"), -F.col("lead"))
    return (timed.join(state, [*GAME, "_abs"], "left")
            .withColumn("score_state", F.least(F.greatest(F.coalesce(seen, F.lit(0)), F.lit(-cap)), F.lit(cap))
                        .cast("double"))
            .drop("_abs", "_a", "_b", "lead"))
