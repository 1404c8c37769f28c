"""Constant-lineup intervals rebuilt from overlapping shifts.

Scale notes. A game clock counts whole seconds, so after reduction to distinct
seconds one (season, game, period) holds at most as many rows as the period has
seconds, however many raw rows it has. Windows below only ever run over such reduced
groups. Raw shifts meet segments on (period, time slice), which spreads one hot period
over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from icelens.config import DEFAULT_RULES, PERIOD_KEYS, Rules
from icelens.functions.clock import is_clock, seconds
from icelens.operators.attach import add_sums


def clean_shifts(shifts: DataFrame) -> DataFrame:
    """Shifts with two valid clocks and a positive length, as integer seconds."""
    return (shifts
            .where(is_clock(F.col("start_time")) & is_clock(F.col("end_time")))
            .withColumns({"start_sec": seconds(F.col("start_time")), "end_sec": seconds(F.col("end_time"))})
            .where(F.col("end_sec") > F.col("start_sec")))


def flag_goalies(shifts: DataFrame, player_ids: DataFrame) -> DataFrame:
    """Mark shifts of the season's rostered goalies."""
    goalies = (player_ids.where(F.col("position") == "G")
               .select("season", "player_id").distinct().withColumn("_g", F.lit(True)))
    return (shifts.join(goalies, ["season", "player_id"], "left")
            .withColumn("is_goalie", F.coalesce("_g", F.lit(False))).drop("_g"))


def two_team_periods(shifts: DataFrame) -> DataFrame:
    """Periods in which exactly two teams have shifts, with both names in order."""
    return (shifts.select(*PERIOD_KEYS, "team").distinct()
            .groupBy(*PERIOD_KEYS)
            .agg(F.count("*").alias("_n"), F.min("team").alias("team_a"), F.max("team").alias("team_b"))
            .where("_n = 2").drop("_n"))


def boundary_segments(shifts: DataFrame) -> DataFrame:
    """Atomic segments between consecutive distinct shift boundaries of each period."""
    order = W.partitionBy(*PERIOD_KEYS).orderBy("seg_start")
    return (shifts
            .select(*PERIOD_KEYS, F.explode(F.array("start_sec", "end_sec")).alias("seg_start"))
            .distinct()
            .withColumns({"seg_end": F.lead("seg_start").over(order),
                          "is_first": F.lag("seg_start").over(order).isNull(),
                          "is_last": F.lead("seg_start", 2).over(order).isNull()})
            .where(F.col("seg_end").isNotNull()))


def segments(shifts: DataFrame) -> DataFrame:
    """Boundary segments of the two-team periods."""
    return boundary_segments(shifts).join(two_team_periods(shifts), PERIOD_KEYS)


def presence(shifts: DataFrame, who: list[str]) -> DataFrame:
    """Disjoint intervals during which ``who`` (columns besides the period keys) is on the ice.

    Overlapping and touching shifts are joined, so everyone counts once at any moment.
    Shifts with the same start are reduced first: a group has at most one row per second.
    """
    keys = [*PERIOD_KEYS, *who]
    order = W.partitionBy(*keys).orderBy("start_sec")
    reach = F.max("end_sec").over(order.rowsBetween(W.unboundedPreceding, -1))
    return (shifts.groupBy(*keys, "start_sec").agg(F.max("end_sec").alias("end_sec"))
            .withColumn("_new", F.when(F.col("start_sec") <= reach, 0).otherwise(1))
            .withColumn("_run", F.sum("_new").over(order))
            .groupBy(*keys, "_run").agg(F.min("start_sec").alias("start_sec"), F.max("end_sec").alias("end_sec"))
            .drop("_run"))


def _in_slices(present: DataFrame, segs: DataFrame, rules: Rules) -> DataFrame:
    """``on_ice`` with the time slice ``_slice`` of the segment's start, by which its rows are still dealt to tasks.

    A segment lies inside every interval that covers its start, so it is looked up only in
    the time slice of its start, while an interval is repeated for each slice it touches.
    """
    width = rules.slice_seconds
    sliced = present.withColumn("_slice", F.explode(F.sequence(
        F.floor(F.col("start_sec") / width), F.floor((F.col("end_sec") - 1) / width))))
    placed = segs.withColumn("_slice", F.floor(F.col("seg_start") / width))
    return (placed.join(sliced, [*PERIOD_KEYS, "_slice"])
            .where((F.col("start_sec") <= F.col("seg_start")) & (F.col("end_sec") > F.col("seg_start")))
            .drop("start_sec", "end_sec"))


def on_ice(present: DataFrame, segs: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """One row per (segment, presence interval covering it)."""
    return _in_slices(present, segs, rules).drop("_slice")


def _sided_presence(shifts: DataFrame) -> DataFrame:
    """Presence of each player for team a (``in_a``) or team b in the two-team periods."""
    sided = (shifts.join(two_team_periods(shifts), PERIOD_KEYS)
             .select(*PERIOD_KEYS, (F.col("team") == F.col("team_a")).alias("in_a"), "is_goalie", "player_id",
                     "start_sec", "end_sec"))
    return presence(sided, ["in_a", "is_goalie", "player_id"])


def count_skaters(segs: DataFrame, present: DataFrame) -> DataFrame:
    """Add ``a_n``/``b_n``: skaters of each side, by a running sum of arrivals and departures."""
    # Goalies are left out in the sums and not by a filter: so this reads what is shuffled for on_ice already.
    moves = present.select(*PERIOD_KEYS, F.explode(F.array(
        F.struct(F.col("start_sec").alias("seg_start"), F.lit(1).alias("by")),
        F.struct(F.col("end_sec").alias("seg_start"), F.lit(-1).alias("by")))).alias("_m"), "in_a", "is_goalie")
    in_a, skater = F.col("in_a"), ~F.col("is_goalie")
    per_second = moves.groupBy(*PERIOD_KEYS, "_m.seg_start").agg(
        F.sum(F.when(skater & in_a, F.col("_m.by"))).alias("_a"), F.sum(F.when(skater & ~in_a, F.col("_m.by"))).alias("_b"))
    # Every arrival and departure is a shift boundary, so it lands on a segment's start.
    so_far = W.partitionBy(*PERIOD_KEYS).orderBy("seg_start").rowsBetween(W.unboundedPreceding, 0)
    return (segs.join(per_second, [*PERIOD_KEYS, "seg_start"], "left")
            .withColumns({"a_n": F.coalesce(F.sum("_a").over(so_far), F.lit(0)).cast("int"),
                          "b_n": F.coalesce(F.sum("_b").over(so_far), F.lit(0)).cast("int")}).drop("_a", "_b"))


def lineups(shifts: DataFrame, segs: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Who is on the ice in each segment; sides of 0 or more than six skaters are dropped.

    Skaters are counted first, by a sweep over the clock. Only segments within bounds meet
    the players, so the arrays collected here never hold more than six entries. Rows are
    grouped in the slice where they met: the pairs of segment and player are not shuffled.
    """
    present = _sided_presence(shifts)
    bounds = [F.col(n).between(1, rules.max_skaters) for n in ("a_n", "b_n")]
    usable = count_skaters(segs.drop("is_first", "is_last"), present).where(bounds[0] & bounds[1])
    in_a, goalie = F.col("in_a"), F.col("is_goalie")

    def skaters(side: Column) -> Column:
        return F.array_sort(F.collect_list(F.when(side & ~goalie, F.col("player_id"))))

    return (_in_slices(present, usable, rules).groupBy(*PERIOD_KEYS, "_slice", "seg_start", *[
                c for c in usable.columns if c not in (*PERIOD_KEYS, "seg_start")])
            .agg(skaters(in_a).alias("a_skaters"), skaters(~in_a).alias("b_skaters"),
                 F.min(F.when(in_a & goalie, F.col("player_id"))).alias("a_goalie_id"),
                 F.min(F.when(~in_a & goalie, F.col("player_id"))).alias("b_goalie_id"))
            .drop("_slice").withColumns({"a_goalie_on": F.col("a_goalie_id").isNotNull(),
                          "b_goalie_on": F.col("b_goalie_id").isNotNull()}))


def segment_goals(segs: DataFrame, goals: DataFrame) -> DataFrame:
    """Add ``a_goals``/``b_goals``: open on the left, closed on the right.

    The first segment also owns its own start, the last one everything later.
    """
    return add_sums(segs, goals, {"goals": F.count("*")}, "tile", "seg_start", "seg_end")


def merge_lineups(lines: DataFrame) -> DataFrame:
    """Join touching neighbours with the same skaters and the same goalie on/off flags.

    The first segment's row stands for the whole interval, so its goalie is kept: a swap
    in goal does not split an interval.
    """
    order = W.partitionBy(*PERIOD_KEYS).orderBy("seg_start")
    so_far = order.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*PERIOD_KEYS)
    same = F.lag("seg_end").over(order) == F.col("seg_start")
    for column in ("a_skaters", "a_goalie_on", "b_skaters", "b_goalie_on"):
        same &= F.lag(column).over(order) == F.col(column)
    # A stint ends, and its goals end, where the next one of the period begins: one sort serves both steps.
    lines = lines.withColumns({"_same": F.coalesce(same, F.lit(False)), "_end": F.lag("seg_end").over(order),
                               "_last": F.max("seg_end").over(whole)})
    for side in "ab":
        lines = lines.withColumns({f"_{side}": F.coalesce(F.sum(f"{side}_goals").over(so_far), F.lit(0)),
                                   f"_{side}_all": F.sum(f"{side}_goals").over(whole)})
    return (lines.where("not _same")
            .withColumns({"end_sec": F.coalesce(F.lead("_end").over(order), F.col("_last")),
                          **{f"{side}_goals": F.coalesce(F.lead(f"_{side}").over(order), F.col(f"_{side}_all")) - F.col(f"_{side}")
                             for side in "ab"}})
            .select(*PERIOD_KEYS, F.col("seg_start").alias("start_sec"), "end_sec",
                    (F.col("end_sec") - F.col("seg_start")).alias("duration"),
                    "team_a", "a_skaters", "a_goalie_on", "a_goalie_id",
                    "team_b", "b_skaters", "b_goalie_on", "b_goalie_id", "a_goals", "b_goals", "a_n", "b_n"))


def build_stints(shifts: DataFrame, goals: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Maximal intervals of one period in which neither side's skaters change.

    ``shifts``: period keys, player_id, team, is_goalie (boolean), start_sec, end_sec.
    ``goals``: period keys, team, sec.
    """
    return merge_lineups(lineups(shifts, segment_goals(segments(shifts), goals), rules))
