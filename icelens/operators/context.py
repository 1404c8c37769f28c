"""Circumstances of a stint: special-teams change, faceoff zone, home ice, rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from icelens.config import DEFAULT_RULES, PERIOD_KEYS, Rules
from icelens.operators.attach import attach_score_state, attach_xg
from icelens.operators.perspective import STATES

#: What each step adds to the regression, from the attacking (off) or the defending (def) side.
MODEL = {
    "attach_zone_start": [f"off_zone_{z}" for z in "odn"],
    "attach_score_state": [f"off_{lead}{goals}" for lead in ("up", "down") for goals in (1, 2, 3)],
    "attach_expiry": ["off_ppx", "off_pkx"],
    "attach_on_the_fly": ["off_otf"],
    "attach_home": ["off_home"],
    "attach_back_to_back": ["off_b2b", "def_b2b"],
    "attach_interactions": ["off_score_x_o", "off_score_x_d"] + [f"{s}_{k}_x_home" for k in ("ppx", "pkx") for s in ("off", "def")],
    "even_pooled_rows": list(STATES),
}
CONTEXT_COLUMNS = tuple(column for columns in MODEL.values() for column in columns)


def _previous() -> tuple[Column, Column, Column]:
    """Skater counts and end of the stint before, in the same period.

    Stints are unique per (period, start), so this window is bounded by the clock.
    """
    by_start = W.partitionBy(*PERIOD_KEYS).orderBy("start_sec")
    return (F.lag("a_n").over(by_start), F.lag("b_n").over(by_start), F.lag("end_sec").over(by_start))


def attach_expiry(stints: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """``ppx``/``pkx``: even strength within seconds of the end of a power play or kill."""
    prev_a, prev_b, prev_end = _previous()
    just = (prev_a != prev_b) & (F.col("start_sec") - prev_end <= rules.change_window_seconds) \
        & (F.col("a_n") == F.col("b_n"))
    a_side = F.coalesce(just & (prev_a > prev_b), F.lit(False)).cast("int")
    b_side = F.coalesce(just & (prev_a < prev_b), F.lit(False)).cast("int")
    return stints.withColumns({"a_ppx": a_side, "b_ppx": b_side, "a_pkx": b_side, "b_pkx": a_side})


def attach_on_the_fly(stints: DataFrame, faceoffs: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """``otf``: uneven stints right after an even one, without a faceoff at their start."""
    prev_a, prev_b, prev_end = _previous()
    changed = F.coalesce((prev_a == prev_b) & (F.col("a_n") != F.col("b_n"))
                         & (F.col("start_sec") - prev_end <= rules.change_window_seconds), F.lit(False))
    drops = (faceoffs.where(F.col("sec").isNotNull())
             .select(*PERIOD_KEYS, F.col("sec").alias("start_sec")).distinct()
             .withColumn("_drop", F.lit(True)))
    flagged = stints.withColumn("_changed", changed).join(drops, [*PERIOD_KEYS, "start_sec"], "left")
    otf = (F.col("_changed") & F.col("_drop").isNull()).cast("int")
    return flagged.withColumns({"a_otf": otf, "b_otf": otf}).drop("_changed", "_drop")


def attach_zone_start(stints: DataFrame, faceoffs: DataFrame) -> DataFrame:
    """Zone of the first faceoff in a stint's first second, seen by each side.

    ``faceoffs.zone`` is relative to the winner (``team``); ``seq`` orders one second's draws.
    """
    first = (faceoffs.where(F.col("sec").isNotNull())
             .groupBy(*PERIOD_KEYS, F.col("sec").alias("start_sec"))
             .agg(F.min_by(F.struct("team", "zone"), "seq").alias("_f")))
    joined = stints.join(first, [*PERIOD_KEYS, "start_sec"], "left")
    zone = F.when(F.col("_f.zone").isin("O", "D", "N"), F.col("_f.zone"))
    mirrored = F.when(zone == "O", "D").when(zone == "D", "O").otherwise(zone)
    a_zone = F.when(F.col("_f.team") == F.col("team_a"), zone).when(F.col("_f.team") == F.col("team_b"), mirrored)
    b_zone = F.when(F.col("_f.team") == F.col("team_b"), zone).when(F.col("_f.team") == F.col("team_a"), mirrored)
    flags = {f"{side}_zone_{z.lower()}": F.coalesce((value == z), F.lit(False)).cast("int")
             for side, value in (("a", a_zone), ("b", b_zone)) for z in "ODN"}
    return joined.withColumns(flags).drop("_f")


def attach_home(stints: DataFrame, schedule: DataFrame) -> DataFrame:
    home = schedule.groupBy("season", "game_id").agg(F.min("home_team").alias("_home"))
    out = stints.join(home, ["season", "game_id"], "left")
    return out.withColumns({
        f"{s}_home": F.coalesce(F.col(f"team_{s}") == F.col("_home"), F.lit(False)).cast("int")
        for s in "ab"}).drop("_home")


def attach_back_to_back(stints: DataFrame, schedule: DataFrame) -> DataFrame:
    """``b2b``: the team also played the day before, whether or not it is listed in this game."""
    dates = schedule.groupBy("season", "game_id").agg(F.min("date").alias("_date"))
    days = (schedule.where(F.col("date").isNotNull())
            .select("season", F.date_add("date", 1).alias("_date"),
                    F.explode(F.array("home_team", "away_team")).alias("_team")).distinct()
            .withColumn("_hit", F.lit(1)))
    out = stints.join(dates, ["season", "game_id"], "left")
    for side in "ab":
        out = (out.join(days.withColumnsRenamed({"_team": f"team_{side}", "_hit": f"{side}_b2b"}),
                        ["season", "_date", f"team_{side}"], "left")
               .fillna(0, [f"{side}_b2b"]))
    return out.drop("_date")


def attach_interactions(stints: DataFrame) -> DataFrame:
    """Products of score and zone, and of expiry and home ice; absent inputs count as 0."""
    def col(name: str) -> Column:
        return F.col(name) if name in stints.columns else F.lit(0)

    return stints.withColumns({
        f"{s}_{name}": col(f"{s}_{left}") * col(f"{s}_{right}")
        for s in "ab"
        for name, left, right in (("score_x_o", "score_state", "zone_o"), ("score_x_d", "score_state", "zone_d"),
                                  ("ppx_x_home", "ppx", "home"), ("pkx_x_home", "pkx", "home"))})


def attach_context(stints: DataFrame, shots: DataFrame, goals: DataFrame, faceoffs: DataFrame,
                   schedule: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Every circumstance at once."""
    return (stints
            .transform(attach_xg, shots)
            .transform(attach_expiry, rules)
            .transform(attach_on_the_fly, faceoffs, rules)
            .transform(attach_zone_start, faceoffs)
            .transform(attach_score_state, goals, rules)
            .transform(attach_home, schedule)
            .transform(attach_back_to_back, schedule)
            .transform(attach_interactions))
