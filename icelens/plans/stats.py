"""Season statistics of skaters and goalies, all seasons and situations in one plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from icelens.config import DEFAULT_RULES, GOALIE_SITUATIONS, SKATER_SITUATIONS, Rules
from icelens.operators import aggregate as agg
from icelens.operators.attach import attach_shots, tag_strength
from icelens.operators.context import attach_zone_start
from icelens.operators.perspective import goalie_stints, player_stints
from icelens.operators.stints import build_stints
from icelens.session import settle

PLAYER = ["season", "player_id"]
COUNTS = ["gp", "toi", *agg.CREDITS, "off_zone_starts", "neu_zone_starts", "def_zone_starts"]


@dataclass
class LeagueTables:
    """The flat event tables; ``shots`` carries xg, ``shifts`` integer seconds and is_goalie."""
    shifts: DataFrame
    goals: DataFrame
    shots: DataFrame
    faceoffs: DataFrame
    penalties: DataFrame
    possession: DataFrame
    roster: DataFrame
    schedule: DataFrame
    standings: DataFrame
    box_skaters: DataFrame
    box_goalies: DataFrame
    goalie_logs: DataFrame
    bios: DataFrame


def measured_stints(t: LeagueTables, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Stints with shots and zone starts, written once because every statistic reads them."""
    return settle(build_stints(t.shifts, t.goals, rules).transform(attach_shots, t.shots)
                  .transform(attach_zone_start, t.faceoffs), "stints")


def _roster(roster: DataFrame, positions: tuple, situations: tuple) -> DataFrame:
    return (roster.where(F.col("position").isin(*positions))
            .groupBy(*PLAYER).agg(F.min_by(F.struct("player", "team", "position", "specific_position"), "team").alias("_r"))
            .select(*PLAYER, "_r.*", F.explode(F.array(*[F.lit(s) for s in situations])).alias("situation")))


def skater_stats(t: LeagueTables, stints: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """One row per rostered skater, season and situation; missing counts are 0, missing rates null."""
    totals = agg.player_totals(player_stints(stints))
    events = agg.event_totals(agg.credited(t.shots, t.goals, t.possession, t.penalties, rules), stints, rules)
    out = (_roster(t.roster, ("F", "D"), SKATER_SITUATIONS)
           .join(agg.skater_gp(t.box_skaters, t.shifts.where("not is_goalie")), PLAYER, "left")
           .join(totals.drop("gf", "ga", "xgf", "xga", "sogf", "soga"), [*PLAYER, "situation"], "left")
           .join(events, [*PLAYER, "situation"], "left"))
    # The season's box score replaces the all-situation minutes where there is one.
    boxed = t.box_skaters.groupBy(*PLAYER).agg(F.sum("toi").alias("_box"))
    seasons = t.box_skaters.select("season").distinct().withColumn("_has", F.lit(True))
    out = out.join(boxed, PLAYER, "left").join(seasons, "season", "left")
    toi = F.when((F.col("situation") == "all") & F.col("_has"), F.col("_box")).otherwise(F.col("stint_toi"))
    out = out.withColumn("toi", toi).drop("_box", "_has", "stint_toi").fillna(0, COUNTS)
    return out.withColumns({"total_assists": F.col("first_assists") + F.col("second_assists")}) \
              .withColumn("total_points", F.col("goals") + F.col("total_assists"))


GOALIE_COUNTS = ["gp", "toi", "shots_against", "saves", "goals_against", "rebound_attempts_against",
                 "rebound_xg_against", *[f"{z}_{n}" for z in ("hd", "md", "ld")
                                         for n in ("shots_against", "saves", "goals_against", "xg_against")]]


def goalie_stats(t: LeagueTables, stints: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """One row per rostered goalie, season and situation."""
    toi = agg.goalie_toi(goalie_stints(stints))
    faced = agg.goalie_shots(tag_strength(t.shots.where(F.col("goalie_id").isNotNull()), stints, rules), toi, rules)
    return (_roster(t.roster, ("G",), GOALIE_SITUATIONS)
            .join(agg.goalie_gp(t.box_goalies, t.shifts), PLAYER, "left")
            .join(toi, [*PLAYER, "situation"], "left")
            .join(faced, [*PLAYER, "situation"], "left")
            .fillna(0, GOALIE_COUNTS))
