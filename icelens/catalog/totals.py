"""Queries for season statistics."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from icelens.catalog.intervals import base_stints, measured_stints
from icelens.catalog.registry import register
from icelens.operators import aggregate as agg
from icelens.operators.attach import tag_strength
from icelens.operators.perspective import goalie_stints, player_stints
from icelens.plans import season, stats
from icelens.plans.stats import LeagueTables
from icelens.session import shared_folder
from icelens.sources.league_views import LEAGUE_RULES as RULES, league
from icelens.sources.tables import TableStore

K = "season player_id:l situation "


def tables(view) -> LeagueTables:
    return LeagueTables(
        shifts=view("clean_v"), goals=view("goals_v"), shots=view("shots_v"), faceoffs=view("faceoffs_v"),
        penalties=view("penalties_v"), possession=view("possession_v"), roster=view("roster_v"),
        schedule=view("schedule_v"), standings=view("standings_v"), box_skaters=view("box_skater_v"),
        box_goalies=view("box_goalie_v"), goalie_logs=view("goalie_logs_v"), bios=view("bios_v"))


def skater_table(view) -> DataFrame:
    t = tables(view)
    return stats.skater_stats(t, stats.measured_stints(t, RULES), RULES)


def goalie_table(view) -> DataFrame:
    t = tables(view)
    return stats.goalie_stats(t, stats.measured_stints(t, RULES), RULES)


def _totals(view) -> DataFrame:
    return agg.player_totals(player_stints(measured_stints(view)))


@register("skater_gp", "season player_id:l gp:l", "SELECT * FROM skater_gp_o")
def _(spark, folder):
    view = league(spark, folder)
    return agg.skater_gp(view("box_skater_v"), view("clean_v").where("not is_goalie"))


@register("goalie_gp", "season player_id:l gp:l", "SELECT * FROM goalie_gp_o")
def _(spark, folder):
    view = league(spark, folder)
    return agg.goalie_gp(view("box_goalie_v"), view("clean_v"))


@register("skater_toi", K + "toi:r6", "SELECT * FROM skater_toi_o")
def _(spark, folder):
    view = league(spark, folder)
    return agg.skater_toi(agg.player_totals(player_stints(base_stints(view))), view("box_skater_v"))


@register("onice_stats", K + "gf_pct:r6 xgf_pct:r6 pdo:r6", "SELECT * FROM ptot_o")
def _(spark, folder):
    return _totals(league(spark, folder))


@register("zone_counts", K + "off_zone_starts:l neu_zone_starts:l def_zone_starts:l", "SELECT * FROM ptot_o")
def _(spark, folder):
    return _totals(league(spark, folder))


def _event_totals(view) -> DataFrame:
    credits = agg.credited(view("shots_v"), view("goals_v"), view("possession_v"), view("penalties_v"), RULES)
    return agg.event_totals(credits, base_stints(view), RULES)


@register("goals_assists", K + "goals:l first_assists:l second_assists:l total_assists:l total_points:l", """
SELECT *, first_assists + second_assists AS total_assists, goals + first_assists + second_assists AS total_points
FROM etot_o WHERE goals + first_assists + second_assists > 0""")
def _(spark, folder):
    out = _event_totals(league(spark, folder)).withColumn("total_assists", F.col("first_assists") + F.col("second_assists"))
    return out.withColumn("total_points", F.col("goals") + F.col("total_assists")).where("total_points > 0")


@register("possession_counts", K + "hits:l hits_taken:l giveaways:l takeaways:l", """
SELECT * FROM etot_o WHERE hits + hits_taken + giveaways + takeaways > 0""")
def _(spark, folder):
    return _event_totals(league(spark, folder)).where("hits + hits_taken + giveaways + takeaways > 0")


@register("penalty_counts", K + "penalties_drawn:l total_penalties:l", """
SELECT * FROM etot_o WHERE penalties_drawn + total_penalties > 0""")
def _(spark, folder):
    return _event_totals(league(spark, folder)).where("penalties_drawn + total_penalties > 0")


@register("player_xg", "season player_id:l ixg_all:r6 ixg_5v5:r6", """
SELECT season, shooter_id AS player_id, SUM(xg) AS ixg_all, COALESCE(SUM(xg) FILTER (strength = '5v5'), 0) AS ixg_5v5
FROM tagged_shots_o WHERE shooter_id IS NOT NULL GROUP BY ALL""")
def _(spark, folder):
    view = league(spark, folder)
    shots = tag_strength(view("shots_v").where("shooter_id is not null"), base_stints(view), RULES)
    return shots.groupBy("season", F.col("shooter_id").alias("player_id")).agg(
        F.sum("xg").alias("ixg_all"),
        F.coalesce(F.sum(F.when(F.col("strength") == "5v5", F.col("xg"))), F.lit(0.0)).alias("ixg_5v5"))


@register("goalie_toi", K + "toi:r6", "SELECT * FROM goalie_toi_o")
def _(spark, folder):
    return agg.goalie_toi(goalie_stints(base_stints(league(spark, folder))))


FACED = ("shots_against:l saves:l goals_against:l sv_pct:r6 gaa:r6 xg_against:r6 rebound_attempts_against:l "
         "rebound_xg_against:r6 " + " ".join(f"{z}_shots_against:l {z}_saves:l {z}_goals_against:l {z}_xg_against:r6"
                                             for z in ("hd", "md", "ld")))


@register("goalie_shots", K + FACED, "SELECT * FROM goalie_shots_o")
def _(spark, folder):
    view = league(spark, folder)
    t = tables(view)
    stints = stats.measured_stints(t, RULES)
    return agg.goalie_shots(tag_strength(t.shots, stints, RULES), agg.goalie_toi(goalie_stints(stints)), RULES)


@register("game_gsax", "season player_id:l game_id:l shots_against:l goals_against:l xg_against:r6 gsax:r6",
          "SELECT * FROM game_gsax_o")
def _(spark, folder):
    return agg.game_gsax(league(spark, folder)("shots_v"))


@register("danger_tier", "season game_id:l seq:l xg:r6 tier", "SELECT * FROM tagged_shots_o")
def _(spark, folder):
    from icelens.functions.labels import danger
    return league(spark, folder)("shots_v").withColumn("tier", danger(F.col("xg"), RULES))


SKATER = ("player team position specific_position gp:l toi:r6 goals:l total_assists:l first_assists:l second_assists:l "
          "total_points:l ixg:r6 hits:l hits_taken:l giveaways:l takeaways:l penalties_drawn:l total_penalties:l "
          "off_zone_starts:l neu_zone_starts:l def_zone_starts:l gf_pct:r6 xgf_pct:r6 pdo:r6")


@register("skater_stats", K + SKATER, "SELECT * FROM skater_stats_o")
def _(spark, folder):
    return skater_table(league(spark, folder))


@register("goalie_stats", K + "player team gp:l toi:r6 " + FACED, "SELECT * FROM goalie_stats_o")
def _(spark, folder):
    return goalie_table(league(spark, folder))


@register("stats_all", K + "position gp:l toi:r6", """
SELECT season, player_id, situation, position, gp, toi FROM skater_stats_o UNION ALL
SELECT season, player_id, situation, position, gp, toi FROM goalie_stats_o""")
def _(spark, folder):
    t = tables(league(spark, folder))
    store = TableStore(spark, f"{shared_folder(spark)}/tables-{uuid.uuid4().hex}")
    return season.save_stats(store, t, stats.measured_stints(t, RULES), RULES)


@register("toi_totals", K + "toi:r6 gp:l", """
SELECT season, player_id, situation, SUM(toi) AS toi, SUM(gp) AS gp FROM skater_stats_o GROUP BY ALL""")
def _(spark, folder):
    return agg.toi_totals(skater_table(league(spark, folder)))


@register("goalie_record", "season player_id:l w:l l:l ot_so:l shutouts:l", """
SELECT season, player_id, COUNT(*) FILTER (result = 'W') AS w, COUNT(*) FILTER (result = 'L') AS l,
 COUNT(*) FILTER (result = 'O') AS ot_so, SUM(shutouts) AS shutouts FROM goalie_logs_v GROUP BY ALL""")
def _(spark, folder):
    return agg.goalie_record(league(spark, folder)("goalie_logs_v"))


START_SQL = """
SELECT g.season, g.player_id, SUM(CASE WHEN gsax >= 1.5 THEN 1 WHEN l.player_id IS NOT NULL THEN 0 END)*1.0/gp AS gre_score,
 SUM(CASE WHEN gsax >= 0 THEN 1 WHEN l.player_id IS NOT NULL THEN 0 END)*1.0/gp AS qal_score,
 -SUM(CASE WHEN gsax < 0 THEN 1 WHEN l.player_id IS NOT NULL THEN 0 END)*1.0/gp AS bad_score,
 -SUM(CASE WHEN gsax <= -1.5 THEN 1 WHEN l.player_id IS NOT NULL THEN 0 END)*1.0/gp AS awf_score
FROM goalie_gp_o g LEFT JOIN goalie_logs_v l USING (season, player_id)
LEFT JOIN game_gsax_o x ON (x.season, x.player_id, x.game_id) = (l.season, l.player_id, l.game_id)
GROUP BY g.season, g.player_id, gp"""


@register("start_quality", "season player_id:l gre_score:r6 qal_score:r6 bad_score:r6 awf_score:r6", START_SQL)
def _(spark, folder):
    view = league(spark, folder)
    gp = agg.goalie_gp(view("box_goalie_v"), view("clean_v"))
    return agg.start_quality(view("goalie_logs_v"), agg.game_gsax(view("shots_v")), gp, RULES)


@register("calibration", "season actual:l predicted:r6 error:r6 max_error:r6", """
SELECT *, MAX(error) OVER () AS max_error FROM (
 SELECT season, COUNT(*) FILTER (event_type = 'goal') AS actual, SUM(xg) AS predicted,
  ABS(SUM(xg) - COUNT(*) FILTER (event_type = 'goal'))/NULLIF(COUNT(*) FILTER (event_type = 'goal'), 0) AS error
 FROM shots_v GROUP BY season)""")
def _(spark, folder):
    shots = league(spark, folder)("shots_v").withColumn("goal", (F.col("event_type") == "goal").cast("int"))
    return agg.calibration(shots)


@register("weighted_r2", "l_returnflag r2:r6", """
WITH r AS (SELECT l_returnflag, l_quantity AS w, l_extendedprice AS y, 1500*l_quantity + 20 AS p FROM lineitem),
 m AS (SELECT l_returnflag, SUM(w*y)/SUM(w) AS mean FROM r GROUP BY ALL)
SELECT l_returnflag, 1 - SUM(w*(y - p)*(y - p))/SUM(w*(y - mean)*(y - mean)) AS r2
FROM r JOIN m USING (l_returnflag) GROUP BY l_returnflag""")
def _(spark, folder):
    rows = (spark.read.parquet(f"{folder}/lineitem.parquet")
            .select("l_returnflag", "l_quantity", "l_extendedprice", (F.col("l_quantity") * 1500 + 20).alias("p")))
    return agg.weighted_r2(rows, ["l_returnflag"], "l_extendedprice", "p", "l_quantity")
