"""Queries for single expressions and plain relational shapes."""

from __future__ import annotations

from pyspark.sql import functions as F

from icelens.catalog.ingest import PRIOR_SQL, full_shots
from icelens.catalog.intervals import base_stints
from icelens.catalog.registry import register
from icelens.functions import clock, geometry, labels
from icelens.operators.attach import tag_strength
from icelens.sources.league_views import LEAGUE_RULES as RULES, league


@register("clock_parse", "season game_id:l sort_order:l strict:l lenient:r1 valid:b", """
SELECT *, CASE WHEN regexp_full_match(t, '\\d{1,2}:\\d{2}') THEN CAST(split_part(t, ':', 1) AS INT)*60 + CAST(split_part(t, ':', 2) AS INT) END AS strict,
 CASE WHEN t LIKE '%:%' THEN TRY_CAST(split_part(t, ':', 1) AS INT)*60 + TRY_CAST(split_part(t, ':', 2) AS INT) END AS lenient,
 COALESCE(regexp_full_match(t, '\\d{1,2}:\\d{2}'), FALSE) AS valid
FROM (SELECT *, CASE WHEN sort_order % 11 = 0 THEN 'x:10' WHEN sort_order % 13 = 0 THEN '1210' ELSE ltrim(time, '0') END AS t FROM plays_v)""")
def _(spark, folder):
    t = F.when(F.col("sort_order") % 11 == 0, "x:10").when(F.col("sort_order") % 13 == 0, "1210").otherwise(F.ltrim("time", F.lit("0")))
    return league(spark, folder)("plays_v").withColumn("t", t).withColumns({
        "strict": clock.seconds(F.col("t")), "lenient": clock.lenient_seconds(F.col("t")), "valid": clock.is_clock(F.col("t"))})


@register("abs_clock", "season game_id:l seq:l abs_sec:l", "SELECT *, (period - 1)*28800 + sec AS abs_sec FROM pbp_v")
def _(spark, folder):
    return league(spark, folder)("pbp_v").withColumn(
        "abs_sec", clock.absolute_second(F.col("period"), F.col("sec"), RULES.period_seconds))


@register("season_shift", "season n:l prev next earlier", """
SELECT season, COUNT(*) AS n, printf('%d-%d', y - 1, y) AS prev, printf('%d-%d', y + 1, y + 2) AS next,
 printf('%d-%d,%d-%d', y - 1, y, y - 2, y - 1) AS earlier FROM (SELECT season, CAST(substr(season, 1, 4) AS INT) AS y FROM pbp_v) GROUP BY season, y""")
def _(spark, folder):
    s = F.col("season")
    return league(spark, folder)("pbp_v").groupBy("season").agg(F.count("*").alias("n")).withColumns({
        "prev": clock.shift_season(s, -1), "next": clock.shift_season(s, 1),
        "earlier": F.concat_ws(",", clock.previous_seasons(s, 2))})


@register("shot_geometry", "season game_id:l seq:l distance:r6 angle:r6", """
SELECT *, sqrt(dx*dx + y*y) AS distance, degrees(atan2(abs(y), abs(dx))) AS angle
FROM (SELECT *, CASE WHEN x >= 0 THEN 89 - x ELSE -89 - x END AS dx FROM shots_v)""")
def _(spark, folder):
    x, y = F.col("x").cast("double"), F.col("y").cast("double")
    return league(spark, folder)("shots_v").withColumns({"distance": geometry.distance(x, y), "angle": geometry.angle(x, y)})


FEATURES = ("distance:r6 angle:r6 behind_net:l prior_event_elapsed:r1 distance_change:r6 shot_speed:r6 is_rebound:l is_rush:l "
            "crossed_royal_road:l lateral_movement:r1 same_team_as_prior:l prior_event_type period_number:l shot_type goal:l")


def dist(x: str, y: str) -> str:
    return f"sqrt(pow(CASE WHEN {x} >= 0 THEN 89 - {x} ELSE -89 - {x} END, 2) + {y}*{y})"


def secs(t: str) -> str:
    return f"(CAST(split_part({t}, ':', 1) AS INT)*60 + CAST(split_part({t}, ':', 2) AS INT))"


FEATURE_SQL = f"""
SELECT * EXCLUDE (prior_event_type, shot_type), CAST(COALESCE(abs(x) > 89, FALSE) AS INT) AS behind_net, elapsed AS prior_event_elapsed,
 CASE WHEN known THEN distance - {dist('prior_event_x', 'prior_event_y')} END AS distance_change,
 CASE WHEN known AND elapsed > 0 AND travel IS NOT NULL THEN LEAST(50, travel/elapsed) END AS shot_speed,
 CAST(COALESCE(known AND prior_event_type IN ('goal', 'shot-on-goal', 'missed-shot', 'blocked-shot') AND elapsed <= 3, FALSE) AS INT) AS is_rebound,
 CAST(COALESCE(known AND elapsed <= 5 AND travel >= 40, FALSE) AS INT) AS is_rush,
 CAST(COALESCE(known AND sign(y) <> sign(prior_event_y) AND y <> 0 AND prior_event_y <> 0, FALSE) AS INT) AS crossed_royal_road,
 CASE WHEN known THEN abs(y - prior_event_y) END AS lateral_movement,
 CAST(COALESCE(known AND prior_event_team = team, FALSE) AS INT) AS same_team_as_prior,
 CASE WHEN known THEN prior_event_type ELSE 'none' END AS prior_event_type, LEAST(period, 4) AS period_number,
 COALESCE(shot_type, 'unknown') AS shot_type, CAST(event_type = 'goal' AS INT) AS goal
FROM (SELECT *, {dist('x', 'y')} AS distance, degrees(atan2(abs(y), abs(CASE WHEN x >= 0 THEN 89 - x ELSE -89 - x END))) AS angle,
  GREATEST(0, {secs('time')} - {secs('prior_event_time')}) AS elapsed_raw,
  CASE WHEN prior_event_time IS NOT NULL THEN GREATEST(0, {secs('time')} - {secs('prior_event_time')}) END AS elapsed,
  prior_event_x IS NOT NULL AND prior_event_y IS NOT NULL AND prior_event_time IS NOT NULL AS known,
  sqrt(pow(x - prior_event_x, 2) + pow(y - prior_event_y, 2)) AS travel
 FROM ({PRIOR_SQL}))"""


@register("shot_features", "season game_id:l sort_order:l " + FEATURES, FEATURE_SQL)
def _(spark, folder):
    return geometry.shot_features(full_shots(league(spark, folder)), RULES)


HAND_SQL = """
SELECT h.*, COALESCE(s.shoots_catches, 'unknown') AS shooter_shoots, COALESCE(g.shoots_catches, 'unknown') AS goalie_catches,
 CAST(COALESCE((s.shoots_catches = 'R' AND y*m < 0) OR (s.shoots_catches = 'L' AND y*m > 0), FALSE) AS INT) AS off_wing
FROM (SELECT *, CASE WHEN x >= 0 THEN 1 ELSE -1 END AS m FROM {0}) h
LEFT JOIN bios_v s ON s.player_id = h.shooter_id LEFT JOIN bios_v g ON g.player_id = h.goalie_id"""


@register("off_wing", "season game_id:l seq:l shooter_shoots goalie_catches off_wing:l", HAND_SQL.format("shots_v"))
def _(spark, folder):
    view = league(spark, folder)
    return geometry.attach_hands(view("shots_v"), view("bios_v"))


XG_SQL = f"""
WITH f AS (SELECT * FROM ({FEATURE_SQL}) WHERE event_type <> 'blocked-shot'), t AS (SELECT *, {secs('time')} AS sec FROM f),
 h AS ({HAND_SQL.format('t')}), two AS (SELECT game_id, MIN(team) AS ta FROM h GROUP BY game_id HAVING COUNT(DISTINCT team) = 2),
 st AS (SELECT h.season, h.game_id, h.sort_order, LEAST(3, GREATEST(-3, CASE WHEN two.ta IS NULL THEN 0
   ELSE COUNT(*) FILTER (o.team = h.team) - COUNT(*) FILTER (o.team <> h.team) END)) AS score_state
  FROM h LEFT JOIN two USING (game_id) LEFT JOIN (SELECT * FROM h WHERE goal = 1) o ON o.game_id = h.game_id
   AND (o.period - 1)*28800 + o.sec < (h.period - 1)*28800 + h.sec GROUP BY h.season, h.game_id, h.sort_order, h.team, two.ta)
SELECT h.*, h.sort_order AS seq, st.score_state, COALESCE(x.strength, 'unknown') AS strength FROM h JOIN st USING (season, game_id, sort_order)
LEFT JOIN strength_o x USING (season, game_id, period, sec, team)"""


@register("xg_training", "season game_id:l seq:l " + FEATURES + " shooter_shoots goalie_catches off_wing:l score_state:l strength", XG_SQL)
def _(spark, folder):
    from icelens.catalog.models import xg_table
    return xg_table(spark, folder)


@register("role_label", "c_custkey:l role", """
SELECT c_custkey, CASE pos WHEN 'G' THEN CASE WHEN share >= 0.6 THEN 'Starter' WHEN share >= 0.5 THEN 'Tandem (1A)' WHEN share >= 0.4 THEN 'Tandem (1B)'
  WHEN share >= 0.1 THEN 'Backup' ELSE 'Fringe' END
 WHEN 'D' THEN CASE WHEN a >= 22 THEN 'First Pair' WHEN a > 18 THEN 'Second Pair' WHEN a > 13 THEN 'Third Pair' ELSE 'Fringe' END
 ELSE CASE WHEN a >= 18 THEN 'First Line' WHEN a > 15.5 THEN 'Second Line' WHEN a > 13.5 THEN 'Third Line' WHEN a > 9 THEN 'Fourth Line' ELSE 'Fringe' END END AS role
FROM (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'G' WHEN 1 THEN 'D' ELSE 'F' END AS pos, (c_custkey % 82)/82.0 AS share,
 c_acctbal/NULLIF(c_custkey % 82, 0)/10 AS a FROM customer)""")
def _(spark, folder):
    position = F.when(F.col("c_custkey") % 3 == 0, "G").when(F.col("c_custkey") % 3 == 1, "D").otherwise("F")
    return spark.read.parquet(f"{folder}/customer.parquet").select(
        "c_custkey", labels.role(position, F.col("c_custkey") % 82, F.col("c_acctbal") / 10, F.lit(82)).alias("role"))


@register("age_at", "season player_id:l age:l", """
SELECT season, player_id, date_diff('year', birth_date, make_date(CAST(substr(season, 1, 4) AS INT), 9, 1))
 - CASE WHEN (month(birth_date), day(birth_date)) > (9, 1) THEN 1 ELSE 0 END AS age FROM roster_v JOIN bios_v USING (player_id)""")
def _(spark, folder):
    view = league(spark, folder)
    return view("roster_v").join(view("bios_v"), "player_id").withColumn("age", labels.age(F.col("season"), F.col("birth_date")))


@register("category_clamp", "season game_id:l seq:l kind", """
SELECT *, CASE WHEN type IN ('goal', 'shot-on-goal', 'faceoff') THEN type ELSE 'unknown' END AS kind FROM pbp_v""")
def _(spark, folder):
    return league(spark, folder)("pbp_v").withColumn("kind", labels.clamp_category(F.col("type"), ["goal", "shot-on-goal", "faceoff"]))


TRAINED = ["5v5", "5v4", "4v5", "3v3", "EN_for"]


@register("nearest_key", "strength n:l model", """
WITH s AS (SELECT strength, COUNT(*) AS n FROM tagged_shots_o GROUP BY ALL), c AS (SELECT unnest(['5v5', '5v4', '4v5', '3v3']) AS cand),
 d AS (SELECT s.*, cand, abs((CAST(cand[1] AS INT) - CAST(cand[3] AS INT)) - (o - p)) AS gap,
   abs(CAST(cand[1] AS INT) - o) + abs(CAST(cand[3] AS INT) - p) AS far FROM (
   SELECT *, LEAST(5, GREATEST(3, CAST(regexp_extract(strength, '^(\\d+)v(\\d+)', 1) AS INT))) AS o,
    LEAST(5, GREATEST(3, CAST(regexp_extract(strength, '^(\\d+)v(\\d+)', 2) AS INT))) AS p FROM s WHERE regexp_matches(strength, '^\\d+v\\d+')) s, c)
SELECT strength, n, CASE WHEN strength IN ('5v5', '5v4', '4v5', '3v3', 'EN_for') THEN strength WHEN NOT regexp_matches(strength, '^\\d+v\\d+') THEN '5v5'
 ELSE (SELECT arg_min(cand, (gap, far, cand)) FROM d WHERE d.strength = s.strength) END AS model FROM s""")
def _(spark, folder):
    view = league(spark, folder)
    tagged = tag_strength(view("shots_v"), base_stints(view), RULES)
    return tagged.groupBy("strength").agg(F.count("*").alias("n")).withColumn("model", labels.nearest_strength(F.col("strength"), TRAINED))


@register("semi_filter", "c_custkey:l c_name", """
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)""")
def _(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return spark.read.parquet(f"{folder}/customer.parquet").select("c_custkey", "c_name").join(orders, "c_custkey", "left_semi")


@register("union_setops", "kind key:l", """
SELECT 'union' AS kind, key FROM (SELECT o_custkey AS key FROM orders UNION SELECT c_custkey FROM customer) UNION ALL
SELECT 'difference', c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def _(spark, folder):
    buyers = spark.read.parquet(f"{folder}/orders.parquet").select(F.col("o_custkey").alias("key")).distinct()
    people = spark.read.parquet(f"{folder}/customer.parquet").select(F.col("c_custkey").alias("key"))
    both = buyers.unionByName(people).distinct().withColumn("kind", F.lit("union"))
    return both.unionByName(people.join(buyers, "key", "left_anti").withColumn("kind", F.lit("difference")))
