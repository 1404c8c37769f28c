"""Queries for landed feeds, name resolution, incremental loads and stored tables.

The feeds themselves are derived from the driver's events by Spark: nested JSON and HTML
texts are built from the views and then parsed by the operators under test.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from icelens.catalog.registry import register
from icelens.config import REPORT_NAME_OVERRIDES
from icelens.functions.text import name_key
from icelens.operators.resolve import resolve_names
from icelens.session import shared_folder
from icelens.sources import feeds
from icelens.sources.league_views import LEAGUE_RULES as RULES, league
from icelens.sources.tables import TableStore
from icelens.streaming import incremental

G = "season game_id:l "


def play_feed(view) -> DataFrame:
    """Play-by-play documents of at most 64 plays."""
    details = F.struct(
        F.col("team_id").alias("eventOwnerTeamId"), F.col("x").alias("xCoord"), F.col("y").alias("yCoord"),
        F.col("zone").alias("zoneCode"), F.col("shot_type").alias("shotType"), F.col("scoring_player_id").alias("scoringPlayerId"),
        F.col("shooting_player_id").alias("shootingPlayerId"), F.col("goalie_id").alias("goalieInNetId"),
        F.col("assist1_id").alias("assist1PlayerId"), F.col("assist2_id").alias("assist2PlayerId"),
        F.col("committed_by_id").alias("committedByPlayerId"), F.col("drawn_by_id").alias("drawnByPlayerId"),
        F.col("penalty_type").alias("descKey"), "duration",
        F.when(F.col("type") == "hit", F.col("actor_id")).alias("hittingPlayerId"), F.col("hittee_id").alias("hitteePlayerId"),
        F.when(F.col("type") != "hit", F.col("actor_id")).alias("playerId"))
    play = F.struct("pos", F.col("sort_order").alias("sortOrder"), F.col("type").alias("typeDescKey"),
                    F.col("time").alias("timeInPeriod"),
                    F.struct(F.col("period").alias("number"), F.col("period_type").alias("periodType")).alias("periodDescriptor"),
                    details.alias("details"))
    pair = F.col("game_id") % 10000 * 2

    def team(n):
        return F.struct(n.alias("id"), F.concat(F.lit("T"), n.cast("string")).alias("abbrev"))

    return (view("plays_v").groupBy("season", "game_id", "doc_no").agg(F.array_sort(F.collect_list(play)).alias("plays"))
            .select("season", "game_id", "doc_no", F.to_json(F.struct(
                team(pair).alias("awayTeam"), team(pair + 1).alias("homeTeam"), "plays")).alias("payload")))


def parsed(spark, folder) -> DataFrame:
    return feeds.plays(play_feed(league(spark, folder)))


def full_shots(view) -> DataFrame:
    """Shot events with prior-event context, with the columns the strength tag needs."""
    shots = feeds.shots(view("plays_v"))
    part = F.split("time", ":")
    return shots.withColumns({"sec": part[0].cast("int") * 60 + part[1].cast("int"), "seq": F.col("sort_order")})


OK = "period IS NOT NULL AND time IS NOT NULL"
register("pbp_faceoffs", G + "sort_order:l period:l time team zone",
         f"SELECT * FROM plays_v WHERE type = 'faceoff' AND {OK} AND team IS NOT NULL")(
    lambda spark, folder: feeds.faceoffs(parsed(spark, folder)))
register("pbp_goals", G + "sort_order:l period:l time team assist1_id:l assist2_id:l",
         f"SELECT * FROM plays_v WHERE type = 'goal' AND period_type <> 'SO' AND {OK} AND team IS NOT NULL")(
    lambda spark, folder: feeds.goals(parsed(spark, folder)))
register("pbp_penalties", G + "sort_order:l period:l time team penalty_player_id:l drew_player_id:l penalty_type duration:l",
         f"""SELECT *, committed_by_id AS penalty_player_id, drawn_by_id AS drew_player_id FROM plays_v
         WHERE type = 'penalty' AND {OK} AND duration IS NOT NULL""")(
    lambda spark, folder: feeds.penalties(parsed(spark, folder)))
register("pbp_possession", G + "sort_order:l period:l time team event_type player_id:l hittee_id:l",
         f"""SELECT * EXCLUDE (hittee_id), type AS event_type, actor_id AS player_id, CASE WHEN type = 'hit' THEN hittee_id END AS hittee_id
         FROM plays_v WHERE type IN ('hit', 'giveaway', 'takeaway') AND {OK} AND actor_id IS NOT NULL""")(
    lambda spark, folder: feeds.possession(parsed(spark, folder)))

PRIOR_SQL = """
SELECT *, type AS event_type, CASE WHEN type = 'goal' THEN scoring_player_id ELSE shooting_player_id END AS shooter_id,
 CASE WHEN pp = period THEN pt END AS prior_event_type, CASE WHEN pp = period THEN pteam END AS prior_event_team,
 CASE WHEN pp = period THEN ptime END AS prior_event_time, CASE WHEN pp = period THEN px END AS prior_event_x,
 CASE WHEN pp = period THEN py END AS prior_event_y
FROM (SELECT *, LAG(type) OVER w AS pt, LAG(team) OVER w AS pteam, LAG(period) OVER w AS pp, LAG(time) OVER w AS ptime,
  LAG(x) OVER w AS px, LAG(y) OVER w AS py FROM plays_v
  WHERE type IS NOT NULL AND period IS NOT NULL AND time IS NOT NULL AND period_type <> 'SO'
  WINDOW w AS (PARTITION BY season, game_id ORDER BY sort_order))
WHERE type IN ('goal', 'shot-on-goal', 'missed-shot', 'blocked-shot') AND team IS NOT NULL"""
register("prior_event", G + "sort_order:l period:l time team event_type shot_type shooter_id:l goalie_id:l x:r1 y:r1 zone "
         "prior_event_type prior_event_team prior_event_time prior_event_x:r1 prior_event_y:r1", PRIOR_SQL)(
    lambda spark, folder: feeds.shots(parsed(spark, folder)))


def _clock(column: str) -> str:
    return f"CONCAT(LPAD(CAST(CAST(FLOOR({column}/60) AS BIGINT) AS VARCHAR(10)), 3, '0'), ':', LPAD(CAST({column} % 60 AS VARCHAR(10)), 2, '0'))"


CHART = f"""SELECT event_id, season, game_id AS gameId, CASE WHEN event_id % 13 = 0 THEN NULL ELSE player_id END AS playerId,
 'First' AS firstName, CONCAT('Last', CAST(player_id AS VARCHAR(10))) AS lastName,
 CASE WHEN event_id % 17 = 0 THEN NULL ELSE team END AS teamAbbrev, CASE WHEN event_id % 19 = 0 THEN NULL ELSE period END AS period,
 {_clock('start_sec')} AS startTime, CASE WHEN event_id % 23 = 0 THEN NULL ELSE {_clock('end_sec')} END AS endTime,
 {_clock('(end_sec - start_sec)')} AS duration FROM shifts_v"""


@register("shift_normalise", "game_id:l player_id:l player team period:l start_time end_time duration", f"""
SELECT gameId AS game_id, playerId AS player_id, concat(firstName, ' ', lastName) AS player, teamAbbrev AS team, period,
 startTime AS start_time, endTime AS end_time, duration FROM ({CHART})
WHERE playerId IS NOT NULL AND teamAbbrev IS NOT NULL AND period IS NOT NULL AND endTime IS NOT NULL""")
def _(spark, folder):
    from icelens.sources.league_views import with_views
    events = spark.read.parquet(f"{folder}/events.parquet")
    return feeds.normalise_shifts(spark.sql(with_views(CHART, "{events}"), events=events))


@register("fallback_union", G + "event_id:l player_id:l source", """
SELECT season, game_id, event_id, player_id, 'primary' AS source FROM shifts_v WHERE game_id % 3 > 0 UNION ALL
SELECT season, game_id, event_id, player_id, 'fallback' FROM clean_v
WHERE game_id NOT IN (SELECT game_id FROM shifts_v WHERE game_id % 3 > 0)""")
def _(spark, folder):
    view = league(spark, folder)
    columns = ["season", "game_id", "event_id", "player_id"]
    primary = view("shifts_v").where("game_id % 3 > 0").select(*columns, F.lit("primary").alias("source"))
    return feeds.with_fallback(primary, view("clean_v").select(*columns, F.lit("fallback").alias("source")))


def html_reports(view) -> DataFrame:
    """Time-on-ice reports: per player a header row, then one row per shift, in documents of one player and period."""
    clock = {n: F.expr(f"CONCAT(CAST(FLOOR(({c} % 5400)/60) AS INT), ':', LPAD(CAST({c} % 60 AS STRING), 2, '0'))")
             for n, c in (("a", "start_sec"), ("b", "end_sec"), ("d", "(end_sec - start_sec)"))}
    row = F.concat(F.lit("<tr class='oddColor'><td>"), F.lit("1</td><td>"), F.col("period").cast("string"), F.lit("</td><td>"),
                   clock["a"], F.lit("&nbsp;/ 9:59</td><td>"), clock["b"], F.lit(" / 0:01</td>\n<td>"), clock["d"], F.lit("</td></tr>"))
    cells = (view("clean_v").withColumn("chunk", F.floor(F.col("event_id") / 256))
             .groupBy("season", "game_id", "team", "player_id", "chunk")
             .agg(F.array_sort(F.collect_list(F.struct("event_id", row.alias("r")))).alias("rows")))
    head = F.concat(F.lit("<html><table><tr><td colspan=8> </td></tr><tr><td>"), (F.col("player_id") % 90).cast("string"),
                    F.lit(" <b>Name-"), F.translate(F.col("player_id").cast("string"), "0123456789", "ABCDEFGHIJ"), F.lit(", Ann</b></td></tr>"))
    return cells.select("season", "game_id", "team", F.concat_ws("-", "player_id", "chunk").alias("doc_no"), F.concat(
        head, F.array_join(F.transform("rows", lambda r: r["r"]), ""), F.lit("<tr><td>TOT</td></tr></table></html>")).alias("html"))


HTML_SQL = """
SELECT season, game_id, team, concat('Ann Name-', translate(CAST(player_id AS VARCHAR), '0123456789', 'ABCDEFGHIJ')) AS report_name,
 concat('Name-', translate(CAST(player_id AS VARCHAR), '0123456789', 'ABCDEFGHIJ')) AS report_last_name, period,
 concat(lpad(CAST((start_sec % 5400) // 60 AS VARCHAR), 2, '0'), ':', lpad(CAST(start_sec % 60 AS VARCHAR), 2, '0')) AS start_time,
 concat(lpad(CAST((end_sec % 5400) // 60 AS VARCHAR), 2, '0'), ':', lpad(CAST(end_sec % 60 AS VARCHAR), 2, '0')) AS end_time,
 concat(lpad(CAST(((end_sec - start_sec) % 5400) // 60 AS VARCHAR), 2, '0'), ':', lpad(CAST((end_sec - start_sec) % 60 AS VARCHAR), 2, '0')) AS duration
FROM clean_v"""


@register("html_rows", G + "team report_name report_last_name period:l start_time end_time duration",
          f"SELECT * FROM ({HTML_SQL}) WHERE length(duration) = 5")
def _(spark, folder):
    # a row without a third clock has fewer than five times; every report row here has five
    return feeds.html_shifts(html_reports(league(spark, folder)))


@register("name_key", "doc_id:l key", """
SELECT doc_id, trim(regexp_replace(upper(strip_accents(text)), '[^A-Z]+', ' ', 'g')) AS key FROM (
 SELECT doc_id, replace(regexp_replace(text, '[^\\x00-\\x{24F}]', ' ', 'g'), 'ß', ' ') AS text FROM documents)""")
def _(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return docs.select("doc_id", name_key(F.col("text")).alias("key"))


FIRST = "CASE player_id % 4 WHEN 0 THEN 'Zoë' WHEN 1 THEN 'Jean-Luc' WHEN 2 THEN 'Bo' ELSE 'Ål' END"
LAST = """CASE player_id % 7 WHEN 0 THEN 'Stützle' WHEN 1 THEN 'O''Neil' WHEN 2 THEN 'van Berg' WHEN 3 THEN 'Müller'
 WHEN 4 THEN 'Picard' ELSE CONCAT('Solo', TRANSLATE(CAST(player_id AS VARCHAR(10)), '0123456789', 'abcdefghij')) END"""
NAMED = f"SELECT season, player_id, team, CONCAT({FIRST}, ' ', {LAST}) AS player, {LAST} AS last_name FROM roster_v"
# what the report prints: sometimes another first name, sometimes the wrong team
REPORT = f"""SELECT season, game_id, event_id,
 CASE WHEN player_id % 9 = 5 THEN 'T99' ELSE team END AS team,
 CASE WHEN player_id % 5 = 2 THEN CONCAT('Nick ', {LAST}) WHEN player_id % 31 = 3 THEN 'Nobody Known'
      ELSE CONCAT({FIRST}, ' ', {LAST}) END AS report_name,
 CASE WHEN player_id % 31 = 3 AND player_id % 5 <> 2 THEN 'Known' ELSE {LAST} END AS report_last_name FROM shifts_v"""
FORCED = [("NICK MULLER", "T1", 7), ("NICK PICARD", "T99", 10 ** 6)]
KEY = "trim(regexp_replace(upper(strip_accents({0})), '[^A-Z]+', ' ', 'g'))"


@register("entity_resolve", G + "event_id:l team report_name player player_id:l", f"""
WITH p AS (SELECT season, team, key, arg_min(player_id, player_id) AS player_id, arg_min(player, player_id) AS player
   FROM (SELECT *, {KEY.format('player')} AS key FROM ({NAMED})) GROUP BY ALL),
 n AS (SELECT DISTINCT season, team, report_name, {KEY.format('report_name')} AS key, {KEY.format('report_last_name')} AS last_key FROM ({REPORT})),
 f AS (SELECT * FROM (VALUES ('NICK MULLER', 'T1', 7), ('NICK PICARD', 'T99', 1000000)) f(key, team, forced)),
 t1 AS (SELECT n.season, n.team, n.key, p.player_id FROM n JOIN p USING (season, team, key)),
 t2 AS (SELECT season, key, MIN(player_id) AS player_id FROM p GROUP BY ALL HAVING COUNT(DISTINCT player_id) = 1),
 m AS (SELECT n.season, n.team, n.key, p.team AS pteam, p.player_id FROM n JOIN p ON n.season = p.season
   AND (p.key = n.last_key OR ends_with(p.key, ' ' || n.last_key))),
 t3 AS (SELECT season, team, key, MIN(player_id) AS player_id FROM m WHERE pteam = team GROUP BY ALL HAVING COUNT(DISTINCT player_id) = 1),
 t4 AS (SELECT season, team, key, MIN(player_id) AS player_id FROM m GROUP BY ALL HAVING COUNT(DISTINCT player_id) = 1),
 r AS (SELECT DISTINCT n.season, n.team, n.key, COALESCE(t1.player_id, f.forced, t2.player_id, t3.player_id, t4.player_id) AS player_id
  FROM n LEFT JOIN t1 USING (season, team, key) LEFT JOIN f USING (key, team) LEFT JOIN t2 USING (season, key)
  LEFT JOIN t3 USING (season, team, key) LEFT JOIN t4 USING (season, team, key)),
 who AS (SELECT season, player_id, MIN(player) AS player FROM ({NAMED}) GROUP BY ALL)
SELECT x.season, x.game_id, x.event_id, x.team, x.report_name, r.player_id, COALESCE(who.player, CAST(r.player_id AS VARCHAR)) AS player
FROM (SELECT *, {KEY.format('report_name')} AS key FROM ({REPORT})) x JOIN r USING (season, team, key)
LEFT JOIN who ON who.season = x.season AND who.player_id = r.player_id WHERE r.player_id IS NOT NULL""")
def _(spark, folder):
    from icelens.sources.league_views import with_views
    events = spark.read.parquet(f"{folder}/events.parquet")
    run = lambda text: spark.sql(with_views(text, "{events}"), events=events)
    overrides = spark.createDataFrame([*REPORT_NAME_OVERRIDES, *FORCED], "key string, team string, player_id long")
    return resolve_names(run(REPORT), run(NAMED), overrides)


def box_feed(view) -> DataFrame:
    """Box scores, one document per game and player."""
    side = F.when(F.substring("team", 2, 9).cast("int") % 2 == 0, "awayTeam").otherwise("homeTeam")
    toi = F.expr("CASE WHEN s % 11 = 0 THEN '' WHEN s % 11 = 1 THEN 'x:y' ELSE CONCAT(CAST(FLOOR(s/60) AS INT), ':', LPAD(CAST(s % 60 AS STRING), 2, '0')) END")
    rows = (view("clean_v").groupBy("season", "game_id", "player_id", "team", "is_goalie")
            .agg(F.sum("end_sec").alias("s"), F.count("*").alias("n")))
    skater = F.array(F.struct(F.col("player_id").alias("playerId"), F.lit("C").alias("position"), toi.alias("toi"),
                              F.col("n").cast("int").alias("shifts")))
    faced = lambda k: F.when(F.col("s") % 7 != k, F.concat((F.col("s") % 20).cast("string"), F.lit("/"), (F.col("s") % 20 + k).cast("string")))
    goalie = F.array(F.struct(
        F.col("player_id").alias("playerId"), F.when(F.col("s") % 3 > 0, F.col("s") % 3 == 1).alias("starter"), toi.alias("toi"),
        faced(1).alias("evenStrengthShotsAgainst"), faced(2).alias("powerPlayShotsAgainst"), F.lit("junk").alias("shorthandedShotsAgainst"),
        (F.col("s") % 5).cast("int").alias("evenStrengthGoalsAgainst"), F.when(F.col("s") % 2 == 0, 1).alias("powerPlayGoalsAgainst"),
        (F.col("s") % 30).cast("int").alias("shotsAgainst"), (F.col("s") % 6).cast("int").alias("goalsAgainst")))
    group = F.struct(F.when(~F.col("is_goalie") & (F.col("player_id") % 3 > 0), skater).alias("forwards"),
                     F.when(~F.col("is_goalie") & (F.col("player_id") % 3 == 0), skater).alias("defense"),
                     F.when(F.col("is_goalie"), goalie).alias("goalies"))
    is_away = side == "awayTeam"
    abbrev = F.struct(F.col("team").alias("abbrev"))
    return rows.select("season", "game_id", F.to_json(F.struct(
        F.when(is_away, abbrev).alias("awayTeam"), F.when(~is_away, abbrev).alias("homeTeam"),
        F.struct(F.when(is_away, group).alias("awayTeam"), F.when(~is_away, group).alias("homeTeam")).alias("playerByGameStats"))).alias("payload"))


BOX_SQL = """SELECT season, game_id, player_id, team, is_goalie, SUM(end_sec) AS s, COUNT(*) AS n,
 CASE WHEN SUM(end_sec) % 11 > 1 THEN SUM(end_sec)/60.0 END AS toi FROM clean_v GROUP BY ALL"""


@register("boxscore_flatten", G + "player_id:l team toi:r6 shifts:l", f"SELECT *, n AS shifts FROM ({BOX_SQL}) WHERE NOT is_goalie")
def _(spark, folder):
    return feeds.box_skaters(box_feed(league(spark, folder)))


@register("boxscore_goalies", G + "player_id:l team starter:b toi:r6 ev_shots_against:l ev_goals_against:l pk_shots_against:l "
          "pk_goals_against:l own_pp_shots_against:l shots_against:l goals_against:l saves:l", f"""
SELECT *, s % 3 = 1 AS starter, CASE WHEN s % 7 <> 1 THEN s % 20 + 1 ELSE 0 END AS ev_shots_against, s % 5 AS ev_goals_against,
 CASE WHEN s % 7 <> 2 THEN s % 20 + 2 ELSE 0 END AS pk_shots_against, CASE WHEN s % 2 = 0 THEN 1 ELSE 0 END AS pk_goals_against,
 0 AS own_pp_shots_against, s % 30 AS shots_against, s % 6 AS goals_against, 0 AS saves FROM ({BOX_SQL}) WHERE is_goalie""")
def _(spark, folder):
    return feeds.box_goalies(box_feed(league(spark, folder)))


@register("roster_latest", "season player_id:l team position specific_position", """
SELECT season, player_id, arg_max(team, game_id) AS team,
 CASE WHEN bool_or(is_goalie) THEN 'G' WHEN player_id % 3 = 0 THEN 'D' ELSE 'F' END AS position,
 CASE WHEN bool_or(is_goalie) THEN 'G' ELSE 'C' END AS specific_position FROM clean_v GROUP BY season, player_id""")
def _(spark, folder):
    return feeds.roster(box_feed(league(spark, folder)))


@register("goalie_log_flatten", "season player_id:l team game_id:l date result shutouts:l", """
SELECT season, player_id, team, game_id, CAST(DATE '2024-01-01' + CAST(game_id // 10000 AS INT) AS VARCHAR) AS date, result, shutouts
FROM goalie_logs_v""")
def _(spark, folder):
    log = F.array(F.struct(F.col("team").alias("teamAbbrev"), F.col("game_id").alias("gameId"),
                           F.date_add(F.lit("2024-01-01").cast("date"), F.floor(F.col("game_id") / 10000).cast("int")).cast("string").alias("gameDate"),
                           F.col("result").alias("decision"), "shutouts"))
    docs = league(spark, folder)("goalie_logs_v").select(
        "season", "player_id", F.lit("G").alias("player"), F.to_json(F.struct(log.alias("gameLog"))).alias("payload"))
    return feeds.goalie_logs(docs)


@register("adjacent_ids", "season player_id:l player", """
SELECT season, player_id, arg_min(player, (o, player)) AS player FROM (
 SELECT r.player_id, r.player, t.o, concat(CAST(substr(r.season, 1, 4) AS INT) + t.d, '-', CAST(substr(r.season, 1, 4) AS INT) + t.d + 1) AS season
 FROM roster_v r, (VALUES (0, 0), (1, 1), (2, -1)) t(o, d) WHERE position = 'G') GROUP BY season, player_id""")
def _(spark, folder):
    return feeds.adjacent_goalies(league(spark, folder)("roster_v"))


@register("schedule_dedupe", "season game_id:l date home_team away_team", "SELECT * FROM schedule_v WHERE game_id % 7 <> 0 AND game_id % 5 <> 0")
def _(spark, folder):
    listed = league(spark, folder)("schedule_v").select(
        "*", F.explode(F.array("home_team", "away_team")).alias("listed_by"),
        F.when(F.col("game_id") % 7 == 0, 1).otherwise(2).alias("game_type"),
        F.when(F.col("game_id") % 5 == 0, "LIVE").when(F.col("game_id") % 2 == 0, "OFF").otherwise("FINAL").alias("game_state"))
    return feeds.schedule(listed)


@register("standings", "season team gp:l goals_for:l goals_against:l goal_diff:l", """
SELECT *, gp*3 AS goals_against, goals_for - gp*3 AS goal_diff FROM standings_v""")
def _(spark, folder):
    view = league(spark, folder)
    rows = view("standings_v").select(
        "season", F.concat(F.when(F.col("team") == "T1", "Olde ").otherwise("Club "), F.col("team")).alias("team_full_name"),
        "gp", "goals_for", (F.col("gp") * 3).alias("goals_against"))
    names = view("standings_v").select(F.col("team").alias("abbrev"), F.concat(F.lit("Club "), F.col("team")).alias("full_name")).distinct()
    aliases = spark.createDataFrame([("Olde T1", "Club T1")], "spelling string, full_name string")
    return feeds.standings(rows, names, aliases)


@register("bios_flatten", "player_id:l player shoots_catches height_in:l weight_lb:l birth_date birth_country draft_year:l", """
SELECT *, concat('Ann', ' ', 'P', player_id) AS player FROM bios_v""")
def _(spark, folder):
    b = league(spark, folder)("bios_v")
    last = F.concat(F.lit("P"), F.col("player_id").cast("string"))
    whole = F.to_json(F.struct(F.lit("Ann").alias("firstName"), last.alias("lastName"), F.col("shoots_catches").alias("shootsCatches"),
                               F.col("height_in").alias("heightInInches"), F.col("weight_lb").alias("weightInPounds"),
                               F.col("birth_date").alias("birthDate"), F.col("birth_country").alias("birthCountry"),
                               F.struct(F.col("draft_year").alias("year")).alias("draftDetails")))
    split = F.to_json(F.struct(F.struct(F.lit("Ann").alias("default")).alias("firstName"), F.struct(last.alias("default")).alias("lastName"),
                               F.col("shoots_catches").alias("shootsCatches"), F.col("height_in").alias("heightInInches"),
                               F.col("weight_lb").alias("weightInPounds"), F.col("birth_date").alias("birthDate"),
                               F.col("birth_country").alias("birthCountry"), F.struct(F.col("draft_year").alias("year")).alias("draftDetails")))
    return feeds.bios(b.select("player_id", F.when(F.col("player_id") % 2 == 0, whole).otherwise(split).alias("payload")))


@register("incremental_merge", "kind o_orderkey:l o_custkey:l", """
WITH done AS (SELECT * FROM orders WHERE o_orderkey % 3 = 0), gone AS (SELECT * FROM orders WHERE o_orderkey % 7 = 1),
 todo AS (SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM done) AND o_orderkey NOT IN (SELECT o_orderkey FROM gone)),
 fresh AS (SELECT * FROM orders WHERE o_orderkey IN (SELECT o_orderkey FROM todo) AND o_orderkey % 5 <> 2)
SELECT 'loaded' AS kind, o_orderkey, o_custkey FROM done UNION ALL SELECT 'loaded', o_orderkey, o_custkey FROM fresh UNION ALL
SELECT 'empty', o_orderkey, NULL FROM (SELECT o_orderkey FROM gone UNION SELECT o_orderkey FROM todo
 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM fresh))""")
def _(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey", "o_custkey")
    loaded, empty = incremental.merge(orders.select("o_orderkey"), orders.where("o_orderkey % 5 <> 2"),
                                      orders.where("o_orderkey % 3 = 0"), orders.where("o_orderkey % 7 = 1"), "o_orderkey")
    return loaded.withColumn("kind", F.lit("loaded")).unionByName(
        empty.withColumns({"kind": F.lit("empty"), "o_custkey": F.lit(None).cast("long")}))


def _store(spark) -> TableStore:
    return TableStore(spark, f"{shared_folder(spark)}/tables-{uuid.uuid4().hex}")


@register("scan_stats", "season player_id:l situation toi:r6", """
SELECT * FROM skater_toi_o WHERE season = '2022-2023' AND situation IN ('all', '5v5')""")
def _(spark, folder):
    from icelens.catalog.intervals import base_stints
    from icelens.operators import aggregate as agg
    from icelens.operators.perspective import player_stints
    view, store = league(spark, folder), _store(spark)
    table = agg.skater_toi(agg.player_totals(player_stints(base_stints(view))), view("box_skater_v")).withColumn("position", F.lit("F"))
    store.save(table, "stats")
    return store.load("stats", table.schema, season="2022-2023", position="F", situation=["all", "5v5"])


@register("write_roundtrip", G + "event_id:l player_id:l team start_sec:l end_sec:l", """
SELECT * FROM shifts_v WHERE season <> '2022-2023' UNION ALL
SELECT * REPLACE (start_sec + 1 AS start_sec) FROM shifts_v WHERE season = '2022-2023'""")
def _(spark, folder):
    shifts, store = league(spark, folder)("shifts_v"), _store(spark)
    store.save(shifts, "shifts")
    store.save(shifts.where("season = '2022-2023'").withColumn("start_sec", F.col("start_sec") + 1), "shifts")
    return store.load("shifts", shifts.schema)
