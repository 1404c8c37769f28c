"""Queries for shifts, stints and what is attached to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from icelens.catalog.registry import register
from icelens.config import PERIOD_KEYS
from icelens.operators import attach, context, overlap, perspective, stints as st
from icelens.sources.league_views import LEAGUE_RULES as RULES, league

P = "season game_id:l period:l "
CLOCK_TEXT = """CONCAT(CAST(CAST(FLOOR({0}/60) AS BIGINT) AS VARCHAR(10)), ':',
 LPAD(CAST({0} % 60 AS VARCHAR(10)), 2, '0'))"""


def base_stints(view) -> DataFrame:
    return st.build_stints(view("clean_v"), view("goals_v"), RULES)


def measured_stints(view) -> DataFrame:
    """Stints with xG, shots on goal and zone starts."""
    return (base_stints(view).transform(attach.attach_shots, view("shots_v"))
            .transform(context.attach_zone_start, view("faceoffs_v")))


# The periods of the views are longer than a clock of two digits shows: fold them to 90 minutes. A few clocks stay unreadable.
FOLDED = {name: f"(CASE WHEN event_id % 29 = 0 THEN {name} + 6000 ELSE {name} % 5400 END)" for name in ("start_sec", "end_sec")}


@register("shift_clean", P + "player_id:l event_id:l start_sec:l end_sec:l", f"""
SELECT * FROM (SELECT season, game_id, period, player_id, event_id, {FOLDED['start_sec']} AS start_sec, {FOLDED['end_sec']} AS end_sec,
  {CLOCK_TEXT.format(FOLDED['start_sec'])} AS t0, {CLOCK_TEXT.format(FOLDED['end_sec'])} AS t1 FROM shifts_v)
WHERE regexp_full_match(t0, '\\d{{1,2}}:\\d{{2}}') AND regexp_full_match(t1, '\\d{{1,2}}:\\d{{2}}')
 AND end_sec > start_sec""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    view = league(spark, folder)
    text = view("shifts_v").selectExpr(
        *PERIOD_KEYS, "player_id", "event_id", f"{CLOCK_TEXT.format(FOLDED['start_sec'])} AS start_time",
        f"{CLOCK_TEXT.format(FOLDED['end_sec'])} AS end_time")
    return st.clean_shifts(text)


@register("segments", P + "seg_start:l seg_end:l is_first:b is_last:b team_a team_b", "SELECT * FROM segments_o")
def _(spark, folder):
    return st.segments(league(spark, folder)("clean_v"))


@register("lineups", P + "seg_start:l seg_end:l team_a a_skaters:a a_goalie_id:l team_b b_skaters:a b_goalie_id:l",
          "SELECT * FROM lineups_o")
def _(spark, folder):
    shifts = league(spark, folder)("clean_v")
    return st.lineups(shifts, st.segments(shifts), RULES)


@register("segment_goals", P + "seg_start:l team_a a_goals:l team_b b_goals:l", """
SELECT s.*, COALESCE(a.goals, 0) AS a_goals, COALESCE(b.goals, 0) AS b_goals FROM segments_o s
LEFT JOIN seggoals_o a ON (s.season, s.game_id, s.period, s.seg_start, s.team_a)
                        = (a.season, a.game_id, a.period, a.seg_start, a.team)
LEFT JOIN seggoals_o b ON (s.season, s.game_id, s.period, s.seg_start, s.team_b)
                        = (b.season, b.game_id, b.period, b.seg_start, b.team)""")
def _(spark, folder):
    view = league(spark, folder)
    return st.segment_goals(st.segments(view("clean_v")), view("goals_v"))


STINT = (P + "start_sec:l end_sec:l duration:l team_a a_skaters:a a_goalie_on:b a_goalie_id:l a_goals:l "
         "team_b b_skaters:a b_goalie_on:b b_goalie_id:l b_goals:l")


@register("stints", STINT, "SELECT * FROM stints_o")
def _(spark, folder):
    return base_stints(league(spark, folder))


PAIRS_SQL = """
WITH act AS (SELECT DISTINCT season, game_id, period, seg_start, seg_end, player_id
  FROM boundseg_o JOIN clean_v USING (season, game_id, period) WHERE start_sec <= seg_start AND end_sec > seg_start),
 side AS (SELECT season, game_id, period, player_id, arg_min(team, (start_sec, end_sec, team)) AS side,
  bool_or(is_goalie) AS goalie FROM clean_v GROUP BY ALL),
 teams AS (SELECT season, game_id, period, COUNT(DISTINCT side) AS n, MIN(side) AS team_a FROM side GROUP BY ALL),
 cnt AS (SELECT season, game_id, period, seg_start, team_a,
   CASE WHEN n = 2 THEN sign(COUNT(*) FILTER (NOT goalie AND side = team_a)
                            - COUNT(*) FILTER (NOT goalie AND side <> team_a)) ELSE 0 END AS diff
   FROM act JOIN side USING (season, game_id, period, player_id) JOIN teams USING (season, game_id, period)
   GROUP BY season, game_id, period, seg_start, team_a, n),
 who AS (SELECT act.*, side, CASE WHEN side = team_a THEN diff ELSE -diff END AS edge
   FROM act JOIN side USING (season, game_id, period, player_id) JOIN cnt USING (season, game_id, period, seg_start))
SELECT p.season, p.player_id, o.player_id AS other_player_id, p.side = o.side AS same_team,
 CASE WHEN p.edge > 0 THEN 'PP' WHEN p.edge < 0 THEN 'PK' ELSE 'ES' END AS situation,
 SUM(p.seg_end - p.seg_start) AS shared_toi
FROM who p JOIN who o USING (season, game_id, period, seg_start) WHERE p.player_id <> o.player_id GROUP BY ALL"""


@register("toi_pairs", "season player_id:l other_player_id:l same_team:b situation shared_toi:l", PAIRS_SQL)
def _(spark, folder):
    return overlap.shared_seconds(league(spark, folder)("clean_v"), RULES)


@register("toi_matrix", "season player_id:l other_player_id:l kind situation shared_toi:l",
          f"SELECT *, CASE WHEN same_team THEN 'teammate' ELSE 'competition' END AS kind FROM ({PAIRS_SQL})")
def _(spark, folder):
    mates, rivals = overlap.toi_matrices(league(spark, folder)("clean_v"), RULES)
    return mates.withColumn("kind", F.lit("teammate")).unionByName(rivals.withColumn("kind", F.lit("competition")))


@register("strength_tag", P + "seq:l team sec:l strength", """
SELECT p.season, p.game_id, p.period, p.seq, p.team, p.sec, COALESCE(s.strength, 'unknown') AS strength
FROM pbp_v p LEFT JOIN strength_o s USING (season, game_id, period, sec, team)""")
def _(spark, folder):
    view = league(spark, folder)
    return attach.tag_strength(view("pbp_v"), base_stints(view), RULES)


@register("stint_xg", P + "start_sec:l a_xg:r6 b_xg:r6", "SELECT * FROM stint_xg_o")
def _(spark, folder):
    view = league(spark, folder)
    return attach.attach_xg(base_stints(view), view("shots_v"))


@register("stint_sog", P + "start_sec:l a_sog:l b_sog:l", "SELECT * FROM stint_xg_o")
def _(spark, folder):
    view = league(spark, folder)
    return attach.attach_shots_on_goal(base_stints(view), view("shots_v"))


STATE_SQL = """
SELECT *, -a_score_state AS b_score_state,
 CAST(a_score_state = 1 AS INT) AS a_up1, CAST(a_score_state = 2 AS INT) AS a_up2, CAST(a_score_state = 3 AS INT) AS a_up3,
 CAST(a_score_state = -1 AS INT) AS a_down1, CAST(a_score_state = -2 AS INT) AS a_down2,
 CAST(a_score_state = -3 AS INT) AS a_down3 FROM (
 SELECT s.season, s.game_id, s.period, s.start_sec,
  LEAST(3, GREATEST(-3, COUNT(*) FILTER (g.team = s.team_a) - COUNT(*) FILTER (g.team = s.team_b))) AS a_score_state
 FROM stints_o s LEFT JOIN goals_v g ON s.season = g.season AND s.game_id = g.game_id
  AND (g.period - 1)*28800 + g.sec < (s.period - 1)*28800 + s.start_sec
 GROUP BY s.season, s.game_id, s.period, s.start_sec)"""


@register("stint_score_state", P + "start_sec:l a_score_state:l b_score_state:l a_up1:l a_up2:l a_up3:l "
          "a_down1:l a_down2:l a_down3:l", STATE_SQL)
def _(spark, folder):
    view = league(spark, folder)
    return attach.attach_score_state(base_stints(view), view("goals_v"), RULES)


@register("shot_score_state", P + "seq:l score_state:r1", """
WITH teams AS (SELECT game_id, MIN(team) AS ta, MAX(team) AS tb FROM shots_v GROUP BY game_id HAVING COUNT(DISTINCT team) = 2),
 pts AS (SELECT h.*, (period - 1)*28800 + sec AS at FROM shots_v h)
SELECT p.season, p.game_id, p.period, p.seq, LEAST(3, GREATEST(-3, CASE WHEN t.ta IS NULL THEN 0
  ELSE COUNT(*) FILTER (g.team = p.team) - COUNT(*) FILTER (g.team <> p.team) END)) AS score_state
FROM pts p LEFT JOIN teams t USING (game_id)
LEFT JOIN (SELECT * FROM pts WHERE event_type = 'goal') g ON p.game_id = g.game_id AND g.at < p.at
GROUP BY p.season, p.game_id, p.period, p.seq, p.team, t.ta""")
def _(spark, folder):
    return attach.attach_shot_score_state(league(spark, folder)("shots_v"), RULES)


EXPIRY_SQL = """
SELECT *, b_ppx AS a_pkx, a_ppx AS b_pkx FROM (SELECT *,
 CAST(COALESCE(a_n = b_n AND pa > pb AND start_sec - pe <= 20, FALSE) AS INT) AS a_ppx,
 CAST(COALESCE(a_n = b_n AND pa < pb AND start_sec - pe <= 20, FALSE) AS INT) AS b_ppx
FROM (SELECT *, LAG(a_n) OVER w AS pa, LAG(b_n) OVER w AS pb, LAG(end_sec) OVER w AS pe FROM zone_o
      WINDOW w AS (PARTITION BY season, game_id, period ORDER BY start_sec)))"""
OTF_SQL = f"""
SELECT e.*, CAST(COALESCE(a_n <> b_n AND pa = pb AND start_sec - pe <= 20, FALSE) AND f.sec IS NULL AS INT) AS otf
FROM ({EXPIRY_SQL}) e LEFT JOIN (SELECT DISTINCT season, game_id, period, sec FROM faceoffs_v) f
 ON (e.season, e.game_id, e.period, e.start_sec) = (f.season, f.game_id, f.period, f.sec)"""


@register("pp_expiry", P + "start_sec:l a_ppx:l b_ppx:l a_pkx:l b_pkx:l", EXPIRY_SQL)
def _(spark, folder):
    return context.attach_expiry(base_stints(league(spark, folder)), RULES)


@register("pp_start_otf", P + "start_sec:l a_otf:l b_otf:l", f"SELECT *, otf AS a_otf, otf AS b_otf FROM ({OTF_SQL})")
def _(spark, folder):
    view = league(spark, folder)
    return context.attach_on_the_fly(base_stints(view), view("faceoffs_v"), RULES)


@register("zone_start", P + "start_sec:l a_zone_o:l a_zone_d:l a_zone_n:l b_zone_o:l b_zone_d:l b_zone_n:l",
          "SELECT * FROM zone_o")
def _(spark, folder):
    view = league(spark, folder)
    return context.attach_zone_start(base_stints(view), view("faceoffs_v"))


REST_SQL = """
SELECT s.*, CAST(s.team_a = g.home_team AS INT) AS a_home, CAST(s.team_b = g.home_team AS INT) AS b_home,
 CAST(EXISTS (SELECT 1 FROM schedule_v p WHERE p.season = s.season AND p.date = g.date - 1
   AND s.team_a IN (p.home_team, p.away_team)) AS INT) AS a_b2b,
 CAST(EXISTS (SELECT 1 FROM schedule_v p WHERE p.season = s.season AND p.date = g.date - 1
   AND s.team_b IN (p.home_team, p.away_team)) AS INT) AS b_b2b
FROM {0} s JOIN schedule_v g USING (season, game_id)"""


@register("home_flag", P + "start_sec:l team_a a_home:l team_b b_home:l", REST_SQL.format("stints_o"))
def _(spark, folder):
    view = league(spark, folder)
    return context.attach_home(base_stints(view), view("schedule_v"))


@register("back_to_back", P + "start_sec:l team_a a_b2b:l team_b b_b2b:l", REST_SQL.format("stints_o"))
def _(spark, folder):
    view = league(spark, folder)
    return context.attach_back_to_back(base_stints(view), view("schedule_v"))


CONTEXT_SQL = f"""
SELECT r.*, q.a_score_state, q.b_score_state,
 q.a_score_state*a_zone_o AS a_score_x_o, q.a_score_state*a_zone_d AS a_score_x_d,
 q.b_score_state*b_zone_o AS b_score_x_o, q.b_score_state*b_zone_d AS b_score_x_d,
 a_ppx*a_home AS a_ppx_x_home, b_ppx*b_home AS b_ppx_x_home,
 a_pkx*a_home AS a_pkx_x_home, b_pkx*b_home AS b_pkx_x_home
FROM ({REST_SQL.format(f'({OTF_SQL})')}) r JOIN ({STATE_SQL}) q USING (season, game_id, period, start_sec)"""
INTERACT = "a_score_x_o:l a_score_x_d:l b_score_x_o:l b_score_x_d:l a_ppx_x_home:l b_ppx_x_home:l a_pkx_x_home:l b_pkx_x_home:l"


def context_stints(view) -> DataFrame:
    return context.attach_context(base_stints(view), view("shots_v"), view("goals_v"), view("faceoffs_v"),
                                  view("schedule_v"), RULES)


@register("interactions", P + "start_sec:l " + INTERACT, CONTEXT_SQL)
def _(spark, folder):
    view = league(spark, folder)
    parts = (base_stints(view).transform(context.attach_expiry, RULES)
             .transform(context.attach_zone_start, view("faceoffs_v"))
             .transform(attach.attach_score_state, view("goals_v"), RULES)
             .transform(context.attach_home, view("schedule_v")))
    return context.attach_interactions(parts)


@register("stint_context", P + "start_sec:l duration:l a_xg:r6 b_xg:r6 a_score_state:l a_ppx:l b_ppx:l a_zone_o:l "
          "b_zone_d:l a_home:l b_home:l a_b2b:l b_b2b:l " + INTERACT, CONTEXT_SQL)
def _(spark, folder):
    return context_stints(league(spark, folder))


ROWS = P + "start_sec:l duration:l off_team off_skaters:a def_skaters:a goals_for:l xg_for:r6"
ROWS_SQL = """SELECT *, team AS off_team, skaters AS off_skaters, others AS def_skaters, gf AS goals_for, xgf AS xg_for,
 CAST(own = 4 AS INT) AS state_4v4, CAST(own = 3 AS INT) AS state_3v3 FROM sides_o"""


def _rows(expand):
    def run(spark, folder):
        view = league(spark, folder)
        return expand(attach.attach_xg(base_stints(view), view("shots_v")))
    return run


register("perspective", ROWS, ROWS_SQL)(_rows(perspective.perspectives))
for _name, _expand, _where in (
        ("es_rows", perspective.even_rows, "own = 5 AND opp = 5"),
        ("pp_rows", perspective.power_play_rows, "own = 5 AND opp = 4"),
        ("pk_rows", perspective.short_handed_rows, "own = 4 AND opp = 5"),
        ("rows_5v3", perspective.two_man_rows, "own = 5 AND opp = 3")):
    register(_name, ROWS, f"{ROWS_SQL} WHERE own_g AND opp_g AND {_where}")(_rows(_expand))
register("es_pooled_rows", ROWS + " state_4v4:l state_3v3:l",
         f"{ROWS_SQL} WHERE own_g AND opp_g AND own = opp AND own IN (3, 4, 5)")(_rows(perspective.even_pooled_rows))


@register("player_stints", P + "start_sec:l duration:l team player_id:l situation gf:l ga:l xgf:r6 xga:r6 sogf:l soga:l "
          "zone_o:l zone_d:l zone_n:l", "SELECT * FROM player_stints_o")
def _(spark, folder):
    return perspective.player_stints(measured_stints(league(spark, folder)))


@register("goalie_stints", P + "start_sec:l duration:l team player_id:l situation", "SELECT * FROM goalie_stints_o")
def _(spark, folder):
    return perspective.goalie_stints(base_stints(league(spark, folder)))


@register("situation_label", P + "start_sec:l team situation", "SELECT * FROM labelled_o")
def _(spark, folder):
    from icelens.functions.labels import situation
    rows = perspective.perspectives(base_stints(league(spark, folder)))
    return rows.withColumn("team", F.col("off_team")).withColumn("situation", situation(
        F.col("n_off"), F.col("n_def"), F.col("off_goalie_on"), F.col("def_goalie_on")))
