"""Shared DuckDB blocks the oracle statements are assembled from."""

from __future__ import annotations

import re

from icelens.catalog.oracle_stats import STATS_BLOCKS
from icelens.catalog.oracle_value import VALUE_BLOCKS
from icelens.sources.league_views import VIEWS

BLOCKS = {
    "bounds_o": """
SELECT DISTINCT season, game_id, period, b FROM (
 SELECT season, game_id, period, start_sec AS b FROM clean_v
 UNION ALL SELECT season, game_id, period, end_sec FROM clean_v)""",
    "boundseg_o": """
SELECT * FROM (
 SELECT season, game_id, period, b AS seg_start, LEAD(b) OVER w AS seg_end,
  ROW_NUMBER() OVER w = 1 AS is_first, LEAD(b, 2) OVER w IS NULL AS is_last
 FROM bounds_o WINDOW w AS (PARTITION BY season, game_id, period ORDER BY b)) WHERE seg_end IS NOT NULL""",
    "segments_o": """
SELECT s.*, t.team_a, t.team_b FROM boundseg_o s JOIN (
 SELECT season, game_id, period, MIN(team) AS team_a, MAX(team) AS team_b FROM clean_v
 GROUP BY ALL HAVING COUNT(DISTINCT team) = 2) t USING (season, game_id, period)""",
    "lineups_o": """
SELECT *, a_goalie_id IS NOT NULL AS a_goalie_on, b_goalie_id IS NOT NULL AS b_goalie_on FROM (
 SELECT s.season, s.game_id, s.period, seg_start, seg_end, is_first, is_last, team_a, team_b,
  list_sort(list(DISTINCT player_id) FILTER (team = team_a AND NOT is_goalie)) AS a_skaters,
  list_sort(list(DISTINCT player_id) FILTER (team = team_b AND NOT is_goalie)) AS b_skaters,
  MIN(player_id) FILTER (team = team_a AND is_goalie) AS a_goalie_id,
  MIN(player_id) FILTER (team = team_b AND is_goalie) AS b_goalie_id
 FROM segments_o s JOIN clean_v c USING (season, game_id, period)
 WHERE c.start_sec <= seg_start AND c.end_sec > seg_start GROUP BY ALL)
WHERE len(a_skaters) BETWEEN 1 AND 6 AND len(b_skaters) BETWEEN 1 AND 6""",
    "seggoals_o": """
SELECT s.season, s.game_id, s.period, seg_start, g.team, COUNT(*) AS goals
FROM segments_o s JOIN goals_v g USING (season, game_id, period)
WHERE (g.sec > seg_start OR (is_first AND g.sec = seg_start)) AND (g.sec <= seg_end OR is_last)
GROUP BY ALL""",
    "lines_o": """
SELECT l.*, COALESCE(a.goals, 0) AS a_goals, COALESCE(b.goals, 0) AS b_goals FROM lineups_o l
LEFT JOIN seggoals_o a ON (l.season, l.game_id, l.period, l.seg_start, l.team_a)
                        = (a.season, a.game_id, a.period, a.seg_start, a.team)
LEFT JOIN seggoals_o b ON (l.season, l.game_id, l.period, l.seg_start, l.team_b)
                        = (b.season, b.game_id, b.period, b.seg_start, b.team)""",
    "stints_o": """
SELECT season, game_id, period, MIN(seg_start) AS start_sec, MAX(seg_end) AS end_sec,
 MAX(seg_end) - MIN(seg_start) AS duration, team_a, team_b, a_skaters, b_skaters, a_goalie_on, b_goalie_on,
 arg_min(a_goalie_id, seg_start) AS a_goalie_id, arg_min(b_goalie_id, seg_start) AS b_goalie_id,
 SUM(a_goals) AS a_goals, SUM(b_goals) AS b_goals, len(a_skaters) AS a_n, len(b_skaters) AS b_n
FROM (SELECT *, SUM(fresh) OVER (PARTITION BY season, game_id, period ORDER BY seg_start) AS island FROM (
  SELECT *, CASE WHEN LAG(seg_end) OVER w = seg_start AND LAG(a_skaters) OVER w = a_skaters
    AND LAG(b_skaters) OVER w = b_skaters AND LAG(a_goalie_on) OVER w = a_goalie_on
    AND LAG(b_goalie_on) OVER w = b_goalie_on THEN 0 ELSE 1 END AS fresh
  FROM lines_o WINDOW w AS (PARTITION BY season, game_id, period ORDER BY seg_start)))
GROUP BY season, game_id, period, island, team_a, team_b, a_skaters, b_skaters, a_goalie_on, b_goalie_on""",
    "numbered_o": """
SELECT *, ROW_NUMBER() OVER (PARTITION BY season, game_id, period ORDER BY start_sec) AS rn,
 COUNT(*) OVER (PARTITION BY season, game_id, period) AS n_stints,
 LAG(end_sec) OVER (PARTITION BY season, game_id, period ORDER BY start_sec) AS prev_end FROM stints_o""",
    "ranks_o": """
SELECT t.season, t.game_id, t.period, t.sec,
 COUNT(*) FILTER (s.start_sec < t.sec) AS lt, COUNT(*) FILTER (s.start_sec <= t.sec) AS le
FROM (SELECT DISTINCT season, game_id, period, sec FROM pbp_v) t
JOIN stints_o s USING (season, game_id, period) GROUP BY ALL""",
    # strength of a (second, team): last stint that began before, the first one otherwise
    "strength_o": """
SELECT r.season, r.game_id, r.period, r.sec, x.team,
 CASE WHEN NOT opp_g THEN 'EN_for' WHEN NOT own_g THEN 'EN_against'
  WHEN own = 3 AND opp = 3 AND CAST(substr(CAST(r.game_id AS VARCHAR), 1, 4) AS INT) < 2015 THEN '3v3_pre2015ot'
  ELSE concat(own, 'v', opp) END AS strength
FROM ranks_o r JOIN (
 SELECT season, game_id, period, rn, team_a AS team, a_n AS own, b_n AS opp, a_goalie_on AS own_g, b_goalie_on AS opp_g
 FROM numbered_o UNION ALL
 SELECT season, game_id, period, rn, team_b, b_n, a_n, b_goalie_on, a_goalie_on FROM numbered_o) x
 ON (r.season, r.game_id, r.period) = (x.season, x.game_id, x.period) AND x.rn = GREATEST(1, r.lt)""",
    # stint of a second, gap aware
    "gap_o": """
SELECT r.season, r.game_id, r.period, r.sec,
 CASE WHEN s.rn > 1 AND r.sec = s.start_sec AND s.prev_end = r.sec THEN s.rn - 1
      WHEN s.rn = s.n_stints OR r.sec < s.end_sec THEN s.rn END AS rn
FROM ranks_o r JOIN numbered_o s ON (r.season, r.game_id, r.period) = (s.season, s.game_id, s.period)
 AND s.rn = GREATEST(1, r.le)""",
    "stint_xg_o": """
SELECT s.*, COALESCE(v.a_xg, 0) AS a_xg, COALESCE(v.b_xg, 0) AS b_xg,
 COALESCE(v.a_sog, 0) AS a_sog, COALESCE(v.b_sog, 0) AS b_sog
FROM numbered_o s LEFT JOIN (
 SELECT n.season, n.game_id, n.period, n.rn,
  SUM(CASE WHEN h.team = n.team_a THEN xg END) AS a_xg, SUM(CASE WHEN h.team = n.team_b THEN xg END) AS b_xg,
  COUNT(CASE WHEN h.team = n.team_a AND event_type <> 'missed-shot' THEN 1 END) AS a_sog,
  COUNT(CASE WHEN h.team = n.team_b AND event_type <> 'missed-shot' THEN 1 END) AS b_sog
 FROM shots_v h JOIN gap_o g USING (season, game_id, period, sec)
 JOIN numbered_o n USING (season, game_id, period, rn) GROUP BY ALL) v USING (season, game_id, period, rn)""",
    "zone_o": """
SELECT s.*,
 CAST(COALESCE(az = 'O', FALSE) AS INT) AS a_zone_o, CAST(COALESCE(az = 'D', FALSE) AS INT) AS a_zone_d,
 CAST(COALESCE(az = 'N', FALSE) AS INT) AS a_zone_n, CAST(COALESCE(bz = 'O', FALSE) AS INT) AS b_zone_o,
 CAST(COALESCE(bz = 'D', FALSE) AS INT) AS b_zone_d, CAST(COALESCE(bz = 'N', FALSE) AS INT) AS b_zone_n
FROM (SELECT n.*,
  CASE WHEN f.team = team_a THEN f.zone WHEN f.team = team_b THEN translate(f.zone, 'OD', 'DO') END AS az,
  CASE WHEN f.team = team_b THEN f.zone WHEN f.team = team_a THEN translate(f.zone, 'OD', 'DO') END AS bz
 FROM stint_xg_o n LEFT JOIN (
  SELECT season, game_id, period, sec, arg_min(team, seq) AS team, arg_min(zone, seq) AS zone
  FROM faceoffs_v GROUP BY ALL) f
 ON (n.season, n.game_id, n.period, n.start_sec) = (f.season, f.game_id, f.period, f.sec)) s""",
    "sides_o": """
SELECT season, game_id, period, start_sec, duration, team_a AS team, a_skaters AS skaters, b_skaters AS others,
 a_n AS own, b_n AS opp, a_goalie_on AS own_g, b_goalie_on AS opp_g, a_goalie_id AS goalie_id,
 a_goals AS gf, b_goals AS ga, a_xg AS xgf, b_xg AS xga, a_sog AS sogf, b_sog AS soga,
 a_zone_o AS zone_o, a_zone_d AS zone_d, a_zone_n AS zone_n FROM zone_o
UNION ALL
SELECT season, game_id, period, start_sec, duration, team_b, b_skaters, a_skaters, b_n, a_n, b_goalie_on, a_goalie_on,
 b_goalie_id, b_goals, a_goals, b_xg, a_xg, b_sog, a_sog, b_zone_o, b_zone_d, b_zone_n FROM zone_o""",
    "labelled_o": """
SELECT *, CASE WHEN NOT opp_g THEN 'EN_for' WHEN NOT own_g THEN 'EN_against'
 ELSE concat(own, 'v', opp) END AS situation FROM sides_o""",
    "player_stints_o": "SELECT * EXCLUDE (skaters, others), unnest(skaters) AS player_id FROM labelled_o",
    "goalie_stints_o": "SELECT *, goalie_id AS player_id FROM labelled_o WHERE goalie_id IS NOT NULL",
}


def assemble(query: str) -> str:
    """``WITH <needed views and blocks>, <query>`` for a text of further CTEs."""
    blocks = {**VIEWS, **BLOCKS, **STATS_BLOCKS, **VALUE_BLOCKS}
    done: dict[str, str] = {}

    def visit(text: str) -> None:
        for name in re.findall(r"\b[a-z]\w*_[vo]\b", text):
            if name in blocks and name not in done and name not in path:
                path.append(name)
                visit(blocks[name])
                path.pop()
                done[name] = blocks[name]

    path: list[str] = []
    visit(query)
    return "WITH " + ",\n".join([f"{n} AS MATERIALIZED ({t})" for n, t in done.items()] + [query])
