"""DuckDB blocks for wins, scores and rankings."""

GOALIE_LEVEL = "CASE situation WHEN '5v5' THEN 'evs' WHEN '4v5' THEN 'pkl' END"
SCORES = {
    "skater": ["ovr", "evo", "evd", "ppl", "pkl", "fin", "pen", "xgl", "gol", "ast", "hit", "ozs", "pdo"],
    "goalie": ["ovr", "evs", "pkl", "ldg", "mdg", "hdg", "rbd", "tmd", "gre", "qal", "bad", "awf", "wrk"],
}


def ranked_sql(source: str, attrs: list[str], pools: bool = True) -> str:
    """Percentiles and dense ranks of every score of ``source`` within (season, position)."""
    columns = []
    for a in attrs:
        v = f"{a}_score"
        columns.append(f"""
 CASE WHEN {v} IS NOT NULL THEN round_even((
  (COUNT({v}) OVER (PARTITION BY season, position ORDER BY {v} RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
   - COUNT({v}) OVER (PARTITION BY season, position, {v})) + (COUNT({v}) OVER (PARTITION BY season, position, {v}) + 1)/2.0)
  /COUNT({v}) OVER (PARTITION BY season, position)*100, 1) END AS {a}_pct,
 CASE WHEN {v} IS NOT NULL THEN DENSE_RANK() OVER (PARTITION BY season, position ORDER BY {v} DESC NULLS LAST) END AS {a}_rank""")
    sizes = ", COUNT(*) OVER (PARTITION BY season, position) AS all_players"
    if "ppl" in attrs:
        sizes += (", COUNT(ppl_score) OVER (PARTITION BY season, position) AS ppl_players"
                  ", COUNT(pkl_score) OVER (PARTITION BY season, position) AS pkl_players")
    return f"SELECT *, {','.join(columns)}{sizes if pools else ''} FROM {source}"


def weighted_sql(source: str, attrs: list[str]) -> str:
    def blend(a: str) -> str:
        c, p, q = f"c.{a}_score", f"p.{a}_score", f"q.{a}_score"
        def arm(three, two, gap):
            return (f"CASE WHEN {c} IS NULL THEN NULL WHEN {p} IS NOT NULL AND {q} IS NOT NULL "
                    f"THEN {c}*{three[0]} + {p}*{three[1]} + {q}*{three[2]} WHEN {p} IS NOT NULL "
                    f"THEN {c}*{two[0]} + {p}*{two[1]} WHEN {q} IS NOT NULL THEN {c}*{gap[0]} + {q}*{gap[1]} ELSE {c} END")
        return (f"CASE WHEN c.position = 'G' THEN {arm((0.366, 0.365, 0.269), (0.526, 0.474), (0.553, 0.447))} "
                f"ELSE {arm((0.436, 0.328, 0.236), (0.535, 0.465), (0.591, 0.409))} END AS {a}_score")
    year = "CAST(substr({0}.season, 1, 4) AS INT)"
    match = " AND ".join(["{0}.player_id = c.player_id", "{0}.position = c.position",
                          year.format("{0}") + " = " + year.format("c") + " - {1}"])
    return (f"SELECT c.season, c.player_id, c.position, {', '.join(blend(a) for a in attrs)} FROM {source} c "
            f"LEFT JOIN {source} p ON {match.format('p', 1)} LEFT JOIN {source} q ON {match.format('q', 2)}")


VALUE_BLOCKS = {
    "g2w_o": "SELECT season, 2.109::DOUBLE/(4*(SUM(goals_for)/SUM(gp))) AS g2w FROM standings_v GROUP BY season",
    "comp_rows_o": """
SELECT s.season, s.player_id, s.position, s.team, s.situation, s.toi, s.gp, c.component,
 CASE c.component WHEN 'evo' THEN evo_rapm WHEN 'evd' THEN evd_rapm WHEN 'ppl' THEN ppl_rapm ELSE pkl_rapm END AS rate
FROM skater_stats_o s JOIN (VALUES ('evo', '5v5'), ('evd', '5v5'), ('ppl', '5v4'), ('pkl', '4v5')) c(component, situation)
 USING (situation) LEFT JOIN ratings_v r USING (season, player_id)""",
    "levels_o": """
SELECT season, component, position, SUM(rate*toi)/SUM(toi) AS replacement FROM (
 SELECT *, ROW_NUMBER() OVER (PARTITION BY season, component, position, team ORDER BY toi DESC, player_id) AS nth
 FROM comp_rows_o WHERE rate IS NOT NULL AND toi > 0)
WHERE nth > CASE situation WHEN '5v5' THEN CASE position WHEN 'F' THEN {f5} ELSE {d5} END
  WHEN '5v4' THEN CASE position WHEN 'F' THEN {fp} ELSE {dp} END ELSE CASE position WHEN 'F' THEN {fk} ELSE {dk} END END
GROUP BY ALL""".format(f5=2, d5=1, fp=1, dp=1, fk=1, dk=1),
    "comp_war_o": """
SELECT season, player_id, position, component,
 (COALESCE(rate, COALESCE(replacement, 0)) - COALESCE(replacement, 0))*toi/60.0*g2w AS war_total,
 (COALESCE(rate, COALESCE(replacement, 0)) - COALESCE(replacement, 0))*toi/60.0*g2w/NULLIF(gp, 0) AS war
FROM comp_rows_o LEFT JOIN levels_o USING (season, component, position) JOIN g2w_o USING (season)""",
    "finishing_o": """
SELECT season, shooter_id AS player_id, strength, COUNT(*) FILTER (event_type = 'goal') AS goals, SUM(xg) AS xg,
 COUNT(*) AS shots, (COUNT(*) FILTER (event_type = 'goal') - SUM(xg))*COUNT(*)/(COUNT(*) + 100.0) AS finishing
FROM tagged_shots_o WHERE shooter_id IS NOT NULL GROUP BY ALL""",
    "penwar_o": """
SELECT x.season, player_id, strength, SUM(net)*CASE strength WHEN '4v5' THEN 0.24575 ELSE 0.09624 END*g2w
 *COUNT(*)/(COUNT(*) + 10.0) AS penalty_war
FROM (SELECT p.season, s.strength, e.p AS player_id, e.m AS net FROM (
   SELECT *, unnest([{'p': drew_player_id, 'm': minutes}, {'p': penalty_player_id, 'm': -minutes}]) AS e
   FROM penalties_v WHERE minutes <> 10) p JOIN strength_o s USING (season, game_id, period, sec, team)
  WHERE strength IN ('5v5', '5v4', '4v5')) x JOIN g2w_o g ON g.season = x.season
WHERE player_id IS NOT NULL GROUP BY x.season, player_id, strength, g2w""",
    "skater_war_o": """
SELECT *, evo_war + evd_war + ppl_war + pkl_war + fin_war + pen_war AS tot_war,
 evo_war_total + evd_war_total + ppl_war_total + pkl_war_total + fin_war_total + pen_war_total AS tot_war_total FROM (
SELECT *, fin_war_total/NULLIF(gp, 0) AS fin_war, pen_war_total/NULLIF(gp, 0) AS pen_war FROM (
SELECT c.season, c.player_id, c.position, g.gp,
 COALESCE(SUM(war) FILTER (component = 'evo'), 0) AS evo_war, COALESCE(SUM(war_total) FILTER (component = 'evo'), 0) AS evo_war_total,
 COALESCE(SUM(war) FILTER (component = 'evd'), 0) AS evd_war, COALESCE(SUM(war_total) FILTER (component = 'evd'), 0) AS evd_war_total,
 COALESCE(SUM(war) FILTER (component = 'ppl'), 0) AS ppl_war, COALESCE(SUM(war_total) FILTER (component = 'ppl'), 0) AS ppl_war_total,
 COALESCE(SUM(war) FILTER (component = 'pkl'), 0) AS pkl_war, COALESCE(SUM(war_total) FILTER (component = 'pkl'), 0) AS pkl_war_total,
 COALESCE(ANY_VALUE(f.v), 0) AS fin_war_total, COALESCE(ANY_VALUE(p.v), 0) AS pen_war_total
FROM comp_war_o c
LEFT JOIN (SELECT season, player_id, gp FROM skater_stats_o WHERE situation = 'all') g USING (season, player_id)
LEFT JOIN (SELECT season, player_id, SUM(finishing*g2w) AS v FROM finishing_o JOIN g2w_o USING (season)
  WHERE strength IN ('5v5', '5v4', '4v5') GROUP BY ALL) f USING (season, player_id)
LEFT JOIN (SELECT season, player_id, SUM(penalty_war) AS v FROM penwar_o GROUP BY ALL) p USING (season, player_id)
GROUP BY c.season, c.player_id, c.position, g.gp))""",
    "goalie_rate_o": """
SELECT s.season, s.player_id, s.team, s.situation, s.toi, s.gp,
 CASE WHEN toi > 0 THEN COALESCE(v.gsax, 0)*60/toi ELSE 0 END AS rate
FROM goalie_stats_o s LEFT JOIN (
 SELECT season, goalie_id AS player_id, CASE strength WHEN '5v4' THEN '4v5' ELSE '5v5' END AS situation,
  (SUM(xg) - COUNT(*) FILTER (event_type = 'goal'))*COUNT(*)/(COUNT(*) + 300.0) AS gsax
 FROM tagged_shots_o WHERE goalie_id IS NOT NULL AND strength IN ('5v5', '5v4') GROUP BY ALL) v
USING (season, player_id, situation) WHERE s.situation <> 'all'""",
    "goalie_war_o": """
SELECT *, evs_war + pkl_war AS tot_war, evs_war_total + pkl_war_total AS tot_war_total FROM (
SELECT season, player_id,
 COALESCE(SUM(t/NULLIF(gp, 0)) FILTER (situation = '5v5'), 0) AS evs_war, COALESCE(SUM(t) FILTER (situation = '5v5'), 0) AS evs_war_total,
 COALESCE(SUM(t/NULLIF(gp, 0)) FILTER (situation = '4v5'), 0) AS pkl_war, COALESCE(SUM(t) FILTER (situation = '4v5'), 0) AS pkl_war_total
FROM (SELECT r.*, (rate - replacement)*toi/60.0*g2w AS t FROM goalie_rate_o r LEFT JOIN (
  SELECT season, situation, SUM(rate*toi)/SUM(toi) AS replacement FROM (
   SELECT *, ROW_NUMBER() OVER (PARTITION BY season, situation, team ORDER BY toi DESC, player_id) AS nth
   FROM goalie_rate_o WHERE toi > 0) WHERE nth > 1 GROUP BY ALL) l USING (season, situation) JOIN g2w_o USING (season))
GROUP BY season, player_id)""",
    "games_o": """
SELECT season, MAX(n) AS season_games FROM (
 SELECT season, team, COUNT(DISTINCT game_id) AS n FROM (
  SELECT season, game_id, home_team AS team FROM schedule_v UNION ALL SELECT season, game_id, away_team FROM schedule_v)
 GROUP BY ALL) GROUP BY season""",
    "qual_skater_o": """
SELECT a.season, a.player_id, a.player, a.team, a.position, a.gp AS all_gp, a.toi AS all_toi,
 e.gp AS e_gp, e.ixg, e.goals, e.first_assists, e.second_assists, e.hits, e.hits_taken, e.off_zone_starts,
 e.neu_zone_starts, e.def_zone_starts, COALESCE(e.pdo, 0) AS pdo, p.toi >= a.gp*0.75 AS ppl_ok, k.toi >= a.gp*0.75 AS pkl_ok
FROM (SELECT * FROM skater_stats_o WHERE situation = 'all') a
JOIN (SELECT * FROM skater_stats_o WHERE situation = '5v5') e USING (season, player_id)
JOIN (SELECT * FROM skater_stats_o WHERE situation = '5v4') p USING (season, player_id)
JOIN (SELECT * FROM skater_stats_o WHERE situation = '4v5') k USING (season, player_id)
JOIN games_o USING (season) WHERE a.toi >= season_games*3.6585::DOUBLE""",
    "qual_goalie_o": """
SELECT a.season, a.player_id, a.player, a.team, a.position, a.gp AS all_gp, a.toi AS all_toi,
 e.gp AS e_gp, e.rebound_xg_against, COALESCE(e.xg_against, 0) AS xg_against, e.ld_xg_against, e.ld_goals_against,
 e.md_xg_against, e.md_goals_against, e.hd_xg_against, e.hd_goals_against
FROM (SELECT * FROM goalie_stats_o WHERE situation = 'all') a
JOIN (SELECT * FROM goalie_stats_o WHERE situation = '5v5') e USING (season, player_id)
JOIN games_o USING (season) WHERE a.gp >= season_games*0.15::DOUBLE""",
    "skater_scores_o": """
SELECT season, player_id, player, team, q.position, tot_war AS ovr_score, evo_war AS evo_score, evd_war AS evd_score,
 CASE WHEN ppl_ok THEN ppl_war END AS ppl_score, CASE WHEN pkl_ok THEN pkl_war END AS pkl_score,
 fin_war AS fin_score, pen_war AS pen_score, ixg/NULLIF(e_gp, 0) AS xgl_score, goals/NULLIF(e_gp, 0) AS gol_score,
 (first_assists*0.8::DOUBLE + second_assists*0.2::DOUBLE)/NULLIF(e_gp, 0) AS ast_score,
 (hits + hits_taken*0.5)/NULLIF(e_gp, 0) AS hit_score,
 off_zone_starts/NULLIF(off_zone_starts + neu_zone_starts + def_zone_starts, 0)*100 AS ozs_score, pdo AS pdo_score
FROM qual_skater_o q LEFT JOIN skater_war_o w USING (season, player_id)""",
    "starts_o": """
SELECT g.season, g.player_id, SUM(CASE WHEN gsax >= 1.5 THEN 1 WHEN l.player_id IS NOT NULL THEN 0 END)*1.0/gp AS gre_score,
 SUM(CASE WHEN gsax >= 0 THEN 1 WHEN l.player_id IS NOT NULL THEN 0 END)*1.0/gp AS qal_score,
 -SUM(CASE WHEN gsax < 0 THEN 1 WHEN l.player_id IS NOT NULL THEN 0 END)*1.0/gp AS bad_score,
 -SUM(CASE WHEN gsax <= -1.5 THEN 1 WHEN l.player_id IS NOT NULL THEN 0 END)*1.0/gp AS awf_score
FROM goalie_gp_o g LEFT JOIN goalie_logs_v l USING (season, player_id)
LEFT JOIN game_gsax_o x ON (x.season, x.player_id, x.game_id) = (l.season, l.player_id, l.game_id)
GROUP BY g.season, g.player_id, gp""",
    "goalie_scores_o": """
SELECT season, player_id, player, team, position, tot_war AS ovr_score, evs_war AS evs_score, pkl_war AS pkl_score,
 (ld_xg_against - ld_goals_against)/NULLIF(e_gp, 0) AS ldg_score, (md_xg_against - md_goals_against)/NULLIF(e_gp, 0) AS mdg_score,
 (hd_xg_against - hd_goals_against)/NULLIF(e_gp, 0) AS hdg_score, -rebound_xg_against/NULLIF(e_gp, 0) AS rbd_score,
 -xg_against/NULLIF(e_gp, 0) AS tmd_score, gre_score, qal_score, bad_score, awf_score, all_gp + all_toi/60.0 AS wrk_score
FROM qual_goalie_o LEFT JOIN goalie_war_o USING (season, player_id) LEFT JOIN starts_o USING (season, player_id)""",
    # ranks over rounded scores, so that equal values stay equal in both engines
    "skater_round_o": "SELECT season, player_id, player, team, position, " + ", ".join(
        f"ROUND({a}_score, 6) AS {a}_score" for a in SCORES["skater"]) + " FROM skater_scores_o",
    "goalie_round_o": "SELECT season, player_id, player, team, position, " + ", ".join(
        f"ROUND({a}_score, 6) AS {a}_score" for a in SCORES["goalie"]) + " FROM goalie_scores_o",
}
