"""DuckDB blocks for season statistics."""

STATS_BLOCKS = {
    "player_buckets_o": """
SELECT *, unnest(CASE WHEN situation IN ('5v5', '5v4', '4v5') THEN ['all', situation] ELSE ['all'] END) AS bucket
FROM player_stints_o""",
    "ptot_o": """
SELECT season, player_id, bucket AS situation, SUM(duration)/60.0 AS stint_toi, SUM(gf) AS gf, SUM(ga) AS ga,
 SUM(xgf) AS xgf, SUM(xga) AS xga, SUM(sogf) AS sogf, SUM(soga) AS soga,
 SUM(zone_o) AS off_zone_starts, SUM(zone_n) AS neu_zone_starts, SUM(zone_d) AS def_zone_starts,
 CASE WHEN SUM(gf) + SUM(ga) > 0 THEN SUM(gf)*100.0/(SUM(gf) + SUM(ga)) END AS gf_pct,
 CASE WHEN SUM(xgf) + SUM(xga) > 0 THEN SUM(xgf)*100.0/(SUM(xgf) + SUM(xga)) END AS xgf_pct,
 CASE WHEN SUM(sogf) > 0 THEN SUM(gf)*1.0/SUM(sogf) ELSE 0 END
 + CASE WHEN SUM(soga) > 0 THEN 1 - SUM(ga)*1.0/SUM(soga) ELSE 0 END AS pdo
FROM player_buckets_o GROUP BY season, player_id, bucket""",
    "skater_gp_o": """
SELECT season, player_id, COUNT(DISTINCT game_id) AS gp FROM (
 SELECT season, player_id, game_id FROM box_skater_v UNION ALL
 SELECT season, player_id, game_id FROM clean_v
 WHERE NOT is_goalie AND season NOT IN (SELECT season FROM box_skater_v)) GROUP BY ALL""",
    "goalie_gp_o": """
SELECT season, player_id, COUNT(DISTINCT game_id) AS gp FROM (
 SELECT season, player_id, game_id FROM box_goalie_v WHERE toi > 0 UNION ALL
 SELECT season, player_id, game_id FROM clean_v
 WHERE is_goalie AND season NOT IN (SELECT season FROM box_goalie_v WHERE toi > 0)) GROUP BY ALL""",
    "skater_toi_o": """
SELECT season, player_id, situation, stint_toi AS toi FROM ptot_o
WHERE situation <> 'all' OR season NOT IN (SELECT season FROM box_skater_v)
UNION ALL SELECT season, player_id, 'all', SUM(toi) FROM box_skater_v GROUP BY season, player_id""",
    "credits_o": """
SELECT season, game_id, period, sec, team, shooter_id AS player_id, 'goals' AS metric, 1.0 AS value
 FROM shots_v WHERE event_type = 'goal' UNION ALL
SELECT season, game_id, period, sec, team, shooter_id, 'ixg', xg FROM shots_v UNION ALL
SELECT season, game_id, period, sec, team, assist1_id, 'first_assists', 1 FROM goals_v UNION ALL
SELECT season, game_id, period, sec, team, assist2_id, 'second_assists', 1 FROM goals_v UNION ALL
SELECT season, game_id, period, sec, team, player_id, event_type || 's', 1 FROM possession_v UNION ALL
SELECT season, game_id, period, sec, team, hittee_id, 'hits_taken', 1 FROM possession_v WHERE event_type = 'hit' UNION ALL
SELECT season, game_id, period, sec, team, drew_player_id, 'penalties_drawn', 1 FROM penalties_v WHERE minutes <> 10 UNION ALL
SELECT season, game_id, period, sec, team, penalty_player_id, 'total_penalties', 1 FROM penalties_v WHERE minutes <> 10""",
    "etot_o": """
SELECT season, player_id, situation,
 SUM(CASE WHEN metric = 'goals' THEN value ELSE 0 END) AS goals,
 SUM(CASE WHEN metric = 'ixg' THEN value ELSE 0 END) AS ixg,
 SUM(CASE WHEN metric = 'first_assists' THEN value ELSE 0 END) AS first_assists,
 SUM(CASE WHEN metric = 'second_assists' THEN value ELSE 0 END) AS second_assists,
 SUM(CASE WHEN metric = 'hits' THEN value ELSE 0 END) AS hits,
 SUM(CASE WHEN metric = 'hits_taken' THEN value ELSE 0 END) AS hits_taken,
 SUM(CASE WHEN metric = 'giveaways' THEN value ELSE 0 END) AS giveaways,
 SUM(CASE WHEN metric = 'takeaways' THEN value ELSE 0 END) AS takeaways,
 SUM(CASE WHEN metric = 'penalties_drawn' THEN value ELSE 0 END) AS penalties_drawn,
 SUM(CASE WHEN metric = 'total_penalties' THEN value ELSE 0 END) AS total_penalties
FROM (SELECT c.*, unnest(CASE WHEN s.strength IN ('5v5', '5v4', '4v5') THEN ['all', s.strength] ELSE ['all'] END) AS situation
 FROM credits_o c LEFT JOIN strength_o s USING (season, game_id, period, sec, team) WHERE player_id IS NOT NULL)
GROUP BY season, player_id, situation""",
    "goalie_toi_o": """
SELECT season, player_id, bucket AS situation, SUM(duration)/60.0 AS toi FROM (
 SELECT *, unnest(CASE WHEN situation IN ('5v5', '4v5') THEN ['all', situation] ELSE ['all'] END) AS bucket
 FROM goalie_stints_o) GROUP BY season, player_id, bucket""",
    "tagged_shots_o": """
SELECT h.*, COALESCE(s.strength, 'unknown') AS strength,
 CASE WHEN xg >= 0.08 THEN 'HD' WHEN xg >= 0.02 THEN 'MD' ELSE 'LD' END AS tier
FROM shots_v h LEFT JOIN strength_o s USING (season, game_id, period, sec, team)""",
    "goalie_shots_o": """
SELECT x.*, saves*1.0/NULLIF(shots_against, 0) AS sv_pct,
 CASE WHEN t.toi > 0 THEN goals_against/(t.toi/60.0) END AS gaa
FROM (SELECT *, shots_against - goals_against AS saves, hd_shots_against - hd_goals_against AS hd_saves,
  md_shots_against - md_goals_against AS md_saves, ld_shots_against - ld_goals_against AS ld_saves FROM (
  SELECT season, goalie_id AS player_id, situation,
   COUNT(*) FILTER (event_type <> 'missed-shot') AS shots_against, COUNT(*) FILTER (event_type = 'goal') AS goals_against,
   SUM(xg) AS xg_against, SUM(is_rebound) AS rebound_attempts_against, SUM(xg*is_rebound) AS rebound_xg_against,
   COUNT(*) FILTER (event_type <> 'missed-shot' AND tier = 'HD') AS hd_shots_against,
   COUNT(*) FILTER (event_type = 'goal' AND tier = 'HD') AS hd_goals_against,
   COALESCE(SUM(xg) FILTER (tier = 'HD'), 0) AS hd_xg_against,
   COUNT(*) FILTER (event_type <> 'missed-shot' AND tier = 'MD') AS md_shots_against,
   COUNT(*) FILTER (event_type = 'goal' AND tier = 'MD') AS md_goals_against,
   COALESCE(SUM(xg) FILTER (tier = 'MD'), 0) AS md_xg_against,
   COUNT(*) FILTER (event_type <> 'missed-shot' AND tier = 'LD') AS ld_shots_against,
   COUNT(*) FILTER (event_type = 'goal' AND tier = 'LD') AS ld_goals_against,
   COALESCE(SUM(xg) FILTER (tier = 'LD'), 0) AS ld_xg_against
  FROM (SELECT *, unnest(CASE strength WHEN '5v5' THEN ['all', '5v5'] WHEN '5v4' THEN ['all', '4v5'] ELSE ['all'] END) AS situation
   FROM tagged_shots_o WHERE goalie_id IS NOT NULL) GROUP BY season, goalie_id, situation)) x
LEFT JOIN goalie_toi_o t USING (season, player_id, situation)""",
    "game_gsax_o": """
SELECT season, goalie_id AS player_id, game_id, COUNT(*) FILTER (event_type <> 'missed-shot') AS shots_against,
 COUNT(*) FILTER (event_type = 'goal') AS goals_against, SUM(xg) AS xg_against,
 SUM(xg) - COUNT(*) FILTER (event_type = 'goal') AS gsax
FROM shots_v WHERE goalie_id IS NOT NULL GROUP BY ALL""",
    "skater_stats_o": """
SELECT r.*, s.situation, COALESCE(g.gp, 0) AS gp, COALESCE(t.toi, 0) AS toi,
 COALESCE(goals, 0) AS goals, COALESCE(first_assists, 0) AS first_assists, COALESCE(second_assists, 0) AS second_assists,
 COALESCE(first_assists, 0) + COALESCE(second_assists, 0) AS total_assists,
 COALESCE(goals, 0) + COALESCE(first_assists, 0) + COALESCE(second_assists, 0) AS total_points,
 COALESCE(ixg, 0) AS ixg, COALESCE(hits, 0) AS hits, COALESCE(hits_taken, 0) AS hits_taken,
 COALESCE(giveaways, 0) AS giveaways, COALESCE(takeaways, 0) AS takeaways,
 COALESCE(penalties_drawn, 0) AS penalties_drawn, COALESCE(total_penalties, 0) AS total_penalties,
 COALESCE(off_zone_starts, 0) AS off_zone_starts, COALESCE(neu_zone_starts, 0) AS neu_zone_starts,
 COALESCE(def_zone_starts, 0) AS def_zone_starts, gf_pct, xgf_pct, pdo
FROM (SELECT * FROM roster_v WHERE position <> 'G') r
CROSS JOIN (SELECT unnest(['all', '5v5', '5v4', '4v5']) AS situation) s
LEFT JOIN skater_gp_o g USING (season, player_id)
LEFT JOIN skater_toi_o t USING (season, player_id, situation)
LEFT JOIN ptot_o p USING (season, player_id, situation)
LEFT JOIN etot_o e USING (season, player_id, situation)""",
    "goalie_stats_o": """
SELECT r.*, s.situation, COALESCE(g.gp, 0) AS gp, COALESCE(t.toi, 0) AS toi,
 COALESCE(shots_against, 0) AS shots_against, COALESCE(saves, 0) AS saves, COALESCE(goals_against, 0) AS goals_against,
 sv_pct, gaa, xg_against,
 COALESCE(hd_shots_against, 0) AS hd_shots_against, COALESCE(hd_saves, 0) AS hd_saves,
 COALESCE(hd_goals_against, 0) AS hd_goals_against, COALESCE(hd_xg_against, 0) AS hd_xg_against,
 COALESCE(md_shots_against, 0) AS md_shots_against, COALESCE(md_saves, 0) AS md_saves,
 COALESCE(md_goals_against, 0) AS md_goals_against, COALESCE(md_xg_against, 0) AS md_xg_against,
 COALESCE(ld_shots_against, 0) AS ld_shots_against, COALESCE(ld_saves, 0) AS ld_saves,
 COALESCE(ld_goals_against, 0) AS ld_goals_against, COALESCE(ld_xg_against, 0) AS ld_xg_against,
 COALESCE(rebound_attempts_against, 0) AS rebound_attempts_against, COALESCE(rebound_xg_against, 0) AS rebound_xg_against
FROM (SELECT * FROM roster_v WHERE position = 'G') r
CROSS JOIN (SELECT unnest(['all', '5v5', '4v5']) AS situation) s
LEFT JOIN goalie_gp_o g USING (season, player_id)
LEFT JOIN goalie_toi_o t USING (season, player_id, situation)
LEFT JOIN goalie_shots_o f USING (season, player_id, situation)""",
}
