"""A league seen through the driver's ``events`` table.

Each view is one SQL text that Spark and DuckDB accept unchanged; later views may use
earlier ones by name. Every row of ``events`` is a shift and a play at once: the user is
the player, the day of the year and the team pair make the game, the hour makes the
period. Periods last 28,800 seconds and seasons ten days.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from icelens.config import Rules

LEAGUE_RULES = Rules(period_seconds=28800)

VIEWS = {
    "base_v": """
SELECT event_id, user_id, event_type, value,
 CONCAT(CAST(2021 + CAST(FLOOR((dayofyear(ts)-1)/10) AS INT) AS VARCHAR(4)), '-',
        CAST(2022 + CAST(FLOOR((dayofyear(ts)-1)/10) AS INT) AS VARCHAR(4))) AS season,
 dayofyear(ts) AS day_no,
 user_id % 8 + 8*CAST(FLOOR(user_id/150) AS BIGINT) AS team_no,
 CAST(FLOOR(user_id/150) AS BIGINT) AS block_no,
 dayofyear(ts)*10000 + CAST(FLOOR((user_id % 8 + 8*CAST(FLOOR(user_id/150) AS BIGINT))/2) AS BIGINT) AS game_id,
 1 + CAST(FLOOR(hour(ts)/8) AS INT) AS period,
 (hour(ts) % 8)*3600 + minute(ts)*60 + CAST(FLOOR(second(ts)) AS INT) AS sec0
FROM events""",
    "shifts_v": """
SELECT season, game_id, period, user_id AS player_id, CONCAT('T', CAST(team_no AS VARCHAR(10))) AS team,
 CASE WHEN CAST(FLOOR(user_id/8) AS BIGINT) % 9 = 0 THEN TRUE ELSE FALSE END AS is_goalie,
 sec0 AS start_sec, LEAST(28800, sec0 + CAST(FLOOR(value*240) AS INT)) AS end_sec, event_id
FROM base_v""",
    # shifts with a positive length; what the interval operators take
    "clean_v": "SELECT * FROM shifts_v WHERE end_sec > start_sec",
    "pbp_v": """
SELECT season, game_id, day_no, period, event_id AS seq, user_id AS player_id, team_no, block_no,
 CONCAT('T', CAST(team_no AS VARCHAR(10))) AS team,
 CASE event_type WHEN 'purchase' THEN 'goal' WHEN 'click' THEN 'shot-on-goal' WHEN 'view' THEN 'missed-shot'
                 WHEN 'signup' THEN 'faceoff' ELSE 'penalty' END AS type,
 CASE WHEN event_type='signup' THEN sec0 ELSE LEAST(28800, sec0 + event_id % 90) END AS sec,
 (event_id*37) % 199 - 99 AS x, (event_id*53) % 85 - 42 AS y
FROM base_v""",
    "goals_v": """
SELECT season, game_id, period, seq, team, sec, player_id,
 CASE WHEN seq % 3 > 0 THEN player_id + 8 END AS assist1_id,
 CASE WHEN seq % 3 = 2 THEN player_id + 16 END AS assist2_id
FROM pbp_v WHERE type = 'goal'""",
    "shots_v": """
SELECT season, game_id, period, seq, team, sec, type AS event_type,
 CASE WHEN seq % 23 = 0 THEN NULL ELSE player_id END AS shooter_id,
 CASE WHEN seq % 17 = 0 THEN NULL
      ELSE (team_no + 1 - 2*(team_no % 2)) % 8 + 72*CAST(CEIL(150*block_no/72.0) AS BIGINT) END AS goalie_id,
 x, y,
 0.3*EXP(-SQRT((CASE WHEN x >= 0 THEN 89 - x ELSE -89 - x END)*(CASE WHEN x >= 0 THEN 89 - x ELSE -89 - x END)
               + y*y)/30.0) AS xg,
 CASE WHEN seq % 7 = 0 THEN 1 ELSE 0 END AS is_rebound
FROM pbp_v WHERE type IN ('goal', 'shot-on-goal', 'missed-shot')""",
    "faceoffs_v": """
SELECT season, game_id, period, seq, team, sec,
 CASE WHEN x < -25 THEN 'D' WHEN x > 25 THEN 'O' ELSE 'N' END AS zone
FROM pbp_v WHERE type = 'faceoff'""",
    "penalties_v": """
SELECT season, game_id, period, seq, team, sec,
 CASE WHEN seq % 19 = 0 THEN NULL ELSE player_id END AS penalty_player_id,
 CASE WHEN seq % 5 = 0 THEN NULL ELSE player_id + 1 - 2*(player_id % 2) END AS drew_player_id,
 CASE seq % 4 WHEN 0 THEN 2 WHEN 1 THEN 4 WHEN 2 THEN 5 ELSE 10 END AS minutes
FROM pbp_v WHERE type = 'penalty'""",
    "possession_v": """
SELECT season, game_id, period, seq, team, sec,
 CASE seq % 3 WHEN 0 THEN 'hit' WHEN 1 THEN 'giveaway' ELSE 'takeaway' END AS event_type,
 CASE WHEN seq % 29 = 0 THEN NULL ELSE player_id END AS player_id,
 CASE WHEN seq % 3 = 0 AND seq % 4 > 0 THEN player_id + 1 - 2*(player_id % 2) END AS hittee_id
FROM pbp_v WHERE type IN ('missed-shot', 'shot-on-goal')""",
    "roster_v": """
SELECT season, player_id, MIN(team) AS team, CONCAT('Player ', CAST(player_id AS VARCHAR(12))) AS player,
 CASE WHEN CAST(FLOOR(player_id/8) AS BIGINT) % 9 = 0 THEN 'G'
      WHEN CAST(FLOOR(player_id/8) AS BIGINT) % 3 = 0 THEN 'D' ELSE 'F' END AS position,
 CASE WHEN CAST(FLOOR(player_id/8) AS BIGINT) % 9 = 0 THEN 'G'
      WHEN CAST(FLOOR(player_id/8) AS BIGINT) % 3 = 0 THEN 'D'
      WHEN player_id % 3 = 0 THEN 'C' WHEN player_id % 3 = 1 THEN 'L' ELSE 'R' END AS specific_position
FROM shifts_v GROUP BY season, player_id""",
    "schedule_v": """
SELECT season, game_id, DATE '2024-01-01' + CAST((day_no-1)*(1 + game_id % 2) AS INT) AS date,
 CONCAT('T', CAST(2*(game_id % 10000) + day_no % 2 AS VARCHAR(10))) AS home_team,
 CONCAT('T', CAST(2*(game_id % 10000) + 1 - day_no % 2 AS VARCHAR(10))) AS away_team
FROM (SELECT DISTINCT season, game_id, day_no FROM pbp_v) g""",
    "standings_v": """
SELECT g.season, g.team, g.gp, COALESCE(s.goals_for, 0) AS goals_for
FROM (SELECT season, team, COUNT(*) AS gp FROM
        (SELECT season, home_team AS team FROM schedule_v UNION ALL
         SELECT season, away_team AS team FROM schedule_v) t GROUP BY season, team) g
LEFT JOIN (SELECT season, team, COUNT(*) AS goals_for FROM goals_v GROUP BY season, team) s
  ON g.season = s.season AND g.team = s.team""",
    # the first season has no box scores, so its totals come from shifts
    "box_skater_v": """
SELECT season, game_id, player_id, MIN(team) AS team, SUM(end_sec - start_sec)/CAST(60 AS DOUBLE) AS toi, COUNT(*) AS shifts
FROM clean_v WHERE NOT is_goalie AND season <> '2021-2022' GROUP BY season, game_id, player_id""",
    "box_goalie_v": """
SELECT season, game_id, player_id, MIN(team) AS team,
 CASE WHEN game_id % 5 = 0 THEN CAST(0 AS DOUBLE) ELSE SUM(end_sec - start_sec)/CAST(60 AS DOUBLE) END AS toi
FROM clean_v WHERE is_goalie AND season <> '2021-2022' GROUP BY season, game_id, player_id""",
    "goalie_logs_v": """
SELECT season, game_id, player_id, MIN(team) AS team,
 CASE (player_id + game_id) % 4 WHEN 0 THEN 'W' WHEN 1 THEN 'L' WHEN 2 THEN 'O' END AS result,
 CASE WHEN (player_id + game_id) % 8 = 0 THEN 1 ELSE 0 END AS shutouts
FROM shifts_v WHERE is_goalie GROUP BY season, game_id, player_id""",
    # plays as a feed would carry them, with the gaps a feed has
    "plays_v": """
SELECT season, game_id, CAST(FLOOR(seq/64) AS BIGINT) AS doc_no, seq % 64 AS pos, seq AS sort_order,
 CASE WHEN seq % 53 = 0 THEN NULL
      WHEN type = 'penalty' THEN CASE seq % 4 WHEN 1 THEN 'hit' WHEN 2 THEN 'giveaway' WHEN 3 THEN 'takeaway' ELSE 'penalty' END
      WHEN type = 'missed-shot' AND seq % 6 = 0 THEN 'blocked-shot' ELSE type END AS type,
 CASE WHEN seq % 37 = 0 THEN NULL
      ELSE CONCAT(LPAD(CAST(CAST(FLOOR(sec/60) AS BIGINT) AS VARCHAR(10)), 3, '0'), ':',
                  LPAD(CAST(sec % 60 AS VARCHAR(10)), 2, '0')) END AS time,
 CASE WHEN seq % 31 = 0 THEN NULL ELSE period END AS period,
 CASE WHEN seq % 41 = 0 THEN 'SO' ELSE 'REG' END AS period_type,
 CASE WHEN seq % 43 = 0 THEN NULL ELSE team_no END AS team_id,
 CASE WHEN seq % 43 = 0 THEN NULL ELSE team END AS team,
 CASE WHEN seq % 47 = 0 THEN NULL ELSE CAST(x AS DOUBLE) END AS x, CAST(y AS DOUBLE) AS y,
 CASE WHEN x < -25 THEN 'D' WHEN x > 25 THEN 'O' ELSE 'N' END AS zone,
 CASE seq % 4 WHEN 0 THEN 'wrist' WHEN 1 THEN 'slap' WHEN 2 THEN 'snap' END AS shot_type,
 CASE WHEN type = 'goal' THEN player_id END AS scoring_player_id,
 CASE WHEN type IN ('shot-on-goal', 'missed-shot') THEN player_id END AS shooting_player_id,
 CASE WHEN seq % 17 > 0 AND type IN ('goal', 'shot-on-goal', 'missed-shot') THEN
  (team_no + 1 - 2*(team_no % 2)) % 8 + 72*CAST(CEIL(150*block_no/CAST(72 AS DOUBLE)) AS BIGINT) END AS goalie_id,
 CASE WHEN type = 'goal' AND seq % 3 > 0 THEN player_id + 8 END AS assist1_id,
 CASE WHEN type = 'goal' AND seq % 3 = 2 THEN player_id + 16 END AS assist2_id,
 CASE WHEN type = 'penalty' AND seq % 19 > 0 THEN player_id END AS committed_by_id,
 CASE WHEN type = 'penalty' AND seq % 5 > 0 THEN player_id + 1 - 2*(player_id % 2) END AS drawn_by_id,
 CASE WHEN type = 'penalty' THEN 'minor' END AS penalty_type,
 CASE WHEN type = 'penalty' AND seq % 8 > 0 THEN 2 + seq % 3 END AS duration,
 CASE WHEN type = 'penalty' AND seq % 29 > 0 THEN player_id END AS actor_id,
 CASE WHEN type = 'penalty' AND seq % 3 > 0 THEN player_id + 1 - 2*(player_id % 2) END AS hittee_id
FROM pbp_v""",
    # shares of a player's plays, standing in for fitted ratings where SQL has to follow
    "ratings_v": """
SELECT season, player_id,
 SUM(CASE WHEN type = 'goal' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)/COUNT(*) AS evo_rapm,
 SUM(CASE WHEN type = 'faceoff' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)/COUNT(*) AS evd_rapm,
 CASE WHEN player_id % 6 = 0 THEN NULL
      ELSE SUM(CASE WHEN type = 'shot-on-goal' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)/COUNT(*) END AS ppl_rapm,
 CASE WHEN player_id % 7 = 0 THEN NULL
      ELSE -SUM(CASE WHEN type = 'penalty' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)/COUNT(*) END AS pkl_rapm
FROM pbp_v GROUP BY season, player_id""",
    "bios_v": """
SELECT DISTINCT player_id,
 CASE player_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'R' ELSE 'L' END AS shoots_catches,
 DATE '1988-06-01' + CAST((player_id*137) % 5200 AS INT) AS birth_date,
 66 + player_id % 13 AS height_in, 160 + (player_id*7) % 80 AS weight_lb,
 CASE player_id % 3 WHEN 0 THEN 'CAN' WHEN 1 THEN 'USA' ELSE 'SWE' END AS birth_country,
 CASE WHEN player_id % 4 > 0 THEN 2005 + player_id % 15 END AS draft_year,
 CASE WHEN player_id % 4 > 0 THEN 1 + player_id % 7 END AS draft_round,
 CASE WHEN player_id % 4 > 0 THEN 30*(player_id % 7) + 1 + player_id % 30 END AS draft_overall_pick
FROM shifts_v""",
}


def with_views(query: str, events: str = "events") -> str:
    """``query`` with every view it needs in front, as one statement."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in re.findall(r"\b\w+_v\b", text):
            if name in VIEWS and name not in needed:
                needed.add(name)
                visit(VIEWS[name])

    visit(query)
    parts = [f"{n} AS ({re.sub(r'\bFROM events\b', f'FROM {events}', VIEWS[n])})" for n in VIEWS if n in needed]
    if not parts:
        return query
    body = query.lstrip()
    if body[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(parts) + ",\n" + body[5:]
    return "WITH " + ",\n".join(parts) + "\n" + query


def league(spark: SparkSession, folder: str):
    """``view(name)`` over ``folder``'s events; only the columns a view needs are read."""
    events = spark.read.parquet(f"{folder}/events.parquet")

    def view(name: str) -> DataFrame:
        return spark.sql(with_views(f"SELECT * FROM {name}", "{events}"), events=events)

    return view
