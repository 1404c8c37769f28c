"""Queries for wins above replacement, scores, rankings and cards."""

from __future__ import annotations

import dataclasses
import uuid

from pyspark.sql import DataFrame, Window as W, functions as F

from icelens.catalog.oracle_value import SCORES, ranked_sql, weighted_sql
from icelens.catalog.registry import register
from icelens.catalog.totals import goalie_table, skater_table, tables
from icelens.catalog.intervals import PAIRS_SQL, base_stints
from icelens.operators import aggregate as agg, overlap, quality, ranking, value
from icelens.operators.attach import tag_strength
from icelens.functions import text
from icelens.plans import cards, rankings, season, stats
from icelens.session import settle, shared_folder
from icelens.sources.league_views import LEAGUE_RULES, league
from icelens.sources.tables import TableStore

# Teams of the driver's league are small, so replacement starts lower on the list.
RULES = dataclasses.replace(LEAGUE_RULES, season_games={}, team_rank={
    ("5v5", "F"): 2, ("5v5", "D"): 1, ("5v4", "F"): 1, ("5v4", "D"): 1, ("4v5", "F"): 1, ("4v5", "D"): 1})


class Bench:
    """Inputs of the late stages for one folder; the stints are written once and shared."""

    def __init__(self, spark, folder):
        self.view = league(spark, folder)
        self.t = tables(self.view)
        self.stints = stats.measured_stints(self.t, RULES)

    def skaters(self) -> DataFrame:
        return settle(stats.skater_stats(self.t, self.stints, RULES), "skater_stats")

    def goalies(self) -> DataFrame:
        return settle(stats.goalie_stats(self.t, self.stints, RULES), "goalie_stats")

    def tagged(self, name: str) -> DataFrame:
        return tag_strength(self.view(name), self.stints, RULES)

    def skater_war(self, table: DataFrame) -> DataFrame:
        return value.skater_war(table, self.view("ratings_v"), self.t.standings, self.tagged("shots_v"),
                                self.tagged("penalties_v"), RULES)

    def goalie_war(self, table: DataFrame) -> DataFrame:
        return value.goalie_war(table, self.t.standings, self.tagged("shots_v"), RULES)

    def skater_scores(self, table: DataFrame) -> DataFrame:
        return rankings.skater_scores(rankings.qualify_skaters(table, self.t.schedule, RULES), self.skater_war(table))

    def goalie_scores(self, table: DataFrame) -> DataFrame:
        starts = agg.start_quality(self.t.goalie_logs, agg.game_gsax(self.t.shots),
                                   agg.goalie_gp(self.t.box_goalies, self.t.shifts), RULES)
        return rankings.goalie_scores(rankings.qualify_goalies(table, self.t.schedule, RULES),
                                      self.goalie_war(table), starts)


@register("goals_to_wins", "season g2w:r6", "SELECT * FROM g2w_o")
def _(spark, folder):
    return value.goals_to_wins(league(spark, folder)("standings_v"), RULES)


@register("replacement_level", "p_brand replacement:r4", """
SELECT p_brand, SUM(rate*toi)/SUM(toi) AS replacement FROM (
 SELECT *, ROW_NUMBER() OVER (PARTITION BY p_brand, team ORDER BY toi DESC, player_id) AS nth FROM (
  SELECT p_brand, l_suppkey AS team, l_partkey AS player_id, SUM(l_quantity) AS toi, AVG(l_discount) AS rate
  FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL)) WHERE nth > 2 GROUP BY p_brand""")
def _(spark, folder):
    items = spark.read.parquet(f"{folder}/lineitem.parquet").select("l_partkey", "l_suppkey", "l_quantity", "l_discount")
    parts = spark.read.parquet(f"{folder}/part.parquet").select("p_partkey", "p_brand")
    rated = (items.join(parts, items.l_partkey == parts.p_partkey)
             .groupBy("p_brand", F.col("l_suppkey").alias("team"), F.col("l_partkey").alias("player_id"))
             .agg(F.sum("l_quantity").alias("toi"), F.avg("l_discount").alias("rate")))
    return value.replacement_rates(rated, ["p_brand"], F.lit(2), 2)


@register("replacement_levels", "season component position replacement:r6", "SELECT * FROM levels_o")
def _(spark, folder):
    bench = Bench(spark, folder)
    return value.replacement_levels(value.component_rows(bench.skaters(), bench.view("ratings_v")), RULES)


@register("shrunk_finishing", "season player_id:l strength goals:l xg:r6 shots:l finishing:r6", "SELECT * FROM finishing_o")
def _(spark, folder):
    view = league(spark, folder)
    return value.finishing_impact(tag_strength(view("shots_v"), base_stints(view), RULES), ["strength"], RULES)


@register("penalty_impact", "season player_id:l strength penalty_war:r6", "SELECT * FROM penwar_o")
def _(spark, folder):
    view = league(spark, folder)
    tagged = tag_strength(view("penalties_v"), base_stints(view), RULES)
    return value.penalty_impact(tagged, value.goals_to_wins(view("standings_v"), RULES), RULES)


@register("component_war", "season player_id:l position component war:r6 war_total:r6", "SELECT * FROM comp_war_o")
def _(spark, folder):
    bench = Bench(spark, folder)
    rows = value.component_rows(bench.skaters(), bench.view("ratings_v"))
    return value.component_war(rows, value.replacement_levels(rows, RULES), value.goals_to_wins(bench.t.standings, RULES))


WAR = " ".join(f"{c}_war:r6 {c}_war_total:r6" for c in ("tot", "evo", "evd", "ppl", "pkl", "fin", "pen"))


@register("skater_war", f"season player_id:l position {WAR}", "SELECT * FROM skater_war_o")
def _(spark, folder):
    bench = Bench(spark, folder)
    return bench.skater_war(bench.skaters())


@register("goalie_war", "season player_id:l " + " ".join(f"{c}_war:r6 {c}_war_total:r6" for c in ("tot", "evs", "pkl")),
          "SELECT * FROM goalie_war_o")
def _(spark, folder):
    bench = Bench(spark, folder)
    return bench.goalie_war(bench.goalies())


@register("qualify_skaters", "season player_id:l position all_gp:l all_toi:r6 ppl_ok:b pkl_ok:b", "SELECT * FROM qual_skater_o")
def _(spark, folder):
    return rankings.qualify_skaters(skater_table(league(spark, folder)), league(spark, folder)("schedule_v"), RULES)


@register("qualify_goalies", "season player_id:l all_gp:l all_toi:r6", "SELECT * FROM qual_goalie_o")
def _(spark, folder):
    return rankings.qualify_goalies(goalie_table(league(spark, folder)), league(spark, folder)("schedule_v"), RULES)


def score_spec(kind: str, digits: int = 6) -> str:
    return " ".join(f"{a}_score:r{digits}" for a in SCORES[kind])


def rank_spec(attrs) -> str:
    return " ".join(f"{a}_pct:r1 {a}_rank:l" for a in attrs)


@register("scores", "season player_id:l position " + score_spec("skater"), "SELECT * FROM skater_scores_o")
def _(spark, folder):
    bench = Bench(spark, folder)
    return bench.skater_scores(bench.skaters())


@register("goalie_scores", "season player_id:l position " + score_spec("goalie"), "SELECT * FROM goalie_scores_o")
def _(spark, folder):
    bench = Bench(spark, folder)
    return bench.goalie_scores(bench.goalies())


@register("secondary_scores", "season player_id:l xgl_score:r6 gol_score:r6 ast_score:r6 hit_score:r6 ozs_score:r6 pdo_score:r6",
          "SELECT * FROM skater_scores_o")
def _(spark, folder):
    bench = Bench(spark, folder)
    qualified = rankings.qualify_skaters(bench.skaters(), bench.t.schedule, RULES)
    wins = [F.lit(None).cast("double").alias(f"{c}_war") for c in ("tot", "evo", "evd", "ppl", "pkl", "fin", "pen")]
    return rankings.skater_scores(qualified, qualified.select("season", "player_id", *wins))


@register("per_game_rate", "season player_id:l situation goals_per_game:r6 toi_per_game:r6", """
SELECT *, goals/NULLIF(gp, 0) AS goals_per_game, toi/NULLIF(gp, 0) AS toi_per_game FROM skater_stats_o""")
def _(spark, folder):
    from icelens.functions.rates import per_game
    return skater_table(league(spark, folder)).withColumns({
        "goals_per_game": per_game(F.col("goals"), F.col("gp")), "toi_per_game": per_game(F.col("toi"), F.col("gp"))})


QUALITY_SQL = f"""
WITH pairs AS ({PAIRS_SQL}), tal AS (SELECT season, player_id AS other_player_id, {{0}} AS talent FROM ratings_v
  WHERE {{0}} IS NOT NULL)
SELECT season, player_id,
 SUM(shared_toi*talent) FILTER (same_team)/SUM(shared_toi) FILTER (same_team) AS qot_score,
 SUM(shared_toi) FILTER (same_team) AS qot_sample,
 SUM(shared_toi*talent) FILTER (NOT same_team)/SUM(shared_toi) FILTER (NOT same_team) AS qoc_score,
 SUM(shared_toi) FILTER (NOT same_team) AS qoc_sample
FROM pairs JOIN tal USING (season, other_player_id) WHERE situation = 'ES' GROUP BY ALL"""
QUALITY_SPEC = "season player_id:l qot_score:r6 qot_sample:r1 qoc_score:r6 qoc_sample:r1"


@register("neighbour_quality", QUALITY_SPEC, f"""
SELECT season, player_id, AVG(qot_score) AS qot_score, AVG(qot_sample) AS qot_sample, AVG(qoc_score) AS qoc_score,
 AVG(qoc_sample) AS qoc_sample FROM (SELECT * FROM ({QUALITY_SQL.format('evo_rapm')}) UNION ALL
 SELECT * FROM ({QUALITY_SQL.format('ppl_rapm')})) GROUP BY ALL""")
def _(spark, folder):
    view = league(spark, folder)
    pairs = settle(overlap.shared_seconds(view("clean_v"), RULES), "pairs")
    ratings = view("ratings_v")
    return quality.average_quality(quality.neighbour_quality(pairs, ratings, "evo_rapm"),
                                   quality.neighbour_quality(pairs, ratings, "ppl_rapm"))


@register("percentiles", "season player_id:l position " + rank_spec(["evo", "evd", "ppl", "pkl"]),
          ranked_sql("(SELECT season, player_id, position, evo_rapm AS evo_score, evd_rapm AS evd_score, ppl_rapm AS ppl_score, "
                     "pkl_rapm AS pkl_score FROM ratings_v JOIN roster_v USING (season, player_id))", ["evo", "evd", "ppl", "pkl"]))
def _(spark, folder):
    view = league(spark, folder)
    rows = view("ratings_v").join(view("roster_v").select("season", "player_id", "position"), ["season", "player_id"])
    rows = rows.withColumnsRenamed({f"{a}_rapm": f"{a}_score" for a in ("evo", "evd", "ppl", "pkl")})
    return rankings.rank_scores(rows)


@register("dense_ranks", "c_mktsegment c_custkey:l bal_pct:r1 bal_rank:l", """
SELECT c_mktsegment, c_custkey, round_even((
  (COUNT(*) OVER (PARTITION BY c_mktsegment ORDER BY b RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
   - COUNT(*) OVER (PARTITION BY c_mktsegment, b)) + (COUNT(*) OVER (PARTITION BY c_mktsegment, b) + 1)/2.0)
  /COUNT(*) OVER (PARTITION BY c_mktsegment)*100, 1) AS bal_pct,
 DENSE_RANK() OVER (PARTITION BY c_mktsegment ORDER BY b DESC) AS bal_rank
FROM (SELECT *, FLOOR(c_acctbal/10) AS b FROM customer)""")
def _(spark, folder):
    rows = spark.read.parquet(f"{folder}/customer.parquet").select(
        "c_mktsegment", "c_custkey", F.floor(F.col("c_acctbal") / 10).cast("double").alias("bal_score"))
    return ranking.attach_ranks(rows, ["c_mktsegment"], ["c_custkey"], ["bal_score"])


@register("yearly_ranking", "season player_id:l position all_players:l ppl_players:l pkl_players:l tmt_score:r5 cmp_score:r5 "
          + rank_spec(SCORES["skater"]), f"""
SELECT r.*, q.tmt_score, q.cmp_score FROM ({ranked_sql('skater_round_o', SCORES['skater'])}) r
LEFT JOIN (SELECT season, player_id, AVG(qot_score) AS tmt_score, AVG(qoc_score) AS cmp_score FROM (
 SELECT * FROM ({QUALITY_SQL.format('evo_score').replace('ratings_v', 'skater_round_o')}) UNION ALL
 SELECT * FROM ({QUALITY_SQL.format('evd_score').replace('ratings_v', 'skater_round_o')})) GROUP BY ALL) q USING (season, player_id)""")
def _(spark, folder):
    bench = Bench(spark, folder)
    scores = settle(season.rounded(bench.skater_scores(bench.skaters())), "scores")
    pairs = settle(overlap.shared_seconds(bench.t.shifts, RULES), "pairs")
    return rankings.yearly_ranking(scores, pairs)


@register("goalie_ranking", "season player_id:l position all_players:l " + rank_spec(SCORES["goalie"]),
          ranked_sql("goalie_round_o", SCORES["goalie"]))
def _(spark, folder):
    bench = Bench(spark, folder)
    return rankings.yearly_ranking(settle(season.rounded(bench.goalie_scores(bench.goalies())), "scores"))


@register("weighted_ranking", "season player_id:l position all_players:l " + score_spec("skater", 9) + " "
          + rank_spec(SCORES["skater"]), ranked_sql("(SELECT season, player_id, position, "
          + ", ".join(f"ROUND({a}_score, 6) AS {a}_score" for a in SCORES["skater"])
          + f" FROM ({weighted_sql('skater_round_o', SCORES['skater'])}))", SCORES["skater"]))
def _(spark, folder):
    bench = Bench(spark, folder)
    scores = settle(season.rounded(bench.skater_scores(bench.skaters())), "scores")
    return rankings.rank_scores(season.rounded(rankings.weighted_scores(scores, RULES)))


@register("weighted_goalie_ranking", "season player_id:l position all_players:l " + score_spec("goalie", 9) + " "
          + rank_spec(SCORES["goalie"]), ranked_sql("(SELECT season, player_id, position, "
          + ", ".join(f"ROUND({a}_score, 6) AS {a}_score" for a in SCORES["goalie"])
          + f" FROM ({weighted_sql('goalie_round_o', SCORES['goalie'])}))", SCORES["goalie"]))
def _(spark, folder):
    bench = Bench(spark, folder)
    scores = settle(season.rounded(bench.goalie_scores(bench.goalies())), "scores")
    return rankings.rank_scores(season.rounded(rankings.weighted_scores(scores, RULES)))


@register("history_arrays", "season player_id:l evo_history evd_history", """
WITH y AS (SELECT season, player_id, position, evo_pct, evd_pct FROM (""" + ranked_sql(
    "(SELECT season, player_id, position, evo_rapm AS evo_score, evd_rapm AS evd_score FROM ratings_v JOIN roster_v USING (season, player_id))",
    ["evo", "evd"]) + """)),
 s AS (SELECT y.season, y.player_id, y.position, k, CAST(substr(y.season, 1, 4) AS INT) - k AS yr FROM y, range(5) t(k))
SELECT s.season, s.player_id, string_agg(COALESCE(CAST(CAST(trunc(o.evo_pct) AS INT) AS VARCHAR), '-'), ',' ORDER BY k DESC) AS evo_history,
 string_agg(COALESCE(CAST(CAST(trunc(o.evd_pct) AS INT) AS VARCHAR), '-'), ',' ORDER BY k DESC) AS evd_history
FROM s LEFT JOIN y o ON o.player_id = s.player_id AND o.position = s.position AND CAST(substr(o.season, 1, 4) AS INT) = s.yr
GROUP BY s.season, s.player_id""")
def _(spark, folder):
    view = league(spark, folder)
    rows = view("ratings_v").join(view("roster_v").select("season", "player_id", "position", "team"), ["season", "player_id"])
    ranked = settle(rankings.rank_scores(rows.select("season", "player_id", "position", "team", F.col("evo_rapm").alias("evo_score"),
                                                     F.col("evd_rapm").alias("evd_score"))), "ranked")
    out = cards.history(ranked, ranked, ranked.select("season", "player_id", "position", "team"), ("evo", "evd"))
    text = {f"{a}_history": F.array_join(F.col(f"{a}_history").cast("array<string>"), ",", "-") for a in ("evo", "evd")}
    return out.withColumns(text)


CARD_SQL = """
SELECT r.season, r.player_id, r.player, r.position, s.gp, round_even(s.toi, 2) AS toi, s.goals, s.total_points,
 round_even(s.ixg, 2) AS ixg, round_even(e.gf_pct, 2) AS gf_pct, round_even(e.xgf_pct, 2) AS xgf_pct, r.ovr_pct, r.ovr_rank, r.ppl_rank,
 date_diff('year', b.birth_date, make_date(CAST(substr(r.season, 1, 4) AS INT), 9, 1))
  - CASE WHEN (month(b.birth_date), day(b.birth_date)) > (9, 1) THEN 1 ELSE 0 END AS age,
 CASE WHEN r.position = 'D' THEN CASE WHEN s.toi/s.gp >= 22 THEN 'First Pair' WHEN s.toi/s.gp > 18 THEN 'Second Pair'
   WHEN s.toi/s.gp > 13 THEN 'Third Pair' ELSE 'Fringe' END
  ELSE CASE WHEN s.toi/s.gp >= 18 THEN 'First Line' WHEN s.toi/s.gp > 15.5 THEN 'Second Line' WHEN s.toi/s.gp > 13.5 THEN 'Third Line'
   WHEN s.toi/s.gp > 9 THEN 'Fourth Line' ELSE 'Fringe' END END AS role, b.height_in, b.weight_lb, b.birth_date
FROM (""" + ranked_sql("skater_round_o", SCORES["skater"]) + """) r
LEFT JOIN (SELECT * FROM skater_stats_o WHERE situation = 'all') s USING (season, player_id)
LEFT JOIN (SELECT * FROM skater_stats_o WHERE situation = '5v5') e USING (season, player_id)
LEFT JOIN bios_v b ON b.player_id = r.player_id"""


def skater_card_rows(spark, folder) -> DataFrame:
    bench = Bench(spark, folder)
    table = bench.skaters()
    ranked = settle(rankings.yearly_ranking(settle(season.rounded(bench.skater_scores(table)), "scores")), "ranked")
    return cards.skater_cards(ranked, ranked, table, bench.t.bios, bench.t.schedule, RULES)


@register("card_assemble", "season player_id:l player position gp:l toi:r2 goals:l total_points:l ixg:r2 gf_pct:r2 xgf_pct:r2 "
          "ovr_pct:r1 ovr_rank:l age:l role", CARD_SQL)
def _(spark, folder):
    return skater_card_rows(spark, folder)


@register("card_display", "season player_id:l ovr_shown_rank ovr_shown_pct:l ppl_shown_rank toi_per_game size born", f"""
SELECT *, CAST(ovr_rank AS VARCHAR) AS ovr_shown_rank, CAST(round_even(ovr_pct, 0) AS INT) AS ovr_shown_pct,
 COALESCE(CAST(ppl_rank AS VARCHAR), 'N/A') AS ppl_shown_rank,
 concat(CAST(FLOOR(toi/gp) AS INT), ':', lpad(CAST(CAST(FLOOR((toi/gp - FLOOR(toi/gp))*60) AS INT) AS VARCHAR), 2, '0')) AS toi_per_game,
 concat(height_in // 12, chr(39), height_in % 12, '", ', weight_lb, ' lbs') AS size, strftime(birth_date, '%b %d, %Y') AS born
FROM ({CARD_SQL})""")
def _(spark, folder):
    return cards.display(skater_card_rows(spark, folder), ("ovr", "ppl"))


@register("goalie_cards", "season player_id:l gp:l toi:r2 sv_pct:r3 gaa:r2 xg_against:r2 w:l l:l ot_so:l shutouts:l role record gsax", f"""
SELECT *, printf('%d-%d-%d', w, l, ot_so) AS record, printf('%.2f', xg_against - goals_against) AS gsax FROM (
SELECT r.season, r.player_id, s.gp, round_even(s.toi, 2) AS toi, round_even(s.sv_pct, 3) AS sv_pct, round_even(s.gaa, 2) AS gaa,
 round_even(s.xg_against, 2) AS xg_against, s.goals_against, COALESCE(w, 0) AS w, COALESCE(l, 0) AS l, COALESCE(ot_so, 0) AS ot_so,
 COALESCE(shutouts, 0) AS shutouts,
 CASE WHEN s.gp/season_games >= 0.6 THEN 'Starter' WHEN s.gp/season_games >= 0.5 THEN 'Tandem (1A)'
  WHEN s.gp/season_games >= 0.4 THEN 'Tandem (1B)' WHEN s.gp/season_games >= 0.1 THEN 'Backup' ELSE 'Fringe' END AS role
FROM goalie_scores_o r LEFT JOIN (SELECT * FROM goalie_stats_o WHERE situation = 'all') s USING (season, player_id)
LEFT JOIN (SELECT season, player_id, COUNT(*) FILTER (result = 'W') AS w, COUNT(*) FILTER (result = 'L') AS l,
 COUNT(*) FILTER (result = 'O') AS ot_so, SUM(shutouts) AS shutouts FROM goalie_logs_v GROUP BY ALL) g USING (season, player_id)
JOIN games_o USING (season))""")
def _(spark, folder):
    bench = Bench(spark, folder)
    table = bench.goalies()
    ranked = settle(rankings.yearly_ranking(settle(season.rounded(bench.goalie_scores(table)), "scores")), "ranked")
    rows = cards.goalie_cards(ranked, ranked, table, bench.t.bios, agg.goalie_record(bench.t.goalie_logs), bench.t.schedule, RULES)
    return cards.display(rows, ("ovr", "pkl"))


@register("shrunk_prior", "season player_id:l role prior:r6", """
SELECT printf('%d-%d', yr, yr + 1) AS season, player_id, role, SUM(rate*toi)/(SUM(toi) + 200.0) AS prior FROM (
 SELECT CAST(substr(r.season, 1, 4) AS INT) + k AS yr, player_id, x.role, CASE x.role WHEN 'off' THEN evo_rapm ELSE -evd_rapm END AS rate, toi
 FROM ratings_v r JOIN (SELECT season, player_id, SUM(toi) AS toi FROM skater_stats_o WHERE situation = '5v5' GROUP BY ALL) s
 USING (season, player_id), (VALUES ('off'), ('def')) x(role), range(1, 3) t(k) WHERE toi > 0)
GROUP BY yr, player_id, role""")
def _(spark, folder):
    bench = Bench(spark, folder)
    return value.shrunk_prior(bench.view("ratings_v"), agg.toi_totals(bench.skaters()).select("season", "player_id", "situation", "toi"),
                              "evo_rapm", "evd_rapm", "5v5", "5v5", RULES)


@register("rapm_merge", "season player_id:l evo_rapm:r6 evd_rapm:r6 ppl_rapm:r6 pkl_rapm:r6", """
SELECT season, player_id, e.o AS evo_rapm, e.d AS evd_rapm, s.o AS ppl_rapm, s.d AS pkl_rapm FROM (
 SELECT season, player_id, COALESCE(ppl_rapm, 0) AS o, CASE WHEN evd_rapm = 0 THEN 0 ELSE -evd_rapm END AS d FROM ratings_v WHERE player_id % 4 <> 1) e
FULL JOIN (SELECT season, player_id, evo_rapm AS o, COALESCE(-pkl_rapm, 0) AS d FROM ratings_v WHERE player_id % 4 <> 2) s USING (season, player_id)""")
def _(spark, folder):
    ratings = league(spark, folder)("ratings_v")
    even = ratings.where("player_id % 4 <> 1").select("season", "player_id", F.col("ppl_rapm").alias("off_coef"),
                                                      F.col("evd_rapm").alias("def_coef"))
    special = ratings.where("player_id % 4 <> 2").select("season", "player_id", F.col("evo_rapm").alias("off_coef"),
                                                         F.col("pkl_rapm").alias("def_coef"))
    return value.merge_scores(even, special)


WEIGHTED_SQL = ranked_sql("(SELECT w.*, player FROM (SELECT season, player_id, position, "
                          + ", ".join(f"ROUND({a}_score, 6) AS {a}_score" for a in SCORES["skater"])
                          + f" FROM ({weighted_sql('skater_round_o', SCORES['skater'])})) w JOIN (SELECT season, player_id, player FROM skater_round_o) USING (season, player_id))",
                          SCORES["skater"])
STORED_SQL = f"""
SELECT c.*, draft_year, draft_round, draft_overall_pick, shoots_catches, birth_country, y.evo_history,
 row_number() OVER (PARTITION BY c.season, c.position ORDER BY c.player, c.player_id) AS place,
 printf('%d-%d-%d', CAST(c.goals AS BIGINT), CAST(a.total_assists AS BIGINT), CAST(c.total_points AS BIGINT)) AS stat_line,
 CASE WHEN c.xgf_pct IS NOT NULL THEN printf('%.3f', FLOOR(c.xgf_pct*10 + 0.5 + 1e-9)/1000) END AS xg_share,
 translate(c.player, '{text.HEADER_FROM}', '{text.HEADER_TO}') AS header
FROM ({CARD_SQL.replace(ranked_sql("skater_round_o", SCORES["skater"]), WEIGHTED_SQL)}) c
LEFT JOIN (SELECT season, player_id, total_assists FROM skater_stats_o WHERE situation = 'all') a USING (season, player_id)
LEFT JOIN (SELECT player_id, draft_year, draft_round, draft_overall_pick, shoots_catches, birth_country FROM bios_v) b ON b.player_id = c.player_id
LEFT JOIN (SELECT s.season, s.player_id, string_agg(COALESCE(CAST(CAST(trunc(o.evo_pct) AS INT) AS VARCHAR), '-'), ',' ORDER BY k DESC) AS evo_history
 FROM (SELECT season, player_id, position, k, CAST(substr(season, 1, 4) AS INT) - k AS yr FROM skater_round_o, range(5) t(k)) s
 LEFT JOIN ({ranked_sql("skater_round_o", SCORES["skater"])}) o
 ON o.player_id = s.player_id AND o.position = s.position AND CAST(substr(o.season, 1, 4) AS INT) = s.yr GROUP BY s.season, s.player_id) y USING (season, player_id)"""


def stored_cards(spark, folder, given: bool) -> DataFrame:
    """Cards of all stages, read back from their table; ``place``: of a row in its season and position as it is stored."""
    bench_view = league(spark, folder)
    store = TableStore(spark, f"{shared_folder(spark)}/tables-{uuid.uuid4().hex}")
    out = season.run(store, tables(bench_view), RULES, bench_view("ratings_v") if given else None)
    # row groups keep the order of writing, so a file's rows are numbered as they stand, files by their first player
    stored = out.withColumns({"_file": F.input_file_name(), "_row": F.monotonically_increasing_id()})
    firsts = stored.groupBy("season", "position", "_file").agg(F.min_by("player", "_row").alias("_first"), F.count("*").alias("_n"))
    by = W.partitionBy("season", "position")
    firsts = firsts.withColumn("_before", F.sum("_n").over(by.orderBy("_first", "_file").rowsBetween(W.unboundedPreceding, 0)) - F.col("_n"))
    inside = F.row_number().over(W.partitionBy("season", "position", "_file").orderBy("_row"))
    placed = stored.withColumn("_inside", inside).join(firsts.drop("_n", "_first"), ["season", "position", "_file"])
    placed = placed.withColumn("place", F.col("_inside") + F.col("_before")).where("position != 'G'")
    return cards.display(placed, ("ovr", "ppl")).withColumn("evo_history", F.array_join(F.col("evo_history").cast("array<string>"), ",", "-"))


# Statistics, wins, rankings and cards stored and read back; ratings are given, so every value is compared.
@register("stored_cards", "season player_id:l player position place:l gp:l toi:r2 goals:l ixg:r2 gf_pct:r2 ovr_pct:r1 ovr_rank:l ppl_rank:l age:l role "
          "draft_year:l draft_round:l draft_overall_pick:l shoots_catches birth_country stat_line xg_share header evo_history", STORED_SQL)
def _(spark, folder):
    return stored_cards(spark, folder, True)


# The same with fitted ratings. SQL has no fit: compared is everything on the card that does not depend on one.
@register("season_run", "season player_id:l player position place:l gp:l toi:r2 goals:l ixg:r2 xgf_pct:r2 age:l role draft_round:l stat_line header", STORED_SQL)
def _(spark, folder):
    return stored_cards(spark, folder, False)
