"""Queries for the regression and the expected-goals model."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from icelens.catalog.intervals import CONTEXT_SQL, context_stints
from icelens.catalog.registry import register
from icelens.catalog.scalars import XG_SQL
from icelens.catalog.totals import skater_table, tables
from icelens.operators import aggregate as agg, ridge, xg
from icelens.operators.context import CONTEXT_COLUMNS
from icelens.operators.folds import group_folds
from icelens.operators.perspective import even_pooled_rows
from icelens.plans import ratings, stats
from icelens.session import settle, shared_folder
from icelens.sources.league_views import LEAGUE_RULES, league

# Penalties, folds, grids and the least number of rows are those of the library.
RULES = LEAGUE_RULES


def pooled(spark, folder) -> DataFrame:
    return even_pooled_rows(context_stints(league(spark, folder)))


def _context_sql(column: str, own: str, opp: str) -> str:
    side, _, value = column.partition("_")
    name = own if side == "off" else opp
    if side == "state":
        return f"CAST({own}_n = {value[0]} AS INT)"
    if value[:-1] in ("up", "down"):
        return f"CAST({name}_score_state = {'-' if value[0] == 'd' else ''}{value[-1]} AS INT)"
    return "otf" if value == "otf" else f"{name}_{value}"


def _side_sql(own: str, opp: str) -> str:
    values = ", ".join(f"{{'f': {ridge.context_code(i)}::BIGINT, 'x': ({_context_sql(c, own, opp)})::DOUBLE}}" for i, c in enumerate(CONTEXT_COLUMNS))
    return f"""SELECT season, game_id, period, start_sec, duration, team_{own} AS team, {own}_skaters AS skaters, {opp}_skaters AS others,
 {own}_xg AS xgf, [{values}] AS context FROM c WHERE a_goalie_on AND b_goalie_on AND a_n = b_n AND a_n IN (3, 4, 5)"""


DESIGN_SQL = f"""
WITH c AS ({CONTEXT_SQL}), s AS ({_side_sql("a", "b")} UNION ALL {_side_sql("b", "a")})
SELECT season, game_id, period, start_sec, team AS off_team, duration/3600.0 AS weight,
 LEAST(50, GREATEST(0, xgf/(duration/3600.0))) AS y, game_id % 5 AS fold, e.f AS feature, e.x AS value FROM (
 SELECT *, unnest(list_concat(list_transform(skaters, lambda p: {{'f': p*2, 'x': 1.0::DOUBLE}}),
  list_transform(others, lambda p: {{'f': p*2 + 1, 'x': 1.0::DOUBLE}}), list_filter(context, lambda z: z.x <> 0))) AS e FROM s)"""


@register("design_long", "season game_id:l period:l start_sec:l off_team feature:l value:r6", DESIGN_SQL)
def _(spark, folder):
    return ridge.design_long(pooled(spark, folder), CONTEXT_COLUMNS)


@register("ridge_gram", "season i:l j:l g0:r6 g1:r6 g2:r6 g3:r6 g4:r6", f"""
WITH d AS ({DESIGN_SQL}), x AS (SELECT season, game_id, period, start_sec, off_team, weight, fold, feature, value FROM d UNION ALL
 SELECT DISTINCT season, game_id, period, start_sec, off_team, weight, fold, -1, 1.0 FROM d UNION ALL
 SELECT DISTINCT season, game_id, period, start_sec, off_team, weight, fold, -2, y FROM d)
SELECT season, a.feature AS i, b.feature AS j, {', '.join(
    f"COALESCE(SUM(a.weight*a.value*b.value) FILTER (a.fold = {k}), 0) AS g{k}" for k in range(5))}
FROM x a JOIN x b USING (season, game_id, period, start_sec, off_team) WHERE a.feature <= b.feature GROUP BY ALL""")
def _(spark, folder):
    rows = ridge.with_response(pooled(spark, folder), "xg_for", RULES)
    return ridge.gram(rows, ["season"], CONTEXT_COLUMNS, 5, F.pmod(F.col("game_id"), F.lit(5)))


# Fits have no SQL. What is compared: which features, players, rows and folds they cover, and that they are optimal or in bounds.
@register("ridge_fit", "season feature:l solved:b", f"""
WITH d AS ({DESIGN_SQL}) SELECT DISTINCT season, feature, TRUE AS solved FROM d
UNION ALL SELECT DISTINCT season, {ridge.INTERCEPT}, TRUE FROM d""")
def _(spark, folder):
    rows = settle(pooled(spark, folder), "rows")
    fitted = settle(ridge.fit(rows, ["season"], "xg_for", CONTEXT_COLUMNS, RULES.alphas, rules=RULES), "fit")
    sums = ridge.gram(ridge.with_response(rows, "xg_for", RULES), ["season"], CONTEXT_COLUMNS, RULES.ridge_folds)
    sums = settle(sums.select("season", "i", "j", sum((F.col(f"g{k}") for k in range(1, RULES.ridge_folds)), F.col("g0")).alias("g")), "sums")
    # the normal equations: sum_j g_ij b_j + penalty_i b_i = g_iy for every feature i
    both = sums.union(sums.where("i <> j").select("season", F.col("j").alias("i"), F.col("i").alias("j"), "g"))
    side = both.join(fitted.select("season", F.col("feature").alias("j"), "coef"), ["season", "j"], "left")
    right = F.col("j") == ridge.RESPONSE
    left = (side.groupBy("season", F.col("i").alias("feature"))
            .agg(F.sum(F.when(~right, F.col("g") * F.col("coef"))).alias("lhs"), F.sum(F.when(right, F.col("g"))).alias("rhs"),
                 F.sum(F.abs("g")).alias("size")))
    penalty = F.when(F.col("feature") >= 0, F.col("alpha")).when(F.col("feature") == ridge.INTERCEPT, 0.0).otherwise(RULES.context_alpha)
    gap = F.abs(F.col("lhs") + penalty * F.col("coef") - F.coalesce("rhs", F.lit(0.0)))
    return fitted.join(left, ["season", "feature"]).withColumn("solved", gap <= 1e-6 * (1 + F.col("size")))


def _rated_sql(even: str) -> str:
    return f"""
SELECT season, player_id, bool_or(even) AS even, bool_or(NOT even) AS special FROM (
 SELECT season, own = opp AS even, unnest(list_concat(skaters, others)) AS player_id FROM sides_o
 WHERE own_g AND opp_g AND ((own = opp AND own IN ({even})) OR (own = 5 AND opp = 4))) GROUP BY ALL"""


def rated(scores: DataFrame) -> DataFrame:
    """Which parts of a player's rating there are; a value that is no finite number counts as missing."""
    def there(name: str):
        return F.coalesce(F.abs(name) < 1e6, F.lit(False))
    return scores.withColumns({"even": there("evo_rapm") & there("evd_rapm"), "special": there("ppl_rapm") & there("pkl_rapm")})


@register("rapm_goals", "season player_id:l even:b special:b", _rated_sql("5"))
def _(spark, folder):
    return rated(ratings.goal_ratings(settle(context_stints(league(spark, folder)), "stints"), RULES))


@register("rapm_xg", "season player_id:l even:b special:b", _rated_sql("3, 4, 5"))
def _(spark, folder):
    view = league(spark, folder)
    stints = settle(context_stints(view), "stints")
    minutes = settle(agg.toi_totals(skater_table(view)).select("season", "player_id", "situation", "toi"), "minutes")
    seasons = [r["season"] for r in stints.select("season").distinct().collect()]
    return rated(ratings.chained_ratings(stints, minutes, seasons, RULES))


def xg_table(spark, folder) -> DataFrame:
    from icelens.catalog.ingest import full_shots
    view = league(spark, folder)
    stints = stats.measured_stints(tables(view), RULES)
    return xg.training_table(full_shots(view), stints, view("bios_v"), RULES)


@register("group_folds", "game_id:l fold:l n:l", """
SELECT game_id, n, CASE WHEN (place // used) % 2 = 0 THEN place % used ELSE used - 1 - place % used END AS fold FROM (
 SELECT game_id, n, row_number() OVER (ORDER BY n DESC, CAST(game_id AS VARCHAR)) - 1 AS place, GREATEST(2, LEAST(5, COUNT(*) OVER ())) AS used
 FROM (SELECT game_id, COUNT(*) AS n FROM shots_v GROUP BY game_id))""")
def _(spark, folder):
    shots = league(spark, folder)("shots_v")
    return group_folds(shots, "game_id", RULES.ridge_folds).groupBy("game_id", "fold").agg(F.count("*").alias("n"))


def inside(scored: DataFrame) -> DataFrame:
    return scored.withColumn("inside", (F.col("xg") > 0) & (F.col("xg") < 1))


@register("xg_oof", "season game_id:l seq:l fold:l label:r1 inside:b", f"""
WITH x AS ({XG_SQL}), n AS (SELECT season, COUNT(*) AS n FROM x GROUP BY season),
 f AS (SELECT season, row_number() OVER (ORDER BY n DESC, season) - 1 AS place, GREATEST(2, LEAST(5, COUNT(*) OVER ())) AS used FROM n)
SELECT x.season, game_id, seq, CASE WHEN (place // used) % 2 = 0 THEN place % used ELSE used - 1 - place % used END AS fold, goal AS label, TRUE AS inside
FROM x JOIN f USING (season)""")
def _(spark, folder):
    rows = settle(group_folds(xg.prepared(xg_table(spark, folder)), "season", RULES.xg_folds, few=True), "shots")
    return inside(xg.out_of_fold(rows, RULES.xg_grid[0], ["season", "game_id", "seq", "fold", "label"]))


@register("xg_grid", "n_rows:l candidates:l auc_in_bounds:b calibrated:b",
          f"SELECT COUNT(*) AS n_rows, {len(RULES.xg_grid)} AS candidates, TRUE AS auc_in_bounds, TRUE AS calibrated FROM ({XG_SQL})")
def _(spark, folder):
    _, report = xg.grid_search(settle(xg.prepared(xg_table(spark, folder)), "shots"), RULES.xg_grid, RULES.xg_folds)
    worst = max(v for v in report["calibration"].values() if v is not None)
    return spark.createDataFrame([(report["n_rows"], len(report["candidates"]), 0.4 < report["cv_auc"] < 1, worst < 0.5)],
                                 "n_rows long, candidates long, auc_in_bounds boolean, calibrated boolean")


def _trained(spark, folder):
    table = settle(xg_table(spark, folder), "shots")
    return table, xg.train(table, RULES)


@register("xg_train", "strength n_rows:l auc_in_bounds:b", f"""
SELECT strength, COUNT(*) AS n_rows, TRUE AS auc_in_bounds FROM ({XG_SQL}) WHERE strength <> 'unknown' GROUP BY strength
HAVING COUNT(*) >= {RULES.min_rows_per_strength}""")
def _(spark, folder):
    _, models = _trained(spark, folder)
    rows = [(s, r["n_rows"], 0.4 < r["cv_auc"] < 1) for s, (_, r) in models.items()]
    return spark.createDataFrame(rows, "strength string, n_rows long, auc_in_bounds boolean")


@register("xg_score", "season game_id:l seq:l strength inside:b", f"SELECT season, game_id, seq, strength, TRUE AS inside FROM ({XG_SQL})")
def _(spark, folder):
    table, models = _trained(spark, folder)
    path = f"{shared_folder(spark)}/xg-{uuid.uuid4().hex}"
    xg.save(models, path, spark)
    return inside(xg.score(table, xg.load(path, spark), ["season", "game_id", "seq", "strength"]))
