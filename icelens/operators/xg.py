"""Expected goals: training table, grid search, one model per strength, routed scoring."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from icelens.config import DEFAULT_RULES, UNBLOCKED, Rules
from icelens.functions.geometry import attach_hands, shot_features
from icelens.functions.labels import nearest_strength
from icelens.operators import boosting
from icelens.operators.aggregate import calibration
from icelens.operators.folds import dealt, group_folds
from icelens.operators.attach import attach_shot_score_state, tag_strength
from icelens.session import settle

NUMERIC = ("distance", "angle", "behind_net", "prior_event_elapsed", "distance_change", "shot_speed", "is_rebound",
           "is_rush", "crossed_royal_road", "period_number", "same_team_as_prior", "lateral_movement",
           "score_state", "off_wing")
CATEGORIES = ("shot_type", "prior_event_type", "shooter_shoots", "goalie_catches")
#: Numbers whose absence is a feature of its own.
MAY_MISS = ("distance", "prior_event_elapsed", "distance_change", "shot_speed", "lateral_movement")
NUMBERS = [*(f"n_{c}" for c in NUMERIC), *(f"m_{c}" for c in MAY_MISS)]
# Values below any real one, so a tree can separate "unknown" by a single split.
MISSING = -1000.0
#: Folds and candidates, each, of a model of more than ``boosting.IN_TASK`` rows that are fitted at the same time, by many Spark jobs.
PARALLEL = 4
#: Part of a model that trains on all its rows.
ALL = -1


def training_table(shots: DataFrame, stints: DataFrame, bios: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Every unblocked shot of every season with all model features, in one plan.

    The score state is taken over all unblocked shots, before any other filter.
    """
    unblocked = shots.where(F.col("event_type").isin(*UNBLOCKED))
    return (unblocked.transform(shot_features, rules).transform(attach_hands, bios)
            .transform(attach_shot_score_state, rules).transform(tag_strength, stints, rules))


def prepared(table: DataFrame) -> DataFrame:
    """MLlib trees reject missing numbers: a sentinel plus an indicator replaces them."""
    filled = {f"n_{c}": F.coalesce(F.col(c).cast("double"), F.lit(MISSING)) for c in NUMERIC}
    gone = {f"m_{c}": F.col(c).isNull().cast("double") for c in MAY_MISS}
    return table.withColumns({**filled, **gone, "label": F.col("goal").cast("double"),
                              **{c: F.coalesce(F.col(c), F.lit("unknown")) for c in CATEGORIES}})


def _pipeline(params: dict, seed: int = 0) -> Pipeline:
    # one indexer of all columns is one pass over the rows
    indexer = StringIndexer(inputCols=list(CATEGORIES), outputCols=[f"i_{c}" for c in CATEGORIES], handleInvalid="keep", stringOrderType="alphabetAsc")
    assembler = VectorAssembler(inputCols=NUMBERS + [f"i_{c}" for c in CATEGORIES], outputCol="features")
    trees = GBTClassifier(featuresCol="features", labelCol="label", maxBins=64, seed=seed, **params)
    return Pipeline(stages=[indexer, assembler, trees])


def _scored(model: PipelineModel, rows: DataFrame, keep: list[str]) -> DataFrame:
    return model.transform(rows).select(*keep, vector_to_array("probability")[1].alias("xg"))


def _by_trees(rows: DataFrame, key: str, models: dict, keep: list[str]) -> DataFrame:
    """``rows`` scored by the trees that ``models`` has for their ``key``; null without any."""
    packed = {k: trees.to_bytes() for k, trees in models.items()}
    names = list(dict.fromkeys(keep))

    def scored(batches):
        known, held, size = {}, [], 0

        def part():
            table = pa.Table.from_batches(held).combine_chunks()
            keys = table.column("_key").to_pylist()
            xg = np.full(len(keys), np.nan)
            for k in {*keys} & {*packed}:
                if k not in known:
                    known[k] = boosting.Trees.from_bytes(packed[k])
                own = np.flatnonzero(np.array([x == k for x in keys]))
                columns = [table.column(f"_{c}").to_numpy() for c in NUMBERS] + [table.column(f"_{c}").to_numpy().astype(str) for c in CATEGORIES]
                xg[own] = known[k].probability([c[own] for c in columns])
            out = table.select(names).append_column("xg", pa.array(xg, from_pandas=True))
            return out.to_batches()

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= boosting.BLOCK:
                yield from part()
                held, size = [], 0
        if size:
            yield from part()

    schema = StructType([rows.schema[c] for c in names] + [StructField("xg", DoubleType())])
    columns = [F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in [*NUMBERS, *CATEGORIES]]]
    return rows.select(*names, *columns).mapInArrow(scored, schema).select(*keep, "xg")


def out_of_fold(rows: DataFrame, params: dict, keep: list[str]) -> DataFrame:
    """Each row scored by the model that did not see its fold. ``rows`` has ``fold``. Folds are fitted side by side."""
    sizes = {r["fold"]: r["n"] for r in rows.groupBy("fold").agg(F.count("*").alias("n")).collect()}
    folds = sorted(sizes)
    if sum(sizes.values()) > boosting.IN_TASK:
        return _out_of_fold_by_jobs(rows, folds, params, keep)
    data = rows.withColumns({"_model": F.lit(""), "_tag": F.lit(""), "_trains": F.filter(F.lit(folds).cast("array<int>"), lambda k: k != F.col("fold"))})
    bins = boosting.binnings(data, NUMBERS, list(CATEGORIES))
    packed = boosting.blocks(data, NUMBERS, list(CATEGORIES), bins)
    fitted = boosting.fits(packed, [("", k, 0, params) for k in folds], bins, score=False).collect()
    return _by_trees(rows, "fold", {r["_part"]: boosting.Trees.from_bytes(r["trees"]) for r in fitted}, keep)


def _out_of_fold_by_jobs(rows: DataFrame, folds: list[int], params: dict, keep: list[str]) -> DataFrame:
    def part(fold: int) -> DataFrame:
        model = _pipeline(params).fit(rows.where(F.col("fold") != fold))
        return _scored(model, rows.where(F.col("fold") == fold), keep)

    with ThreadPoolExecutor(PARALLEL) as pool:
        parts = list(pool.map(part, folds))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def pooled_auc(scored: DataFrame) -> float:
    """Area under the ROC curve over all out-of-fold rows together."""
    return BinaryClassificationEvaluator(rawPredictionCol="xg", labelCol="label", metricName="areaUnderROC",
                                         numBins=0).evaluate(scored)


def pooled_aucs(scored: DataFrame, keys: list[str]) -> dict[tuple, float]:
    """:func:`pooled_auc` for each of ``keys``, of all in one query. Scores are met in ranges, so no task sees all of a key."""
    counts = scored.groupBy(*keys, "xg").agg(F.sum("label").alias("ones"), F.sum(1 - F.col("label")).alias("zeros"))
    counts = counts.withColumn("_range", F.floor(F.col("xg") * 4096))
    ranges = counts.groupBy(*keys, "_range").agg(F.sum("zeros").alias("_in"))
    below = F.sum("_in").over(Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    ranges = ranges.select(*keys, "_range", F.coalesce(below, F.lit(0.0)).alias("_below"))
    within = F.sum("zeros").over(Window.partitionBy(*keys, "_range").orderBy("xg").rowsBetween(Window.unboundedPreceding, -1))
    lower = counts.withColumn("_within", F.coalesce(within, F.lit(0.0))).join(ranges, [*keys, "_range"])
    won = F.sum(F.col("ones") * (F.col("_below") + F.col("_within") + F.col("zeros") / 2))
    found = lower.groupBy(*keys).agg(won.alias("won"), F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros")).collect()
    return {tuple(r[k] for k in keys): r["won"] / (r["ones"] * r["zeros"]) if r["ones"] and r["zeros"] else float(r["ones"] > 0) for r in found}


def grid_search(rows: DataFrame, grid: tuple, folds: int, parallel: int = PARALLEL) -> tuple:
    """Best candidate by pooled out-of-fold AUC, refitted on everything, with its report.

    All candidates of all folds are fitted side by side, each in a task, up to ``boosting.IN_TASK`` rows; beyond that
    candidates run as concurrent Spark jobs, the way MLlib's own cross-validator does.
    """
    return _search(rows.withColumn("_model", F.lit("")), {"": grid}, folds, parallel)[""]


def _search(data: DataFrame, grids: dict[str, tuple], folds: int, parallel: int = PARALLEL) -> dict[str, tuple]:
    """:func:`grid_search` for the rows of each ``_model``, the fits of all models side by side.

    Only counts by model and season, the values of bins, and reports and fitted trees come to the driver.
    """
    counts: dict[str, dict] = {m: {} for m in grids}
    for r in data.groupBy("_model", "season").agg(F.count("*").alias("n")).collect():
        counts[r["_model"]][r["season"]] = r["n"]
    sizes = {m: sum(c.values()) for m, c in counts.items()}
    found = {m: _search_by_jobs(data.where(F.col("_model") == m).drop("_model"), grids[m], folds, parallel) for m in grids if sizes[m] > boosting.IN_TASK}
    models = [m for m in grids if m not in found]
    if not models:
        return found
    deal, parts = [], {}
    for m in models:
        fold_of = dealt(counts[m], folds)
        parts[m] = sorted({*fold_of.values()}) if len(fold_of) >= 2 else []
        deal += [(m, season, fold, [ALL, *(k for k in parts[m] if k != fold)]) for season, fold in fold_of.items()]
    kind = data.schema["season"].dataType.simpleString()
    deal = data.sparkSession.createDataFrame(deal, f"_m string, _s {kind}, fold int, _trains array<int>")
    rows = data.drop("fold").join(F.broadcast(deal), (F.col("_model") == F.col("_m")) & F.col("season").eqNullSafe(F.col("_s")))
    rows = rows.withColumn("_tag", F.col("season").cast("string"))
    bins = boosting.binnings(rows, NUMBERS, list(CATEGORIES))
    packed = boosting.blocks(rows, NUMBERS, list(CATEGORIES), bins)
    wanted = [(m, k, n, params) for m in models for k in parts[m] for n, params in enumerate(grids[m])]
    wanted.sort(key=lambda w: -sizes[w[0]] * w[3]["maxIter"] * w[3]["maxDepth"])  # the longest first
    reports = {m: {"cv_auc": None, "calibration": {}, "params": dict(grids[m][0]), "n_rows": sizes[m]} for m in models}
    if wanted:
        scores = settle(boosting.fits(packed, wanted, bins, score=True), "boost-scores")
        auc = pooled_aucs(scores, ["_model", "candidate"])
        best = {m: max(range(len(grids[m])), key=lambda n: (auc[m, n], -n)) for m in models if parts[m]}
        chosen = data.sparkSession.createDataFrame([*best.items()], "_model string, candidate int")
        errors = calibration(scores.join(F.broadcast(chosen), ["_model", "candidate"]).withColumn("_group", F.struct("_model", "season")), "_group", "label", "xg")
        for m, n in best.items():
            reports[m] |= {"cv_auc": auc[m, n], "params": dict(grids[m][n]), "candidates": [{**p, "auc": auc[m, k]} for k, p in enumerate(grids[m])]}
        for r in errors.collect():
            reports[r["_group"]["_model"]]["calibration"][r["_group"]["season"]] = r["error"]
    refits = sorted(((m, ALL, 0, reports[m]["params"]) for m in models if sizes[m]), key=lambda w: -sizes[w[0]])
    for r in boosting.fits(packed, refits, bins, score=False).collect():
        found[r["_model"]] = boosting.Trees.from_bytes(r["trees"]), reports[r["_model"]]
    return found


def _search_by_jobs(rows: DataFrame, grid: tuple, folds: int, parallel: int) -> tuple[PipelineModel, dict]:
    data = group_folds(rows, "season", folds, few=True).persist()
    try:
        seasons = [r["fold"] for r in data.select("season", "fold").distinct().collect()]
        report = {"cv_auc": None, "calibration": {}, "params": dict(grid[0]), "n_rows": data.count()}
        if len(seasons) >= 2:
            def evaluate(params: dict) -> tuple[float, DataFrame]:
                scored = _out_of_fold_by_jobs(data, sorted({*seasons}), params, ["season", "label"])
                return pooled_auc(scored), scored

            with ThreadPoolExecutor(parallel) as pool:
                results = list(pool.map(evaluate, grid))
            best = max(range(len(grid)), key=lambda k: (results[k][0], -k))
            errors = calibration(results[best][1], "season", "label", "xg").collect()
            report |= {"cv_auc": results[best][0], "params": dict(grid[best]),
                       "candidates": [{**p, "auc": r[0]} for p, r in zip(grid, results)],
                       "calibration": {r["season"]: r["error"] for r in errors}}
        return _pipeline(report["params"]).fit(data), report
    finally:
        data.unpersist()


def train(table: DataFrame, rules: Rules = DEFAULT_RULES) -> dict[str, tuple]:
    """One model per strength with enough rows; busy strengths search the deeper grid."""
    data = prepared(table)
    sizes = {r["strength"]: r["n"] for r in data.groupBy("strength").agg(F.count("*").alias("n")).collect()}
    found = sorted(s for s, n in sizes.items() if s != "unknown" and n >= rules.min_rows_per_strength)
    grids = {s: rules.xg_grid_high_volume if s in rules.high_volume else rules.xg_grid for s in found}
    if not grids:
        return {}
    models = _search(data.where(F.col("strength").isin(found)).withColumn("_model", F.col("strength")), grids, rules.xg_folds)
    return {s: models[s] for s in found}


def save(models: dict, folder: str, spark) -> None:
    """A table of the trees, one pipeline directory per strength fitted by MLlib, and a JSON report table."""
    trees = []
    for strength, (model, _) in models.items():
        if isinstance(model, boosting.Trees):
            trees.append((strength, bytearray(model.to_bytes())))
        else:
            model.write().overwrite().save(f"{folder}/{strength}")
    spark.createDataFrame(trees, "strength string, trees binary").coalesce(1).write.mode("overwrite").parquet(f"{folder}/_trees")
    rows = [(strength, json.dumps(report)) for strength, (_, report) in models.items()]
    spark.createDataFrame(rows, "strength string, report string").coalesce(1).write.mode("overwrite").json(f"{folder}/_report")


def load(folder: str, spark) -> dict[str, tuple]:
    reports = spark.read.schema("strength string, report string").json(f"{folder}/_report").collect()
    trees = {r["strength"]: boosting.Trees.from_bytes(r["trees"]) for r in spark.read.schema("strength string, trees binary").parquet(f"{folder}/_trees").collect()}
    return {r["strength"]: (trees.get(r["strength"]) or PipelineModel.load(f"{folder}/{r['strength']}"), json.loads(r["report"])) for r in reports}


def score(table: DataFrame, models: dict, keep: list[str]) -> DataFrame:
    """Every shot scored by its own strength's model, or by the nearest trained one."""
    # the few labels are routed, not each shot
    labels = table.select(F.col("strength").alias("_label")).distinct().withColumn("_model", nearest_strength(F.col("_label"), list(models)))
    data = prepared(table).join(F.broadcast(labels), F.col("strength").eqNullSafe(F.col("_label")))
    trees = {s: model for s, (model, _) in models.items() if isinstance(model, boosting.Trees)}
    parts = [_by_trees(data.where(F.col("_model").isin(list(trees))), "_model", trees, keep)] if trees else []
    parts += [_scored(model, data.where(F.col("_model") == s), keep) for s, (model, _) in sorted(models.items()) if s not in trees]
    if not parts:
        return table.select(*keep).withColumn("xg", F.lit(None).cast("double"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
