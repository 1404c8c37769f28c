"""Ridge against a closed form, the expected-goals model against sanity bounds."""

import dataclasses
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from icelens.config import DEFAULT_RULES
from icelens.catalog.registry import models
from icelens.operators import boosting, folds, ridge, value, xg

ROWS = """season string, game_id long, period int, start_sec int, off_team string, duration int, off_skaters array<long>,
 def_skaters array<long>, xg_for double, off_home int"""
CONTEXT = ("off_home", "not_there")


def make_rows(n=400, seed=11):
    rnd = random.Random(seed)
    return [("s", rnd.randint(1, 25), 1, i, "A", rnd.randint(60, 600), sorted(rnd.sample(range(8), 3)),
             sorted(rnd.sample(range(8), 3)), rnd.random() * 0.4, rnd.randint(0, 1)) for i in range(n)]


def closed_form(rows, alpha, prior, context_alpha=3.0):
    feats = [2 * p for p in range(8)] + [2 * p + 1 for p in range(8)] + [ridge.context_code(0)]
    x = np.zeros((len(rows), len(feats)))
    for i, r in enumerate(rows):
        for p in r[6]:
            x[i, feats.index(2 * p)] = 1
        for p in r[7]:
            x[i, feats.index(2 * p + 1)] = 1
        x[i, -1] = r[9]
    w = np.array([r[5] / 3600 for r in rows])
    y = np.clip(np.array([r[8] for r in rows]) / w, 0, 50)
    b0 = np.array([prior.get(f, 0.0) for f in feats])
    t = y - x @ b0
    xm, tm = np.average(x, axis=0, weights=w), np.average(t, weights=w)
    xc, tc = x - xm, t - tm
    pen = np.diag([alpha if f >= 0 else context_alpha for f in feats])
    b = np.linalg.solve(xc.T @ (w[:, None] * xc) + pen, xc.T @ (w * tc))
    return dict(zip(feats, b + b0)), tm - xm @ b


@pytest.mark.parametrize("dense,prior", [(4_000, {}), (4_000, {2: 0.5, 5: -0.25}), (0, {2: 0.5, 5: -0.25})])
def test_ridge_equals_closed_form(spark, monkeypatch, dense, prior):
    monkeypatch.setattr(ridge, "DENSE", dense)
    rows = make_rows()
    frame = spark.createDataFrame(rows, ROWS)
    before = spark.createDataFrame([("s", f, v) for f, v in prior.items()], "season string, feature long, prior double") if prior else None
    got = ridge.fit(frame, ["season"], "xg_for", CONTEXT, (7.0,), before).collect()
    want, intercept = closed_form(rows, 7.0, prior)
    have = {r["feature"]: r["coef"] for r in got}
    assert have.pop(ridge.INTERCEPT) == pytest.approx(intercept, abs=1e-9)
    assert have == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("dense,alphas", [(4_000, (0.01, 1.0, 100.0)), (0, (20.0, 100.0, 500.0))])
def test_cross_validation_picks_the_best_mean_r2(spark, monkeypatch, dense, alphas):
    monkeypatch.setattr(ridge, "DENSE", dense)
    rows = make_rows()
    frame = spark.createDataFrame(rows, ROWS)
    got = ridge.fit(frame, ["season"], "xg_for", CONTEXT, alphas, fold=F.pmod(F.col("game_id"), F.lit(5))).first()
    scores = {}
    for a in alphas:
        found = []
        for k in range(5):
            train, test = [r for r in rows if r[1] % 5 != k], [r for r in rows if r[1] % 5 == k]
            coef, c = closed_form(train, a, {})
            w = np.array([r[5] / 3600 for r in test])
            y = np.clip(np.array([r[8] for r in test]) / w, 0, 50)
            guess = np.array([c + sum(coef[2 * p] for p in r[6]) + sum(coef[2 * p + 1] for p in r[7])
                              + coef[ridge.context_code(0)] * r[9] for r in test])
            found.append(1 - np.sum(w * (y - guess) ** 2) / np.sum(w * (y - np.average(y, weights=w)) ** 2))
        scores[a] = np.mean(found)
    assert got["alpha"] == max(scores, key=scores.get)
    assert got["cv_r2"] == pytest.approx(max(scores.values()), abs=1e-9)


def test_huge_penalty_returns_the_prior(spark):
    frame = spark.createDataFrame(make_rows(100), ROWS)
    prior = spark.createDataFrame([("s", 4, 1.5)], "season string, feature long, prior double")
    got = {r["feature"]: r["coef"] for r in ridge.fit(frame, ["season"], "xg_for", (), (1e12,), prior).collect()}
    assert got[4] == pytest.approx(1.5, abs=1e-6) and got[6] == pytest.approx(0.0, abs=1e-6)


def test_prior_pools_two_seasons_and_flips_defence(spark):
    rates = spark.createDataFrame([("2019-2020", 1, 1.0, 2.0), ("2020-2021", 1, 3.0, -1.0), ("2015-2016", 1, 9.0, 9.0)],
                                  "season string, player_id long, evo_rapm double, evd_rapm double")
    minutes = spark.createDataFrame([(s, 1, "5v5", t) for s, t in (("2019-2020", 100.0), ("2020-2021", 300.0), ("2015-2016", 50.0))],
                                    "season string, player_id long, situation string, toi double")
    got = {r["role"]: r["prior"] for r in value.shrunk_prior(rates, minutes, "evo_rapm", "evd_rapm", "5v5", "5v5").where(
        "season = '2021-2022'").collect()}
    assert got["off"] == pytest.approx((100 + 900) / 600) and got["def"] == pytest.approx((-200 + 300) / 600)


def test_folds_keep_groups_whole_and_balanced(spark):
    rows = spark.createDataFrame([(f"s{i % 7}",) for i in range(700)] + [("s0",)] * 100, "season string")
    got = folds.group_folds(rows, "season", 3).groupBy("season").agg(F.countDistinct("fold").alias("k"), F.first("fold").alias("f")).collect()
    assert all(r["k"] == 1 for r in got) and {r["f"] for r in got} == {0, 1, 2}


def test_model_learns_distance_and_survives_saving(spark, tmp_path):
    rnd = random.Random(2)
    data = []
    for i in range(3000):
        d = rnd.random() * 60
        data.append((f"20{10 + i % 3}-x", i, "5v5" if i % 2 else "9v9", d, int(rnd.random() < np.exp(-d / 12)), "wrist"))
    table = spark.createDataFrame(data, "season string, seq long, strength string, distance double, goal int, shot_type string")
    for c in xg.NUMERIC:
        if c not in table.columns:
            table = table.withColumn(c, F.lit(None).cast("double"))
    for c in xg.CATEGORIES:
        if c not in table.columns:
            table = table.withColumn(c, F.lit("unknown"))
    rules = dataclasses.replace(DEFAULT_RULES, min_rows_per_strength=1000, xg_folds=3, high_volume=(),
                                xg_grid=({"maxDepth": 2, "stepSize": 0.2, "maxIter": 4},))
    models = xg.train(table.where("strength = '5v5'"), rules)
    assert list(models) == ["5v5"] and models["5v5"][1]["cv_auc"] > 0.75
    assert max(models["5v5"][1]["calibration"].values()) < 0.5
    xg.save(models, str(tmp_path / "m"), spark)
    scored = xg.score(table, xg.load(str(tmp_path / "m"), spark), ["seq", "distance"])
    assert scored.count() == 3000
    near, far = (scored.where(q).agg(F.avg("xg")).first()[0] for q in ("distance < 5", "distance > 40"))
    assert near > far


def test_shifted_solutions_share_the_products_of_one_sequence():
    rnd = np.random.default_rng(5)
    x = rnd.normal(size=(60, 40)) * rnd.random(40)
    matrix, right = x.T @ x, rnd.normal(size=40)
    alphas, seen = np.array([50.0, 0.5, 3.0, 1e6]), []

    def times(v):
        seen.append(1)
        return matrix @ v
    got = ridge._shifted(times, right, alphas)
    want = np.column_stack([np.linalg.solve(matrix + a * np.eye(40), right) for a in alphas])
    assert got == pytest.approx(want, rel=1e-9, abs=1e-12)
    alone = len(seen)
    ridge._shifted(times, right, np.array([0.5]))
    assert len(seen) == 2 * alone


def test_a_league_of_some_thousand_players_is_solved_in_tasks(spark, monkeypatch):
    def never(*_):
        raise AssertionError("by joins")
    monkeypatch.setattr(ridge.wide_ridge, "fit_sums", never)
    rows = [("s", i % 10, 1, i, "A", 600, [3 * i, 3 * i + 1], [3 * i + 2], 0.1 * (i % 3), i % 2) for i in range(1_500)]
    got = ridge.fit(spark.createDataFrame(rows, ROWS), ["season"], "xg_for", CONTEXT, (1.0, 7.0))
    assert got.where("feature >= 0").count() == 4_500
    got = {r["feature"]: r["coef"] for r in got.where(f"feature < 3 or feature = {ridge.INTERCEPT}").collect()}
    # players of the first row share its rate alike, attack and defence
    assert got[0] == pytest.approx(got[2]) and all(np.isfinite(v) for v in got.values())


def test_folds_of_a_handful_of_groups_leave_the_rows_in_place(spark):
    rows = spark.range(4000).select(F.concat(F.lit("s"), (F.col("id") % 7).cast("string")).alias("season"), "id").union(
        spark.sql("SELECT CAST(NULL AS STRING) AS season, 1L AS id"))
    few, many = (folds.group_folds(rows, "season", 3, few=k) for k in (True, False))
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect()))
    join = next(line for line in few._jdf.queryExecution().sparkPlan().toString().splitlines() if "Join" in line)
    assert "BroadcastHashJoin" in join


def test_categories_are_indexed_in_one_pass():
    stages = xg._pipeline({"maxDepth": 2}).getStages()
    assert len(stages) == 3 and list(stages[0].getInputCols()) == list(xg.CATEGORIES)


def shot_rows(spark, n=900, seed=4):
    """Prepared shots with few distinct values, whose bins do not depend on how quantiles are found."""
    rnd = random.Random(seed)
    rows = [(f"20{10 + i % 3}-x", i, rnd.randint(0, 30), rnd.choice([None, 1, 2, 8]), rnd.randint(-3, 3),
             rnd.choice(["wrist", "slap", "snap"] + ["tip"] * (i % 3 == 1)), rnd.choice(["faceoff", "hit", "none"]), rnd.randint(0, 1)) for i in range(n)]
    table = spark.createDataFrame([(*r, int(rnd.random() < 0.1 + 0.6 * (r[2] < 9) + 0.2 * (r[5] == "slap"))) for r in rows],
                                  "season string, seq long, distance int, shot_speed int, score_state int, shot_type string, prior_event_type string, off_wing int, goal int")
    for c in [*xg.NUMERIC, *xg.CATEGORIES]:
        if c not in table.columns:
            table = table.withColumn(c, F.lit(None).cast("string" if c in xg.CATEGORIES else "double"))
    return folds.group_folds(xg.prepared(table), "season", 3, few=True).localCheckpoint()


def test_trees_grown_in_a_task_are_those_of_mllib(spark):
    rows, params = shot_rows(spark), {"maxDepth": 3, "stepSize": 0.1, "maxIter": 12}
    ours, theirs = ({r["seq"]: r["xg"] for r in found.collect()} for found in (
        xg.out_of_fold(rows, params, ["seq"]), xg._out_of_fold_by_jobs(rows, [0, 1, 2], params, ["seq"])))
    assert len(ours) == 900 and ours == pytest.approx(theirs, abs=1e-9)


def test_a_search_side_by_side_finds_what_one_by_jobs_finds(spark):
    rows = shot_rows(spark).drop("fold")
    grid = ({"maxDepth": 1, "stepSize": 0.1, "maxIter": 2}, {"maxDepth": 3, "stepSize": 0.1, "maxIter": 6})
    ours, theirs = xg.grid_search(rows, grid, 5)[1], xg._search_by_jobs(rows, grid, 5, 2)[1]
    assert ours["params"] == theirs["params"] and ours["n_rows"] == theirs["n_rows"] == 900
    assert [c["auc"] for c in ours["candidates"]] == pytest.approx([c["auc"] for c in theirs["candidates"]], abs=1e-9)
    assert ours["calibration"] == pytest.approx(theirs["calibration"], abs=1e-9)


def test_bins_follow_the_quantiles_and_saved_trees_score_alike():
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=5_000)
    splits = boosting.thresholds(list(np.quantile(x, np.linspace(0, 1, 501))))
    assert len(splits) == boosting.BINS - 1 and np.bincount(np.searchsorted(splits, x)).max() < 150
    bins = boosting.Binning([splits, np.array([0.5])], [["a", "b"]])
    columns = [x, rnd.integers(0, 2, 5_000).astype(float), rnd.choice(["a", "b", "new"], 5_000)]
    trees = boosting.grow(bins, bins.codes(columns), (x > 0).astype(np.uint8), maxDepth=2, stepSize=0.1, maxIter=5)
    again = boosting.Trees.from_bytes(trees.to_bytes())
    assert np.array_equal(trees.probability(columns), again.probability(columns))
    assert trees.probability(columns)[x > 0.1].min() > trees.probability(columns)[x < -0.1].max()


def test_registered_models_search_the_grids_of_the_library():
    for name in ("xg_grid", "xg_grid_high_volume", "high_volume", "xg_folds", "min_rows_per_strength", "alphas", "alphas_special", "ridge_folds"):
        assert getattr(models.RULES, name) == getattr(DEFAULT_RULES, name)


def test_folds_of_counts_are_those_of_rows(spark):
    counts = {"b": 5, "a": 5, None: 5, "c": 9, "d": 1, "e": 2, "f": 2}
    rows = spark.createDataFrame([(s,) for s, n in counts.items() for _ in range(n)], "season string")
    for k in (2, 3, 5, 9):
        got = {r["season"]: r["fold"] for r in folds.group_folds(rows, "season", k).distinct().collect()}
        assert got == folds.dealt(counts, k)


def test_shots_are_routed_with_any_number_of_models(spark):
    names = [f"{a}v{b}" for a in range(1, 7) for b in range(1, 7) if (a, b) != (5, 4)] + ["EN_for", "EN_against"]
    table = shot_rows(spark, 60).select("seq", "goal", *xg.NUMERIC, *xg.CATEGORIES).withColumn(
        "strength", F.element_at(F.lit(["5v4", "3v3", "9v1", "odd", None]), (F.col("seq") % 5 + 1).cast("int")))
    bins = boosting.Binning([np.array([])] * len(xg.NUMBERS), [["wrist"]] * len(xg.CATEGORIES))

    def model(n):  # one tree whose leaf tells the model
        return boosting.Trees(bins, np.zeros((1, 1), dtype=np.uint16), np.ones((1, 1, bins.width), dtype=bool), np.array([[n / 100, 0.0]])), {}
    found = xg.score(table, {s: model(n + 1) for n, s in enumerate(names)}, ["strength"]).distinct()
    assert "Code grows" not in (plan := found._jdf.queryExecution().toString()) and len(plan) < 100_000
    got = {r["strength"]: names[round(-np.log(1 / r["xg"] - 1) / 2 * 100) - 1] for r in found.collect()}
    assert got == {"5v4": "4v3", "3v3": "3v3", "9v1": "5v3", "odd": "5v5", None: "5v5"}


def test_a_system_streams_through_files_in_pieces(spark, monkeypatch):
    def never(*_):
        raise AssertionError("by joins")
    monkeypatch.setattr(ridge.wide_ridge, "fit_sums", never)
    assert ridge.DENSE >= 1_000_000 and ridge.SUMS >= 20_000_000  # a league of half a million players, 17 million sums a season
    rows = make_rows()
    sums = ridge.gram(ridge.with_response(spark.createDataFrame(rows, ROWS), "xg_for"), ["season"], CONTEXT, 1, F.lit(0)).collect()
    both = {(r["i"], r["j"]): r["g0"] for r in sums} | {(r["j"], r["i"]): r["g0"] for r in sums if r["i"] >= 0}
    order = sorted(both, key=lambda p: (p[0] != ridge.INTERCEPT if p[0] < 0 else 2, p))
    monkeypatch.setattr(ridge, "CHUNK", 5)
    seen = []

    def solve(part, stream):
        features, train, test, base = stream.moments()
        seen.append((part, stream.folder))
        assert test.w == 0 and not test.times(np.ones(test.n)).any()
        assert base[list(features).index(3)] == 0.25 and np.count_nonzero(base) == 1
        return dict(zip(features, np.concatenate(train.solve((7.0,), 3.0, base))[:, 0]))
    table = pa.table({"part": [4] * (len(order) + 2), "i": [ridge.PRIOR] * 2 + [p[0] for p in order], "j": [3, 999] + [p[1] for p in order],
                      "all": [0.25, 9.0] + [both[p] for p in order], "test": [0.0] * (len(order) + 2)})
    got, = ridge._systems(table.to_batches(max_chunksize=7), solve)
    want, _ = closed_form(rows, 7.0, {3: 0.25})
    assert got == pytest.approx(want, abs=1e-9)
    assert seen[0][0] == 4 and not os.path.exists(seen[0][1])
