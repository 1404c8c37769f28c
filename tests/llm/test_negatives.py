"""Hard negatives against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from icelens.llm import hard_negatives

LARGEST = 2 ** 63 - 1


def plain(rows, every, k=5, m=5, low=80):
    kept = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept[i] = min(kept.get(i, (label, v)), (label, v))
    def whole(x):
        return max(-2 ** 63, min(2 ** 63 - 1024, math.floor(256 * x) if math.isfinite(256 * x) else int(math.copysign(2 ** 63, x))))
    q = {i: [whole(x) for x in v] for i, (_, v) in kept.items()}
    out = []
    for a in kept:
        if a % every:
            continue
        score = {i: max(-LARGEST, min(LARGEST, sum(x * y for x, y in zip(q[a], q[i])))) for i in kept if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        same = [i for i in order if kept[i][0] == kept[a][0]][:k]
        for p in same:
            found = [n for n in order if kept[n][0] != kept[a][0] and low * score[p] <= 100 * score[n] <= 100 * score[p]][:m]
            out += [(a, p, r, n, score[p], score[n]) for r, n in enumerate(found, 1)]
    return sorted(out)


def got(spark, rows, every, **settings):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, label int, `a.b` int, Limits string").repartition(4)
    out = hard_negatives.mined(hard_negatives.usable(df), F.col("vec_id") % every == 0, **settings)
    assert dict(out.dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"}
    return sorted(map(tuple, out.collect()))


def sample(seed, n, dim=6, ties=False):
    rnd = random.Random(seed)
    def one():
        return [rnd.choice([0.0, 0.25, 0.5, 1.0]) if ties else rnd.gauss(0.1, 0.3) for _ in range(dim)]
    return [(i, one(), rnd.randrange(4)) for i in range(n)]


@pytest.mark.parametrize("grid,ties", [(16_384, False), (16_384, True), (30, True), (7, False)])
def test_negatives_equal_brute_force(spark, monkeypatch, grid, ties):
    monkeypatch.setattr(hard_negatives, "GRID", grid)
    monkeypatch.setattr(hard_negatives, "AT_ONCE", 3)
    rows = sample(grid + ties, 160, ties=ties)
    rows += [(None, [1.0] * 6, 1), (500, None, 1), (501, [1.0] * 6, None), (502, [1.0, None] + [1.0] * 4, 1), (503, [float("nan")] * 6, 1),
             (504, [float("inf")] * 6, 1), (505, [], 1), (506, [1.0, 1.0], 1), (510, [1.0] * 9, 2), (510, [1.0] * 9, 2), (510, [0.5] * 9, 1), *rows[:9]]
    want = plain(rows, 10)
    assert len(want) > 50
    assert got(spark, rows, 10) == want
    assert got(spark, rows, 10, positives=3, negatives=2, low=60) == plain(rows, 10, 3, 2, 60)


def test_scores_below_zero_and_huge_ones(spark):
    rows = [(i, [-1.0 if i % 3 else 1.0, 0.0], i % 2) for i in range(30)] + [(i, [s * 10.0 ** e, 1.0], i % 2) for i, (s, e) in enumerate(
        ((s, e) for s in (1, -1) for e in (3, 6, 9, 12, 15, 18, 300)), 100)]
    assert got(spark, rows, 5) == plain(rows, 5)


def test_no_rows(spark):
    assert got(spark, [], 10) == []
    assert got(spark, [(0, [1.0], 1)], 10) == []
    assert got(spark, [(1, [1.0], 1), (2, [1.0], 1)], 10) == []
    assert got(spark, [(10, [1.0], 1), (2, [1.0], 2)], 10) == []
