"""Hard negatives by slots: for every positive the best rows of other labels that score a little less than it.

The windows of an anchor's positives overlap, but their upper limits, in descending order, cut the scores into disjoint
slots: slot i holds the scores up to the i-th positive's and above the next one's. A row of another label falls into one
slot, of which only the best few can be an answer, so every block of rows passes on the best few of each slot and Spark
keeps the best few of those. A window is the suffix of slots from its own on: its answers are the best few of them,
cut at the lower limit. No window is searched for itself.

Scores of anchors and rows are formed in blocks: a cell of a grid has some GRID rows and some GRID anchors, and both
sides are shuffled to the cells they belong to. What a cell needs in memory does not grow with the table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from icelens.session import settle

#: Rows and anchors of a cell, on average, and anchors whose scores are formed at once.
GRID, AT_ONCE = 16_384, 128
SCALE = 256
#: Positives of an anchor, negatives of a positive, and the least score of a negative in per cent of its positive's.
POSITIVES, NEGATIVES, LOW = 5, 5, 80
LARGEST = (1 << 63) - 1


def usable(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id long, label, vector array<double>) of the rows that take part: no null, no infinite and no NaN component.
    Of rows with equal vec_id the one with the least label, then the least vector, takes part."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    picked = rows.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{label}`").cast("long").alias("label"),
                         F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    picked = picked.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)
    return picked.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row")).select("vec_id", "row.label", "row.vector")


def whole_numbers(column: pa.ChunkedArray) -> np.ndarray:
    """floor(SCALE * x) of every component, a matrix; shorter vectors end in zeros, numbers past 64 bits are cut to them."""
    lists = column.combine_chunks()
    lists = lists if isinstance(lists, pa.ListArray) else pa.chunked_array([lists]).combine_chunks()
    starts = lists.offsets.to_numpy()
    flat = lists.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(starts)
    with np.errstate(over="ignore"):
        flat = np.clip(np.floor(SCALE * flat), -2.0 ** 63, 2.0 ** 63 - 1024).astype(np.int64)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), dtype=np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row, at] = flat[starts[0]:starts[-1]]
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``a`` and of ``b``, exact; those past 64 bits are cut to the largest number of them."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * width if width else 0.0
    for kind, most in ((np.float32, 2.0 ** 24), (np.float64, 2.0 ** 53)):  # sums of whole numbers that the type holds exactly
        if bound < most:
            return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)
    return np.clip(a.astype(object) @ b.astype(object).T, -LARGEST, LARGEST).astype(np.int64)


def first_of(group: np.ndarray, score: np.ndarray, name: np.ndarray, k: int) -> np.ndarray:
    """Which rows are among the first ``k`` of their group: by score descending, then name."""
    order = np.lexsort((name, -score, group))
    sorted_ = group[order]
    begins = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]])) if len(order) else np.zeros(0, dtype=np.int64)
    place = np.arange(len(order)) - np.repeat(begins, np.diff(np.append(begins, len(order))))
    return order[place < k]


def cells(rows: DataFrame, anchors: DataFrame, fn, schema: str, n_rows: int, n_anchors: int) -> DataFrame:
    """``fn(anchors, rows)``, tables of pyarrow, for every cell of the grid. ``anchors`` and ``rows`` have a vec_id."""
    down, over = -(-n_rows // GRID) or 1, -(-n_anchors // GRID) or 1

    def part(count: int) -> Column:
        return F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int")

    def all_of(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    left = anchors.withColumn("over", part(over)).withColumn("down", all_of(down))
    right = rows.withColumn("down", part(down)).withColumn("over", all_of(over))
    right = right.toDF(*right.columns)  # both may come from the same table
    return left.groupBy("over", "down").cogroup(right.groupBy("over", "down")).applyInArrow(fn, schema)


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def nearest_of_label(k: int):
    """A cell's function: for each anchor the first ``k`` other rows of its label."""
    def of(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        found = []
        if anchors.num_rows and rows.num_rows:
            a_id, a_label, a = _column(anchors, "vec_id"), _column(anchors, "label"), whole_numbers(anchors.column("vector"))
            r_id, r_label, r = _column(rows, "vec_id"), _column(rows, "label"), whole_numbers(rows.column("vector"))
            for label in np.intersect1d(a_label, r_label):
                own, others = np.flatnonzero(a_label == label), np.flatnonzero(r_label == label)
                for at in range(0, len(own), AT_ONCE):
                    some = own[at:at + AT_ONCE]
                    score = products(a[some], r[others])
                    # rows below the k-th score of an anchor are out; ties with it are still in
                    least = np.partition(score, max(0, len(others) - k - 1), axis=1)[:, max(0, len(others) - k - 1)]
                    x, y = np.nonzero((score >= least[:, None]) & (a_id[some][:, None] != r_id[others][None, :]))
                    pick = first_of(x, score[x, y], r_id[others[y]], k)
                    found.append((a_id[some[x[pick]]], r_id[others[y[pick]]], score[x[pick], y[pick]]))
        return _table(found, ["anchor_id", "positive_id", "positive_score"])
    return of


def best_of_slots(k: int, low: int):
    """A cell's function: for each anchor and slot the first ``k`` rows of other labels above the lowest limit."""
    def of(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        found = []
        if anchors.num_rows and rows.num_rows:
            a_id, a_label, a = _column(anchors, "vec_id"), _column(anchors, "label"), whole_numbers(anchors.column("vector"))
            r_id, r_label, r = _column(rows, "vec_id"), _column(rows, "label"), whole_numbers(rows.column("vector"))
            lists = anchors.column("limits").to_pylist()  # ascending, at least one
            limits = np.full((len(lists), max(map(len, lists))), -1, dtype=np.int64)  # limits are never below zero
            for at, own in enumerate(lists):
                limits[at, :len(own)] = own
            top, floor = limits.max(axis=1), np.array([-(-low * own[0] // 100) for own in lists])
            for at in range(0, len(a_id), AT_ONCE):
                some = slice(at, at + AT_ONCE)
                score = products(a[some], r)
                x, y = np.nonzero((score <= top[some][:, None]) & (score >= floor[some][:, None]) & (a_label[some][:, None] != r_label[None, :]))
                value = score[x, y]
                slot = (limits[some][x] >= value[:, None]).sum(axis=1)  # limits that reach it: 1 is the highest slot
                pick = first_of(x * (limits.shape[1] + 1) + slot, value, r_id[y], k)
                found.append((a_id[some][x[pick]], slot[pick], r_id[y[pick]], value[pick]))
        return _table(found, ["anchor_id", "slot", "negative_id", "negative_score"])
    return of


def _table(found: list[tuple], names: list[str]) -> pa.Table:
    return pa.table({name: pa.array(np.concatenate([f[i] for f in found]).astype(np.int64) if found else [], pa.int64())
                     for i, name in enumerate(names)})


def _first(df: DataFrame, group: list[str], score: str, name: str, k: int) -> DataFrame:
    best = W.partitionBy(*group).orderBy(F.desc(score), name)
    return df.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k).drop("place")


def mined(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows (vec_id, label, vector) of
    usable(); ``is_anchor``: a condition on vec_id.

    A score is the inner product of the vectors' whole numbers floor(SCALE * x); higher ones come first, ties go by smaller
    vec_id. Positives are the first other rows of the anchor's label. Negatives of a positive are the first rows of other
    labels with low * positive_score <= 100 * negative_score <= 100 * positive_score; a positive below zero has none.
    An empty table gives no rows, and neither do anchors without a positive.
    """
    rows = settle(rows, "vectors")
    anchors = rows.where(is_anchor)
    n_rows, n_anchors = rows.count(), anchors.count()
    near = cells(rows, anchors, nearest_of_label(positives), "anchor_id long, positive_id long, positive_score long", n_rows, n_anchors)
    chosen = settle(_first(near, ["anchor_id"], "positive_score", "positive_id", positives), "positives")
    # at most ``positives`` limits an anchor; those below zero have no window
    limits = chosen.where("positive_score >= 0").groupBy("anchor_id").agg(F.array_sort(F.collect_list("positive_score")).alias("limits"))
    limited = anchors.join(limits.withColumnRenamed("anchor_id", "vec_id"), "vec_id")
    found = cells(rows, limited, best_of_slots(negatives, low), "anchor_id long, slot long, negative_id long, negative_score long", n_rows, n_anchors)
    slots = _first(found, ["anchor_id", "slot"], "negative_score", "negative_id", negatives)
    # at most positives * negatives rows an anchor, best first
    lists = slots.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("negative_score")).alias("lower"), "negative_id", "slot"))).alias("slots"))
    own = F.size(F.filter("limits", lambda x: x >= F.col("positive_score")))
    windows = chosen.where("positive_score >= 0").join(limits, "anchor_id").join(lists, "anchor_id").withColumn("own", own)
    windows = windows.select("anchor_id", "positive_id", "positive_score", F.posexplode(F.slice(
        F.filter("slots", lambda s: s["slot"] >= F.col("own")), 1, negatives)).alias("at", "n"))
    return windows.where(low * F.col("positive_score").cast("decimal(20,0)") <= -100 * F.col("n.lower").cast("decimal(20,0)")).select(
        "anchor_id", "positive_id", (F.col("at") + 1).alias("rank"), F.col("n.negative_id").alias("negative_id"), "positive_score",
        (-F.col("n.lower")).alias("negative_score"))
