"""Gradient-boosted trees whose fits run side by side, each in one task.

The same trees as MLlib's ``GBTClassifier``: logistic loss, the first tree on the labels as -1 and 1, each later one on the
negative gradient; splits by variance, numbers at quantiles of the training rows, categories in the order of their means.
MLlib needs a Spark job per level of each tree. Here Spark brings the rows of a fit together as codes of a few bytes a row, and a
task grows all trees from histograms, of which each level counts the smaller children only. Grids of many fits keep all cores
busy; a fit holds some 30 bytes a row, and callers bound its rows by IN_TASK.
"""

from __future__ import annotations

import io
import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from icelens.session import settle

#: Bins of a number, quantiles asked for to place them, and the largest number of codes in a pack of features.
BINS, QUANTILES, WIDTH = 64, 500, 256
#: Rows up to which a fit is one task.
IN_TASK = 20_000_000
#: Rows that are binned together, and rows of a fit that are worked on together.
BLOCK, CHUNK = 1 << 16, 1 << 16


def thresholds(values: list) -> np.ndarray:
    """At most BINS - 1 splits of a number, between values of the sorted ``values``; x <= split is left."""
    v = np.unique(np.asarray([x for x in values if x is not None and x == x], dtype=float))
    at = np.arange(1, len(v)) if len(v) <= BINS else np.unique(np.round(np.linspace(0, len(v), BINS + 1)[1:-1]).astype(int))
    with np.errstate(over="ignore", invalid="ignore"):
        middle = v[at - 1] / 2 + v[at] / 2
    return np.where(np.isfinite(middle) & (middle >= v[at - 1]) & (middle < v[at]), middle, v[at - 1])


class Binning:
    """How rows become codes: bins of every feature, features packed side by side. Numbers stand first, then categories.

    A category that was not seen has a bin of its own, the last.
    """

    def __init__(self, splits: list[np.ndarray], labels: list[list[str]]):
        self.splits, self.labels = splits, labels
        self.sizes = [len(s) + 1 for s in splits] + [len(v) + 1 for v in labels]
        self.packs: list[list[int]] = []
        for f in sorted(range(len(self.sizes)), key=lambda f: (-self.sizes[f], f)):
            for pack in self.packs:
                if np.prod([self.sizes[g] for g in pack]) * self.sizes[f] <= WIDTH:
                    pack.append(f)
                    break
            else:
                self.packs.append([f])
        self.widths = [int(np.prod([self.sizes[f] for f in pack])) for pack in self.packs]
        self.width = max(self.widths)
        self.kind = np.uint8 if self.width <= 256 else np.uint16 if self.width <= 65536 else np.uint32
        self.start = np.concatenate([[0], np.cumsum(self.sizes)])
        self.feature_of = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.pack_of = np.zeros(len(self.sizes), dtype=np.intp)
        #: the bin of a feature in each code of its pack
        self.bin_in = np.zeros((len(self.sizes), self.width), dtype=np.int64)
        #: per pack, the bins of its features and the matrix that sums codes to them
        self.columns, self.spread = [], []
        for p, pack in enumerate(self.packs):
            codes, step = np.arange(self.widths[p]), self.widths[p]
            matrix = np.zeros((self.widths[p], sum(self.sizes[f] for f in pack)))
            column = 0
            self.columns.append(np.concatenate([np.arange(self.start[f], self.start[f + 1]) for f in pack]))
            for f in pack:
                step //= self.sizes[f]
                self.pack_of[f] = p
                self.bin_in[f, :self.widths[p]] = codes // step % self.sizes[f]
                matrix[codes, column + self.bin_in[f, :self.widths[p]]] = 1.0
                column += self.sizes[f]
            self.spread.append(None if len(pack) == 1 else matrix)

    def codes(self, columns: list[np.ndarray]) -> np.ndarray:
        """(pack, row): ``columns`` are the features, categories as text."""
        bins = [np.searchsorted(s, x, side="left") for s, x in zip(self.splits, columns)]
        for labels, x in zip(self.labels, columns[len(self.splits):]):
            place = {v: k for k, v in enumerate(labels)}
            found, back = np.unique(x, return_inverse=True)
            bins.append(np.array([place.get(v, len(labels)) for v in found], dtype=np.int64)[back])
        out = np.zeros((len(self.packs), len(columns[0])), dtype=self.kind)
        for p, pack in enumerate(self.packs):
            code = np.zeros(len(columns[0]), dtype=np.int64)
            for f in pack:
                code = code * self.sizes[f] + bins[f]
            out[p] = code
        return out


@dataclass
class Trees:
    """Boosted trees over codes: all trees are complete, a node sends codes left by a table."""

    binning: Binning
    pack: np.ndarray  # (tree, node)
    left: np.ndarray  # (tree, node, code)
    value: np.ndarray  # (tree, leaf), weights included

    def margin(self, codes: np.ndarray) -> np.ndarray:
        n, width = codes.shape[1], self.left.shape[2]
        depth = int(np.log2(self.value.shape[1]))
        flat = self.left.reshape(len(self.left), -1)
        out = np.zeros(n)
        for a in range(0, n, CHUNK):
            part = np.ascontiguousarray(codes[:, a:a + CHUNK]).reshape(-1)
            m = len(part) // len(codes)
            row, total = np.arange(m), np.zeros(m)
            for pack, left, value in zip(self.pack.astype(np.intp) * m, flat, self.value):
                node = np.zeros(m, dtype=np.intp)
                for _ in range(depth):
                    node = 2 * node + 2 - left[node * width + part[pack[node] + row]]
                total += value[node - (len(value) - 1)]
            out[a:a + m] = total
        return out

    def probability(self, columns: list[np.ndarray]) -> np.ndarray:
        if not len(columns[0]):
            return np.zeros(0)
        return _probability(self.margin(self.binning.codes(columns)))

    def to_bytes(self) -> bytes:
        b, out = self.binning, io.BytesIO()
        np.savez_compressed(out, pack=self.pack, left=np.packbits(self.left, axis=-1), value=self.value, splits=np.concatenate([[], *b.splits]),
                            sizes=[len(s) for s in b.splits], labels=json.dumps(b.labels))
        return out.getvalue()

    @staticmethod
    def from_bytes(data: bytes) -> Trees:
        with np.load(io.BytesIO(data)) as z:
            splits = np.split(z["splits"], np.cumsum(z["sizes"])[:-1])
            binning = Binning(splits, json.loads(str(z["labels"])))
            left = np.unpackbits(z["left"], axis=-1, count=binning.width).astype(bool)
            return Trees(binning, z["pack"], left, z["value"])


def _probability(margin: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-2 * margin))


class _Grower:
    """Grows trees on one set of rows."""

    def __init__(self, binning: Binning, codes: np.ndarray):
        self.b, self.codes, self.n = binning, codes, codes.shape[1]
        self.root_counts = None

    def histograms(self, target: np.ndarray, node: np.ndarray, slot: np.ndarray | None, slots: int, count: bool) -> tuple:
        """(slot, bin of a feature): rows and sums of ``target``, of the rows whose node has a slot (all rows if ``slot`` is None)."""
        b = self.b
        rows = [np.zeros(slots * w) for w in b.widths]
        sums = [np.zeros(slots * w) for w in b.widths]
        for a in range(0, self.n, CHUNK):
            own, t = None, target[a:a + CHUNK]
            if slot is not None:
                at = slot[node[a:a + CHUNK]]
                own = np.flatnonzero(at >= 0)
                at, t = at[own], t[own]
            for p, w in enumerate(b.widths):
                code = self.codes[p, a:a + CHUNK]
                key = code.astype(np.intp) if own is None else at * w + code[own]
                sums[p] += np.bincount(key, t, slots * w)
                if count:
                    rows[p] += np.bincount(key, minlength=slots * w)
        if not count:
            return None, self._by_feature(sums, slots)
        both = self._by_feature([np.concatenate(x) for x in zip(rows, sums)], 2 * slots)
        return both[:slots], both[slots:]

    def _by_feature(self, parts: list[np.ndarray], slots: int) -> np.ndarray:
        b = self.b
        out = np.empty((slots, b.start[-1]))
        for part, columns, spread in zip(parts, b.columns, b.spread):
            part = part.reshape(slots, -1)
            out[:, columns] = part if spread is None else part @ spread
        return out

    def splits(self, rows: np.ndarray, sums: np.ndarray) -> tuple:
        """Best split of each node: the pack, the table of codes that go left, and rows and sums on the left and in all."""
        b, nodes = self.b, np.arange(len(rows))
        n, s = rows[:, :b.start[1]].sum(axis=1), sums[:, :b.start[1]].sum(axis=1)
        first, size = b.start[len(b.splits)], b.start[-1] - b.start[len(b.splits)]
        sorted_rows, sorted_sums = rows.copy(), sums.copy()
        with np.errstate(divide="ignore", invalid="ignore"):
            if size:  # categories by their means, those without a row last
                some_rows, some_sums = rows[:, first:], sums[:, first:]
                mean = np.where(some_rows > 0, some_sums / some_rows, np.inf)
                order = np.lexsort((mean, np.broadcast_to(b.feature_of[first:], mean.shape)), axis=1)
                at = nodes[:, None] * size + order
                sorted_rows[:, first:], sorted_sums[:, first:] = np.take(some_rows, at), np.take(some_sums, at)
            before = b.start[b.feature_of]
            row_sums = np.concatenate([np.zeros((len(rows), 1)), np.cumsum(sorted_rows, axis=1)], axis=1)
            sum_sums = np.concatenate([np.zeros((len(rows), 1)), np.cumsum(sorted_sums, axis=1)], axis=1)
            n_left, s_left = row_sums[:, 1:] - row_sums[:, before], sum_sums[:, 1:] - sum_sums[:, before]
            n_right, s_right = n[:, None] - n_left, s[:, None] - s_left
            gain = s_left ** 2 / n_left + s_right ** 2 / n_right - (s ** 2 / n)[:, None]
        gain = np.where((n_left > 0) & (n_right > 0), gain, -np.inf)
        best = gain.argmax(axis=1)
        go = gain[nodes, best] > 1e-12
        feature = b.feature_of[best]
        place = best - b.start[feature]
        left = b.bin_in[feature] <= place[:, None]
        for k in np.flatnonzero(go & (feature >= len(b.splits))):
            rank = np.empty(size, dtype=np.int64)
            rank[order[k]] = first + np.arange(size)
            rank = rank[b.start[feature[k]] - first:b.start[feature[k] + 1] - first] - b.start[feature[k]]
            left[k] = rank[b.bin_in[feature[k]]] <= place[k]
        left[~go] = True
        return (b.pack_of[feature], left, np.where(go, n_left[nodes, best], n), np.where(go, s_left[nodes, best], s), n, s)

    def tree(self, target: np.ndarray, depth: int) -> tuple:
        """(pack, left, value of leaves, leaf of each row)."""
        b = self.b
        node = np.zeros(self.n, dtype=np.uint16)
        first, sums = self.histograms(target, node, None, 1, self.root_counts is None)
        self.root_counts = rows = first if self.root_counts is None else self.root_counts
        packs, lefts = [], []
        for level in range(depth):
            pack, left, n_left, s_left, n, s = self.splits(rows, sums)
            packs.append(pack)
            lefts.append(left)
            table, width = left.reshape(-1), left.shape[1]
            for a in range(0, self.n, CHUNK):
                at = node[a:a + CHUNK].astype(np.intp)
                code = self.codes.reshape(-1)[pack[at] * self.n + np.arange(a, a + len(at))]
                node[a:a + CHUNK] = 2 * at + 1 - table[at * width + code]
            n_right, s_right = n - n_left, s - s_left
            if level + 1 < depth:  # count the smaller child, the other one is the rest
                slot = np.full(2 * len(n), -1, dtype=np.intp)
                lesser = n_left <= n_right
                slot[2 * np.arange(len(n)) + ~lesser] = np.arange(len(n))
                few_rows, few_sums = self.histograms(target, node, slot, len(n), True)
                rows, sums = (np.where(np.repeat(np.stack([lesser, ~lesser], axis=1)[:, :, None], few.shape[1], axis=2), few[:, None], (all_ - few)[:, None]).reshape(2 * len(n), -1)
                              for few, all_ in ((few_rows, rows), (few_sums, sums)))
                sums = np.where(rows > 0, sums, 0.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            value = np.stack([np.where(n_left > 0, s_left / n_left, 0.0), np.where(n_right > 0, s_right / n_right, 0.0)], axis=1).reshape(-1)
        return np.concatenate(packs), np.concatenate(lefts), value, node


def grow(binning: Binning, codes: np.ndarray, label: np.ndarray, maxDepth: int, stepSize: float, maxIter: int) -> Trees:
    """``maxIter`` trees; parameters are named as MLlib names them."""
    grower = _Grower(binning, codes)
    sign = np.where(label > 0, 1.0, -1.0)
    total, target = np.zeros(len(label)), sign.copy()
    packs, lefts, values = [], [], []
    for k in range(maxIter):
        pack, left, value, leaf = grower.tree(target, maxDepth)
        value = value if k == 0 else value * stepSize
        packs.append(pack)
        lefts.append(left)
        values.append(value)
        for a in range(0, len(label), CHUNK):
            part = slice(a, a + CHUNK)
            total[part] += value[leaf[part]]
            with np.errstate(over="ignore"):
                target[part] = 4 * sign[part] / (1 + np.exp(2 * sign[part] * total[part]))
    return Trees(binning, np.array(packs, dtype=np.uint16), np.array(lefts), np.array(values))


# --- many fits ---------------------------------------------------------------------------------

def _columns(batch, numbers: list[str], categories: list[str]) -> list[np.ndarray]:
    return [batch.column(c).to_numpy(zero_copy_only=False) for c in numbers] + [
        batch.column(c).to_numpy(zero_copy_only=False).astype(str) for c in categories]


def binnings(rows: DataFrame, numbers: list[str], categories: list[str]) -> dict[tuple[str, int], Binning]:
    """For each ``_model`` and each number in its rows' array ``_trains``: the bins that those rows give.

    A few thousand values for each of them come to the driver, whatever the rows.
    """
    levels = F.array(*[F.lit(k / QUANTILES) for k in range(QUANTILES + 1)])
    quantiles = [F.array_distinct(F.percentile_approx(c, levels, F.lit(10_000))).alias(c) for c in numbers]
    found = rows.select("_model", F.explode("_trains").alias("_part"), *numbers, *categories).groupBy("_model", "_part").agg(
        *quantiles, *[F.collect_set(c).alias(c) for c in categories])
    return {(r["_model"], r["_part"]): Binning([thresholds(r[c] or []) for c in numbers], [sorted(r[c]) for c in categories])
            for r in found.collect()}


BLOCKS = "_model string, _part int, test boolean, tag string, n int, codes binary, label binary"


def blocks(rows: DataFrame, numbers: list[str], categories: list[str], bins: dict) -> DataFrame:
    """Rows as codes, in blocks: those that a part of a model trains on, and (``test``) those of its fold ``fold``.

    ``rows``: ``_model``, ``fold``, ``_trains``, ``_tag``, ``label`` and the features.
    """
    def pack(batches):
        held, size = [], 0

        def packed():
            table = pa.Table.from_batches(held).combine_chunks()
            key = list(zip(*(table.column(c).to_pylist() for c in ("_model", "fold", "_tag"))))
            known = {k: n for n, k in enumerate(dict.fromkeys(key))}
            of = np.array([known[k] for k in key])
            columns, label = _columns(table, numbers, categories), table.column("label").to_numpy().astype(np.uint8)
            trains = table.column("_trains")
            out = []
            for (model, fold, tag), number in known.items():
                own = np.flatnonzero(of == number)
                some = [c[own] for c in columns]
                for part in {*trains[int(own[0])].as_py(), fold}:
                    if (model, part) in bins:
                        codes = bins[model, part].codes(some)
                        out.append((model, part, part == fold, tag, len(own), codes.tobytes(), label[own].tobytes()))
            fields = [pa.string(), pa.int32(), pa.bool_(), pa.string(), pa.int32(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), fields)],
                                              names=["_model", "_part", "test", "tag", "n", "codes", "label"])

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= BLOCK:
                yield packed()
                held, size = [], 0
        if size:
            yield packed()

    return settle(rows.select("_model", "fold", "_trains", "_tag", "label", *numbers, *categories).mapInArrow(pack, BLOCKS), "boost-blocks")


def fits(packed: DataFrame, wanted: list[tuple[str, int, int, dict]], bins: dict, score: bool) -> DataFrame:
    """One task for each of ``wanted`` (model, part, candidate, parameters): its trees (``trees``), or with ``score`` the
    ``label`` and ``xg`` of its test rows."""
    def work(batches):
        found: dict[int, list] = {}
        for batch in batches:
            for r in batch.to_pylist():
                model, part = wanted[r["fit"]][:2]
                codes = np.frombuffer(r["codes"], dtype=bins[model, part].kind).reshape(len(bins[model, part].packs), -1)
                found.setdefault(r["fit"], []).append((r["test"], r["tag"], codes, np.frombuffer(r["label"], dtype=np.uint8)))
        while found:
            fit, parts = found.popitem()
            model, part, candidate, params = wanted[fit]
            training = [p for p in parts if not p[0]]
            tests = [p for p in parts if p[0]]
            parts.clear()
            if not training:
                continue
            label = np.concatenate([p[3] for p in training])
            codes = np.empty((len(bins[model, part].packs), len(label)), dtype=bins[model, part].kind)
            at = 0
            while training:
                piece = training.pop(0)[2]
                codes[:, at:at + piece.shape[1]] = piece
                at += piece.shape[1]
            trees = grow(bins[model, part], codes, label, **params)
            del codes, label
            if not score:
                yield pa.RecordBatch.from_pydict({"_model": [model], "_part": pa.array([part], pa.int32()), "candidate": pa.array([candidate], pa.int32()),
                                                  "trees": pa.array([trees.to_bytes()], pa.binary())})
                continue
            for _, tag, piece, y in tests:
                xg = _probability(trees.margin(piece))
                yield pa.RecordBatch.from_pydict({
                    "_model": pa.array([model] * len(y), pa.string()), "candidate": pa.array(np.full(len(y), candidate, np.int32)),
                    "season": pa.array([tag] * len(y), pa.string()), "label": pa.array(y.astype(float)), "xg": pa.array(xg)})

    plan = packed.sparkSession.createDataFrame([(m, p, n) for n, (m, p, _, _) in enumerate(wanted)], "_model string, _part int, fit int")
    rows = packed if score else packed.where("NOT test")
    dealt = rows.join(F.broadcast(plan), ["_model", "_part"]).select("fit", "test", "tag", "codes", "label")
    schema = "_model string, candidate int, season string, label double, xg double" if score else "_model string, _part int, candidate int, trees binary"
    return dealt.repartitionById(len(wanted), "fit").mapInArrow(work, schema)
