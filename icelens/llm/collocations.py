"""Phrases whose words occur together far more often than apart, found by counting the longest windows only.

Every word opens one window of three words: itself and the two that lead on from it in its piece, padded where the piece
ends. Windows are counted by chunks of text, then over all chunks, and one ROLLUP sums them into the counts of all shorter
phrases, since an occurrence of a phrase is a window that begins with it. No length has a pass of its own.

A phrase below the least count is neither a candidate nor a part of one. So before the sums a window that is too rare gives
up its last word, and one whose first two words are too rare the second as well: the counts of the shorter phrases stay
the same, and only some ten million of a hundred million windows reach the ROLLUP.

Windows of one chunk are numbers (word ids of that chunk), counted by numpy; exploding and grouping the strings in Spark
took 1,040 core seconds for 0.5 GB, before any ROLLUP, where this takes 830 with it. Then Spark shuffles them by their first two words and sorts them, and equal ones are
summed as they stream by, so neither a frequent phrase nor a long text has to fit in memory.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from icelens.llm.common import text_of
from icelens.session import settle

#: Words of the longest phrase, least count of one, results of a language.
MOST, LEAST, TOP = 3, 10, 2000
#: A phrase goes if a longer one that holds it has at least this percentage of its count.
COVERED = 50
#: Scores are whole numbers of this part of one.
UNIT = 1_000_000
#: Bytes of text whose windows are counted at once (a piece that is longer is not cut), and rows handed over at once.
CHUNK, ROWS = 12_000_000, 100_000
#: Parts of a language that are ranked apart.
PARTS = 64
PIECE_END, BLANK, LETTER = 2, 1, 0
KIND = np.zeros(256, dtype=np.uint8)
KIND[list(b".,;:!?\n\x0b\x0c\r")] = PIECE_END
KIND[list(b" \t")] = BLANK
ENDS = re.compile(rb"[.,;:!?\n\x0b\x0c\r]")
LOWER = bytes(range(256)).lower()
WINDOW = pa.schema([("lang", pa.string()), ("head", pa.string()), ("third", pa.string()), ("n", pa.int64())])


def chunk_windows(data: bytes) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """(head, third, n): the distinct windows of a text in UTF-8 whose letters A-Z are lower-cased already, and how often
    each occurs. head: first and second word with a space between, the second may be empty; third: may be empty."""
    raw = np.frombuffer(data, dtype=np.uint8)
    kind = KIND[raw]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], kind == LETTER, [False]])))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return pa.array([], pa.string()), pa.array([], pa.string()), np.zeros(0, dtype=np.int64)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(raw[kind == LETTER])).dictionary_encode()
    # words are numbered in their order, so windows come out sorted: neighbours share their beginnings and shrink in the shuffle
    order = pc.sort_indices(words.dictionary)
    place = np.empty(len(order), dtype=np.int64)
    place[order.to_numpy()] = np.arange(1, len(order) + 1)  # 0 is the padding
    ids = place[words.indices.to_numpy()]
    piece = np.cumsum(kind == PIECE_END, dtype=np.int64)[starts]
    second, third = np.zeros_like(ids), np.zeros_like(ids)
    second[:-1] = np.where(piece[1:] == piece[:-1], ids[1:], 0)
    third[:-2] = np.where(piece[2:] == piece[:-2], ids[2:], 0)
    size = len(words.dictionary) + 1
    if size < 1 << 21:
        keys, n = np.unique((ids * size + second) * size + third, return_counts=True)
        keys, third = np.divmod(keys, size)
        first, second = np.divmod(keys, size)
    else:
        (first, second, third), n = np.unique(np.stack([ids, second, third]), axis=1, return_counts=True)
    names = pa.concat_arrays([pa.array([""]), words.dictionary.take(order)])
    head = pc.binary_join_element_wise(names.take(pa.array(first)), names.take(pa.array(second)), " ")
    return head, names.take(pa.array(third)), n.astype(np.int64)


def _cut(texts: list[bytes]):
    """The texts as strings of bytes of CHUNK or a little more, each ending where a piece ends."""
    line = b"\n".join(texts)
    at = 0
    while at < len(line):
        end = ENDS.search(line, at + CHUNK)
        stop = end.end() if end else len(line)
        yield line[at:stop]
        at = stop


def windows(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, head, third, n): the windows of each chunk of ``docs``; equal ones occur in several chunks."""
    def counted(waiting: dict):
        for name, texts in waiting.items():
            for data in _cut(texts):
                head, third, n = chunk_windows(data)
                for at in range(0, len(n), ROWS):
                    part = slice(at, at + ROWS)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(n[part]), pa.string()), head[part], third[part], pa.array(n[part])], schema=WINDOW)

    def count(batches):
        waiting, size = {}, 0
        for batch in batches:
            for name, data in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary())):
                data = data.as_py().translate(LOWER)
                waiting.setdefault(name, []).append(data)
                size += len(data)
                if size > CHUNK:
                    yield from counted(waiting)
                    waiting, size = {}, 0
        yield from counted(waiting)

    columns = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), text_of(text).alias("text"))
    return columns.mapInArrow(count, "lang string, head string, third string, n long")


def _sums(same: list[pa.Array], n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, sums): where each run of rows that are equal in all columns of ``same`` begins, and its sum of ``n``."""
    new = np.zeros(len(n), dtype=bool)
    new[:1] = True
    for column in same:
        new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    first = np.flatnonzero(new)
    return first, np.add.reduceat(n, first) if len(first) else n


def blanked(least: int):
    """A function of batches of windows, sorted by (lang, head, third), that sums equal windows and blanks rare words."""
    def rows(lang: pa.Array, head: pa.Array, third: pa.Array, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([lang, head, third, pa.array(n)], schema=WINDOW)

    def closed(lang, head, third, n, rest):
        """Rows for whole heads, one run a row; ``rest``: what rare thirds of the first head had before these."""
        kept = (n >= least) & pc.not_equal(third, "").to_numpy(zero_copy_only=False)
        at, total = _sums([lang, head], n)
        _, gone = _sums([lang, head], np.where(kept, 0, n))
        total[0], gone[0] = total[0] + rest[0], gone[0] + rest[1]
        pick = pa.array(np.flatnonzero(kept))
        yield rows(lang.take(pick), head.take(pick), third.take(pick), n[kept])
        # what is left of a head keeps its second word if the head is frequent
        lang, head, none = lang.take(pa.array(at)), head.take(pa.array(at)), pa.array([""] * len(at), pa.string())
        whole = np.flatnonzero((total >= least) & (gone > 0))
        pick = pa.array(whole)
        yield rows(lang.take(pick), head.take(pick), none[:len(whole)], gone[whole])
        rare = np.flatnonzero((total < least) & (gone > 0))
        if len(rare):
            pick = pa.array(rare)
            lang, first = lang.take(pick), pc.replace_substring_regex(head.take(pick), "(?s) .*", " ")
            at, n = _sums([lang, first], gone[rare])
            yield rows(lang.take(pa.array(at)), first.take(pa.array(at)), none[:len(at)], n)

    def of(batches):
        last, rest = None, (0, 0)  # the run that may go on in the next batch; (count, rare count) of its head before it
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if last is not None:
                table = pa.concat_tables([last, table])
            lang, head, third, n = (c.combine_chunks() for c in table.columns)
            n = n.to_numpy(zero_copy_only=False)
            at, n = _sums([lang, head, third], n)
            pick = pa.array(at)
            lang, head, third = lang.take(pick), head.take(pick), third.take(pick)
            heads, _ = _sums([lang, head], n)
            stop = int(heads[-1])
            if stop:
                yield from closed(lang[:stop], head[:stop], third[:stop], n[:stop], rest)
                rest = (0, 0)
            # of the head that may go on, all runs but the last are whole
            done, names = n[stop:-1], third[stop:-1]
            kept = (done >= least) & pc.not_equal(names, "").to_numpy(zero_copy_only=False)
            if kept.any():
                pick = pa.array(np.flatnonzero(kept))
                yield rows(lang[stop:-1].take(pick), head[stop:-1].take(pick), names.take(pick), done[kept])
            rest = (rest[0] + int(done.sum()), rest[1] + int(done[~kept].sum()))
            last = pa.Table.from_batches([rows(lang[-1:], head[-1:], third[-1:], n[-1:])])
        if last is not None:
            yield from closed(*(c.combine_chunks() for c in last.columns[:3]), last.column(3).to_numpy().copy(), rest)
    return of


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST) -> DataFrame:
    """(lang, w1, w2, w3, size, f): how often each phrase of ``size`` words occurs, for those with at least ``least``
    occurrences; words beyond ``size`` are null. size 0: all words of the language, listed whatever their number."""
    found = windows(docs, text, lang).repartition("lang", "head").sortWithinPartitions("lang", "head", "third")
    few = found.mapInArrow(blanked(least), "lang string, head string, third string, n long")
    parts = F.split("head", " ")

    def word(c: Column) -> Column:
        return F.when(c != "", c)
    few = few.select("lang", word(parts[0]).alias("w1"), word(parts[1]).alias("w2"), word(F.col("third")).alias("w3"), "n")
    summed = few.rollup("lang", "w1", "w2", "w3").agg(F.sum("n").alias("f"), F.bit_count(F.grouping_id()).alias("gone"))
    size = F.lit(MOST) - F.col("gone")
    padded = F.col("w1").isNull() & (size >= 1) | F.col("w2").isNull() & (size >= 2) | F.col("w3").isNull() & (size >= 3)
    return (summed.where((size >= 0) & ~padded & ((size == 0) | (F.col("f") >= least)))
            .select("lang", "w1", "w2", "w3", size.cast("int").alias("size"), "f"))


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(UNIT * a * a / (left * right)) in whole numbers of 38 digits."""
    a, left, right = (c.cast("decimal(19,0)") for c in (a, left, right))
    return F.call_function("div", F.lit(UNIT).cast("decimal(7,0)") * (a * a), left * right)


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the phrases of two and three words of each language that score highest.

    a: occurrences of the phrase, l and r: those of its two parts at the cut with the lowest score, n: words of the
    language, score: floor(UNIT * a * a / (l * r)). A phrase goes if a longer candidate that holds it has COVERED per cent
    of its count or more. ``docs``: any columns. A null text counts as empty, a null language is ``und``; a repeated row
    counts again; blank texts and an empty table give no rows; equal scores go by a, then by the phrase's bytes. Columns of
    other names are not looked at. Numbers are exact up to 10 ** 15 occurrences.
    """
    counts = settle(phrase_counts(docs, text, lang, least), "phrases")

    def of_size(size: int, names: list[str], f: str) -> DataFrame:
        return counts.where(F.col("size") == size).select("lang", *[F.col(f"w{i + 1}").alias(n) for i, n in enumerate(names)], F.col("f").alias(f))

    def wide(name: str) -> Column:
        return F.col(name).cast("decimal(19,0)")

    pairs = (of_size(2, ["w1", "w2"], "a").join(of_size(1, ["w1"], "l"), ["lang", "w1"]).join(of_size(1, ["w2"], "r"), ["lang", "w2"])
             .select("lang", "w1", "w2", F.lit(None).cast("string").alias("w3"), "a", F.array(F.struct(F.lit(1).alias("k"), "l", "r")).alias("cuts")))
    triples = (of_size(3, ["w1", "w2", "w3"], "a")
               .join(of_size(1, ["w1"], "l1"), ["lang", "w1"]).join(of_size(2, ["w2", "w3"], "r1"), ["lang", "w2", "w3"])
               .join(of_size(2, ["w1", "w2"], "l2"), ["lang", "w1", "w2"]).join(of_size(1, ["w3"], "r2"), ["lang", "w3"])
               .select("lang", "w1", "w2", "w3", "a", F.array(
                   F.struct(F.lit(1).alias("k"), F.col("l1").alias("l"), F.col("r1").alias("r")),
                   F.struct(F.lit(2).alias("k"), F.col("l2").alias("l"), F.col("r2").alias("r"))).alias("cuts")))
    triples = settle(triples, "triples")
    longer = triples.select(F.explode(F.array(F.struct("lang", "w1", "w2", "a"), F.struct(
        F.col("lang"), F.col("w2").alias("w1"), F.col("w3").alias("w2"), F.col("a")))).alias("p")).select("p.*")
    longer = longer.groupBy("lang", "w1", "w2").agg(F.max("a").alias("most"))
    pairs = pairs.join(longer, ["lang", "w1", "w2"], "left").where(
        F.col("most").isNull() | (100 * wide("most") < COVERED * wide("a"))).drop("most")
    both = settle(pairs, "pairs").unionByName(triples)
    scores = F.transform("cuts", lambda c: F.struct(_score(F.col("a"), c["l"], c["r"]).alias("score"), c["k"].alias("k"), c["l"].alias("l"), c["r"].alias("r")))
    scored = both.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.array_min(scores).alias("cut"))
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    parts = scored.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)).alias("part"))
    # a language is ranked in parts first, so that what its last task sees does not grow with the table
    parts = parts.withColumn("rank", F.row_number().over(W.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    first = parts.drop("part").withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return first.join(of_size(0, [], "n"), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
