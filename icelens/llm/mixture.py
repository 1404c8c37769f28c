"""Mixing sources to target weights by blocks of words.

Each source is one long line of words, its documents in a fixed pseudorandom order, packed into blocks of BLOCK words.
An output shard has SLOTS slots; a multinomial draw, seeded by the shard's number, says how many of them each source
fills. The draws of a source are numbered through all shards, and number j takes block ``permutation(j mod blocks)`` of
pass ``j div blocks``; every pass has its own pseudorandom permutation, so no block comes twice in a pass. Blocks and
slots are then joined by index. What the draws of a source have beyond its quota is given, in order, to sources that
were drawn too rarely, so each source gets its quota exactly.

Only the table of sources (one row each) is read by the driver.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from icelens.llm.common import text_of, words_of
from icelens.session import settle

WEIGHTS = [5.0, 2.0, 1.0]
SHARE, MOST_PASSES = 1.5, 2
BLOCK, SLOTS, SEED = 128, 1024, 20
#: Running sums are formed in this many chunks for each source, then over the chunks.
CHUNKS = 4096
MOST_SOURCES = 1_000_000


def running_start(df: DataFrame, group: str, chunk: str, order: list[Column], value: str, name: str) -> DataFrame:
    """``name``: the sum of ``value`` over the rows of the group before this one, without one task per group."""
    inside = F.sum(value).over(W.partitionBy(group, chunk).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)) - F.col(value)
    totals = df.groupBy(group, chunk).agg(F.sum(value).alias("_own"))
    before = totals.select(F.col(group).alias("_g"), F.col(chunk).alias("_c"), (F.sum("_own").over(
        W.partitionBy(group).orderBy(chunk).rowsBetween(W.unboundedPreceding, 0)) - F.col("_own")).alias("_before"))
    return (df.withColumn("_inside", inside).join(before, (F.col(group) == F.col("_g")) & (F.col(chunk) == F.col("_c")))
            .withColumn(name, F.col("_inside") + F.col("_before")).drop("_inside", "_before", "_g", "_c"))


def targets(sizes: list[int], weights: list[float] = WEIGHTS, share: float = SHARE, most: float = MOST_PASSES) -> list[float]:
    """Words each source shall give. Sources, in their order, weigh ``weights``, repeating, and share ``share`` of all
    words; none gives more than ``most`` times its size, and the excess is shared again by weight among the others."""
    size = np.asarray(sizes, dtype=float)
    weight = np.resize(np.asarray(weights, dtype=float), len(size))
    limit, target = most * size, np.zeros(len(size))
    open_, left = np.ones(len(size), dtype=bool), share * float(size.sum())
    while open_.any():
        target[open_] = left * weight[open_] / weight[open_].sum()
        over = open_ & (target > limit)
        if not over.any():
            break
        target[over] = limit[over]
        left -= float(limit[over].sum())
        open_ &= ~over
    return target.tolist()


def permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of range(size), computed place by place: four Feistel rounds over the smallest even
    number of bits that holds ``size``; a value outside goes through again until it is inside."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    out, todo = index.astype(np.uint64), np.ones(len(index), dtype=bool)
    while todo.any():
        x = out[todo]
        left, right = x >> np.uint64(half), x & mask
        for turn in range(4):
            mixed = (right + np.uint64((key * 4 + turn) % (1 << 31) + 1)) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed >> np.uint64(32)) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = out >= np.uint64(size)
    return out.astype(np.int64)


def placed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", keep: bool = True) -> tuple[DataFrame, list]:
    """(frame, sources). Every row of ``docs`` gets _size (words), _source (number of its source, by code point, null
    last) and _start (its place in the line of its source); columns of ``docs`` come along if ``keep``, else only doc_id.
    sources: [source, size, target, blocks, quota in blocks] in order."""
    size = F.size(words_of(text_of(text))).cast("long")
    columns = [F.col(f"`{c}`") for c in docs.columns] if keep else [F.col(f"`{doc_id}`").alias("doc_id")]
    sized = settle(docs.select(F.struct(*columns).alias("row"), F.col(f"`{source}`").cast("string").alias("_name"), size.alias("_size"),
                               F.col(f"`{doc_id}`").alias("_id"), F.xxhash64(text_of(text)).alias("_text")), "mixture")
    rows = sized.groupBy("_name").agg(F.sum("_size").alias("size")).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"{len(rows)} sources; the source table must fit the driver: group sources first")
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or ""))
    wanted = targets([r.size for r in rows])
    sources = []
    for r, target in zip(rows, wanted):
        blocks = -(-r.size // BLOCK)
        sources.append([r[0], r.size, target, blocks, min(MOST_PASSES * blocks, round(blocks * target / r.size)) if r.size else 0])
    spark = docs.sparkSession
    numbers = spark.createDataFrame([(r[0], i, r[1], r[2]) for i, r in enumerate(sources)],
                                    "_n string, _source int, source_size long, target double")
    numbered = sized.join(F.broadcast(numbers), F.col("_name").eqNullSafe(F.col("_n"))).drop("_n", "_name")
    chunked = numbered.withColumn("_chunk", F.pmod(F.xxhash64("_id", F.lit(SEED)), F.lit(CHUNKS)))
    order = [F.col("_id").asc_nulls_last(), F.col("_text"), F.col("_size")]
    return settle(running_start(chunked, "_source", "_chunk", order, "_size", "_start").drop("_chunk", "_id", "_text"), "placed"), sources


def slots(spark, sources: list) -> DataFrame:
    """(shard, _source, pass, block): what fills the slots of all output shards."""
    quota = np.array([s[4] for s in sources], dtype=np.int64)
    blocks = np.array([s[3] for s in sources], dtype=np.int64)
    total = int(quota.sum())
    shards = -(-total // SLOTS)
    odds = quota / max(total, 1)

    def draw(frames):
        for frame in frames:
            for shard in frame["id"]:
                size = min(SLOTS, total - int(shard) * SLOTS)
                counts = np.random.default_rng([SEED, int(shard)]).multinomial(size, odds)
                used = np.flatnonzero(counts)
                yield pd.DataFrame({"shard": shard, "_source": used.astype(np.int32), "n": counts[used]})

    drawn = spark.range(shards).mapInPandas(draw, "shard long, _source int, n long")
    drawn = settle(running_start(drawn.withColumn("_chunk", F.floor(F.col("shard") / CHUNKS)), "_source", "_chunk",
                                 [F.col("shard")], "n", "first").drop("_chunk"), "draws")
    had = np.zeros(len(sources), dtype=np.int64)
    for row in drawn.groupBy("_source").agg(F.sum("n").alias("n")).collect():
        had[row[0]] = row.n
    excess, lack = np.maximum(had - quota, 0), np.maximum(quota - had, 0)
    excess_from, lack_to = np.cumsum(excess) - excess, np.cumsum(lack)

    def fill(frames):
        for f in frames:
            if not len(f):
                continue
            n = f["n"].to_numpy()
            source = np.repeat(f["_source"].to_numpy(), n)
            j = np.repeat(f["first"].to_numpy(), n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            over = j >= quota[source]
            if over.any():  # the e-th draw too many goes to the e-th place that is lacking
                e = excess_from[source[over]] + j[over] - quota[source[over]]
                other = np.searchsorted(lack_to, e, side="right")
                j[over] = had[other] + e - (lack_to[other] - lack[other])
                source[over] = other
            turn, at = j // blocks[source], j % blocks[source]
            block = np.empty(len(j), dtype=np.int64)
            for key in np.unique(source.astype(np.int64) * (MOST_PASSES + 1) + turn):
                own = (source.astype(np.int64) * (MOST_PASSES + 1) + turn) == key
                block[own] = permuted(at[own], int(blocks[key // (MOST_PASSES + 1)]), SEED + int(key))
            yield pd.DataFrame({"shard": np.repeat(f["shard"].to_numpy(), n), "_source": source.astype(np.int32),
                                "pass": turn.astype(np.int32), "block": block})

    return drawn.mapInPandas(fill, "shard long, _source int, pass int, block long")


def pieces(rows: DataFrame, sources: list) -> DataFrame:
    """(_source, _start, shard, pass, block, from, n): the words ``from`` to ``from + n`` of a document that a slot takes."""
    last = F.floor((F.col("_start") + F.col("_size") - 1) / BLOCK)
    cut = rows.where("_size > 0").select("_source", "_start", "_size", F.explode(
        F.sequence(F.floor(F.col("_start") / BLOCK), last)).alias("block"))
    begin = F.greatest(F.col("block") * BLOCK, F.col("_start"))
    end = F.least((F.col("block") + 1) * BLOCK, F.col("_start") + F.col("_size"))
    cut = cut.select("_source", "_start", "block", (begin - F.col("_start")).alias("from"), (end - begin).alias("n"))
    # the slots come out of few rows, so their size is not known beforehand: never broadcast them
    return cut.join(slots(rows.sparkSession, sources).hint("merge"), ["_source", "block"])


def counts(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken), one row per row of ``docs`` (doc_id, text, source, any others).

    A null or blank text has size 0 and gives nothing. Null sources are one source. Repeated rows are documents of their
    own. Words are taken at most MOST_PASSES times.
    """
    rows, sources = placed(docs, keep=False)
    taken = pieces(rows, sources).groupBy("_source", "_start").agg(F.sum("n").alias("taken")).withColumnRenamed(
        "_source", "_s").withColumnRenamed("_start", "_at")
    joined = rows.join(taken, (F.col("_source") == F.col("_s")) & (F.col("_start") == F.col("_at")) & (F.col("_size") > 0), "left")
    return joined.select("row.doc_id", F.col("_size").alias("size"), "source_size", "target",
                         F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed(docs: DataFrame) -> DataFrame:
    """The mix as documents, with the columns of ``docs``: one row per document and pass, its text being the words taken
    from it, in order. Where all of it is taken, the text stays as it is; otherwise words are joined by spaces.
    n_chars, if there, is set anew."""
    rows, sources = placed(docs)
    parts = pieces(rows, sources).groupBy("_source", "_start", "pass").agg(
        F.sort_array(F.collect_list(F.struct("from", "n"))).alias("parts"), F.sum("n").alias("taken"))
    parts = parts.withColumnRenamed("_source", "_s").withColumnRenamed("_start", "_at")
    joined = rows.where("_size > 0").join(parts, (F.col("_source") == F.col("_s")) & (F.col("_start") == F.col("_at")))
    packed = joined.select("row", F.col("_size").alias("size"), "taken", "parts")  # the columns of docs may have any names
    text = F.col("row").getField("text")
    packed = packed.withColumn("words", F.when(F.col("taken") < F.col("size"), words_of(F.coalesce(text.cast("string"), F.lit("")))))
    cut = F.array_join(F.flatten(F.transform("parts", lambda p: F.slice(
        F.col("words"), (p["from"] + 1).cast("int"), p["n"].cast("int")))), " ")
    packed = packed.withColumn("words", F.when(F.col("taken") < F.col("size"), cut).otherwise(text))
    new = {"text": F.col("words")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("words").cast(docs.schema["n_chars"].dataType)
    return packed.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])
