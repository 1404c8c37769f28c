"""Near-duplicate texts by SimHash, found through deletion variants.

A fingerprint of 64 bits is cut into two segments of 32, so of two fingerprints with at most three differing bits, at
least one segment differs in one bit or none. Each segment is indexed as it is and as its variants, in which one set bit
is cleared: segments that are equal meet on themselves, and segments one bit apart meet where the variant of the one
is the other. An equality join brings those together and the whole fingerprints decide.

Equal texts, and different texts with equal fingerprints, are one node from the start. A bucket with many nodes (a
large group of near copies) is not joined with itself: its members meet at hubs, see ``_hub_links``.
"""

from __future__ import annotations

import functools
import itertools
import math
import uuid

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icelens.llm.common import text_of, words_of
from icelens.session import clear, scope, settle

SEED = 42
MOST_BITS = 3
HALF = 32
#: A bucket up to this size is joined pair by pair. A member of a larger one goes to its hubs, 1 + 32 + 496 rows in the
#: worst case; so a fingerprint never makes more rows than a fixed number, whatever its bucket holds.
SMALL_BUCKET = 64
#: Words of a shingle of a fingerprint.
FINGERPRINT_SHINGLE = 3
#: For similar(): words of a shingle of its sets, the least Jaccard similarity of shingle sets, and 64-bit lanes of a small set's bit map
#: (those of a larger one: the power of two that has two bits a shingle, or the next).
SHINGLE, SIMILARITY, LANES = 5, 0.8, 8
#: Of so many times the shingles that a prefix has, those with the lowest hashes, the frequent ones are told by a count over
#: all texts; how often is frequent, and the most of them kept. Any order of shingles gives the same groups; with the
#: frequent ones last, fewer pairs are tried.
LOWEST, FREQUENT, MOST_FREQUENT = 2, 8, 200_000
#: Centres of a bucket in the first round after the stars, and by how much they grow each round; parts of a large bucket.
CENTRES, GROWTH, PARTS = 64, 4, 16
#: A pair takes a set along to be compared, so more than so many pairs are compared in parts: by PARTED parts of their first
#: texts and as many of their second ones, or by more, until a part has that many pairs or half as many as there are texts.
AT_ONCE, PARTED = 25_000, 3
#: Hashes of texts that are broadcast, at most: 8 MB of them.
BROADCAST_NODES = 1_000_000


def fingerprint(text: str | None, shingle: int) -> int:
    """The SimHash of one text, as a signed 64-bit number; no word gives zero.

    Shingles count as often as they occur; a text with fewer words is one shingle of all its words.
    """
    data = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII letters and ASCII space only
    if not data:
        return 0
    ends = np.cumsum([len(w) + 1 for w in data]).tolist()
    line = b" ".join(data)
    size = min(shingle, len(data))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip([0, *ends], [e - 1 for e in ends[size - 1:]])], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 8192):  # bounded memory for very long texts
        counts += np.unpackbits(hashes[at:at + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(shingle: int):
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")
    return of


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _one_at(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def _flips(value: Column, most: int) -> Column:
    """Every 32-bit value at most ``most`` (0, 1 or 2) bits away, without the distance."""
    ones = F.transform(F.sequence(F.lit(0), F.lit(HALF - 1)), _one_at)
    if most == 0:
        return F.array(value)
    single = F.transform(ones, lambda m: value.bitwiseXOR(m))
    if most == 1:
        return F.concat(F.array(value), single)
    pairs = F.flatten(F.transform(ones, lambda m: F.transform(F.filter(ones, lambda k: k < m), lambda k: value.bitwiseXOR(m).bitwiseXOR(k))))
    return F.concat(F.array(value), single, pairs)


def _segments(nodes: DataFrame) -> DataFrame:
    """(fp, part, own, rest): both ways to cut a fingerprint into an indexed segment and the rest."""
    low, high = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("fp", HALF)
    return nodes.select("fp", F.explode(F.array(
        F.struct(F.lit(0).alias("part"), low.alias("own"), high.alias("rest")),
        F.struct(F.lit(1).alias("part"), high.alias("own"), low.alias("rest")))).alias("s")).select("fp", "s.*")


def _meet(plain: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members, others) of the buckets (part, own): rows of ``plain`` by their segment and by its variants, as far as the
    bucket has anyone to meet. ``small``: the bucket has at most SMALL_BUCKET of either."""
    plain = settle(plain, "simhash-segments")
    bits = F.filter(F.sequence(F.lit(0), F.lit(HALF - 1)),
                    lambda i: F.call_function("shiftright", F.col("own"), i).bitwiseAND(F.lit(1)) == 1)
    variants = plain.select("fp", "part", "rest", F.explode(F.transform(
        bits, lambda i: F.col("own").bitwiseXOR(_one_at(i)))).alias("own"))
    sizes = plain.groupBy("part", "own").agg(F.count("*").alias("n_plain"))
    # only variants that are somebody's segment go on; most are nobody's
    met = settle(variants.join(sizes, ["part", "own"]), "simhash-variants")
    reached = met.groupBy("part", "own").agg(F.count("*").alias("n_variants"))
    buckets = settle(sizes.where("n_plain > 1").join(reached, ["part", "own"], "full").select(
        "part", "own", ((F.coalesce("n_plain", F.lit(1)) <= SMALL_BUCKET)
                        & (F.coalesce("n_variants", F.lit(0)) <= SMALL_BUCKET)).alias("small")), "simhash-buckets")
    # written, as joins over the same keys can fail in a union when their partitions are merged at run time
    return (settle(plain.join(buckets, ["part", "own"]), "simhash-members"),
            settle(met.drop("n_plain").join(buckets, ["part", "own"]), "simhash-others"))


def _pairs(members: DataFrame, others: DataFrame, near: Column | None = None) -> DataFrame:
    """(a, b): all pairs, ``near`` ones only if given, in small buckets with equal segments or segments one bit apart."""
    near = F.lit(True) if near is None else near
    few, some = members.where("small"), others.where("small")
    left = few.select("part", "own", F.col("fp").alias("a"))
    equal = left.join(few.select("part", "own", F.col("fp").alias("b")), ["part", "own"]).where((F.col("a") < F.col("b")) & near)
    apart = left.join(some.select("part", "own", F.col("fp").alias("b")), ["part", "own"]).where(near)
    return settle(equal.select("a", "b"), "simhash-equal").union(settle(apart.select("a", "b"), "simhash-apart"))


def links(nodes: DataFrame) -> DataFrame:
    """(a, b): pairs of fingerprints whose links connect just what all pairs within MOST_BITS connect.

    ``nodes``: distinct fingerprints ``fp`` (long). Between members of small buckets every pair is listed.
    """
    members, others = _meet(_segments(nodes))
    near = _distance(F.col("a"), F.col("b")) <= MOST_BITS
    return _pairs(members, others, near).union(settle(_hub_links(members.where("not small"), others.where("not small")), "simhash-hubs"))


def _hub_links(members: DataFrame, others: DataFrame) -> DataFrame:
    """Links among members of large buckets, without pairs.

    A hub is a value of the other segment. Members with equal segments are linked if their rests differ in three bits at
    most, that is, if there is a hub one bit or less from the one and two bits or less from the other. Where a hub has a
    member within one bit, all members within two bits of it are linked with that member; where it has none, it
    links nobody. Members one bit apart may differ in two more bits, so a hub within one bit of both links them.
    """
    def at_hubs(df: DataFrame, most: int, near: Column) -> DataFrame:
        hubs = df.select("part", "own", "fp", "rest", F.explode(_flips(F.col("rest"), most)).alias("hub"))
        close = F.when(near & (_distance(F.col("rest"), F.col("hub")) <= 1), F.col("fp"))
        return hubs.select("part", "own", "hub", "fp", close.alias("close"))

    def starred(df: DataFrame) -> DataFrame:
        # the smallest near member of a hub, per hub; hubs without one fall out of the join
        centre = df.where(F.col("close").isNotNull()).groupBy("part", "own", "hub").agg(F.min("close").alias("a"))
        return (df.join(centre, ["part", "own", "hub"]).where(F.col("a") != F.col("fp"))
                .select("a", F.col("fp").alias("b")).distinct())

    equal = settle(starred(at_hubs(members, 2, F.lit(True))), "simhash-stars")
    both = at_hubs(members, 1, F.lit(True)).unionByName(
        at_hubs(others, 1, F.lit(False)).withColumn("close", F.lit(None).cast("long")))
    return equal.union(starred(both))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for every node of ``edges`` (a, b: long) the smallest node of its component, itself included.

    Alternates two steps until nothing changes: every node's larger neighbours point to its smallest neighbour, then its
    smaller neighbours do. Rounds grow with the logarithm of the longest chain. Every round is written.
    """
    edges = settle(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        # pairs (a, b) with a > b
        u, v, m = F.col("u"), F.col("v"), F.col("m")
        down = F.struct(F.col("a").alias("u"), F.col("b").alias("v"))
        up = F.struct(F.col("b").alias("u"), F.col("a").alias("v"))
        both = pairs.select(F.explode(F.array(down, up) if large else F.array(down)).alias("e")).select("e.*")
        low = both.groupBy("u").agg(F.least(F.min("v"), u).alias("m"))
        to_lowest = [F.struct(x.alias("a"), m.alias("b")) for x in ([v] if large else [v, u])]
        joined = both.join(low, "u").where(v > u if large else F.lit(True))
        return joined.select(F.explode(F.array(*to_lowest)).alias("e")).select("e.*").where("a != b").distinct()

    while True:
        after = settle(star(star(edges, True), False), "links")
        same = [row[0] for row in (edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).union(
            after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))).select(F.struct("*")).collect())]
        edges = after
        if same[0] == same[1]:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = FINGERPRINT_SHINGLE) -> DataFrame:
    """(doc_id, fp long, component_id), one row per row of ``docs``.

    ``docs``: any columns; doc_id is an integer and may be null or repeated. component_id: the smallest id of the
    documents in the same component (null if all its ids are null). A null, empty or blank text has fingerprint zero.
    """
    marked = settle(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_of(text).alias("text"))
                    .select("doc_id", fingerprints(shingle)("text").alias("fp")), "simhash")
    nodes = settle(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-nodes")
    roots = components(links(nodes.select("fp"))).select(F.col("node").alias("fp"), "root")
    rooted = nodes.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def shingle_set(text: Column) -> Column:
    """The distinct shingles of SHINGLE words (A-Z lower-cased) as hashes; fewer words are one shingle, no word none."""
    words = words_of(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return F.transform(F.array(words), lambda w: F.array_distinct(F.transform(  # a one-item array names the words once
        F.when(F.size(w) == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(w) - SHINGLE))),
        lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)]))))[0]


def _prefix_size(size: int) -> int:
    """How many shingles of a set, in any common order, hold one of every other set of the least similarity.

    Two such sets share at least that part of the larger one, so both have a shingle in common among their first size -
    part + 1; those are the prefix."""
    return size - math.ceil(SIMILARITY * size - 1e-9) + 1 if size else 0


def _lowest(frames):
    """Frames (node, size, bits, low) from frames (node, set). low: a set's lowest shingles in their order, LOWEST prefixes long."""
    def one(item) -> tuple:
        h = np.sort(np.asarray(item, dtype=np.int64))
        bits = np.zeros(max(64 * LANES, 1 << (2 * len(h) - 1).bit_length() if len(h) else 0), dtype=np.uint8)
        bits[h.view(np.uint64) % np.uint64(len(bits))] = 1
        return len(h), np.packbits(bits).view("<i8"), h[:LOWEST * _prefix_size(len(h))]

    for frame in frames:
        done = pd.DataFrame([one(item) for item in frame["set"]], columns=["size", "bits", "low"])
        yield done.assign(node=frame["node"].to_numpy())[["node", "size", "bits", "low"]]


def _prefixes(order: np.ndarray, counts: np.ndarray, column: str):
    """A function of frames (node, size, ``column``): (node, prefix). ``order``: frequent shingles by value, ``counts``: how often.

    Shingles are ordered by their count if they are frequent, else before all of those, then by hash. ``column`` has the whole
    set or its lowest shingles; where those do not tell the prefix, it is null. An empty set's prefix is zero."""
    def one(size: int, item) -> np.ndarray | None:
        if not size:
            return np.zeros(1, dtype=np.int64)
        h = np.sort(np.asarray(item, dtype=np.int64))
        often = np.zeros(len(h), dtype=np.int64)
        if len(order):
            at = np.minimum(np.searchsorted(order, h), len(order) - 1)
            often = np.where(order[at] == h, counts[at], 0)
        wanted = _prefix_size(size)
        if len(h) < size and np.count_nonzero(often == 0) < wanted:
            return None
        return h[np.argsort(often, kind="stable")][:wanted]

    def of(frames):
        for frame in frames:
            yield pd.DataFrame({"node": frame["node"], "prefix": [one(*row) for row in zip(frame["size"], frame[column])]})
    return of


def _sets_of(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, set) of the ``wanted`` (node) among ``texts`` (node, text), once each."""
    # where few texts are wanted, the others need not be shuffled to find them
    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_NODES else wanted
    return texts.join(wanted, "node", "left_semi").dropDuplicates(["node"]).select("node", shingle_set(F.col("text")).alias("set"))


def _found(texts: DataFrame, folder: str) -> DataFrame:
    """(node, size, bits, prefix) of ``texts`` (node, text), one row a node. What the result does not need is settled in the scope ``folder``.

    The frequent shingles come from a count over all texts: were they told from a sample of a fixed size, a shingle just below
    the limit would be that of more texts the more there are, and its pairs would grow with the square of that."""
    with scope(folder):
        sets = texts.select("node", shingle_set(F.col("text")).alias("set")).mapInPandas(
            _lowest, "node long, size int, bits array<long>, low array<long>")
        cut = settle(sets.dropDuplicates(["node"]), "similar-lowest")
        often = settle(cut.select(F.explode("low").alias("s")).groupBy("s").agg(F.count("*").cast("int").alias("n"))
                       .where(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "s").limit(MOST_FREQUENT), "similar-frequent").toPandas().sort_values("s")
        order = often["s"].to_numpy(dtype=np.int64), often["n"].to_numpy(dtype=np.int64)
        prefixes = settle(cut.select("node", "size", "low").mapInPandas(_prefixes(*order, "low"), "node long, prefix array<long>"), "similar-told")
        # texts that are frequent shingles for the most part: their whole sets are ordered
        rest = settle(_sets_of(texts, prefixes.where("prefix is null").select("node")).select("node", F.size("set").alias("size"), "set")
                      .mapInPandas(_prefixes(*order, "set"), "node long, prefix array<long>"), "similar-rest")
        return settle(cut.drop("low").join(prefixes.where("prefix is not null").union(rest), "node"), "similar-prefixes")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of ``pairs`` whose shingle sets have the least similarity."""
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    folder, parts = f"sets-{uuid.uuid4().hex}", []
    with scope(folder):
        wanted = settle(wanted, "similar-wanted")
        count, number = wanted.count(), pairs.count()
        sets = settle(_sets_of(texts, wanted), "similar-sets")
    side = 1 if number <= AT_ONCE else max(PARTED, math.ceil(math.sqrt(number / max(AT_ONCE, count // 2))))

    def part_of(node: str) -> Column:
        return F.pmod(F.xxhash64(node, F.lit(SEED)), F.lit(side))

    for i, j in itertools.product(range(side), repeat=2):  # so no more than a part of the sets and pairs is shuffled at a time
        some = pairs.where((part_of("a") == i) & (part_of("b") == j))
        x, y = sets.where(part_of("node") == i).toDF("a", "x"), sets.where(part_of("node") == j).toDF("b", "y")
        both = some.join(x, "a").join(y, "b")
        counted = both.select("a", "b", F.size(F.array_intersect("x", "y")).alias("n"), (F.size("x") + F.size("y")).alias("sum"))
        parts.append(settle(counted.where(F.col("n") >= SIMILARITY * (F.col("sum") - F.col("n"))).select("a", "b"), "similar-links"))
    with scope(folder):  # the sets are the largest part of a round
        clear(texts.sparkSession)
    return functools.reduce(DataFrame.union, parts)


def _shared(found: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """(rows, facts): the (token, node, n) of tokens that several texts have, and (node, size, bits, score) of their nodes.

    Most tokens are one text's alone and are gone before anything is written. ``found``: (node, size, bits, prefix), one row
    a node. Tokens with the same nodes say the same: one of them stays. score: how shared the tokens of a node are. What the
    result does not need is settled in the scope ``folder``.
    """
    every = found.select("node", F.explode("prefix").alias("token"))
    with scope(folder):
        common = settle(every.groupBy("token").agg(F.count("*").alias("n")).where("n > 1"), "similar-counts")
        rows = settle(every.join(common, "token"), "similar-shingles")
    kept = (rows.groupBy("token", "n").agg(F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(SEED))).alias("y"))
            .groupBy("n", "x", "y").agg(F.min("token").alias("token")).select("token"))
    rows = settle(rows.join(kept, "token", "left_semi"), "similar-rows")
    shared = rows.groupBy("node").agg(F.sum("n").alias("score"))
    facts = found.select("node", "size", "bits").join(shared, "node").select(
        "node", "size", "bits", (F.col("score") / F.greatest(F.lit(1), "size")).alias("score"))
    return rows, settle(facts, "similar-facts")


def _open(rows: DataFrame, roots: DataFrame, before: int) -> DataFrame:
    """The ``rows`` of tokens with several components and nodes that were no centres yet."""
    rooted = rows.join(roots, "node", "left").select("token", "node", "n", F.coalesce("root", "node").alias("root"))
    tokens = rooted.groupBy("token").agg(F.first("n").alias("n"), F.min("root").alias("low"), F.max("root").alias("high")).where(
        (F.col("low") != F.col("high")) & (F.col("n") > before)).select("token")
    return rows.join(tokens, "token", "left_semi")


def _simhash_links(texts: DataFrame) -> DataFrame:
    """(a, b): links between the nodes of ``texts`` (node, text) that connect just what fingerprints within MOST_BITS connect."""
    folder = f"simhash-{uuid.uuid4().hex}"
    with scope(folder):
        marked = settle(texts.select("node", fingerprints(FINGERPRINT_SHINGLE)("text").alias("fp")).distinct(), "simhash")
        firsts = settle(marked.groupBy("fp").agg(F.min("node").alias("first")), "simhash-nodes")
        near = links(firsts.select("fp")).join(firsts.toDF("a", "x"), "a").join(firsts.toDF("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
        equal = marked.join(firsts, "fp").where("node != first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    known = settle(near, "simhash-near").union(settle(equal, "simhash-equal"))
    with scope(folder):
        clear(texts.sparkSession)
    return known


def _may_be_similar(x: str, y: str) -> Column:
    """False only where the sets of the structs ``x`` and ``y`` (size, bits) do not have the least similarity.

    Where sizes allow it at all, one bit map is as long as the other or twice as long; its halves are then laid on each other."""
    def folded(u: str, v: str) -> Column:
        bits, n = F.col(f"{u}.bits"), F.size(f"{v}.bits")
        return F.when(F.size(bits) <= n, bits).otherwise(F.zip_with(F.slice(bits, F.lit(1), n), F.slice(bits, n + 1, n), lambda p, q: p.bitwiseOR(q)))

    def only(u: str, v: str) -> Column:  # at least so many shingles are not in the other set
        return F.aggregate(F.zip_with(folded(u, v), folded(v, u), lambda p, q: F.bit_count(p.bitwiseAND(F.bitwise_not(q)))), F.lit(0), lambda s, d: s + d)

    u, v = F.col(f"{x}.size"), F.col(f"{y}.size")
    enough = SIMILARITY * F.greatest(u, v) - 1e-9
    return F.when(F.least(u, v) < enough, False).otherwise(F.least(u - only(x, y), v - only(y, x)) >= enough)


def _linked(rows: DataFrame, facts: DataFrame, texts: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """(node, root) for the nodes of ``rows`` (token, node, n) that are linked to another of the same token, or by ``links``.

    What ``links`` connect already is not tried. First each token's most shared node is tried with all others. Then, in rounds, more and more of a token's nodes are
    tried with all others of other components, until the token has one component or every node was tried. Each round
    writes to a folder of its own, which goes when the next one has written what it needs.
    """
    spark = rows.sparkSession
    roots = None
    if links is not None:
        roots = settle(components(links), "similar-first-roots")
        rows = settle(_open(rows, roots, 0), "similar-first-open")
        if rows.isEmpty():
            return roots
    centre = (rows.join(facts.select("node", "score"), "node").groupBy("token")
              .agg(F.max(F.struct("score", "node")).alias("best")).select("token", F.col("best.node").alias("a")))
    tried = rows.join(centre, "token").select("a", F.col("node").alias("b"))
    if roots is not None:
        tried = tried.join(roots.toDF("a", "ra"), "a", "left").join(roots.toDF("b", "rb"), "b", "left").where(
            F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b")
    most, last = CENTRES, None
    while True:
        folder = f"round-{uuid.uuid4().hex}"
        with scope(folder):
            pairs = tried.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
            x, y = (facts.select(F.col("node").alias(k), F.struct("size", "bits").alias(v)) for k, v in (("a", "x"), ("b", "y")))

            pairs = settle(pairs.join(x, "a").join(y, "b").where(_may_be_similar("x", "y")).select("a", "b"), "similar-pairs")
            new = _verified(pairs, texts)
            links = new if links is None else settle(links.union(new), "similar-all-links")
            roots = settle(components(links), "similar-roots")
            before = most // GROWTH if most > CENTRES else 0
            rows = settle(_open(rows, roots, before), "similar-open")
        if last is not None:
            with scope(last):
                clear(spark)
        last = folder
        if rows.isEmpty():
            return roots
        place = F.pmod(F.xxhash64("node", F.lit(SEED + 1)), F.lit(1 << 20)) * F.col("n")
        with scope(folder):
            members = settle(rows.join(roots, "node", "left").select("token", "node", "n", F.coalesce("root", "node").alias("root"), place.alias("place")), "similar-members")
        centres = members.where((F.col("place") >= before << 20) & (F.col("place") < most << 20))
        part = F.when(F.col("n") <= SMALL_BUCKET, 0).otherwise(F.pmod(F.xxhash64("node"), F.lit(PARTS)))
        every = F.when(F.col("n") <= SMALL_BUCKET, F.array(F.lit(0).cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long")))
        left = centres.select("token", F.explode(every).alias("part"), F.col("node").alias("a"), F.col("root").alias("ra"))
        right = members.select("token", part.cast("long").alias("part"), F.col("node").alias("b"), F.col("root").alias("rb"))
        tried = left.join(right, ["token", "part"]).where("ra != rb").select("a", "b")
        most *= GROWTH


def similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", simhash: bool = False) -> DataFrame:
    """(doc_id, node, component_id, keep), one row per row of ``docs``: groups of texts linked by shingle sets of Jaccard
    similarity SIMILARITY or more, with ``simhash`` also by SimHash fingerprints within MOST_BITS, as in classes().

    Candidates are texts with a common shingle in their prefixes (see ``_prefixes``), which no pair of that similarity
    lacks; the sets themselves decide. Pairs that two other links connect already are left out, no others. node: 64-bit
    hash of the text. keep: the row has the smallest doc_id (null last) of its group, then the smallest node.
    """
    marked = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(text_of(text)).alias("node"))
    firsts = settle(marked.groupBy("node").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("first")), "similar-firsts")
    texts = docs.select(F.xxhash64(text_of(text)).alias("node"), text_of(text).alias("text"))
    folder = f"shared-{uuid.uuid4().hex}"
    shared = _shared(_found(texts, folder), folder)
    with scope(folder):  # the rounds need no more than the shared shingles
        clear(docs.sparkSession)
    roots = _linked(*shared, texts, _simhash_links(texts) if simhash else None)
    rooted = firsts.join(roots, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    best = rooted.groupBy("root").agg(F.min("first").alias("best"))
    named = rooted.join(best, "root").select("node", F.col("best.doc_id").alias("component_id"), F.col("best.node").alias("best_node"))
    return marked.join(named, "node").select(
        "doc_id", "node", "component_id", ((F.col("node") == F.col("best_node")) & F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("keep"))


def unique_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of every group of similar(), by SimHash and by shingle sets, with the columns of ``docs``: the one with the smallest doc_id."""
    # one shuffle by (text, id): a text's copies are spread by their ids, and repeated rows meet in the same place
    kept = similar(docs, doc_id, text, simhash=True).where("keep").select(F.xxhash64("node", "doc_id").alias("pick"), F.col("node").alias("kept"))
    node = F.xxhash64(text_of(text))
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), node.alias("node"),
                         F.xxhash64(node, F.col(f"`{doc_id}`")).alias("picked"))
    rows = (marked.join(kept, (F.col("picked") == F.col("pick")) & (F.col("node") == F.col("kept")), "left_semi")
            .dropDuplicates(["picked", "node"]))
    return rows.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
