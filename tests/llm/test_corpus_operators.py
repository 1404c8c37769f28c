"""Near duplicates, decontamination, mixture, token files, archives, and the pipeline."""

import collections
import itertools
import pathlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from icelens.llm import decontaminate, mixture, simhash, tokenbin, warc
from icelens.llm.common import new_folder
from icelens.llm.queries import tokenizer_file


def prose(rnd, n, words="alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu".split()):
    return " ".join(rnd.choice(words) + rnd.choice(["", "s", "ing", "ed", "ous", "ly"]) for _ in range(n))


def lower(text):
    return (text or "").encode().lower().split()


def plain_fingerprint(text):
    w = lower(text)
    shingles = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(items, linked):
    root = {i: i for i in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in itertools.combinations(items, 2):
        if find(a) != find(b) and linked(a, b):
            root[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in items}


@pytest.mark.parametrize("bucket", [64, 1])
def test_simhash_equals_brute_force(messy, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "SMALL_BUCKET", bucket)
    rows = messy.select("doc_id", "text").collect()
    prints = {t: plain_fingerprint(t) for _, t in rows}
    root = groups(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 3)
    first = collections.defaultdict(list)
    for d, t in rows:
        first[root[prints[t]]] += [] if d is None else [d]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    want = sorted(((d, prints[t] - (prints[t] >> 63 << 64), min(first[root[prints[t]]], default=None)) for d, t in rows), key=key)
    assert sorted(map(tuple, simhash.classes(messy).collect()), key=key) == want


@pytest.mark.parametrize("bucket", [64, 3, 1])
def test_links_of_dense_fingerprints(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "SMALL_BUCKET", bucket)
    rnd = random.Random(bucket)
    nodes = set()
    for _ in range(5):
        centre = rnd.getrandbits(64)
        for _ in range(80):
            x = centre
            for k in rnd.sample(range(64), rnd.choice([0, 1, 2, 3, 4, 6])):
                x ^= 1 << k
            nodes.add(x)
    root = groups(sorted(nodes), lambda a, b: (a ^ b).bit_count() <= 3)
    signed = lambda x: x - (x >> 63 << 64)
    want, got = collections.defaultdict(set), collections.defaultdict(set)
    for n, r in root.items():
        want[r].add(signed(n))
    frame = spark.createDataFrame([(signed(n),) for n in nodes], "fp long")
    for r in simhash.components(simhash.links(frame)).collect():
        got[r.root].add(r.node)
    assert {frozenset(g) for g in got.values()} == {frozenset(g) for g in want.values() if len(g) > 1}


def test_unique_documents(spark, messy, empty):
    rnd = random.Random(9)
    rows, truth = [], {}
    for g in range(12):
        text = prose(rnd, 120).split()
        for copy in range(rnd.choice([1, 1, 3, 5])):
            words = list(text)
            for at in rnd.sample(range(120), copy and 1):
                words[at] = "changed"
            truth[len(rows)] = g
            rows.append((len(rows), " ".join(words)))
    kept = {r.doc_id for r in simhash.unique_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == {min(d for d in truth if truth[d] == g) for g in range(12)}
    out = simhash.unique_documents(messy).collect()
    assert len(out) == len({(r.doc_id, r.text) for r in out}) < messy.count() and simhash.unique_documents(empty).columns == empty.columns
    # clean documents, the null id among them only as a copy, stay
    assert {r.doc_id for r in out} >= set(range(25))


def test_unique_documents_link_by_simhash_too(spark):
    """Long texts with scattered changes: their fingerprints are near while their sets of five-word shingles are not."""
    rnd = random.Random(31)
    sets = lambda t: {tuple(t[k:k + 5]) for k in range(len(t) - 4)}
    found, rows = None, []
    for at in range(300):
        text = [f"s{at}_{k % 40}" for k in range(400)]  # forty words again and again
        other = [w if rnd.random() > 0.02 else f"c{at}_{k}" for k, w in enumerate(text)]
        a, b = " ".join(text), " ".join(other)
        alike = len(sets(text) & sets(other)) / len(sets(text) | sets(other))
        if alike < 0.6 and (plain_fingerprint(a) ^ plain_fingerprint(b)).bit_count() <= 3:
            found = (a, b)
            break
    assert found
    third = found[1].split()
    third[-1] = "last"
    rows = [(5, found[0]), (6, found[1]), (7, " ".join(third)), (8, " ".join(f"alone{k}" for k in range(60)))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in simhash.unique_documents(frame).collect()} == {5, 8}
    # without fingerprints only the sets of 6 and 7 are near
    assert {r.doc_id: r.component_id for r in simhash.similar(frame).collect()} == {5: 5, 6: 6, 7: 6, 8: 8}


def changed(words, places, name):
    return " ".join(f"{name}{k}" if k in places else w for k, w in enumerate(words))


def test_copies_of_one_original_are_one_group(spark):
    rnd = random.Random(10)
    text = [f"o{k}" for k in range(100)]
    rows = [(0, changed(text, rnd.sample(range(100), 2), "x0_")), (2000, " ".join(text))]
    rows += [(i, changed(text, rnd.sample(range(5, 95), 2), f"x{i}_")) for i in range(1, 1500)]
    sets = {i: {tuple(t.split()[k:k + 5]) for k in range(96)} for i, t in rows}
    root = {i for i in sets if len(sets[i] & sets[2000]) >= 0.8 * len(sets[i] | sets[2000])}
    out = {r.doc_id: r.component_id for r in simhash.similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(root) > 1400 and {out[i] for i in root} == {min(root)}


def test_block_edits_are_found(spark):
    rows, cases = [], [(14, 1, 0), (54, 5, 0), (104, 11, 0), (204, 22, 0), (104, 0, 25), (104, 0, 12), (9, 0, 1)]
    for n, (size, last, added) in enumerate(cases * 12):
        words = [f"d{n}_{k}" for k in range(size)]
        rows.append((2 * n, " ".join(words)))
        rows.append((2 * n + 1, changed(words, range(size - last, size), "y") + "".join(f" z{n}_{k}" for k in range(added))))
    out = {r.doc_id: r.component_id for r in simhash.similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [i for i, c in out.items() if c != i - i % 2] == []


@pytest.mark.parametrize("centres", [64, 1])
def test_similar_equals_brute_force(spark, monkeypatch, centres):
    monkeypatch.setattr(simhash, "CENTRES", centres)
    monkeypatch.setattr(simhash, "SMALL_BUCKET", centres)
    monkeypatch.setattr(simhash, "FREQUENT", 2 * centres)
    rnd = random.Random(13)
    line = [f"l{k}" for k in range(20)]
    rows = [(i, " ".join(line + [f"{rnd.choice('ab')}{k}" for k in range(rnd.choice([4, 5, 6]))])) for i in range(150)]
    shingles = {i: {tuple(t.split()[k:k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    want = groups([i for i, _ in rows], lambda a, b: len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b]))
    out = {r.doc_id: r.component_id for r in simhash.similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == want and 1 < len(set(want.values())) < 150


def test_frequent_shingles_of_all_texts_come_last(spark):
    rnd = random.Random(17)
    passage = [f"p{k}" for k in range(40)]
    own = [[f"{i}_{k}" for k in range(60)] for i in range(30)]
    alike = {i: " ".join([f"c{i}"] + passage + [rnd.choice("ab")]) for i in range(100, 120)}  # frequent for the most part
    texts = {i: " ".join(words[:30] + passage + words[30:]) for i, words in enumerate(own)} | alike
    frame = spark.createDataFrame(list(texts.items()), "node long, text string")
    found = {r.node: r for r in simhash._found(frame.union(frame), "frequent").collect()}
    counts = collections.Counter(s for r in found.values() for s in r.prefix)
    assert sorted(found) == sorted(texts) and all(len(r.prefix) == simhash._prefix_size(r.size) for r in found.values())
    assert {counts[s] for i in range(30) for s in found[i].prefix} == {1}  # the passage brings no two of them together
    assert max(counts[s] for i in alike for s in found[i].prefix) > 1


def test_bit_maps_tell_large_sets_apart_and_drop_no_similar_pair(spark):
    rnd = random.Random(19)
    texts, size = {}, [200, 256, 257, 300, 512, 520, 640, 1500]
    for n, most in enumerate(size):
        for k, kept in enumerate((1.0, 0.98, 0.9, 0.82, 0.5)):
            words = [f"w{n}_{j}" for j in range(int(most * kept))]
            for at in rnd.sample(range(len(words)), int(k == 2) + int(k == 3) * 2):
                words[at] = f"x{k}_{at}"
            texts[10 * n + k] = " ".join(words + [f"y{n}_{k}_{j}" for j in range(most - len(words) if k == 4 else 0)])
    shingles = {i: {tuple(t.split()[k:k + 5]) for k in range(len(t.split()) - 4)} for i, t in texts.items()}
    frame = spark.createDataFrame(list(texts.items()), "node long, text string")
    facts = simhash._found(frame, "maps").select("node", F.struct("size", "bits").alias("f"))
    both = facts.toDF("a", "x").join(facts.toDF("b", "y"), F.col("a") < F.col("b"))
    passed = {(r.a, r.b) for r in both.where(simhash._may_be_similar("x", "y")).collect()}
    share = {p: len(shingles[p[0]] & shingles[p[1]]) / len(shingles[p[0]] | shingles[p[1]]) for p in itertools.combinations(sorted(texts), 2)}
    assert {p for p, j in share.items() if j >= 0.8} <= passed and not {p for p, j in share.items() if j < 0.4} & passed
    assert any(j >= 0.8 and len(shingles[p[0]]) > 512 >= len(shingles[p[1]]) for p, j in share.items())


def test_pairs_are_compared_in_parts_and_their_sets_go(spark, monkeypatch):
    from icelens import session
    rnd = random.Random(15)
    line = [f"l{k}" for k in range(20)]
    texts = {i: " ".join(line + [f"{rnd.choice('ab')}{k}" for k in range(rnd.choice([4, 5, 6]))]) for i in range(40)}
    shingles = {i: {tuple(t.split()[k:k + 5]) for k in range(len(t.split()) - 4)} for i, t in texts.items()}
    pairs = list(itertools.combinations(texts, 2))
    want = sorted((a, b) for a, b in pairs if len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b]))
    frames = spark.createDataFrame(pairs, "a long, b long"), spark.createDataFrame(list(texts.items()), "node long, text string")
    for at_once, least in ((10_000, 1), (50, 9)):
        monkeypatch.setattr(simhash, "AT_ONCE", at_once)
        with session.scope(f"compared-{at_once}"):
            assert sorted(map(tuple, simhash._verified(*frames).collect())) == want and 0 < len(want) < len(pairs)
            left = [p.name for p in pathlib.Path(session.shared_folder(spark)).rglob("similar-*")]
        assert len(left) >= least and all(name.startswith("similar-links") for name in left)


def test_decontamination_finds_substituted_passages(spark, messy, empty):
    rnd = random.Random(11)
    items = [(i, prose(rnd, 30, [f"w{k}" for k in range(500)])) for i in range(6)] + [(6, "just seven short words stand right here"), (7, "too short"), (None, None)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    clean = [prose(rnd, 60, [f"v{k}" for k in range(500)]) for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(clean)]
    for i in range(6):
        words = items[i][1].split()
        words[rnd.randrange(30)] = "other"
        rows.append((100 + i, clean[i] + "\n" + " ".join(words).upper() + " . " + clean[i + 1]))
    rows += [(106, "before just seven short words, stand right here! after"), (107, items[0][1][:40]), (108, None), (109, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in decontaminate.flagged(docs, benchmark).collect()}
    assert {d for d, r in out.items() if r.contaminated} == set(range(100, 107))
    assert all(out[100 + i].item_id == i and out[100 + i].matched_words >= 29 for i in range(6)) and out[106].item_id == 6
    assert {r.doc_id for r in decontaminate.clean_documents(docs, benchmark).collect()} == set(out) - set(range(100, 107))
    assert decontaminate.flagged(messy, benchmark).count() == messy.count()
    assert decontaminate.flagged(empty, benchmark).count() == 0 and decontaminate.clean_documents(messy, empty.select("item_id", "text")).count() == messy.count()


def test_decontamination_finds_every_placement(spark):
    items, rows = [], []
    for n in (5, 8, 9, 12, 13, 15):
        item = [f"i{n}x{k}" for k in range(n)]
        items.append((n, " ".join(item)))
        width = min(n, decontaminate.WINDOW)
        most = width - -(-width * decontaminate.MATCHES // decontaminate.WINDOW)
        for start in range(n - width + 1):
            for differ in itertools.combinations(range(width), most):
                words = ["other" if k in differ else w for k, w in enumerate(item[start:start + width])]
                rows.append((len(rows), n, " ".join(["before", *words, "after"])))
                rows.append((len(rows), n, " ".join(words).strip("other ")))  # what differs at the ends is not there
    docs = spark.createDataFrame(rows, "doc_id long, n long, text string")
    out = decontaminate.flagged(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert len(out) == len(rows) and [r for r in out if r.item_id != r.n] == []


def test_shuffled_index_finds_the_same(spark, monkeypatch):
    rnd = random.Random(12)
    benchmark = spark.createDataFrame([(0, prose(rnd, 30))], "item_id long, text string")
    docs = benchmark.select(F.lit(5).alias("doc_id"), F.concat(F.lit("start "), "text").alias("text"))
    want = decontaminate.overlaps(docs, benchmark).collect()
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert decontaminate.overlaps(docs, benchmark).collect() == want and len(want) == 1


def test_targets_share_the_excess():
    sizes = [10, 1000, 50, 400, 0, 3]
    got = mixture.targets(sizes)
    assert sum(got) == pytest.approx(1.5 * sum(sizes)) and all(t <= 2 * s + 1e-9 for t, s in zip(got, sizes))
    free = [(t, w) for t, s, w in zip(got, sizes, [5, 2, 1, 5, 2, 1]) if t < 2 * s - 1e-9]
    assert len({round(t / w, 6) for t, w in free}) <= 1


def test_permutation_is_one():
    for size in (1, 2, 3, 17, 64, 1000):
        got = mixture.permuted(np.arange(size), size, 77)
        assert sorted(got.tolist()) == list(range(size))
    assert mixture.permuted(np.arange(1000), 1000, 1).tolist() != mixture.permuted(np.arange(1000), 1000, 2).tolist()


def test_mixture(spark, messy, empty, monkeypatch):
    monkeypatch.setattr(mixture, "BLOCK", 8)
    monkeypatch.setattr(mixture, "SLOTS", 64)
    out = mixture.counts(messy).collect()
    rows = messy.select("doc_id", "text", "source").collect()
    assert len(out) == len(rows)
    key = lambda p: ((p[0] is None, p[0] or 0), p[1])
    assert sorted(((r.doc_id, r.size) for r in out), key=key) == sorted(((d, len(lower(t))) for d, t, _ in rows), key=key)
    assert all(0 <= r.taken <= 2 * r.size for r in out)
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len(lower(t))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = {(sizes[s], round(t, 6)) for s, t in zip(order, mixture.targets([sizes[s] for s in order]))}
    assert {(r.source_size, round(r.target, 6)) for r in out} == want
    taken = collections.Counter()
    for r in out:
        taken[r.source_size, round(r.target, 6)] += r.taken
    assert all(abs(taken[k] - k[1]) <= max(24, 0.02 * k[1]) for k in want)
    assert sorted(map(str, mixture.counts(messy).collect())) == sorted(map(str, out))
    texts = mixture.mixed(messy)
    assert texts.columns == messy.columns
    assert sum(len(lower(r.text)) for r in texts.collect()) == sum(r.taken for r in out)
    assert mixture.counts(empty).count() == 0 and mixture.mixed(empty).count() == 0


def test_packing_round_trip():
    rnd = np.random.default_rng(3)
    runs = [(rnd.integers(0, 2, n) * rnd.integers(0, 1 << 32, n) >> rnd.integers(0, 32, n)).astype(np.uint32) for n in (0, 1, 3, 4, 0, 5, 1000, 0)]
    cuts = np.concatenate([[0], np.cumsum([len(r) for r in runs])])
    for run, control, data in zip(runs, *tokenbin.pack(np.concatenate(runs), cuts), strict=True):
        assert len(control) == -(-len(run) // 4) and tokenbin.unpack(control, data, np.array([len(run)])).tolist() == run.tolist()
    packed = tokenbin.pack(np.concatenate(runs), cuts)
    assert tokenbin.unpack(*map(b"".join, packed), np.diff(cuts)).tolist() == np.concatenate(runs).tolist()


def test_encoder_equals_the_library():
    from tokenizers import Tokenizer
    path = tokenizer_file("byte_bpe_50k.json")
    whole, encoder, rnd = Tokenizer.from_file(path), tokenbin.Encoder(path), random.Random(8)
    parts = ["a", "The", " ", " ", " ", "  ", "\n", "'s", "12", "é", "!", "<|endoftext|>", "\t", "\x1c", "漢", "\r\n", "🙂", " ", "᠎"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 30))) for _ in range(3000)]
    for i in range(0, 3000, 100):
        ids, cuts = encoder.encode(pa.array(["", *texts[i:i + 100]]).slice(1))
        for text, a, b in zip(texts[i:i + 100], cuts, cuts[1:]):
            assert ids[a:b].tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


def test_token_files_round_trip(messy, empty):
    from tokenizers import Tokenizer
    path = tokenizer_file("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    got = sorted(map(tuple, tokenbin.written(messy, path).collect()), key=lambda r: r[1])
    assert [g[0] for g in got] == sorted((r.doc_id for r in messy.collect()), key=lambda d: (d is None, d or 0))
    at = 0
    for doc, start, n, ids, crc in got:
        assert (start, n * 4, zlib.crc32(ids)) == (at, len(ids), crc)
        at += n
    want = collections.Counter((r.doc_id, tuple(whole.encode(r.text or "", add_special_tokens=False).ids) + (tokenbin.END,)) for r in messy.collect())
    assert collections.Counter((doc, tuple(np.frombuffer(ids, "<u4").tolist())) for doc, _, _, ids, _ in got) == want
    assert tokenbin.written(empty, path).count() == 0


def test_archives_round_trip(spark):
    big, small = "é" * 3000, "y" * 999
    pages = [(1, "http://a", big), (2, None, big), (3, "http://c\r\nX: y", None), (None, "n", big), (4, "d", small), (5, "e", small), (6, "f", ""), (6, "f", ""), (7, "g", "z" * 1000)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit(0))
    manifest = warc.write(warc.chunks(frame, chunk=100), new_folder(spark, "warc"))
    rows = warc.read(manifest).collect()
    assert max(len(r.data) for r in rows) <= warc.CHUNK
    ends = [r for r in rows if r["last"]]
    html = {p: (h or "").encode() for p, _, h in pages}
    assert collections.Counter((r.page_id, r.so_far) for r in ends) == collections.Counter((p, len((h or "").encode())) for p, _, h in pages)
    kinds = {r.page_id: (r.record_type, r.refers_to) for r in ends}
    assert kinds == {1: ("revisit", 2), 2: ("response", None), None: ("revisit", 2), **{k: ("response", None) for k in (3, 4, 5, 6, 7)}}
    for page in (2, 4, 7):
        assert b"".join(r.data for r in sorted((r for r in rows if r.page_id == page), key=lambda r: r.chunk_no)) == html[page]
    assert warc.archived(frame.limit(0)).count() == 0


def test_damaged_archive_is_noticed(tmp_path):
    import io
    data = warc.head(1, "u", "0" * 40, 5, None) + b"hello\r\n\r\n"
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(data)))


def test_chunks_carry_the_digest(tmp_path):
    import hashlib
    import io
    payload = bytes(range(256)) * 10
    data = warc.head(1, "u", hashlib.sha1(payload).hexdigest(), len(payload), None) + payload + b"\r\n\r\n"
    rows = list(warc.records(io.BytesIO(data * 2), chunk=1000))
    assert [r["so_far"] for r in rows] == [1000, 2000, 2560] * 2
    assert rows[1]["digest"] == hashlib.sha1(payload[:2000]).hexdigest()


def test_pipeline_keeps_clean_documents(spark, tmp_path):
    import corpus_pipeline
    rnd = random.Random(21)
    word = lambda: "".join(rnd.choice("bcdfglmnprst") + rnd.choice("aeiou") for _ in range(rnd.randint(1, 4)))
    texts = [" ".join(word() for _ in range(60)) for _ in range(40)]
    item = " ".join(word() for _ in range(30))
    near = texts[0].split()
    near[30] = "changed"
    rows = [(i, t) for i, t in enumerate(texts)] + [(100, texts[0]), (101, " ".join(near)), (102, texts[1] + " " + item), (103, "%%% ||| " * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept, frame = [], docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, frame, str(tmp_path)).write.parquet(str(tmp_path / name))
        frame = spark.read.parquet(str(tmp_path / name))
        if name != "token files":
            assert frame.columns == docs.columns
        kept.append({r.doc_id for r in frame.collect()})
    clean = set(range(40))
    assert kept[0] == clean | {100, 101, 102} and kept[1] == clean | {102} and kept[2] == clean
    assert kept[3] <= clean and kept[4] == kept[3]


@pytest.mark.parametrize("which", ["messy", "empty"])
def test_pipeline_of_messy_rows(spark, tmp_path, messy, empty, which):
    """Null and repeated rows, odd texts, and columns with dots and with names that stages use themselves."""
    import corpus_pipeline
    odd = ["a.b", "_n", "_node", "_picked", "_found", "_words", "_text", "_count", "_best", "_taken", "_parts", "node", "pick", "size", "words"]
    docs = {"messy": messy, "empty": empty}[which]
    docs = docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(odd)])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    item = messy.where("doc_id = 2").select("text").first().text
    spark.createDataFrame([(0, item), (1, None), (None, ""), (2, "one")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    frame = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, frame, str(tmp_path)).write.parquet(str(tmp_path / name))
        frame = spark.read.parquet(str(tmp_path / name))
        rows = frame.collect()
        if name != "token files":
            assert frame.columns == docs.columns
            assert all(r[c] == i for r in rows for i, c in enumerate(odd))
        if which == "empty":
            assert rows == []
    if which == "messy":
        assert rows and 2 not in {r.doc_id for r in rows}
