"""Quality rules, secrets, languages, token counts, language model: one result per row."""

import collections
import hashlib
import math
import random
import re
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from icelens.llm import language, language_model, piece_counts, quality, secret_scan
from icelens.llm.queries import tokenizer_file

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_quality_counts_equal_brute_force(messy):
    out = quality.score(messy).collect()
    assert len(out) == messy.count()
    for r in out:
        want = base_counts(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)
    assert quality.kept_documents(messy).columns == messy.columns


def test_quality_fit_equals_plain_em(spark):
    rnd = random.Random(1)
    votes = [[rnd.choice([1, 1, 1, 0, -1]) for _ in quality.rules()] for _ in range(60)]
    got = {tuple(r.votes): r.posterior for r in quality.fit(spark.createDataFrame([(v,) for v in votes], "votes array<int>")).collect()}
    counts = collections.Counter(map(tuple, votes))
    kinds, n = quality.KINDS, len(quality.rules())
    share = [quality.START_GOOD] + [(1 - quality.START_GOOD) / len(kinds)] * len(kinds)
    rate = [[quality.START_RATE] * n] + [[quality.START_OWN if j in k else quality.START_OTHER for j in range(n)] for k in kinds]

    def weights(v):
        logs = [math.log(s) + sum(math.log(r[j]) if x == 1 else math.log(1 - r[j]) for j, x in enumerate(v) if x >= 0) for s, r in zip(share, rate)]
        e = [math.exp(x - max(logs)) for x in logs]
        return [x / sum(e) for x in e]

    for _ in range(quality.ROUNDS):
        w = {v: weights(v) for v in counts}
        share = [(sum(c * w[v][k] for v, c in counts.items()) + 1) / (len(votes) + len(kinds) + 1) for k in range(len(kinds) + 1)]
        rate = [[(sum(c * w[v][k] for v, c in counts.items() if v[j] == 1) + 1) / (sum(c * w[v][k] for v, c in counts.items() if v[j] >= 0) + 2)
                 for j in range(n)] for k in range(len(kinds) + 1)]
    assert got == pytest.approx({v: weights(v)[0] for v in counts}, abs=1e-9)


def test_quality_of_nothing(empty):
    assert quality.score(empty).collect() == [] and quality.kept_documents(empty).columns == empty.columns


def test_quality_drops_junk_and_keeps_prose(spark):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(3, 8)))
    good = [" ".join(word() for _ in range(100)) for _ in range(150)]
    junk = [" ".join(word() + "%%%" for _ in range(100)) for _ in range(8)] + [" | ".join(word() for _ in range(60)) for _ in range(8)]
    rows = [(i, t) for i, t in enumerate(good + junk)]
    kept = {r.doc_id for r in quality.kept_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == set(range(150))


SECRETS = ["password = 'abcdefghijklmno' then", 'API_KEY:"short"', "x" * 5 + "AKIA" + "A1" * 10, "AKIAQ", "0123456789abcdef0 ABCDEF",
           "Token=token=tokentokentoken secret :  deadbeefdeadbeef", "gh" + "p_" + "a1" * 20, "passwordpasswd=aaaaaaaaaaaa", "é🙂 apikey=AAAAAAAAAAAAAAAAAA", None, ""]


def test_secrets_equal_brute_force(spark):
    rnd = random.Random(7)
    parts = [s for s in SECRETS if s] + ["secret", "Token", "=", ":", "'", " ", "abc123def456", "AKIA", "9" * 20, "key", "ſecret=abcdefghijklmn"]
    texts = SECRETS + ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 8))) for _ in range(300)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("spans", F.lit(1))
    kinds = [("assign", r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
             ("access", "AKIA[A-Z0-9]+", 0, 18), ("hex", "[0-9a-f]+", 0, 16)]
    for r in secret_scan.summary(frame).collect():
        found = sorted((m.start(), k, f"{kind}:{m.start()}:{m.end()}") for k, (kind, p, g, least) in enumerate(kinds)
                       for m in re.finditer(p, texts[r.doc_id] or "") if len(m[g]) >= least)
        assert r.base_sha256 == hashlib.sha256(",".join(x for _, _, x in found).encode()).hexdigest()
        assert set(x for _, _, x in found) <= set(r.spans.split(","))
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == i for _, k, _ in found) for i in range(3))


def test_trigram_query_never_loses_a_match():
    rnd = random.Random(2)
    texts = [s for s in SECRETS if s] + ["AIza" + "x" * 35, "sk_live_" + "a" * 20, "-----BEGIN EC PRIVATE KEY", "http://u:pass@h", "xoxb-1234567890"]
    texts = ["".join(rnd.sample(texts, 3)) for _ in range(60)]
    for rule in secret_scan.BASE + secret_scan.MORE:
        query = secret_scan.trigram_query(rule.pattern)
        postings = secret_scan.index(texts, sorted(secret_scan._trigrams(query)))
        hits = set(secret_scan._matching(query, postings, len(texts)).tolist())
        assert {i for i, t in enumerate(texts) if re.search(rule.pattern, t)} <= hits


def test_secrets_of_messy_rows(messy, empty):
    out = secret_scan.summary(messy)
    assert out.count() == messy.count() and secret_scan.summary(empty).count() == 0


def test_language_held_out_accuracy(spark):
    rnd = random.Random(5)
    syllables = {"x": ["ka", "ti", "mo", "ra"], "y": ["sch", "en", "ung", "ver"], "z": ["eau", "oi", "tre", "qu"]}
    rows = []
    for i in range(300):
        lang = rnd.choice("xyz")
        rows.append((i, " ".join("".join(rnd.choices(syllables[lang], k=3)) for _ in range(25)), lang))
    rows += [(300, None, "x"), (301, "123 !!", "y"), (302, "", None)]
    out = language.identified(spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("s"))).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert all(r.lang_pred == r.lang for r in out if r.doc_id < 300)
    assert {(r.lang_pred, r.score) for r in out if r.doc_id >= 300} == {("und", 0.0)}
    assert all(0 <= r.score <= 1 for r in out)


def test_language_blocks_change_nothing(spark, messy, empty, monkeypatch):
    rows = [(i, t * 9, l) for i, (t, l) in enumerate([("kati mora ", "c"), ("schen ung ", "a"), ("eau tre qui ", "b"), ("kati mora ", "a0")] * 6)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    whole = sorted(map(tuple, language.identified(frame).collect()))
    monkeypatch.setattr(language, "LANGUAGES_AT_ONCE", 1)
    assert sorted(map(tuple, language.identified(frame).collect())) == whole
    monkeypatch.undo()
    assert language.identified(messy).count() == messy.count() and language.identified(empty).count() == 0
    unlearned = language.identified(frame.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in unlearned} == {("und", 0.0)}


def test_pieces_equal_the_tokenizers_library():
    from tokenizers import Tokenizer, models, normalizers
    rnd = random.Random(6)
    for path in (None, tokenizer_file("piece_bpe_32k.model")):
        # few pieces with many equal scores: ties everywhere
        pieces = piece_counts.vocabulary(path) if path else [("▁", -2.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("ba", -2.0), ("aba", -3.0), ("▁a", -3.0), ("b▁", -3.0)]
        spare = [("<unk>", min(s for _, s in pieces))] + [(f"<0x{i:02X}>", min(s for _, s in pieces)) for i in range(256)]
        whole = Tokenizer(models.Unigram(spare + pieces, unk_id=0, byte_fallback=True))
        whole.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
        counter = piece_counts.Counter(pieces)
        for _ in range(1500):
            text = "".join(rnd.choice(["a", "b", " ", "  ", "ab", "\n", "é", "🙂", "▁", "the"]) for _ in range(rnd.randint(0, 25)))
            assert counter.count(text)[0] == len(whole.encode(text, add_special_tokens=False).ids), text


def test_pieces_of_messy_rows(messy, empty):
    out = piece_counts.counted(messy.withColumn("n_tokens", F.lit("x")), [("▁", -1.0), ("a", -1.0)])
    assert out.count() == messy.count() and out.where("text is null or text = ''").agg(F.max("n_tokens")).first()[0] == 0
    assert piece_counts.counted(empty, []).count() == 0


@pytest.mark.parametrize("common", [1_000_000, 20])
def test_language_model_base_and_gain(spark, messy, monkeypatch, common):
    monkeypatch.setattr(language_model, "SYMBOLS", 15)
    monkeypatch.setattr(language_model, "COMMON", common)
    rows = messy.select("doc_id", "text").collect()
    out = language_model.held_out_scores(messy).collect()
    assert len(out) == len(rows)
    words = lambda t: (t or "").encode().lower().split()
    counts, ends = collections.Counter(), 0
    for d, t in rows:
        if zlib.crc32(("" if d is None else str(d)).encode()) % 10:
            counts.update(words(t))
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + 1
    log = lambda c: math.log10((c + 0.1) / (n + 0.1 * (v + 1)))
    want = sorted(((d is None, d or 0), len(words(t)) + 1, 1 + sum(counts[w] > 0 for w in words(t)),
                   round(log(ends) + sum(log(counts[w]) for w in words(t)), 6)) for d, t in rows)
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in out) == want
    assert {r.train_tokens for r in out} == {n} and all(r.score < 0 for r in out)


def test_language_model_tasks_hold_a_bounded_number_of_words(spark, monkeypatch):
    known = language_model.Hashes()
    for k in range(250_000):
        known[b"w%d" % k]
    assert len(known) <= 200_000
    assert known[b"w1"] == xxhash.xxh64_intdigest(b"w1", 42)
    monkeypatch.setattr(language_model, "WORDS_HELD", 7)
    texts = spark.createDataFrame([(f"a w{k} b w{k % 5}",) for k in range(40)], "text string").coalesce(1)
    counts = {bytes(r.word): r.c for r in language_model.word_counts(texts).collect()}
    assert counts == {b"a": 40, b"b": 40} | {b"w%d" % k: 1 + 8 * (k < 5) for k in range(40)}


def test_language_model_learns_contexts(spark):
    rnd = random.Random(13)
    follows = {w: rnd.sample("abcdefghij", 2) for w in "abcdefghij"}
    rows = []
    for i in range(200):
        words = ["a"]
        while len(words) < 40:
            words.append(rnd.choice(follows[words[-1]]))
        rows.append((i, " ".join(words)))
    out = language_model.held_out_scores(spark.createDataFrame(rows, "doc_id long, text string")).where("held_out").collect()
    per_token = 10 ** (-sum(r.score for r in out) / sum(r.n_tokens for r in out))
    assert out and per_token < 2.5 < 5 < 10 ** (-sum(r.base_score for r in out) / sum(r.n_tokens for r in out))


def test_language_model_probabilities_sum_to_one(spark, messy, monkeypatch):
    monkeypatch.setattr(language_model, "SYMBOLS", 15)
    import numpy as np
    model, _, _ = language_model.learned(messy.select(F.coalesce("text", F.lit("")).alias("text")))
    n = len(model.symbols) + 2
    for context in range(n):
        assert language_model.chances(model, np.full(n, context), np.arange(n)).sum() == pytest.approx(1)


def test_language_model_learns_pairs_of_words_that_are_no_symbols(spark, monkeypatch):
    monkeypatch.setattr(language_model, "SYMBOLS", 2)
    rnd = random.Random(14)
    follows = {w: rnd.sample("abcdefghij", 2) for w in "abcdefghij"}
    rows = []
    for i in range(200):
        words = ["a"]
        while len(words) < 40:
            words.append(rnd.choice(follows[words[-1]]))
        rows.append((i, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    out = language_model.held_out_scores(frame).where("held_out").collect()
    assert out and 10 ** (-sum(r.score for r in out) / sum(r.n_tokens for r in out)) < 2.5
    # copies of a text score as the text does
    train = frame.where("doc_id < 100")
    twice = language_model.scored(frame.union(frame.where("doc_id < 20")), train).collect()
    assert len(twice) == 220 and all(len({round(r.score, 9) for r in twice if r.doc_id == i}) == 1 for i in range(20))


def test_language_model_probabilities_of_all_words_sum_to_one(spark, messy, monkeypatch):
    monkeypatch.setattr(language_model, "SYMBOLS", 6)
    import numpy as np
    model, tables, unknown = language_model.learned(messy.select(F.coalesce("text", F.lit("")).alias("text")))
    hashed = lambda w: np.array([language_model.xxhash.xxh64_intdigest(w, 42) if w else 0], dtype=np.uint64)
    lifts = {r.key: r.lift for part in tables.lifts for r in part.collect()}
    others = {bytes(r.word): r for r in tables.others.collect()}
    symbols = {b"": 0, **model.symbols}
    chance = lambda c, s: float(language_model.chances(model, np.array([c]), np.array([s]))[0])
    assert len(others) > 20 and len(lifts) > 100
    for u in [*symbols, *others]:
        c, left = symbols.get(u, 1), 10 ** model.turned[symbols[u]] if u in symbols else others[u].left
        lifted = lambda w: 10 ** lifts.get(int(language_model.pair_keys(hashed(u), hashed(w)).view(np.int64)[0]), 0.0)  # noqa: B023, E731
        of_others = sum(others[w].p * lifted(w) for w in others) + unknown
        some = sum(chance(c, s) * (1.0 if u in symbols else lifted(w) * left) for w, s in symbols.items())
        assert some + chance(c, 1) * left * of_others == pytest.approx(1), u


def test_language_model_of_nothing(empty):
    assert language_model.held_out_scores(empty).count() == 0
