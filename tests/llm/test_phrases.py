"""Phrase collocations against brute force."""

import collections
import random
import re

import pytest

from icelens.llm import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, top):
    """All phrase counts by one loop over all windows of all lengths, then the rules one after the other."""
    f, total = collections.Counter(), collections.Counter()
    for text, lang in rows:
        for piece in re.split("[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = [x for x in re.split("[\x20\x09]+", piece) if x]
            total[lang or "und"] += len(w)
            for k in (1, 2, 3):
                f.update((lang or "und", *w[i:i + k]) for i in range(len(w) - k + 1))
    found = {}
    for key, a in f.items():
        lang, *w = key
        if len(w) < 2 or a < least:
            continue
        cuts = [(10 ** 6 * a * a // (f[lang, *w[:k]] * f[lang, *w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        found[key] = (a, f[lang, *w[:k]], f[lang, *w[k:]], score)
    out = collections.defaultdict(list)
    for (lang, *w), (a, left, right, score) in found.items():
        covered = any(len(o) - 1 > len(w) and o[0] == lang and 100 * found[o][0] >= 50 * a
                      and any(list(o[1 + i:1 + i + len(w)]) == w for i in range(len(o) - len(w))) for o in found) if len(w) == 2 else False
        if not covered:
            out[lang].append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, rank, p.decode(), -a, left, right, total[lang], -s) for lang, items in out.items()
                  for rank, (s, a, p, left, right) in enumerate(sorted(items)[:top], 1))


def got(df, **settings):
    return sorted(map(tuple, collocations.collocations(df, **settings).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def sample(seed, n=150):
    rnd = random.Random(seed)
    words = ["a", "b", "C", "dé", "漢", "\x01", "b\x00", "e f", "Ä", *("rare%d" % i for i in range(400))]
    odds = [30, 20, 12, 9, 7, 3, 3, 3, 3] + [0.2] * 400
    ends = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r", "!?"]
    rows = []
    for _ in range(n):
        text = "".join(w + rnd.choice(ends) for w in rnd.choices(words, odds, k=rnd.randint(0, 60)))
        rows.append((text, rnd.choice(["en", "en", "de", None, "und"])))
    return rows


@pytest.mark.parametrize("chunk", [8_000_000, 40])
def test_collocations_equal_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(collocations, "CHUNK", chunk)
    monkeypatch.setattr(collocations, "ROWS", 7)
    rows = sample(chunk % 97) + [(None, "en"), ("", "en"), (" \n\t", None), (None, None), ("...", "fr")]
    rows += rows[:20]
    df = spark.createDataFrame([(t, lang, "x", 1, "y") for t, lang in rows], "text string, lang string, `a.b` string, N int, _words string").repartition(5)
    for least, top in ((10, 2000), (3, 25)):
        assert got(df, least=least, top=top) == plain(rows, least, top)


def test_small_batches_carry_runs(spark):
    """A head that goes on over many batches, with frequent and rare third words."""
    rows = [(("x y " + ("z%d" % (i % 40)) + ". ") * (1 + i % 3), "en") for i in range(400)] + [("q r. " * 30, "en")]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(8)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert got(df) == plain(rows, 10, 2000)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_scores_past_64_bits(spark):
    df = spark.createDataFrame([(3 * 10 ** 14, 4 * 10 ** 14, 10 ** 15)], "a long, l long, r long")
    score = df.select(collocations._score(df.a, df.l, df.r)).first()[0]
    assert score == 10 ** 6 * 9 * 10 ** 28 // (4 * 10 ** 29)


def test_collocations_of_messy_rows(messy, empty):
    rows = messy.select("text", "lang").collect()
    assert got(messy, least=2) == plain(rows, 2, 2000)
    assert got(empty) == []


def test_one_very_long_piece(spark):
    text = " ".join(random.Random(1).choices("abcdefgh", k=60_000))
    df = spark.createDataFrame([(text, "en")], "text string, lang string")
    assert got(df) == plain([(text, "en")], 10, 2000)
