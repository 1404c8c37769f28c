import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, Taken int, item_id string, key string"


def prose(rnd, n, words="alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu".split()):
    return " ".join(rnd.choice(words) + rnd.choice(["", "s", "ing", "ed", "ous", "ly"]) for _ in range(n))


@pytest.fixture(scope="session")
def messy(spark):
    """Null, empty, blank, very long, repeated and near-equal texts, null ids and sources, columns with the names of outputs."""
    rnd = random.Random(4)
    base = [prose(rnd, rnd.randint(12, 80)) for _ in range(25)]
    texts = base + [base[0], base[0].upper(), base[1] + "  \t" + "end", None, "", " \n\t ", "one", "Two words", prose(rnd, 30000), "x" * 50000,
                    "ÄÖ ÿ 漢字 🙂 #### || $$", "a\nb\na\nb\na\n", "same words again here now " * 20]
    rows = [(i, t, rnd.choice(["en", "de", None]), rnd.choice(["b", "a", "é", None]), None if t is None else len(t), "w", 7, "i", "k") for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, base[4], None, None, 1, None, None, None, None), (None,) * 9]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
