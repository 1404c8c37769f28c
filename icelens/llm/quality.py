"""Quality rules as weak supervision, in DataFrame expressions only.

Each rule votes good (1) or bad (0) or abstains (-1), and is right with an unknown rate. A text is good or bad in one of
a few kinds (a table of symbols fails other rules than a text that repeats itself; a single bad class would learn only
the more frequent kind). Expectation-maximisation over the counts of the vote patterns finds P(rule votes 1 | class) and
the share of each class, and a text is kept by its posterior probability of being good rather than by passing all rules. There are at most 3 ** rules patterns,
so the fit works on a bounded table however many texts there are; texts are read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icelens.llm.common import SPACES, text_of, with_outputs, words_of
from icelens.session import settle

WINDOW = 5
ROUNDS = 40
#: Where the search starts: the share of good texts, and P(rule votes 1) for good texts, for bad texts by the rules of
#: their own kind, and by the others.
START_GOOD, START_RATE, START_OWN, START_OTHER = 0.8, 0.98, 0.3, 0.9
#: Kinds of bad text, by the places in rules() of those that look for it: symbols, repetition, shouting.
KINDS = [(0, 7), (1, 2, 5), (3, 4)]
KEEP_FROM = 0.5

FEATURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letters", "n_capitals",
            "n_shouts", "n_distinct", "n_clean"]


def _count(text: Column, other: str) -> Column:
    """Code points left when all runs of ``other`` are removed."""
    return F.length(F.regexp_replace(text, other, "")).cast("long")


def features(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the counts of FEATURES (long) added.

    n_clean: words with a letter and without any of #*$%&|<>. n_repeat_words: words in windows of five words that occur twice or more in the text, the first included; windows are
    compared by 64-bit hash within one text. A null or empty text has zero everywhere.
    """
    whole = text_of(text)
    df = with_outputs(df, _text=whole, _words=words_of(whole),
                      _lines=F.filter(F.split(whole, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]")))
    n = F.size("_words")
    spots = F.when(n >= WINDOW, F.sequence(F.lit(0), n - WINDOW)).otherwise(F.array().cast("array<int>"))
    df = df.withColumn("_hashes", F.transform(
        spots, lambda i: F.xxhash64(*[F.get(F.col("_words"), i + k) for k in range(WINDOW)])))
    repeated = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    df = df.withColumn("_sorted", F.when(repeated, F.sort_array(
        F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    near = lambda k: F.coalesce(F.get(F.col("_sorted"), k)["h"], F.lit(None))
    df = df.withColumn("_starts", F.sort_array(F.transform(
        F.filter("_sorted", lambda e, k: F.coalesce(e["h"] == near(k + 1), F.lit(False))
                 | F.when(k > 0, e["h"] == near(F.greatest(k - 1, F.lit(0)))).otherwise(False)), lambda e: e["i"])))
    covered = F.aggregate(F.transform("_starts", lambda p, k: F.least(
        F.lit(WINDOW), F.coalesce(F.get(F.col("_starts"), k + 1), p + WINDOW) - p)), F.lit(0), lambda a, b: a + b)
    outputs = {
        "n_words": n.cast("long"),
        "word_chars": _count(F.col("_text"), SPACES),
        "n_symbols": _count(F.col("_text"), "[^#*$%&|<>]+"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
        "n_letters": _count(F.col("_text"), "\\P{L}+"),
        "n_capitals": _count(F.col("_text"), "\\P{Lu}+"),
        "n_shouts": ((F.length("_text") - F.length(F.replace(F.col("_text"), F.lit("!!"), F.lit("")))) / 2).cast("long"),
        "n_distinct": F.size(F.array_distinct("_words")).cast("long"),
        "n_clean": F.size(F.filter("_words", lambda w: w.rlike("^[^#*$%&|<>]*\\p{L}[^#*$%&|<>]*$"))).cast("long"),
    }
    return with_outputs(df, **outputs).drop("_text", "_words", "_lines", "_hashes", "_sorted", "_starts")


def _vote(value: Column, good: Column, bad: Column) -> Column:
    return F.when(value.isNull(), -1).when(bad, 0).when(good, 1).otherwise(-1)


def rules() -> list[Column]:
    """The votes, as expressions over FEATURES: 1 good, 0 bad, -1 no opinion (also where a share has no base)."""
    def share(part: str, base: str) -> Column:
        return F.when(F.col(base) > 0, F.col(part) / F.col(base))
    symbols, repeats, lines = share("n_symbols", "word_chars"), share("n_repeat_words", "n_words"), share("n_dup_lines", "n_lines")
    capitals, shouts, variety = share("n_capitals", "n_letters"), share("n_shouts", "n_words"), share("n_distinct", "n_words")
    length, clean = share("word_chars", "n_words"), share("n_clean", "n_words")
    return [
        _vote(symbols, symbols < 0.02, symbols > 0.08),
        _vote(repeats, repeats < 0.1, repeats > 0.2),
        _vote(lines, lines < 0.1, lines > 0.3),
        _vote(capitals, capitals < 0.15, capitals > 0.3),
        _vote(shouts, shouts < 0.02, shouts > 0.1),
        _vote(variety, variety > 0.4, variety < 0.15),
        _vote(length, length.between(3, 9), (length < 2) | (length > 14)),
        _vote(clean, clean > 0.85, clean < 0.7),
    ]


def _weights(votes: Column, state: Column) -> Column:
    """P(class | votes) per class; the first class is the good one."""
    logs = F.transform(state["share"], lambda share, k: F.aggregate(
        F.transform(votes, lambda v, j: F.when(v == 1, F.log(F.get(F.get(state["rate"], k), j)))
                    .when(v == 0, F.log(1 - F.get(F.get(state["rate"], k), j))).otherwise(0.0)),
        F.log(share), lambda a, b: a + b))
    return F.transform(F.array(logs), lambda of: F.transform(  # a one-item array names a value that is used twice
        F.array(F.transform(of, lambda x: F.exp(x - F.array_max(of)))),
        lambda e: F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b)))[0])[0]


def fit(votes: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(votes, posterior, share, rate) per vote pattern, from a frame with one ``votes`` array of rules() per text.

    The patterns, at most 3 ** rules, meet in one row; all rounds run inside one expression there. Counts get one
    imaginary vote each way, so a rule that never votes, or always the same way, keeps a finite weight.
    """
    n_rules = len(rules())
    ids = F.sequence(F.lit(0), F.lit(n_rules - 1))

    def total(items: Column, value) -> Column:
        return F.aggregate(F.transform(items, value), F.lit(0.0), lambda a, b: a + b)

    def step(state: Column, _: Column) -> Column:
        weighed = F.transform("patterns", lambda p: F.struct(
            p["votes"].alias("votes"), p["n"].cast("double").alias("n"), _weights(p["votes"], state).alias("p")))
        classes = F.sequence(F.lit(0), F.lit(len(KINDS)))

        def rate(w: Column, k: Column, j: Column) -> Column:
            ones = total(w, lambda x: F.when(F.get(x["votes"], j) == 1, x["n"] * F.get(x["p"], k)).otherwise(0.0))
            voted = total(w, lambda x: F.when(F.get(x["votes"], j) >= 0, x["n"] * F.get(x["p"], k)).otherwise(0.0))
            return (ones + 1) / (voted + 2)

        return F.transform(F.array(weighed), lambda w: F.struct(
            F.transform(classes, lambda k: (total(w, lambda x: x["n"] * F.get(x["p"], k)) + 1)
                        / (total(w, lambda x: x["n"]) + len(KINDS) + 1)).alias("share"),
            F.transform(classes, lambda k: F.transform(ids, lambda j: rate(w, k, j))).alias("rate")))[0]

    start = F.struct(
        F.array(F.lit(START_GOOD), *[F.lit((1 - START_GOOD) / len(KINDS)) for _ in KINDS]).alias("share"),
        F.array(F.array_repeat(F.lit(START_RATE), n_rules), *[
            F.array(*[F.lit(START_OWN if j in kind else START_OTHER) for j in range(n_rules)]) for kind in KINDS]).alias("rate"))
    one = (votes.groupBy("votes").agg(F.count("*").alias("n"))
           .agg(F.sort_array(F.collect_list(F.struct("votes", "n"))).alias("patterns")))
    fitted = one.select("patterns", F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step).alias("state"))
    return (fitted.select(F.explode("patterns").alias("p"), "state")
            .select(F.col("p.votes").alias("votes"), _weights(F.col("p.votes"), F.col("state"))[0].alias("posterior"),
                    "state.share", "state.rate"))


def score(df: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``df`` (all its columns, one row for each of its rows) with FEATURES, votes (array<int>), base_failed, posterior
    (double) and kept (boolean: not base_failed and posterior at least KEEP_FROM) added, without the text unless ``keep_text``.

    base_failed: fewer than ten words, or over a fifth of them in repeated windows; so an empty or null text is not kept.
    """
    scored = features(df, text)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    scored = with_outputs(scored, votes=F.array(*rules()), base_failed=failed)
    scored = settle(scored if keep_text else scored.drop(text), "quality")
    model = fit(scored.select("votes")).select(F.col("votes").alias("_votes"), F.col("posterior").alias("_posterior"))
    joined = scored.join(F.broadcast(model), F.col("votes") == F.col("_votes"), "left")  # at most 3 ** 8 rows
    return with_outputs(joined, posterior=F.col("_posterior"),
                        kept=~F.col("base_failed") & (F.col("_posterior") >= KEEP_FROM)).drop("_votes", "_posterior")


def kept_documents(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``df`` that are kept, with the columns of ``df``."""
    # whole rows in one column: inputs named like a feature come back unchanged
    packed = df.select(F.col(f"`{text}`").alias("text"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))
    return score(packed).where("kept").select("_row.*")
