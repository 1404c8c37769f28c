"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. A letter n-gram is the product of its letters'
vectors, each rotated by its place, and a text is the sum of its n-grams. The sum over all training texts of a language is
its prototype; a text gets the language whose prototype has the largest cosine with it. Sums are of whole numbers, so
neither the order of rows nor a repeated task changes a prototype.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icelens.llm.common import remainder, text_of, with_outputs
from icelens.session import settle

SIZE, GRAM, SEED = 1024, 3, 5
#: n-gram vectors a task remembers (1 KB each); languages whose sums a task holds, or whose prototypes are compared in one
#: pass over the texts. More languages take more passes.
CACHED, LANGUAGES_AT_ONCE = 40_000, 256
UNKNOWN = "und"


class Vectors:
    def __init__(self):
        self.letters: dict[int, np.ndarray] = {}
        self.rows: dict[int, int] = {}
        self.table = np.empty((CACHED, SIZE), dtype=np.int8)
        self.alpha = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            self.letters[code] = np.random.default_rng([SEED, code]).integers(0, 2, SIZE, dtype=np.int8) * 2 - 1
        return self.letters[code]

    def grams(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The n-grams of the lower-cased text, each run of other characters being one space, and their counts."""
        codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        letter = self.alpha[codes]
        codes = np.where(letter, codes, 32)[np.concatenate([[True], letter[1:] | letter[:-1]])]
        if len(codes) < GRAM:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        packed = codes[:len(codes) - GRAM + 1].copy()
        for k in range(1, GRAM):
            packed = packed << 21 | codes[k:len(codes) - GRAM + 1 + k]
        return np.unique(packed, return_counts=True)

    def total(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The sum of n-gram vectors, each ``counts`` times, exact in floating point below 2 ** 53."""
        out = np.zeros(SIZE)
        for at in range(0, len(grams), 4096):
            some = grams[at:at + 4096].tolist()
            if len(self.rows) + len(some) > CACHED:
                self.rows.clear()
            places = [self.rows.get(g, -1) for g in some]
            for i, place in enumerate(places):
                if place < 0:
                    places[i] = self.rows[some[i]] = len(self.rows)
                    vector = np.ones(SIZE, dtype=np.int8)
                    for k in range(GRAM):
                        vector *= np.roll(self.letter(some[i] >> 21 * (GRAM - 1 - k) & 0x1FFFFF), GRAM - 1 - k)
                    self.table[places[i]] = vector
            part = counts[at:at + 4096]
            kind = np.float32 if part.sum() < 1 << 24 else np.float64  # both exact here
            out += part.astype(kind) @ self.table[places].astype(kind)
        return out


def prototypes(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, vector array<long>), one row per non-null value of ``lang``."""
    def bundle(batches):
        vectors, sums = Vectors(), {}

        def rows():
            values = [vectors.total(np.array(list(c)), np.array(list(c.values()))).astype(np.int64) for c in sums.values()]
            return pa.RecordBatch.from_arrays([pa.array(sums, pa.string()), pa.array([v.tolist() for v in values], pa.list_(pa.int64()))], ["lang", "vector"])

        for batch in batches:
            for value, language in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                counts = sums.setdefault(language, {})
                grams, n = vectors.grams(value)
                for g, k in zip(grams.tolist(), n.tolist()):
                    counts[g] = counts.get(g, 0) + k
                if len(sums) > LANGUAGES_AT_ONCE or len(counts) > 1_000_000:
                    yield rows()
                    sums.clear()
        yield rows()

    used = docs.select(text_of(text).alias("text"), F.col(f"`{lang}`").cast("string").alias("lang")).where("lang IS NOT NULL")
    sums = used.mapInArrow(bundle, "lang string, vector array<long>").select("lang", F.posexplode("vector").alias("at", "value"))
    summed = sums.groupBy("lang", "at").agg(F.sum("value").alias("value"))
    return summed.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("v")).select(
        "lang", F.col("v.value").alias("vector"))


def _scorer(names: list[str], table: np.ndarray):
    """texts -> (lang, score): the nearest of these prototypes, the first of equals; null for a text without a letter."""
    norm = np.linalg.norm(table, axis=1)
    unit = (table / np.where(norm > 0, norm, 1)[:, None]).T

    @F.pandas_udf("lang string, score double")
    def best(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        vectors = Vectors()
        for texts in parts:
            out = []
            for value in texts:
                if not any(map(str.isalpha, value)):
                    out.append((None, 0.0))
                    continue
                vector = vectors.total(*vectors.grams(value))
                cosines = np.round(vector @ unit / (np.linalg.norm(vector) or 1), 12)  # equal prototypes tie
                k = int(np.argmax(cosines))
                out.append((names[k], float(min(1.0, max(0.0, cosines[k])))))
            yield pd.DataFrame(out, columns=["lang", "score"])
    return best


def predicted(docs: DataFrame, learned: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred (string) and score (double, 0 to 1) added, by the prototypes of ``learned``.

    lang_pred is UNKNOWN, with score 0, for a null text, a text without a letter, or if nothing was learned. Of equally
    near languages the first by name wins.
    """
    last, best = None, F.lit(None).cast("struct<lang:string,score:double>")
    while True:
        block = (learned if last is None else learned.where(F.col("lang") > last)).orderBy("lang").limit(LANGUAGES_AT_ONCE).collect()
        if not block:
            break
        scorer = _scorer([r.lang for r in block], np.array([r.vector for r in block], dtype=float))
        found = scorer(text_of(text))
        best = found if last is None else F.when(found["score"] > best["score"], found).otherwise(best)
        last = block[-1].lang
        if len(block) < LANGUAGES_AT_ONCE:
            break
    marked = docs.withColumn("_best", best)
    return with_outputs(marked, lang_pred=F.coalesce("_best.lang", F.lit(UNKNOWN)), score=F.coalesce("_best.score", F.lit(0.0))).drop("_best")


def identified(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", held: int = 5) -> DataFrame:
    """``docs`` with held_out (crc32 of the id's text is divisible by ``held``), lang_pred and score added; learned from
    the texts that are not held out."""
    held_out = remainder(doc_id, held) == 0
    learned = settle(prototypes(docs.where(~held_out), text, lang), "languages")
    return predicted(with_outputs(docs, held_out=held_out), learned, text)
