"""Token counts by a count-only Viterbi search over a unigram vocabulary.

An Aho-Corasick automaton finds all pieces that end at each place of a text; the search carries only the best score and
the number of pieces of the best path. Ties go as in the tokenizers library: of equal scores the path whose last piece
starts first stays. A character that is no piece costs the lowest score minus 10 and counts as its bytes.

A space is written as ``▁`` and a text gets one in front. Where no piece of the vocabulary crosses from some character
into a following ``▁``, the search splits there without change, so the parts are counted once and remembered. (Scores of
the parts start from zero; for scores that are whole numbers, as in the vocabulary used here, this is exact.)
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icelens.llm.common import text_of, with_outputs

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
CACHED_PARTS = 400_000


def vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) of a SentencePiece file, without control, byte, unknown and unused pieces."""
    from sentencepiece import SentencePieceProcessor
    model = SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or model.is_unused(i))]


class Parts(dict):
    """Number of pieces per part, worked out when first asked for; ``scores`` has the same keys."""

    def __init__(self, search):
        super().__init__()
        self.search, self.scores = search, {}

    def __missing__(self, part: str) -> int:
        self[part], self.scores[part] = self.search(SPACE + part)
        return self[part]


class Counter:
    def __init__(self, pieces: list[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        if pieces:
            self.automaton.make_automaton()
        self.singles = {p for p, _ in pieces if len(p) == 1}
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        before = {p[i - 1] for p, _ in pieces for i in range(1, len(p)) if p[i] == SPACE}
        self.simple = before <= {SPACE}  # only runs of spaces cross into a space
        held = "".join(map(re.escape, sorted(before)))
        self.cut = re.compile(f"(?<=[^{held}])(?={SPACE})" if held else f"(?<=.)(?={SPACE})", re.S)
        self.known = Parts(self.search)

    def search(self, part: str) -> tuple[int, float]:
        """(pieces, score) of the best path through ``part``, by its definition."""
        n = len(part)
        if self.singles.issuperset(part):  # every place can be reached: matches come by their end, the longest first
            best, count = [0.0] + [-math.inf] * n, [0] * (n + 1)
            for end, (length, score) in self.automaton.iter(part):
                value = best[end + 1 - length] + score
                if value > best[end + 1]:
                    best[end + 1], count[end + 1] = value, count[end + 1 - length] + 1
            return count[n], best[n]
        ending: list[list] = [[] for _ in range(n + 1)]
        if len(self.automaton):
            for end, match in self.automaton.iter(part):
                ending[end + 1].append(match)
        best, count = [0.0] * (n + 1), [0] * (n + 1)
        for i in range(1, n + 1):
            top = None
            for length, score in sorted(ending[i], reverse=True):  # the longest starts first
                value = best[i - length] + score
                if top is None or value > top:
                    top, pieces = value, count[i - length] + 1
            if part[i - 1] not in self.singles:
                value = best[i - 1] + self.unknown
                if top is None or value > top:
                    top, pieces = value, count[i - 1] + len(part[i - 1].encode("utf-8", "surrogatepass"))
            best[i], count[i] = top, pieces
        return count[n], best[n]

    def count(self, text: str) -> tuple[int, float]:
        """(pieces, score) of a whole text; none for the empty text."""
        if not text:
            return 0, 0.0
        if len(self.known) > CACHED_PARTS:
            self.known = Parts(self.search)
        if self.simple and text[0] != " " and "  " not in text and SPACE not in text:
            parts = text.split(" ")  # remembered without the space mark in front of each
        else:
            parts = [p[1:] for p in self.cut.split(SPACE + text.replace(" ", SPACE))]
        return sum(map(self.known.__getitem__, parts)), sum(map(self.known.scores.__getitem__, parts))


def counted(docs: DataFrame, pieces: list[tuple[str, float]], text: str = "text") -> DataFrame:
    """``docs`` with n_tokens (long) and best_score (double) added, over whole texts; 0 and 0.0 for null or empty texts."""
    shared = docs.sparkSession.sparkContext.broadcast(pieces)  # a vocabulary: some 10,000 pieces

    @F.pandas_udf("n_tokens long, best_score double")
    def count(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counter = Counter(shared.value)
        for texts in parts:
            yield pd.DataFrame([counter.count(t) for t in texts], columns=["n_tokens", "best_score"])

    marked = docs.withColumn("_count", count(text_of(text)))
    return with_outputs(marked, n_tokens=F.col("_count.n_tokens"), best_score=F.col("_count.best_score")).drop("_count")
