"""Secret scan through a trigram index.

From the regular expression of each rule a Boolean query over trigrams is derived: what every match must contain. Texts
are indexed block by block: an inverted index of a block lists, for each trigram that some rule asks for, the texts with
it. A rule's postings are intersected (and) and united (or), and only the texts that remain are searched with the
expression. A rule without mandatory trigrams searches all texts. A block is a few megabytes of text, so the index needs
bounded memory and no shuffle, and a lost task is simply done again.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as op
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icelens.llm.common import text_of, with_outputs

#: Characters of one block of texts. A longer text is a block of its own.
BLOCK_CHARS = 4_000_000
#: More alternatives of a piece than this are not listed: the piece then demands nothing.
MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """``least``: characters that group ``measured`` must have; shorter matches are dropped after the search."""
    kind: str
    pattern: str
    measured: int = 0
    least: int = 0


def either_case(words: str) -> str:
    """A pattern with each ASCII letter in either case."""
    return re.sub("[A-Za-z]", lambda m: f"[{m[0].upper()}{m[0].lower()}]", words)


#: The three base rules.
BASE = [
    Rule("assign", either_case("(password|passwd|secret|token|api_?key)") + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]+", 0, 16),
]
#: Further kinds of secrets, by the fixed prefixes their issuers publish.
MORE = [
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"(?:sk|rk)_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH |PGP )?PRIVATE KEY"),
    Rule("userinfo", r"[a-z][a-z0-9+.-]{1,15}://[^\s:/@]{1,64}:[^\s:/@]{3,128}@"),
]

# A query is None (no demand), a trigram, or ("and" | "or", queries...).


def trigram_query(pattern: str):
    """What every match of ``pattern`` must contain, over lower-case trigrams."""
    exact, query = _demand(list(parser.parse(pattern)))
    return _and([query, _of_strings(exact)])


def _and(queries):
    parts = []
    for q in queries:
        if isinstance(q, tuple) and q[0] == "and":
            parts += q[1:]
        elif q is not None:
            parts.append(q)
    parts = list(dict.fromkeys(parts))
    return None if not parts else parts[0] if len(parts) == 1 else ("and", *parts)


def _or(queries):
    queries = list(dict.fromkeys(queries))
    if not queries or None in queries:
        return None
    return queries[0] if len(queries) == 1 else ("or", *queries)


def _of_strings(strings):
    """One of these strings is contained. ``None``: unknown strings."""
    if strings is None:
        return None
    return _or([_and([s[i:i + 3] for i in range(len(s) - 2)]) for s in strings])


def _demand(items):
    """(strings, query): all lower-case strings that the items can match, or None if they are not listed; and what a match
    contains besides."""
    run, listed, queries = {""}, True, []
    for kind, value in items:
        strings, query = _one(kind, value)
        queries.append(query)
        longer = None if strings is None else {a + b for a in run for b in strings}
        if longer is None or len(longer) > MOST_STRINGS:  # a run of known characters ends; its trigrams are mandatory
            queries.append(_of_strings(run))
            longer, listed = strings or {""}, False
        run = longer
    return (run, _and(queries)) if listed else (None, _and([*queries, _of_strings(run)]))


def _one(kind, value):
    """_demand of one parsed item. Whatever is not known here demands nothing."""
    if kind is op.LITERAL:
        return {chr(value).lower()}, None
    if kind is op.IN:
        found = set()
        for what, x in value:
            if what is op.LITERAL:
                found.add(chr(x).lower())
            elif what is op.RANGE and x[1] - x[0] < MOST_STRINGS:
                found.update(chr(c).lower() for c in range(x[0], x[1] + 1))
            else:
                return None, None
        return (found, None) if len(found) <= 8 else (None, None)  # larger classes would only blow up the query
    if kind is op.SUBPATTERN:
        return _demand(list(value[3]))
    if kind is op.BRANCH:
        ways = [_demand(list(way)) for way in value[1]]
        if all(strings is not None for strings, _ in ways):
            return set().union(*(strings for strings, _ in ways)), _or([query for _, query in ways])
        return None, _or([_and([_of_strings(strings), query]) for strings, query in ways])
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT):
        least, most, inner = value
        strings, query = _demand(list(inner))
        if strings is not None and (least, most) == (0, 1):
            return strings | {""}, None
        if strings is not None and least == most and len(strings) ** least <= MOST_STRINGS:
            run = {""}
            for _ in range(least):
                run = {a + b for a in run for b in strings}
            return run, query
        return None, _and([query, _of_strings(strings)]) if least else None
    return ({""}, None) if kind is op.AT else (None, None)


def _trigrams(query) -> set[str]:
    if query is None:
        return set()
    return {query} if isinstance(query, str) else set().union(*(_trigrams(q) for q in query[1:]))


def _matching(query, postings: dict[str, np.ndarray], n: int) -> np.ndarray:
    """Numbers of the texts of a block that satisfy the query."""
    if query is None:
        return np.arange(n)
    if isinstance(query, str):
        return postings[query]
    lists = sorted((_matching(q, postings, n) for q in query[1:]), key=len, reverse=query[0] == "or")
    out = lists[0]
    for other in lists[1:]:
        out = np.intersect1d(out, other, assume_unique=True) if query[0] == "and" else np.union1d(out, other)
    return out


def index(texts: list[str], trigrams: list[str]) -> dict[str, np.ndarray]:
    """Posting lists of one block. Letters of any case count as their lower-case form, as in the queries."""
    lower = [t.lower() for t in texts]
    return {g: np.array([i for i, t in enumerate(lower) if g in t], dtype=np.int64) for g in trigrams}


def spans(texts: list[str], rules: list[Rule]) -> list[list[tuple[int, int, int]]]:
    """For each text (start, number of the rule, end) of all matches, in order. Ends are exclusive; code points."""
    queries = [trigram_query(r.pattern) for r in rules]
    postings = index(texts, sorted(set().union(*map(_trigrams, queries))))
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for k, (rule, query) in enumerate(zip(rules, queries)):
        search = re.compile(rule.pattern).finditer
        for i in _matching(query, postings, len(texts)).tolist():
            found[i] += [(m.start(), k, m.end()) for m in search(texts[i]) if m.end(rule.measured) - m.start(rule.measured) >= rule.least]
    return [sorted(f) for f in found]


def _blocks(texts: list[str]):
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > BLOCK_CHARS:
            yield start, i
            start, size = i, 0
        size += len(text)
    if texts:
        yield start, len(texts)


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs``, one row per row, with ``found`` added: array of (kind, start, end) by start, then in the order of the rules.

    Base rules come first, then MORE. Per kind, matches are leftmost and do not overlap, and matches whose measured part
    is too short are dropped. A null text counts as empty and has no spans.
    """
    rules = BASE + MORE

    def found(batches):
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            hits = []
            for a, b in _blocks(texts):
                hits += [[{"kind": rules[k].kind, "start": s, "end": e} for s, k, e in row] for row in spans(texts[a:b], rules)]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(hits, kind)], ["_row", "found"])

    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), text_of(text).alias("_text"))
    out = packed.mapInArrow(found, f"_row {packed.schema['_row'].dataType.simpleString()}, "
                                   "found array<struct<kind:string,start:int,end:int>>")
    return with_outputs(out.select("_row.*", F.col("found").alias("_found")), found=F.col("_found")).drop("_found")


def joined(found, kinds=None):
    """kind:start:end of the spans (of these kinds only), comma-joined."""
    chosen = found if kinds is None else F.filter(found, lambda s: s["kind"].isin(kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def summary(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_assign, n_access, n_hex (long), base_sha256 and spans (string) added."""
    marked = scan(docs, text)
    def count(kind: str):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    n = {f"n_{r.kind}": count(r.kind) for r in BASE}
    base = joined(F.col("found"), [r.kind for r in BASE])
    return with_outputs(marked, **n, base_sha256=F.sha2(F.encode(base, "UTF-8"), 256), spans=joined(F.col("found"))).drop("found")
