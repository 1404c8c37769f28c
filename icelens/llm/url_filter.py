"""Block and allow rules for URLs, whose block decisions reach the aliases of a URL.

URLs that a redirect or a canonical link connects are one resource under several names. Their classes are the connected
components of those links, found by alternating stars, every round written. A URL with a rule of its own keeps that
verdict. Any other takes the verdict of its class: allow if a URL of the class is explicitly allowed, else block if one is
blocked, else allow.

Links come from a table of redirects, if given, and from pages: ``<link rel=canonical>`` and ``<meta http-equiv=refresh>``
outside of comments, scripts and styles, resolved against the URL of their page. Targets that nobody fetched count too:
a page whose canonical URL is blocked is blocked.

Two URLs are the same name if they differ in their fragments only, in letter case of scheme and host, or in a missing path
instead of ``/``. In components a name is a 20-byte digest, so no long URL is shuffled there.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icelens.llm.common import text_key, text_of
from icelens.llm.simhash import components
from icelens.session import settle

#: (verdict, host, path) of the registered query.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Comments and elements whose content is not markup are matched whole, to their end or that of the page, and passed over.
TAGS = r"(?is)<!--.*?(?:-->|\z)|<(script|style|textarea|title)\b.*?(?:</\1\b|\z)|<(?:link|meta)\b[^<>]*+>"
REFRESH = re.compile(r"""[0-9.]*\s*[;,]\s*(?:url\s*=\s*)?["']?([^"']+)""", re.IGNORECASE)


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): host after the first ``://``, A-Z lower-cased; path from there up to ``?`` or ``#``. Else both empty."""
    whole = F.coalesce(url, F.lit(""))
    pattern = r"(?s)^.*?://([^/?#]*+)([^?#]*+)"
    return (F.translate(F.regexp_extract(whole, pattern, 1), UPPER, LOWER), F.regexp_extract(whole, pattern, 2))


def name_of(url: Column) -> Column:
    """The URL without what does not tell resources apart; null if it has no ``://``."""
    pattern = r"(?s)^(.*?://)([^/?#]*+)([^?#]*+)([^#]*+)"
    host = F.translate(F.concat(F.regexp_extract(url, pattern, 1), F.regexp_extract(url, pattern, 2)), UPPER, LOWER)
    path = F.regexp_extract(url, pattern, 3)
    return F.when(F.instr(url, "://") > 0, F.concat(host, F.when(path == "", "/").otherwise(path), F.regexp_extract(url, pattern, 4)))


class _Tag(HTMLParser):
    """The attributes of one tag; of an attribute given twice the first counts."""
    def handle_starttag(self, tag, attrs):
        self.tag, self.attributes = tag, {k: v or "" for k, v in reversed(attrs)}


def link_of(base: str, tag: str) -> str | None:
    """The URL that a ``link`` or ``meta`` tag of the page ``base`` names as canonical or sends to, resolved."""
    parser = _Tag()
    parser.tag, parser.attributes = None, {}
    parser.feed(tag)
    found, link = parser.attributes, None
    if parser.tag == "link" and "canonical" in found.get("rel", "").lower().split():
        link = found.get("href")
    elif parser.tag == "meta" and found.get("http-equiv", "").strip().lower() == "refresh":
        sent = REFRESH.match(found.get("content", ""))
        link = sent and sent[1]
    if link is None:
        return None
    try:
        whole = urljoin(base, link.strip())
    except ValueError:  # no URL at all
        return None
    return whole if "://" in whole else None


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(from_url, to_url): the canonical links and refreshes of all pages. Only the few tags that may be one go to Python."""
    @F.pandas_udf("string")
    def links(bases: pd.Series, tags: pd.Series) -> pd.Series:
        return pd.Series([link_of(b, t) for b, t in zip(bases, tags)], dtype=object)

    tags = pages.where(F.instr(F.col(f"`{url}`"), "://") > 0).select(F.col(f"`{url}`").cast("string").alias("from_url"), F.explode(F.filter(
        F.regexp_extract_all(text_of(html), F.lit(TAGS), F.lit(0)), lambda t: t.rlike("(?i)^<(?:link|meta)") & t.rlike("(?i)canonical|refresh|&"))).alias("tag"))
    return tags.select("from_url", links("from_url", "tag").alias("to_url")).where("to_url IS NOT NULL")


def rule_table(spark, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules (verdict, host, path) as a table for judged()."""
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def fitting(places: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict): for the distinct hosts and paths of ``places`` the longest rule, if one fits.

    A place looks rules up by equality, with as many ends of its host as rules have labels, and as many beginnings of its
    path as rules of that host have lengths; so the work does not grow with the number of rules.
    """
    clean = rules.select(F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER).alias("h"), F.coalesce("path", F.lit("")).alias("p"), "verdict")
    unique = settle(clean.groupBy("h", "p").agg(F.max(F.col("verdict") == "allow").alias("allow")), "url-rules")
    hosts = unique.groupBy("h").agg(F.collect_set(F.length("p")).alias("lengths"))
    most = hosts.agg(F.max(F.size(F.split("h", r"\.")))).first()[0] or 0
    labels = F.split("host", r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.least(F.size("labels"), F.lit(max(most, 1)))), lambda k: F.array_join(
        F.slice("labels", F.size("labels") - k + 1, k), "."))
    tried = (places.select("host", "path").where("host != ''").distinct().withColumn("labels", labels)
             .select("host", "path", F.explode(ends).alias("h")).join(hosts, "h")
             .select("host", "path", "h", F.explode("lengths").alias("n")).where(F.length("path") >= F.col("n"))
             .select("host", "path", "h", F.substr("path", F.lit(1), F.col("n")).alias("p")))
    best = tried.join(unique, ["h", "p"]).groupBy("host", "path").agg(F.max(F.struct(
        (F.length("h") + F.length("p")).alias("size"), F.length("h").alias("host_size"), F.concat("h", "p").alias("rule"), "allow")).alias("best"))
    return best.select("host", "path", "best.rule", F.when(F.col("best.allow"), "allow").otherwise("block").alias("verdict"))


def judged(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None, url: str = "url", html: str | None = "html") -> DataFrame:
    """``pages`` with host, path, rule and verdict (allow or block); columns of these names are replaced.

    rules: (verdict, host, path), hosts in any case. A rule fits its host and all subdomains, where the path starts with the rule's; the
    longest rule wins, of equally long ones that with the longer host; of one rule given twice, allow. redirects:
    (from_url, to_url), any other columns; rows with a null are passed over. A null URL, or one without ``://``, has an
    empty host and path, no rule and no aliases: allow. Repeated rows are judged alike. Null, empty or very long html
    is fine; so are empty tables.
    """
    host, path = split_url(F.col(f"`{url}`").cast("string"))
    found = page_links(pages, url, html) if html else None
    if redirects is not None:
        sent = redirects.select(F.col("from_url").cast("string"), F.col("to_url").cast("string"))
        found = sent if found is None else settle(found, "url-links").union(sent)
    own = settle(fitting(pages.select(host.alias("host"), path.alias("path")), rules), "url-verdicts")
    packed = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"), host.alias("host"), path.alias("path"), text_key(name_of(F.col(f"`{url}`").cast("string"))).alias("name"))
    packed = packed.join(own, ["host", "path"], "left")
    verdict = F.col("verdict")
    if found is not None:
        named = found.select(name_of(F.col("from_url")).alias("from_url"), name_of(F.col("to_url")).alias("to_url"))
        named = settle(named.where("from_url != to_url").select("*", *[text_key(F.col(c)).alias(f"{c}_name") for c in named.columns]).distinct(), "url-edges")
        roots = settle(components(named.select(F.col("from_url_name").alias("a"), F.col("to_url_name").alias("b"))), "url-classes")
        ends = [named.select(F.col(f"{c}_name").alias("node"), *[x.alias(n) for x, n in zip(split_url(F.col(c)), ("host", "path"))]) for c in ("from_url", "to_url")]
        names = settle(ends[0].union(ends[1]).distinct(), "url-names")
        decided = names.join(fitting(names, rules), ["host", "path"]).join(roots, "node").groupBy("root").agg(
            F.max(F.col("verdict") == "allow").alias("allow"))
        classes = roots.join(decided, "root").select(F.col("node").alias("name"), F.when(F.col("allow"), "allow").otherwise("block").alias("class"))
        packed = packed.join(classes, "name", "left")
        verdict = F.coalesce("verdict", "class")
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    return packed.select(*[F.col("row").getField(c).alias(c) for c in kept], "host", "path", "rule",
                         F.coalesce(verdict, F.lit("allow")).alias("verdict"))
