"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from icelens.llm import (collocations, decontaminate, hard_negatives, language, language_model, mixture, piece_counts, quality, secret_scan,
                         simhash, tokenbin, url_filter, warc)
from icelens.llm.common import table

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality.score(docs, keep_text=False).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                        "base_failed", "kept", "posterior")


@query
def op2_simhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.classes(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op10_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.flagged(docs, table(spark, folder, "benchmark")).drop("text")


@query
def op1_source_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return mixture.counts(table(spark, folder, "documents").select("doc_id", "text", "source"))


def tokenizer_file(name: str) -> str:
    """The place of a public vocabulary file on this machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op7_token_binary(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return tokenbin.written(docs, tokenizer_file("byte_bpe_50k.json"), with_ids=False)


@query
def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return secret_scan.summary(docs).drop("text")


@query
def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return language.identified(docs).select("doc_id", "held_out", "lang_pred", "score")


@query
def op6_warc_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived(table(spark, folder, "pages"))


ORACLES["op6_warc_chunks"] = """
WITH payloads AS (SELECT page_id, encode(coalesce(html, '')) AS data FROM pages),
sized AS (SELECT page_id, octet_length(data) AS n, sha1(data) AS digest FROM payloads),
firsts AS (SELECT n, digest, max(page_id) AS top FROM sized WHERE n >= 1000 GROUP BY n, digest)
SELECT s.page_id, CAST(s.n AS BIGINT) AS payload_bytes, s.digest AS payload_digest,
       CASE WHEN f.top IS NOT NULL AND f.top IS DISTINCT FROM s.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.top IS DISTINCT FROM s.page_id THEN f.top END AS refers_to
FROM sized s LEFT JOIN firsts f ON f.n = s.n AND f.digest = s.digest
"""


@query
def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    pieces = piece_counts.vocabulary(tokenizer_file("piece_bpe_32k.model"))
    return piece_counts.counted(docs, pieces).drop("text")


@query
def op8_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return language_model.held_out_scores(table(spark, folder, "documents").select("doc_id", "text"))


@query
def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents").select("text", "lang"))


ORACLES["op12_collocations"] = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
lists AS (SELECT lang, [x FOR x IN regexp_split_to_array(piece, '[\\x20\\x09]+') IF x <> ''] AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists),
one AS (SELECT lang, w[i] AS w1, count(*) AS f FROM places GROUP BY ALL),
two AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, count(*) AS f FROM places WHERE i < len(w) GROUP BY ALL),
three AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3, count(*) AS f FROM places WHERE i + 1 < len(w) GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM one GROUP BY lang),
pairs AS (
  SELECT t.lang, t.w1, t.w2, CAST(NULL AS VARCHAR) AS w3, t.f AS a, x.f AS l, y.f AS r,
         CAST(1000000 AS HUGEINT) * t.f * t.f // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM two t JOIN one x ON x.lang = t.lang AND x.w1 = t.w1 JOIN one y ON y.lang = t.lang AND y.w1 = t.w2 WHERE t.f >= 10),
cuts AS (
  SELECT t.lang, t.w1, t.w2, t.w3, t.f AS a, 1 AS k, x.f AS l, y.f AS r
  FROM three t JOIN one x ON x.lang = t.lang AND x.w1 = t.w1 JOIN two y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3 WHERE t.f >= 10
  UNION ALL
  SELECT t.lang, t.w1, t.w2, t.w3, t.f, 2, x.f, y.f
  FROM three t JOIN two x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2 JOIN one y ON y.lang = t.lang AND y.w1 = t.w3 WHERE t.f >= 10),
triples AS (
  SELECT *, CAST(1000000 AS HUGEINT) * a * a // (CAST(l AS HUGEINT) * r) AS score FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, w1, w2, w3 ORDER BY score, k) = 1),
longer AS (
  SELECT lang, p.w1 AS w1, p.w2 AS w2, max(a) AS most
  FROM (SELECT lang, a, unnest([{'w1': w1, 'w2': w2}, {'w1': w2, 'w2': w3}]) AS p FROM triples) GROUP BY ALL),
kept AS (
  SELECT p.* FROM pairs p LEFT JOIN longer b ON b.lang = p.lang AND b.w1 = p.w1 AND b.w2 = p.w2
  WHERE b.most IS NULL OR 100 * b.most < 50 * p.a
  UNION ALL SELECT lang, w1, w2, w3, a, l, r, score FROM triples),
ranked AS (
  SELECT *, concat_ws(' ', w1, w2, w3) AS phrase,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, concat_ws(' ', w1, w2, w3)) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


@query
def op11_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return url_filter.judged(pages, url_filter.rule_table(spark, url_filter.RULES)).select("page_id", "host", "path", "rule", "verdict")


@query
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").withColumn("label", F.when(
        F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mined(hard_negatives.usable(rows), F.col("vec_id") % 100 == 0)


ORACLES["op13_hard_negatives"] = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same, CAST(list_inner_product(a.q, r.q) AS BIGINT) AS score
  FROM usable a JOIN usable r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank,
       n.other_id AS negative_id, positive_score, n.score AS negative_score
FROM positives JOIN scores n USING (anchor_id)
WHERE NOT n.same AND 80 * positive_score <= 100 * n.score AND 100 * n.score <= 100 * positive_score
QUALIFY rank <= 5
"""


_UPPER, _LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"


def _name(url: str) -> str:
    return (f"translate(regexp_extract({url}, '(?s)^(.*?://[^/?#]*)', 1), {_UPPER}, {_LOWER})"
            f" || CASE regexp_extract({url}, '(?s)^.*?://[^/?#]*([^?#]*)', 1) WHEN '' THEN '/'"
            f" ELSE regexp_extract({url}, '(?s)^.*?://[^/?#]*([^?#]*)', 1) END"
            f" || regexp_extract({url}, '(?s)^.*?://[^/?#]*[^?#]*([^#]*)', 1)")


# Of links in pages, SQL reads those that are whole URLs; relative ones are tested against brute force.
ORACLES["op11_url_filter"] = f"""
WITH RECURSIVE rules(verdict, host, path) AS (VALUES {", ".join(str(r) for r in url_filter.RULES)}),
sites AS (
  SELECT page_id, html, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), {_UPPER}, {_LOWER}) AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
         CASE WHEN contains(url, '://') THEN {_name("url")} END AS name FROM pages),
tags AS (
  SELECT name, unnest(regexp_extract_all(regexp_replace(coalesce(html, ''),
         '(?is)<!--.*?(?:-->|\\z)|<script\\b.*?(?:</script\\b|\\z)|<style\\b.*?(?:</style\\b|\\z)|<textarea\\b.*?(?:</textarea\\b|\\z)|<title\\b.*?(?:</title\\b|\\z)', '', 'g'),
         '(?is)<(?:link|meta)\\b[^<>]*>')) AS tag FROM sites WHERE name IS NOT NULL),
links AS (
  SELECT name, CASE
    WHEN regexp_matches(tag, '(?is)^<link') AND regexp_matches(tag, '(?is)\\srel\\s*=\\s*["'']?[^"''>]*\\bcanonical\\b')
      THEN regexp_extract(tag, '(?is)\\shref\\s*=\\s*["'']?([^"''>\\s]+)', 1)
    WHEN regexp_matches(tag, '(?is)^<meta') AND regexp_matches(tag, '(?is)\\shttp-equiv\\s*=\\s*["'']?refresh\\b')
      THEN regexp_extract(tag, '(?is)\\scontent\\s*=\\s*["''][0-9.]*\\s*[;,]\\s*(?:url\\s*=\\s*)?([^"''>]+)', 1) END AS link FROM tags),
edges AS (SELECT DISTINCT name AS a, {_name("link")} AS b FROM links WHERE contains(link, '://') AND name <> {_name("link")}),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reached(node, other) AS (SELECT a, a FROM both_ways UNION SELECT r.node, e.b FROM reached r JOIN both_ways e ON e.a = r.other),
nodes AS (
  SELECT DISTINCT node, regexp_extract(node, '(?s)^.*?://([^/?#]*)', 1) AS host, regexp_extract(node, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM reached),
places AS (SELECT host, path FROM sites UNION SELECT host, path FROM nodes),
fitting AS (
  SELECT p.host, p.path, r.host || r.path AS rule, r.verdict
  FROM places p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  QUALIFY row_number() OVER (PARTITION BY p.host, p.path ORDER BY length(r.host) + length(r.path) DESC, length(r.host) DESC, r.verdict) = 1),
classes AS (
  SELECT r.node, CASE WHEN bool_or(f.verdict = 'allow') THEN 'allow' ELSE 'block' END AS verdict
  FROM reached r JOIN nodes n ON n.node = r.other JOIN fitting f ON f.host = n.host AND f.path = n.path GROUP BY r.node)
SELECT s.page_id, s.host, s.path, f.rule, coalesce(f.verdict, c.verdict, 'allow') AS verdict
FROM sites s LEFT JOIN fitting f ON f.host = s.host AND f.path = s.path LEFT JOIN classes c ON c.node = s.name
"""
