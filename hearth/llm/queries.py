"""Registered queries of this subpackage: one ``opN_<name>`` per operator over
its whole table, and ``pipeline``."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.llm import (
    bpe, collocations, decontam, line_dedup, ngram_join, periodic_runs, pii, quality, sqltext, substring_dedup, token_count, toxicity, url_filter, warc,
)
from hearth.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

RANKS = "byte_bpe_multi_50k.tiktoken"
COUNTS = "byte_bpe_50k.json"
TOKEN_LIMIT = 1024
URL_RULES = [
    url_filter.Rule("net", "/", "block"),
    url_filter.Rule("example.net", "/en/", "allow"),
    url_filter.Rule("example.com", "/de/", "block"),
    url_filter.Rule("org", "/fr/", "allow"),
]


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.round_trip_digest(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.contamination(decontam.find_windows(docs, table(spark, sf_dir, "benchmark")))


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = line_dedup.mark_lines(docs)
    gone = F.coalesce(F.size("__lines"), F.lit(0)).cast("long")
    n_lines = F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long")
    return marked.select(
        "doc_id", n_lines.alias("n_lines"), F.greatest(gone, F.lit(0)).alias("n_removed"),
        F.coalesce(F.array_join(F.col("__lines").cast("array<string>"), ","), F.lit("")).alias("removed_lines"),
        F.sha2(F.coalesce(line_dedup.kept_text(), F.lit("")), 256).alias("kept_sha256"),
    )


@query
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).drop("url")


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query
def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = ngram_join.linked(table(spark, sf_dir, "documents"))
    return linked.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


@query
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts are those of the base spans; ``spans`` has the added ones too."""
    spans = pii.find_spans(table(spark, sf_dir, "documents"))
    return spans.select("doc_id", *[f"n_{k}" for k in pii.KINDS], F.sha2("base_spans", 256).alias("base_sha256"), "spans")


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.score(docs.select("doc_id", "text"), labels.select("doc_id", "toxic")).drop("restored")


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good"
    )


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per passage of 50 words or more that repeats in another document:
    word range [start, end) and one document that has it too."""
    found = substring_dedup.passages(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "start", "end", F.col("other").alias("other_doc_id"))


def planted_repeats(doc_id: int | None, n: int) -> np.ndarray | None:
    """The order in which a document's words are read: a tenth of the documents
    repeat some of their words from a place on, both set by the id's crc32.  A
    document without id is read as it is."""
    if doc_id is None:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    order = np.arange(n)
    order[a:] = a + (order[a:] - a) % p
    return order


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.with_runs(table(spark, sf_dir, "documents").select("doc_id", "text"), rewrite=planted_repeats)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "collapsed", best.alias("best"), F.array_join(lines, "").alias("lines")
    ).select(
        "doc_id", "n_runs", (-F.col("best.col2")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.col3")).alias("period"),
        F.expr("1000 * best.length div -best.col3").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_count.with_token_counts(docs, public_tokenizers.path(COUNTS), public_tokenizers.PATTERN)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


ORACLE["op4_url_filter"] = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^([^/?#]*)([^?#]*)', 1) ELSE '' END AS h,
         CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^([^/?#]*)([^?#]*)', 2) ELSE '' END AS path
  FROM pages
), p AS (SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM parts),
j AS (
  SELECT *, CASE
      WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM p
)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM j
"""
ORACLE["op2_decontamination"] = sqltext.DECONTAMINATION
ORACLE["op3_line_dedup"] = sqltext.LINE_DEDUP
ORACLE["op5_warc"] = sqltext.WARC
ORACLE["op6_ngram_join"] = sqltext.NGRAM_JOIN
ORACLE["op13_collocations"] = sqltext.COLLOCATIONS
