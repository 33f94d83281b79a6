"""opN_<name>: each operator with production parameters over its whole table, and the digest columns of its contract."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteweave.llm import bpe, html_text, line_dedup, media, mixing, near_dedup, quality, rules, suffix_dedup, warc
from siteweave.llm.common import table

#: The rank file of the byte-level BPE queries, and the pattern of its pre-tokens.
BPE_FILE = "byte_bpe_multi_50k.tiktoken"


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a classifier that learned from the labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    out = quality.score(docs, model)
    return out.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), F.col("__score").alias("score"), F.when(F.col("__score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """All texts encoded to ids and decoded again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", bpe.digest_column(F.col("text"), path or public_tokenizers.path(BPE_FILE), pattern).alias("d")).select("doc_id", "d.*")


def op3_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts stored as pictures, read back, with features."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", media.digest_column(F.col("text")).alias("d")).select("doc_id", "d.*")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents judged by the base rule and a decision list learned from the labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learned = rules.fit(docs, table(spark, sf_dir, "labels"))
    out = rules.judge(docs, learned)
    named = [F.col(f"__stats.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return out.select("doc_id", *named, F.col("__base_failed").alias("base_failed"), F.col("__kept").alias("kept"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents that lie in a repeated string of 200 bytes are removed."""
    docs = suffix_dedup.with_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", suffix_dedup.digest_column(F.col("text"), F.col("__intervals"), F.col("__windows")).alias("d")).select("doc_id", "d.*")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to WARC archives and read back."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    read = warc.round_trip(pages)
    kind = pages.schema["page_id"].dataType
    return read.select(F.col("record_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Systematic sampling of all documents to the weights 3, 1, 2; in small tables the words taken come near the target too."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mixing.mix(docs)
    return mixed.select("doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), (F.col("__copies") * F.col("__size")).alias("taken"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose key stands in at least 10 documents are dropped everywhere."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.mark_lines(docs)
    return out.select("doc_id", F.col("__lines").alias("n_lines"), F.col("__dropped").alias("n_dropped"), F.sha2(F.col("__kept").cast("binary"), 256).alias("kept_sha256"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    read = pages.select("page_id", "url", html_text.main_text_column(F.col("html")).alias("text"))
    return read.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 3-word shingles agree to 85 %."""
    found = near_dedup.assign(table(spark, sf_dir, "documents"), words=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


OP4_SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
  md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS tie FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n_rows, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM d GROUP BY source),
w AS (SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight, source_size * 2.0::DOUBLE AS cap,
  CAST(sum(source_size) OVER () AS BIGINT) * 1.5::DOUBLE AS need FROM s),
f AS (SELECT *, sum(cap) OVER l + cap / weight * (sum(weight) OVER () - sum(weight) OVER l) <= need AS is_full FROM w
  WINDOW l AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
g AS (SELECT *, (need - coalesce(sum(cap) FILTER (is_full) OVER (), 0)) / nullif(sum(weight) OVER () - coalesce(sum(weight) FILTER (is_full) OVER (), 0), 0) AS level FROM f),
t AS (SELECT source, source_size, n_rows, CASE WHEN is_full THEN cap ELSE coalesce(least(cap, level * weight), 0) END AS target,
  CAST('0x' || substr(md5('mix:' || coalesce(source, chr(0))), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u FROM g),
p AS (SELECT d.doc_id, d.size, d.tie, t.*,
  floor(CAST('0x' || substr(d.tie, 1, 8) AS BIGINT) / 4294967296.0::DOUBLE * ceil(n_rows / 4096.0::DOUBLE)) AS stratum
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY stratum, size, tie, doc_id) AS place, coalesce(target / nullif(source_size, 0), 0) AS rate FROM p)
SELECT doc_id, size, source_size, target, CAST(floor(place * rate + u) - floor((place - 1) * rate + u) AS BIGINT) * size AS taken FROM r
"""

OP6_SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
hot AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT k.doc_id, k.pos, k.line, hot.key IS NOT NULL AS gone FROM k LEFT JOIN hot ON k.key = hot.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256 FROM m GROUP BY doc_id
"""

OP8_SQL = r"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY digest) ELSE page_id END AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to FROM f
"""

QUERIES = {
    "op1_quality": op1_quality, "op2_byte_bpe": op2_byte_bpe, "op3_media": op3_media, "op5_quality_rules": op5_quality_rules, "op8_warc": op8_warc,
    "op4_mixing": op4_mixing, "op6_line_dedup": op6_line_dedup,
    "op7_suffix_dedup": op7_suffix_dedup, "op9_html_text": op9_html_text, "op10_near_dedup": op10_near_dedup,
}
ORACLES = {"op8_warc": OP8_SQL, "op4_mixing": OP4_SQL, "op6_line_dedup": OP6_SQL}
