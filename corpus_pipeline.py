"""The corpus pipeline: quality rules, line dedup, MinHash near-dedup, mixing and byte-level BPE over ``documents``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet in the shared folder
and hands it, read again, to the next. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from siteweave.llm import bpe, line_dedup, mixing, near_dedup, queries, rules
from siteweave.llm.common import table
from siteweave.recovery import rested, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the learned decision list rejects go."""
    rested(spark)
    return rules.keep_good(docs, rules.fit(docs, table(spark, sf_dir, "labels")))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand in at least 10 documents go, in all of them; documents stay."""
    return line_dedup.dedup_lines(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8 or more) stays."""
    rested(spark)
    return near_dedup.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are taken as often as the weights of their sources ask for: not at all, once or twice."""
    return mixing.take(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document, their number, and whether they decode to its text."""
    rested(spark)
    return bpe.round_trip(docs, ["doc_id", "source"], public_tokenizers.path(queries.BPE_FILE), public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("byte_bpe", encoding),
]

#: The rules are learned and the encoding is beyond SQL: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; each result lies in the shared folder, for as long as the driver lives, and is what the next stage reads."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
