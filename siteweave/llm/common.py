"""What the operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the contracts: space and the control characters 9 to 13.
WHITE = " \t\n\x0b\x0c\r"
#: The same as a character class of Java and Python regular expressions.
WHITE_CLASS = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the corpus tables, by Spark's own reader: the path may be in any store."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as one column ``doc``, so that no column's name can clash with what an operator adds."""
    return docs.select(F.struct("*").alias("doc"))


def field(name: str) -> Column:
    """The column of that name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def unpacked(names: list[str], added: list[str]) -> list[Column]:
    """The columns that ``packed`` held, but for those whose names are added anew."""
    return [F.col("doc")[name].alias(name) for name in names if name not in added]


def row_key(doc_id: Column, text: Column) -> Column:
    """128 bits that stand for a row: equal for repeated rows, else different but for chance.

    The halves are hashes of different seeds from the first byte on, so that rows that agree in one don't agree in the other.
    """
    return F.struct(F.xxhash64(doc_id, text).alias("a"), F.xxhash64(F.lit(7), text, doc_id).alias("b"))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def word_count(text: Column) -> Column:
    """Number of maximal runs of characters that are not white space; 0 for null."""
    held = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.when(held == "", F.lit(0)).otherwise(F.size(F.split(held, WHITE_CLASS + "+", -1))).cast("long")
