"""Line deduplication by range-partitioned hashes and per-document bitmaps; DataFrame operations only.

Every line gets a 128-bit hash of its key (the line without white space at both ends, A-Z lower-cased). The hashes, never
the lines, are written once, range-partitioned by (hash, salt of the row) and sorted by document and position; the salts deal
a very common line out to as many groups as there are partitions. Windows stream over that order: the first occurrence of a
key in each document counts it, and a group with enough documents is settled where it lies. What is left of a key, fewer than
``min_docs`` documents of each group and one row that stands for each settled group, meets by hash and is settled there. So
no task ever holds a whole common line. What goes back to the documents is a sparse bitmap: the 64-bit words, by word number,
that have a dropped line; all other lines are kept.

Defined results: null text is one empty line; keys shorter than ``min_chars`` are never dropped; every row is a document of
its own, also where rows or ids repeat or are null; an empty table gives an empty table; other columns stay as they are,
under any names, but ``mark_lines`` puts its three columns in the place of columns that are called so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siteweave.llm.common import WHITE, ascii_lower, packed, row_key, unpacked
from siteweave.recovery import stored

#: Found in at least so many documents, a key is a common line.
MIN_DOCS = 10
MIN_CHARS = 1


def _words(entries: Column) -> Column:
    return F.map_from_entries(F.collect_list(entries))


def drop_bitmaps(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, keep_first: bool = False) -> DataFrame:
    """(row, words): the lines to drop of each row that has any, as 64-bit words by word number.

    A key in at least ``min_docs`` rows loses all its lines, or all but the first in the order of doc_id and position if
    ``keep_first``. ``row`` is ``row_key(doc_id, text)``; repeated rows share it, count one by one, and lose the same lines.
    """
    spark = docs.sparkSession
    lines = docs.select(
        F.col("doc_id").alias("d"), row_key(F.col("doc_id"), F.col("text")).alias("row"), F.posexplode(F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)).alias("pos", "line")
    )
    key = ascii_lower(F.btrim(F.col("line"), F.lit(WHITE)))
    hashed = lines.select("d", "row", "pos", key.alias("key")).where(F.length("key") >= min_chars)
    # the halves of the hash have different seeds from the first byte on
    hashed = stored(hashed.select("d", "row", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")))
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = hashed.withColumn("salt", F.pmod(F.col("row.a"), F.lit(salts))).repartitionByRange("h1", "h2", "salt")

    group = Window.partitionBy("h1", "h2", "salt")
    place = F.struct("d", "row", "pos")
    # repeated rows stand side by side, with the same places: each of them is a first occurrence in a document
    ranged = ranged.withColumn("opens", (F.rank().over(Window.partitionBy("h1", "h2", "salt", "d", "row").orderBy("pos")) == 1).cast("long"))
    ranged = ranged.withColumn("nth", F.row_number().over(group.orderBy("d", "row", "pos"))).withColumn("first", F.first(place).over(group.orderBy("d", "row", "pos")))
    ranged = ranged.withColumn("docs", F.sum("opens").over(group))
    settled = F.col("docs") >= min_docs

    # lane 0 is what decides a key; the other rows of settled groups keep to themselves
    lane = F.when(settled & (F.col("nth") > 1), F.col("salt") + 1).otherwise(0)
    met = ranged.select("h1", "h2", "d", "row", "pos", "first", lane.alias("lane"), F.when(settled, F.col("docs")).otherwise(F.col("opens")).alias("weight"))
    whole = Window.partitionBy("h1", "h2", "lane")
    met = met.withColumn("docs", F.sum("weight").over(whole)).withColumn("first", F.min("first").over(whole))
    gone = met.where((F.col("lane") > 0) | (F.col("docs") >= min_docs))
    if keep_first:
        gone = gone.where(place != F.col("first"))
    by_word = gone.groupBy("row", F.expr("pos div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits"))
    return by_word.groupBy("row").agg(_words(F.struct("word", "bits")).alias("words"))


def _marked(docs: DataFrame, min_docs: int, min_chars: int, keep_first: bool) -> DataFrame:
    """(doc, lines, some): each row, its lines, and those that are kept."""
    bitmaps = drop_bitmaps(docs, min_docs, min_chars, keep_first)
    held = packed(docs).withColumn("row", row_key(F.col("doc.doc_id"), F.col("doc.text"))).join(bitmaps, "row", "left")
    held = held.withColumn("lines", F.split(F.coalesce(F.col("doc.text"), F.lit("")), "\n", -1))
    stays = "filter(lines, (x, i) -> (shiftright(coalesce(try_element_at(words, i div 64), 0L), i % 64) & 1L) = 0L)"
    return held.select("doc", "lines", F.when(F.col("words").isNull(), F.col("lines")).otherwise(F.expr(stays)).alias("some"))


def mark_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, keep_first: bool = False) -> DataFrame:
    """``docs`` with ``__lines`` (long), ``__dropped`` (long) and ``__kept`` (string: the remaining lines joined by \\n)."""
    out = _marked(docs, min_docs, min_chars, keep_first)
    new = {"__lines": F.size("lines").cast("long"), "__dropped": (F.size("lines") - F.size("some")).cast("long"), "__kept": F.array_join("some", "\n")}
    return out.select(*unpacked(docs.columns, list(new)), *[v.alias(k) for k, v in new.items()])


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, keep_first: bool = False) -> DataFrame:
    """``docs`` with the common lines gone from ``text``, and ``n_chars`` (if there) counted anew; null text stays null."""
    out = _marked(docs, min_docs, min_chars, keep_first)
    new = F.when(F.col("doc.text").isNotNull(), F.array_join("some", "\n"))
    put = {"text": new, "n_chars": F.length(new).cast("long")}
    return out.select(*[put.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])
