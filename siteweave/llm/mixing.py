"""Mixing sources to target weights by systematic sampling; DataFrame operations only.

Targets are set from the aggregated sources alone. Every document of a source expects target / source size copies. The
documents of a source stand in one line, their expected copies are summed along it, one random offset is added for the
source, and a document is emitted once for every integer boundary that its own stretch crosses. The line is cut into
strata of about ``STRATUM_ROWS`` rows by a hash of id and text, so a source with a third of all rows is many windows, not one;
the sum at each stratum's start comes from the counts of the strata before it. Inside a stratum documents stand by size, so
that the words taken stay near the target.

Defined results: null text has size 0; null is a source of its own, last in order; repeated rows are rows of their own;
sources without words get target 0; an empty table gives an empty table. Reruns agree: offsets and order come from hashes of
id and text, not from chance, so rows with null or equal ids are told apart by their texts. ``take`` returns the columns of
``docs`` under any names; ``mix`` puts its four columns in the place of columns that are called so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siteweave.llm.common import field, packed, unpacked, word_count
from siteweave.recovery import cut

#: Weights of the sources in the order of their names, repeated as often as needed.
WEIGHTS = (3, 1, 2)
#: Share of all words that the mix takes, and the most that a source may give as a multiple of its size.
TOTAL_SHARE, MOST = 1.5, 2.0
#: Rows of a stratum, about.
STRATUM_ROWS = 4096
#: Rows of a table of sources or strata that is broadcast; larger ones are shuffled, and the documents with them.
BROADCAST = 20_000
#: The columns that ``mix`` adds.
ADDED = ["__size", "__source_size", "__target", "__copies"]


def unit(text: Column) -> Column:
    """A number from 0 up to 1 that hangs on the text alone."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def source_targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, total_share: float = TOTAL_SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, n_rows, target) from rows of (source, size); one row for each source.

    The sources, already aggregated, are ranked in one window: their number is that of the weights to be set.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    everything = Window.partitionBy()
    per = per.withColumn("rank", rank).withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
    per = per.withColumn("cap", F.col("source_size") * F.lit(most)).withColumn("need", F.sum("source_size").over(everything) * F.lit(total_share))
    # filling up all sources in step: those whose cap comes first stop there, and the rest share what is left by weight
    line = Window.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per = per.withColumn("caps", F.sum("cap").over(line)).withColumn("rest", F.sum("weight").over(everything) - F.sum("weight").over(line))
    per = per.withColumn("full", F.col("caps") + F.col("cap") / F.col("weight") * F.col("rest") <= F.col("need"))
    gone = lambda c: F.coalesce(F.sum(F.when(F.col("full"), F.col(c))).over(everything), F.lit(0.0))
    level = (F.col("need") - gone("cap")) / F.nullif(F.sum("weight").over(everything) - gone("weight"), F.lit(0.0))
    target = F.when(F.col("full"), F.col("cap")).otherwise(F.coalesce(F.least(F.col("cap"), level * F.col("weight")), F.lit(0.0)))
    return per.withColumn("target", target).select("source", "source_size", "n_rows", "target")


def _small(df: DataFrame, rows: int) -> DataFrame:
    """``df``, to be broadcast if it has few rows: the documents that it is joined with then stay where they are."""
    return F.broadcast(df) if rows <= BROADCAST else df


def _placed(docs: DataFrame, targets: DataFrame, stratum_rows: int) -> DataFrame:
    """docs with its source's figures and its stratum. docs: (__doc_id, __source, __size, ...)."""
    own = targets.select(F.col("source").alias("__of"), F.col("source_size").alias("__source_size"), F.col("n_rows").alias("__n_rows"), F.col("target").alias("__target"))
    held = docs.join(own, F.col("__source").eqNullSafe(F.col("__of"))).drop("__of")
    strata = F.ceil(F.col("__n_rows") / F.lit(float(stratum_rows)))
    name = F.concat(F.coalesce(F.col("__doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("__text"))
    return held.withColumn("__tie", F.md5(name)).withColumn("__stratum", F.floor(unit(name) * strata))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, total_share: float = TOTAL_SHARE, most: float = MOST, stratum_rows: int = STRATUM_ROWS, seed: str = "mix") -> DataFrame:
    """``docs`` (doc_id, text, source, ...) with __size, __source_size, __target and __copies, the times the mix takes the row.

    If there are no other columns, ``text`` isn't returned, and texts are read only once.
    """
    slim = set(docs.columns) <= {"doc_id", "source", "text"}
    names = [c for c in docs.columns if not (slim and c == "text")]
    held = F.struct(*[field(c).alias(c) for c in names]).alias("doc")
    text = F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("__text")
    keyed = docs.select(held, F.col("doc_id").alias("__doc_id"), F.col("source").alias("__source"), word_count(F.col("text")).alias("__size"), text)
    sized = cut(keyed if slim else keyed.drop("doc"))
    targets = cut(source_targets(sized.select(F.col("__source").alias("source"), F.col("__size").alias("size")), weights, total_share, most))
    keyed = sized if slim else keyed
    n_sources, n_strata = targets.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.ceil(F.col("n_rows") / F.lit(float(stratum_rows)))), F.lit(0))).first()
    targets = _small(targets, n_sources)
    counts = _placed(sized, targets, stratum_rows).groupBy("__source", "__stratum").count()
    before = Window.partitionBy("__source").orderBy("__stratum").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("__source").alias("__of"), F.col("__stratum").alias("__at"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__start"))
    held = _placed(keyed, targets, stratum_rows).join(_small(starts, n_strata), F.col("__source").eqNullSafe(F.col("__of")) & (F.col("__stratum") == F.col("__at"))).drop("__of", "__at")
    order = Window.partitionBy("__source", "__stratum").orderBy("__size", "__tie", "__doc_id")
    place = F.col("__start") + F.row_number().over(order)
    rate = F.coalesce(F.col("__target") / F.nullif(F.col("__source_size"), F.lit(0)), F.lit(0.0))
    offset = unit(F.concat(F.lit(seed), F.lit(":"), F.coalesce(F.col("__source"), F.lit("\x00"))))
    held = held.withColumn("__place", place).withColumn("__rate", rate).withColumn("__offset", offset)
    copies = F.floor(F.col("__place") * F.col("__rate") + F.col("__offset")) - F.floor((F.col("__place") - 1) * F.col("__rate") + F.col("__offset"))
    return held.withColumn("__copies", copies).select(*unpacked(names, ADDED), *ADDED)


def take(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with its own columns."""
    mixed = mix(packed(docs).select("doc", "doc.doc_id", "doc.text", "doc.source"), **how)
    return mixed.where("__copies > 0").select("doc", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int")))).select("doc.*")
