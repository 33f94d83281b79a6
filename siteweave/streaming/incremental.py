"""Incremental linkage, an extension: new records of A, as they arrive, against the logical records of B."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from siteweave.operators.blocking import with_core
from siteweave.plans.linkage import cell_pass, deduped, normalized


def link_increment(raw_a: DataFrame, b: DataFrame) -> DataFrame:
    """Fine-cell matches of one batch of raw records of A against logical records of B (from ``with_core``)."""
    return cell_pass(with_core(deduped(normalized(raw_a, "A"), "A")), b, "fine")


def link_stream(raw_a: DataFrame, b: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """``link_increment`` for each batch of a stream, written as Parquet by batch number: a batch that runs again replaces its own."""

    def each(batch: DataFrame, number: int) -> None:
        link_increment(batch, b).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return raw_a.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
