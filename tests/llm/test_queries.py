"""Queries beside their SQL, the pipeline's stages, and the tables' clashing columns."""

import os
import pathlib

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="needs the driver's tables")


@pytest.mark.parametrize("name", ["op4_mixing", "op6_line_dedup", "op8_warc"])
def test_sql(spark, name):
    import duckdb

    import __spark_entry__ as entry

    con = duckdb.connect()
    for path in pathlib.Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    got = entry.queries()[name](spark, SF)
    columns = sorted(got.columns)
    wanted = con.execute(f"SELECT {', '.join(columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(repr, wanted))


def test_all_ten_are_registered():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11)) and "pipeline" in entry.queries()


def test_pipeline(spark):
    import corpus_pipeline as p
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns({"size": F.lit(1), "row": F.lit("x"), "node": F.lit(2)})
    columns, seen = docs.columns, []
    for name, stage in p.STAGES:
        before, docs = docs, stage(spark, docs, SF).persist()
        seen.append((name, before.count(), docs.count()))
        if name != "byte_bpe":
            assert docs.columns == columns, name
    counts = {name: (a, b) for name, a, b in seen}
    assert counts["quality_rules"][1] < counts["quality_rules"][0]
    assert counts["line_dedup"][0] == counts["line_dedup"][1]
    assert counts["near_dedup"][1] <= counts["near_dedup"][0]
    assert counts["byte_bpe"][0] == counts["byte_bpe"][1] and docs.where("NOT round_trip").count() == 0


def test_stages_with_python_workers_collect_garbage_first(spark):
    """Their workers stood beside heaps that the stages before them had made grow to the limit."""
    import corpus_pipeline

    beans = spark.sparkContext._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans
    whole = lambda: sum(b.getCollectionCount() for b in beans() if "Old" in b.getName() or "MarkSweep" in b.getName())
    docs, before = spark.createDataFrame([(1, "a b", "s")], "doc_id long, text string, source string"), whole()
    assert corpus_pipeline.encoding(spark, docs, "").first().round_trip and whole() > before
