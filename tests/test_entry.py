"""The driver's contract, and some queries beside their SQL on the smallest tables."""

import pathlib

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not pathlib.Path(SF).exists(), reason="needs the driver's tables")
@pytest.mark.parametrize("name", ["norm_company", "extract_state", "street_core", "cells_fine", "group_mode", "group_join_unique", "token_set_pairs", "primary_dedupe"])
def test_query_is_its_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for path in pathlib.Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    got = entry.queries()[name](spark, SF)
    columns = sorted(got.columns)
    wanted = con.execute(f"SELECT {', '.join(columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(repr, wanted))
