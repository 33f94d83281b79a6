"""The two-source example with outcomes derived by hand; its cells are given, so they don't hang on a grid."""

import random

import pytest
from pyspark.sql import functions as F

from siteweave import recovery
from siteweave.operators import assign, blocking, cluster, consolidate
from siteweave.plans import linkage
from siteweave.sources import sinks
from siteweave.sources.tables import SCHEMA_A, SCHEMA_B

A = [
    ("1", "Acme Inc", "Acme DC1", "100 Main St, Springfield, IL 62701", "Springfield", "USA", "39.8001", "-89.6501"),
    ("1", "Acme Inc", "Acme DC1 Annex", "100 Main Street, Springfield, IL 62701", "Springfield", "USA", "39.8001", "-89.6501"),
    ("3", "Borealis LLC", "Borealis North", "55 Lake Dr, Duluth, MN 55802", "Duluth", "United States", "46.7801", "-92.1001"),
    ("4", "Cobalt Corp", "Cobalt East", "7 Oak Ave, Reno, NV 89501", "Reno", "U.S.", None, None),
    ("5", "Delta", "Delta One", "1 King St, Toronto", "Toronto", "Canada", "43.65", "-79.38"),
    ("6", "Echo Ltd", "Echo One", "9 Elm Ct, Boise, ID 83702", "Boise", "USA", "43.615", "-116.202"),
]
B = [
    ("D1", None, None, None, "Acme Corporation", "Acme", "Acme DC1", "100 Main St", "Springfield", "Illinois", "62701", "USA", "39.8001", "-89.6501"),
    ("D2", "C9", "Campus", "Yes", "Borealis", "Borealis", "Borealis N1", "55 Lake Drive", "Duluth", "Minnesota", "55802", "USA", "46.7821", "-92.1001"),
    ("D3", "C9", "Campus", "Yes", "Borealis", "Borealis", "Borealis N2", "55 Lake Drive", "Duluth", "MN", "55802", "USA", "46.7821", "-92.1001"),
    ("D4", None, None, None, "Cobalt", "Cobalt", "Cobalt East", "7 Oak Avenue", "Reno", "Nevada", "89501", "USA", None, None),
    ("D5", None, None, None, "Foxtrot", "Foxtrot", "Fox One", "1 Pine Rd", "Salem", "Oregon", "97301", "USA", "44.94", "-123.03"),
]


def raw(spark, rows, schema):
    return spark.createDataFrame([(*r, k + 2) for k, r in enumerate(rows)], schema + ", source_row long")


def given_cells(logical):
    """f1/c1 and so on by latitude: Duluth has two fine cells and one coarse one."""
    fine = F.when(F.col("latitude") == 39.8001, "f1").when(F.col("latitude") == 46.7801, "f3").when(F.col("latitude") == 46.7821, "f4").when(F.col("latitude") == 43.615, "f6").when(F.col("latitude") == 44.94, "f7")
    coarse = F.when(F.floor("latitude") == 46, "c3").otherwise(F.replace(fine, F.lit("f"), F.lit("c")))
    put = lambda c: F.when(c.isNotNull(), F.array(c)).otherwise(F.array().cast("array<string>"))
    return logical.withColumns({"cells_fine": put(fine), "cells_coarse": put(coarse)})


@pytest.fixture(scope="module")
def linked(spark):
    a_us, b_us = linkage.normalized(raw(spark, A, SCHEMA_A), "A"), linkage.normalized(raw(spark, B, SCHEMA_B), "B")
    return linkage.link(a_us, b_us, logical=(given_cells(linkage.deduped(a_us, "A")), given_cells(linkage.deduped(b_us, "B"))))


def test_logical_ids(linked):
    ids = lambda df: {r.logical_record_id: r.member_count for r in df.collect()}
    assert ids(linked.a) == {f"site:{k}": 1 for k in (1, 3, 4, 6)}
    assert ids(linked.b) == {"dcid:D1": 1, "campus:C9": 1, "dcid:D4": 1, "dcid:D5": 1}


def test_funnel(linked):
    rows = [tuple(r)[1:] for r in linked.summary().orderBy("stage").collect()]
    assert rows == [(5, 5, 0, 5, 5, 10), (4, 4, 0, 4, 4, 8), (4, 4, 1, 3, 3, 6), (4, 4, 2, 2, 2, 4), (4, 4, 3, 1, 1, 0)]


def test_matches(linked):
    found = {(r.a_logical_id, r.b_logical_id): r for r in linked.matches().collect()}
    assert set(found) == {("site:1", "dcid:D1"), ("site:3", "campus:C9"), ("site:4", "dcid:D4")}
    fine, coarse, manual = (found[k] for k in (("site:1", "dcid:D1"), ("site:3", "campus:C9"), ("site:4", "dcid:D4")))
    assert (fine.match_reason, fine.combined_score, fine.cell) == ("exact fine cell", 100.0, "f1")
    assert (coarse.match_reason, coarse.facility_name_score, coarse.combined_score) == ("coarse cell plus name match", 72.73, 100.0)
    assert (manual.match_stage, manual.manual_label) == ("manual review", "Highly likely match")


def test_review_and_tabs(linked, tmp_path, spark):
    rows = linked.review().collect()
    assert sorted((r.review_source, r.review_label) for r in rows) == [("A", "Definitely unique"), ("A", "Highly likely match"), ("B", "Definitely unique"), ("B", "Highly likely match")]
    assert {r.a_logical_id or r.b_logical_id for r in rows if r.review_label == "Definitely unique"} == {"site:6", "dcid:D5"}
    sinks.write_tabs(linked.tabs(), str(tmp_path))
    assert sorted(p.name for p in tmp_path.iterdir()) == sorted(sinks.TABS)
    assert spark.read.parquet(str(tmp_path / "match_pairs")).count() == 3


def test_empty_sources(spark):
    a, b = linkage.normalized(raw(spark, [], SCHEMA_A), "A"), linkage.normalized(raw(spark, B, SCHEMA_B), "B")
    found = linkage.link(a, b)
    assert found.matches().count() == 0 and found.left_b.count() == 4


def test_left_root_wins():
    import pandas as pd

    edge = lambda *pairs: pd.DataFrame([(a, f"r{a}", b, f"r{b}") for a, b in pairs], columns=["a_ord", "a_id", "b_ord", "b_id"])
    assert set(cluster._roots(edge((0, 2), (1, 2)))["root"]) == {"r1"}
    assert set(cluster._roots(edge((0, 1), (1, 2)))["root"]) == {"r0"}


def test_buckets_that_cross_batches_keep_their_roots():
    import pandas as pd

    rows = [(1.0, 1.0, 0, "p0", 1, "p1"), (1.0, 1.0, 1, "p1", 2, "p2"), (1.0, 2.0, 3, "p3", 4, "p4"), (2.0, 1.0, 5, "p5", 6, "p6")]
    edges = pd.DataFrame(rows, columns=["lat_round_4", "lon_round_4", "a_ord", "a_id", "b_ord", "b_id"])
    found = pd.concat(cluster._bucket_roots(edges[k : k + 1] for k in range(len(edges))))
    assert dict(found.itertuples(index=False)) == {"p0": "p0", "p1": "p0", "p2": "p0", "p3": "p3", "p4": "p3", "p5": "p5", "p6": "p5"}
    assert not len(list(cluster._bucket_roots(iter([]))))


def test_ordered_values(spark):
    df = spark.createDataFrame([(1, k, v) for k, v in enumerate(["b", "a", "a", "b", "", None])] + [(2, k, f"v{k}") for k in range(1, 11)], "g int, k int, v string")
    values = consolidate.group_values(df, ["g"], "k", ["v"]).groupBy("g").agg(consolidate.mode_value().alias("m"), consolidate.joined(consolidate.unique_list(), 8).alias("u"), consolidate.first_value().alias("f"))
    rows = {r.g: (r.m, r.u, r.f) for r in values.collect()}
    assert rows[1] == ("b", "b | a", "b")
    assert rows[2][1] == " | ".join([*(f"v{k}" for k in range(1, 9)), "... (2 more)"])


@pytest.mark.parametrize("seed", [1, 2])
def test_rounds_are_sequential_greedy(spark, seed):
    draw = random.Random(seed)
    edges = {(draw.randint(0, 14), draw.randint(0, 14)): draw.randint(1, 5) for _ in range(80)}
    df = spark.createDataFrame([(a, b, float(w), 1.0) for (a, b), w in edges.items()], "a_ord long, b_ord long, combined_score double, address_score double")
    used, wanted = set(), set()
    for a, b in sorted(edges, key=lambda e: (-edges[e], *e)):
        if not {("a", a), ("b", b)} & used:
            used |= {("a", a), ("b", b)}
            wanted.add((a, b))
    assert {(r.a_ord, r.b_ord) for r in assign.greedy(df, assign.by_scores).collect()} == wanted


@pytest.mark.parametrize("at_once", [1, 7, 1000])
def test_greedy_keeps_no_round_for_each_link_of_a_chain(spark, at_once, monkeypatch):
    """Equal scores on all pairs outdo one another by ordinals, in a chain as long as the block."""
    n, kept, real = 12, [], assign.stored
    monkeypatch.setattr(assign, "stored", lambda df: kept.append(1) or real(df))
    df = spark.range(n * n).selectExpr("id div 12 AS a_ord", "id % 12 AS b_ord", "80.0D AS combined_score", "1.0D AS address_score")
    found = assign.greedy(df, assign.by_scores, at_once)
    assert {(r.a_ord, r.b_ord) for r in found.collect()} == {(k, k) for k in range(n)}
    if at_once == 1000:
        assert len(kept) == 2  # the edges and one round


def test_review_pass_is_greedy_over_all_scored_pairs(spark):
    draw = random.Random(5)
    text = "ord long, core string, number string, company_norm string, facility_owner_norm string, facility_name_norm string, city_norm string, state_norm string, postal_code_norm string"
    sides = []
    for n in (25, 20):
        rows = []
        for k in range(n):
            number, company = draw.choice(["", "12", "14", "15"]), f"brand {draw.randint(1, 4)}"
            rows.append((k, f"{number} {draw.choice(['main', 'oak'])} street".strip(), number, company, draw.choice([company, "zeta"]), draw.choice(["hall", "north hall"]), draw.choice("xy"), "tx", draw.choice(["", "1", "2"])))
        sides.append(spark.createDataFrame(rows, text))
    a, b = sides
    scored = blocking.scored(blocking.review_candidates(a, b), a, b).where(assign.review_floor()).withColumn("label", assign.review_label()).where("label IS NOT NULL").collect()
    used, wanted = set(), set()
    for r in sorted(scored, key=lambda r: (-r.combined_score, r.a_ord, r.b_ord)):
        if not {("a", r.a_ord), ("b", r.b_ord)} & used:
            used |= {("a", r.a_ord), ("b", r.b_ord)}
            wanted.add((r.a_ord, r.b_ord, r.combined_score, r.label))
    above = [w[2] > assign.most_apart() for w in wanted]
    assert any(above) and not all(above)
    assert {(r.a_ord, r.b_ord, r.combined_score, r.manual_label) for r in linkage.review_pass(a, b).collect()} == wanted


def test_small_tables_are_cleansed_by_all_cores(spark):
    a = linkage.normalized(raw(spark, A, SCHEMA_A).coalesce(1), "A")
    assert a.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_pair_is_scored_once_by_one_function(linked):
    """Filters on the scores were pushed below them, and each of the five texts was a function of its own: ten Python workers in a task."""
    pairs = blocking.review_pairs(linked.a, linked.b, fields=blocking.SCORED)
    held = linkage.with_scores(pairs, linkage.RULES).where(assign.review_floor()).withColumn("label", assign.review_label()).where("label IS NOT NULL")
    assert plan_of(held).count("ArrowEvalPython") == 1


def test_summary_counts_each_table_once(linked):
    plan = plan_of(linked.summary())
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert plan.count("partial_count(1)") == 9


def test_block_pairs_shuffle_records_once(linked, monkeypatch):
    pairs = lambda: blocking.block_pairs(linked.a, linked.b, ["state_norm"], ["ord"])
    few, found = plan_of(pairs()), sorted(map(tuple, pairs().select("a_ord", "b_ord").collect()))
    assert few.count("BroadcastHashJoin") >= 2
    monkeypatch.setattr(blocking, "BROADCAST", 0)
    assert sorted(map(tuple, pairs().select("a_ord", "b_ord").collect())) == found


def test_passes_give_back_the_drivers_memory(spark, monkeypatch):
    """What the JVM frees outside its heap stays its own until it is trimmed; planning a pass takes some hundred MB of it."""
    said, real = [], recovery.trimmed
    monkeypatch.setattr(recovery, "trimmed", lambda s: said.append(real(s)))
    a, b = (linkage.normalized(raw(spark, rows, schema), s) for rows, schema, s in ((A, SCHEMA_A, "A"), (B, SCHEMA_B, "B")))
    linkage.link(a, b).review()
    assert len(said) >= 12 and all("Trim native heap" in x for x in said)


def test_greedy_gives_back_what_its_edges_took(spark, monkeypatch):
    """The driver collected and trimmed only after a whole pass, so not before the rounds and the join with their result were planned."""
    said, kept, real = [], [], assign.stored
    monkeypatch.setattr(recovery, "trimmed", lambda s: said.append(len(kept)))
    monkeypatch.setattr(assign, "stored", lambda df: kept.append(1) or real(df))
    df = spark.createDataFrame([(1, 1, 90.0, 1.0), (1, 2, 95.0, 1.0)], "a_ord long, b_ord long, combined_score double, address_score double")
    assert [(r.a_ord, r.b_ord) for r in assign.greedy(df, assign.by_scores).collect()] == [(1, 2)]
    assert said == [1]  # when the edges are kept, before the first round
