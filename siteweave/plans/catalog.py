"""The registered queries of the linkage engine and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteweave.config import RULES
from siteweave.functions import geo, similarity, text
from siteweave.operators import assign, blocking, cluster, consolidate
from siteweave.plans import linkage
from siteweave.plans import oracles as o
from siteweave.sources.tables import derived_sites, raw_a, raw_b

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):  # noqa: ANN202
    def register(f):  # noqa: ANN001, ANN202
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _us(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    sites = derived_sites(spark, sf_dir)
    return linkage.normalized(raw_a(sites), "A"), linkage.normalized(raw_b(sites), "B")


SITES = f"WITH sites AS ({o.SITES_SQL}) "


@_query("text_fold", f"SELECT doc_id, {o.fold('text')} AS folded FROM documents")
def text_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", text.ascii_text(F.col("text")).alias("folded"))


@_query("text_fold_exact", f"SELECT item_id, {o.fold('text')} AS folded FROM benchmark")
def text_fold_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "benchmark").select("item_id", text.fold_exact(F.col("text")).alias("folded"))


@_query("text_compact", f"SELECT conv_id, turn, {o.compact('text')} AS words FROM conversations")
def text_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "conversations").select("conv_id", "turn", text.compact(F.col("text")).alias("words"))


def _site_column(name: str, expression, sql: str) -> None:  # noqa: ANN001
    @_query(name, f"{SITES} SELECT source, source_row, {sql} AS value FROM sites")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return derived_sites(spark, sf_dir).select("source", "source_row", expression().alias("value"))


_site_column("norm_company", lambda: text.company(F.col("company_raw")), o.company("company_raw"))
_site_column("norm_address", lambda: text.address(F.col("street_address_raw")), o.address("street_address_raw"))
_site_column("norm_state", lambda: text.state(F.col("state_raw")), o.state("state_raw"))
_site_column("norm_country", lambda: text.country(F.col("country_raw")), o.country("country_raw"))
_site_column("extract_postal", lambda: text.postal(F.col("street_address_raw")), o.postal("street_address_raw"))
_site_column("extract_state", lambda: text.state_in_address(F.col("street_address_raw")), o.state_in_address("street_address_raw"))
_site_column("cells_fine", lambda: geo.hex_cell(F.col("latitude"), F.col("longitude"), "fine"), o.cell("fine"))
_site_column("cells_coarse", lambda: geo.hex_cell(F.col("latitude"), F.col("longitude"), "coarse"), o.cell("coarse"))


@_query("street_core", f"WITH {o.normalized()}, c AS (SELECT *, {o.core()} AS core FROM norm) SELECT source, source_row, core, {o.number()} AS number FROM c WHERE country_standard = 'United States'")
def street_core(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _us(spark, sf_dir)
    return blocking.with_core(a.unionByName(b)).select("source", "source_row", "core", "number")


@_query(
    "coord_keys",
    f"""{SITES} SELECT source, source_row, {o.trunc3('latitude')} AS lat_trunc_3, {o.trunc3('longitude')} AS lon_trunc_3, {o.half_even('latitude', 4)} AS lat_round_4, {o.half_even('longitude', 4)} AS lon_round_4,
  CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN format('{{:.3f}},{{:.3f}}', {o.trunc3('latitude')}, {o.trunc3('longitude')}) ELSE '' END AS coord_trunc_3_key FROM sites""",
)
def coord_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lat, lon = (geo.to_float(F.col(c).cast("string")) for c in ("latitude", "longitude"))
    held = derived_sites(spark, sf_dir).select("source", "source_row", geo.truncate3(lat).alias("lat_trunc_3"), geo.truncate3(lon).alias("lon_trunc_3"), geo.round_half_even(lat, 4).alias("lat_round_4"), geo.round_half_even(lon, 4).alias("lon_round_4"))
    return held.withColumn("coord_trunc_3_key", geo.coordinate_key(F.col("lat_trunc_3"), F.col("lon_trunc_3")))


PAIRS_SQL = "SELECT p.p_partkey AS id, p.p_name || ' ' || p.p_brand AS a, q.p_name || ' ' || q.p_type AS b FROM part p JOIN part q ON q.p_partkey = p.p_partkey + 1"
TOKEN_SQL = f"WITH pairs AS ({PAIRS_SQL}), {o.token_set('t', 'SELECT a, b FROM pairs')} SELECT id, {o.half_even('score', 2)} AS score FROM pairs JOIN t USING (a, b)"


def _name_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(PAIRS_SQL.replace("FROM part p JOIN part q", "FROM {part} p JOIN {part} q"), part=_table(spark, sf_dir, "part"))


@_query("token_set_pairs", TOKEN_SQL)
def token_set_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _name_pairs(spark, sf_dir).select("id", geo.round_half_even(similarity.token_set(F.col("a"), F.col("b")), 2).alias("score"))


@_query("token_set_native", TOKEN_SQL)
def token_set_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _name_pairs(spark, sf_dir).select("id", geo.round_half_even(similarity.token_set_native(F.col("a"), F.col("b")), 2).alias("score"))


def _groups(table: str, key: str, order: str, value: str, name: str, aggregate, sql: str) -> None:  # noqa: ANN001
    @_query(name, f"WITH g AS (SELECT {key}, {o.ordered(value, order)} AS l FROM {table} GROUP BY {key}), d AS (SELECT {key}, l, {o.distinct('l')} AS u FROM g) SELECT {key}, {sql} AS value FROM d")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        values = consolidate.group_values(_table(spark, sf_dir, table), [key], order, [value])
        return values.groupBy(key).agg(aggregate().alias("value"))


_groups("part", "p_brand", "p_partkey", "p_type", "group_mode", consolidate.mode_value, o.mode("l"))
_groups("part", "p_brand", "p_partkey", "p_name", "group_join_unique", lambda: consolidate.joined(consolidate.unique_list(), RULES.list_limit), o.joined("u", 8))
_groups("events", "user_id", "event_id", "event_type", "group_first", consolidate.first_value, "l[1]")
_groups("orders", "o_custkey", "o_orderkey", "o_orderpriority", "group_mode_orders", consolidate.mode_value, o.mode("l"))


@_query("centroid", f"{SITES} SELECT city_raw, count(*) AS n, {o.half_even('CAST(avg(CAST(latitude AS DECIMAL(28, 12))) AS DOUBLE)', 8)} AS latitude FROM sites GROUP BY city_raw")
def centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    mean = F.avg(F.col("latitude").cast("decimal(28,12)")).cast("double")
    return derived_sites(spark, sf_dir).groupBy("city_raw").agg(F.count(F.lit(1)).alias("n"), geo.round_half_even(mean, 8).alias("latitude"))


SHOWN = [
    "source", "ord", "member_count", "dedupe_reason", "source_primary_ids", "member_source_rows", "company_raw", "facility_name_raw", "street_address_raw", "city_raw", "state_raw",
    "postal_code_raw", "country_raw", "latitude", "longitude", "company_norm", "street_address_norm", "city_norm", "state_norm", "postal_code_norm", "lat_round_4", "lon_round_4",
]
CHAIN = o.chain()
CELLS = "array_to_string(cells_fine, ' | ') AS cells_fine, array_to_string(cells_coarse, ' | ') AS cells_coarse"


@_query("primary_dedupe", f"{CHAIN} SELECT logical_record_id, {', '.join(SHOWN)}, {CELLS} FROM prim")
def primary_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (consolidate.primary_dedupe(df, s) for df, s in zip(_us(spark, sf_dir), "AB", strict=True))
    cells = [F.array_join(c, " | ").alias(c) for c in ("cells_fine", "cells_coarse")]
    return a.unionByName(b).select("logical_record_id", *SHOWN, *cells)


FUZZY = ", ".join("dedupe_reason || CASE WHEN member_count > 1 THEN '; coordinate/address fuzzy dedupe' ELSE '' END AS dedupe_reason" if c == "dedupe_reason" else c for c in SHOWN)


@_query("fuzzy_dedupe", f"{CHAIN} SELECT {FUZZY}, {CELLS} FROM fuz")
def fuzzy_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (linkage.deduped(df, s) for df, s in zip(_us(spark, sf_dir), "AB", strict=True))
    cells = [F.array_join(c, " | ").alias(c) for c in ("cells_fine", "cells_coarse")]
    return a.unionByName(b).select(*SHOWN, *cells)


@_query("bucket_edges", f"{CHAIN} SELECT source, a AS a_ord, b AS b_ord FROM links")
def bucket_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = [cluster.bucket_edges(consolidate.primary_dedupe(df, s)).select(F.lit(s).alias("source"), "a_ord", "b_ord") for df, s in zip(_us(spark, sf_dir), "AB", strict=True)]
    return found[0].unionByName(found[1])


SCORES = ["address_score", "company_score", "facility_name_score", "city_score", "state_match", "postal_match", "combined_score"]


def _logical(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [linkage.cut(blocking.with_core(linkage.deduped(df, s))) for df, s in zip(_us(spark, sf_dir), "AB", strict=True)]


@_query("cell_candidates", f"{CHAIN} SELECT a_ord, b_ord, cell, {', '.join(SCORES)} FROM fine_s")
def cell_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _logical(spark, sf_dir)
    return blocking.scored(blocking.cell_candidates(a, b, "cells_fine"), a, b).select("a_ord", "b_ord", "cell", *SCORES)


TEXT_SQL = CHAIN.replace("a2 AS MATERIALIZED (SELECT * FROM a1 x WHERE x.ord NOT IN (SELECT a_ord FROM coarse))", "a2 AS (SELECT * FROM a0)").replace(
    "b2 AS MATERIALIZED (SELECT * FROM b1 x WHERE x.ord NOT IN (SELECT b_ord FROM coarse))", "b2 AS (SELECT * FROM b0)"
)


@_query("or_blocking", f"{TEXT_SQL} SELECT a_ord, b_ord FROM near_1")
def or_blocking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocking.text_candidates(*_logical(spark, sf_dir))


@_query("capped_state", f"{TEXT_SQL} SELECT a_ord, b_ord FROM review_c")
def capped_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocking.review_candidates(*_logical(spark, sf_dir))


@_query("match_fine", f"{CHAIN} SELECT a_ord, b_ord, cell, {', '.join(SCORES)} FROM fine")
def match_fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkage.cell_pass(*_logical(spark, sf_dir), "fine").select("a_ord", "b_ord", "cell", *SCORES)


@_query("fine_pass_predicate", f"{CHAIN} SELECT a_ord, b_ord FROM fine_k")
def fine_pass_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _logical(spark, sf_dir)
    return blocking.scored(blocking.cell_candidates(a, b, "cells_fine"), a, b).where(assign.pass_predicate(RULES.fine)).select("a_ord", "b_ord")


def _linked(spark: SparkSession, sf_dir: str) -> linkage.Linkage:
    return linkage.link(*_us(spark, sf_dir))


REASON = "CASE WHEN company_score >= address_score THEN 'coarse cell plus name match' ELSE 'coarse cell plus address match' END"


@_query("match_coarse", f"{CHAIN} SELECT a_ord, b_ord, cell, {REASON} AS match_reason, {', '.join(SCORES)} FROM coarse")
def match_coarse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _linked(spark, sf_dir).coarse.select("a_ord", "b_ord", "cell", "match_reason", *SCORES)


@_query("match_review", f"{CHAIN} SELECT a_ord, b_ord, manual_label, {', '.join(SCORES)} FROM review")
def match_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _linked(spark, sf_dir).manual.select("a_ord", "b_ord", "manual_label", *SCORES)


@_query("unmatched_a", f"{CHAIN} SELECT ord, company_raw, street_address_raw FROM a3")
def unmatched_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _linked(spark, sf_dir).left_a.select("ord", "company_raw", "street_address_raw")


@_query("unmatched_b", f"{CHAIN} SELECT ord, company_raw, street_address_raw FROM b3")
def unmatched_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _linked(spark, sf_dir).left_b.select("ord", "company_raw", "street_address_raw")


ALL_SQL = f"""{CHAIN}, m AS (SELECT 'fine cell' AS match_stage, 'exact fine cell' AS match_reason, CAST(NULL AS VARCHAR) AS manual_label, a_ord, b_ord, cell, combined_score FROM fine
  UNION ALL SELECT 'coarse cell', {REASON}, NULL, a_ord, b_ord, cell, combined_score FROM coarse UNION ALL SELECT 'manual review', 'manual review', manual_label, a_ord, b_ord, cell, combined_score FROM review)
SELECT match_stage, match_reason, manual_label, x.source_primary_ids AS a_source_ids, y.source_primary_ids AS b_source_ids, cell, combined_score, x.company_raw AS a_company_raw, y.company_raw AS b_company_raw,
  x.street_address_raw AS a_street_address_raw, y.street_address_raw AS b_street_address_raw FROM m JOIN a0 x ON x.ord = a_ord JOIN b0 y ON y.ord = b_ord"""


@_query("all_matches", ALL_SQL.replace(f"{CHAIN}, m AS", f"{CHAIN.rstrip()}, m AS"))
def all_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = ["match_stage", "match_reason", "manual_label", "a_source_ids", "b_source_ids", "cell", "combined_score", "a_company_raw", "b_company_raw", "a_street_address_raw", "b_street_address_raw"]
    return _linked(spark, sf_dir).matches().select(*shown)


@_query(
    "review",
    f"""{CHAIN} SELECT s.review_source, manual_label AS review_label, x.source_primary_ids AS a_source_ids, y.source_primary_ids AS b_source_ids, combined_score
  FROM review JOIN a0 x ON x.ord = a_ord JOIN b0 y ON y.ord = b_ord CROSS JOIN (SELECT unnest(['A', 'B']) AS review_source) s
UNION ALL SELECT 'A', 'Definitely unique', source_primary_ids, NULL, NULL FROM a3 UNION ALL SELECT 'B', 'Definitely unique', NULL, source_primary_ids, NULL FROM b3""",
)
def review(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _linked(spark, sf_dir).review().select("review_source", "review_label", "a_source_ids", "b_source_ids", "combined_score")


def _stage(name: str, a: str, b: str, m: str, last: bool = False) -> str:
    left_a, left_b = ("(SELECT count(*) FROM a3)", "(SELECT count(*) FROM b3)") if last else (f"greatest({a} - ({m}), 0)", f"greatest({b} - ({m}), 0)")
    return f"SELECT '{name}' AS stage, {a} AS a_records, {b} AS b_records, CAST({m} AS BIGINT) AS matched, CAST({left_a} AS BIGINT) AS unique_a, CAST({left_b} AS BIGINT) AS unique_b, CAST({'0' if last else f'{left_a} + {left_b}'} AS BIGINT) AS still_unmatched"


_N = "(SELECT count(*) FROM {})".format
_US = ["(SELECT count(*) FROM us WHERE source = 'A')", "(SELECT count(*) FROM us WHERE source = 'B')"]
FUNNEL_SQL = CHAIN + " UNION ALL ".join(
    [
        _stage("1. after US filtering", *_US, "0"),
        _stage("2. after within-source deduplication", _N("a0"), _N("b0"), "0"),
        _stage("3. after fine-cell matching", _N("a0"), _N("b0"), _N("fine")),
        _stage("4. after coarse-cell matching", _N("a0"), _N("b0"), f"{_N('fine')} + {_N('coarse')}"),
        _stage("5. after manual review", _N("a0"), _N("b0"), f"{_N('fine')} + {_N('coarse')} + {_N('review')}", last=True),
    ]
)


@_query("funnel", FUNNEL_SQL)
def funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _linked(spark, sf_dir).summary()
