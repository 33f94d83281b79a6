"""Ordered consolidation of groups of records, by two levels of partial aggregation instead of whole groups.

Values are unpivoted to (group, field, value) and counted, with the place of the first occurrence; only the distinct values
of a group meet. So a group with very many records is aggregated before it is shuffled.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteweave.config import REASON, RULES
from siteweave.functions import geo, text
from siteweave.operators.normalize import with_norms
from siteweave.recovery import cut, settled, spread

MODES = ["street_address_raw", "city_raw", "state_raw", "postal_code_raw", "country_raw", "country_standard"]
LISTS = {
    "source_primary_ids": ("source_primary_id", False), "site_ids": ("site_id", False), "datacenter_ids": ("datacenter_id", False), "campus_ids": ("campus_id", False),
    "campus_names": ("campus_name", True), "company_raw": ("company_raw", True), "facility_owner_raw": ("facility_owner_raw", True),
    "facility_name_raw": ("facility_name_raw", True), "member_source_rows": ("source_row", False), "cells_fine": ("cell_fine", False), "cells_coarse": ("cell_coarse", False),
}


@lru_cache(4)
def folded_value() -> Column:
    return text.ascii_text(F.col("p.value"))


@lru_cache(8)
def cell_column(cell: geo.CellFunction, level: str) -> Column:
    return cell(F.col("latitude"), F.col("longitude"), level)


def group_values(df: DataFrame, keys: list[str], order: str, fields: list[str]) -> DataFrame:
    """(keys, field, value, n, first): how often each non-empty value occurs in its group, and where first."""
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])
    long = df.select(*keys, F.col(order).alias("__at"), F.explode(pairs).alias("p"))
    long = long.select(*keys, "__at", "p.field", folded_value().alias("value")).where("value <> ''")
    return long.groupBy(*keys, "field", "value").agg(F.count(F.lit(1)).alias("n"), F.min("__at").alias("first"))


def mode_value(value: str = "value", n: str = "n", first: str = "first") -> Column:
    """The most frequent value; of several, the one seen first."""
    return F.max_by(value, F.struct(F.col(n), -F.col(first), F.col(value)))


def first_value(value: str = "value", first: str = "first") -> Column:
    return F.min_by(value, F.struct(F.col(first), F.col(value)))


def unique_list(value: str = "value", first: str = "first") -> Column:
    """The distinct values in the order in which they were first seen."""
    return F.transform(F.sort_array(F.collect_list(F.struct(F.col(first).alias("f"), F.col(value).alias("v")))), lambda x: x["v"])


def joined(values: Column, limit: int | None = None) -> Column:
    """A list as text; beyond ``limit`` values only their number is told."""
    if limit is None:
        return F.array_join(values, " | ")
    more = F.concat(F.lit("... ("), (F.size(values) - limit).cast("string"), F.lit(" more)"))
    return F.array_join(F.when(F.size(values) > limit, F.concat(F.slice(values, 1, limit), F.array(more))).otherwise(values), " | ")


def consolidate(df: DataFrame, key: str, cell: geo.CellFunction = geo.hex_cell, limit: int = RULES.list_limit) -> DataFrame:
    """One logical record for each value of ``key``; needs the canonical columns, country_standard, latitude, longitude, ord.

    The normalized fields are made anew from the consolidated raw values. ``ord`` is the first member's.
    """
    held = df.withColumns({f"cell_{level}": cell_column(cell, level) for level in ("fine", "coarse")})
    fields = sorted({*MODES, *(f for f, _ in LISTS.values()), "source"})
    values = group_values(held, [key], "ord", fields)
    per_field = values.groupBy(key, "field").agg(mode_value().alias("mode"), unique_list().alias("list"))
    pick = lambda f, c: F.max(F.when(F.col("field") == f, F.col(c)))
    empty = F.array().cast("array<string>")
    wide = per_field.groupBy(key).agg(*[F.coalesce(pick(f, "list"), empty).alias(f"l_{f}") for f in fields], *[F.coalesce(pick(f, "mode"), F.lit("")).alias(f"m_{f}") for f in MODES])
    mean = lambda c: geo.round_half_even(F.avg(F.col(c).cast("decimal(28,12)")).cast("double"), 8)
    counts = held.groupBy(key).agg(F.count(F.lit(1)).alias("member_count"), F.min("ord").alias("ord"), mean("latitude").alias("latitude_raw"), mean("longitude").alias("longitude_raw"), F.min_by("dedupe_reason", "ord").alias("dedupe_reason"))
    out = counts.join(wide, key)
    lists = {name: joined(F.col(f"l_{f}"), limit if limited else None) for name, (f, limited) in LISTS.items() if not name.startswith("cells")}
    cells = {name: F.col(f"l_{LISTS[name][0]}") for name in ("cells_fine", "cells_coarse")}
    modes = {f: F.col(f"m_{f}") for f in MODES} | {"postal_code_raw": F.coalesce(F.nullif(F.col("m_postal_code_raw"), F.lit("")), text.postal(F.col("m_street_address_raw"), True))}
    shaped = out.select(
        F.col(f"`{key}`").alias("logical_record_id"), "ord", "member_count", F.coalesce(F.get("l_source", F.lit(0)), F.lit("")).alias("source"),
        "dedupe_reason", "latitude_raw", "longitude_raw", *[c.alias(n) for n, c in (lists | cells | modes).items()],
    )
    return with_norms(spread(shaped, "logical_record_id"), with_country=False).drop("latitude_raw", "longitude_raw")


def group_key(source: str) -> Column:
    """What records of one logical site share: site id in A; in B the campus of a campus member, else the data center id."""
    by_row = F.concat(F.lit("row:"), F.col("source_row").cast("string"))
    told = lambda prefix, c: F.when(text.ascii_text(F.col(c)) != "", F.concat(F.lit(prefix), text.ascii_text(F.col(c))))
    if source == "A":
        return F.coalesce(told("site:", "site_id"), by_row)
    name = text.compact(F.col("campus_name"))
    named = F.when(name != "", F.concat_ws(":", F.lit("campus_name"), name, F.col("city_norm"), F.col("state_norm")))
    return F.coalesce(F.when(text.is_yes(F.col("part_of_campus")), F.coalesce(told("campus:", "campus_id"), named)), told("dcid:", "datacenter_id"), by_row)


def primary_dedupe(records: DataFrame, source: str, cell: geo.CellFunction = geo.hex_cell) -> DataFrame:
    """Normalized records of one source, consolidated by their ids.

    They are kept first: consolidation reads them twice, and the plan of normalizing them shouldn't be optimized twice more.
    """
    held = settled(cut(records.withColumns({"__key": group_key(source), "ord": F.col("source_row"), "dedupe_reason": F.lit(REASON[source])})))
    return consolidate(held, "__key", cell=cell)
