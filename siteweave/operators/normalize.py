"""From a raw table of either source to the normalized record."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteweave.functions import geo, text

CANONICAL = [
    "source", "source_row", "source_primary_id", "site_id", "datacenter_id", "campus_id", "campus_name", "part_of_campus", "company_raw", "facility_owner_raw",
    "facility_name_raw", "street_address_raw", "city_raw", "state_raw", "postal_code_raw", "country_raw", "latitude_raw", "longitude_raw",
]


def _id(raw: DataFrame, name: str) -> Column:
    return text.number_text(F.col(f"`{name}`")) if dict(raw.dtypes)[name] in ("double", "float") else F.col(f"`{name}`").cast("string")


def canonical_a(raw: DataFrame) -> DataFrame:
    """Source A: state and postal code are read from the address; the owner is the company."""
    site = _id(raw, "Site Id")
    raw = raw.withColumn("__address", text.ascii_text(F.col("Address")))  # folded once, read several times
    values = {
        "source": F.lit("A"), "source_row": F.col("source_row").cast("long"), "source_primary_id": site, "site_id": site, "company_raw": F.col("`Company Name`"),
        "facility_owner_raw": F.col("`Company Name`"), "facility_name_raw": F.col("`DC Name`"), "street_address_raw": F.col("Address"), "city_raw": F.col("City"),
        "state_raw": text.state_in_address(F.col("__address"), text.FOLDED), "postal_code_raw": text.postal(F.col("__address"), text.FOLDED), "country_raw": F.col("Country"),
        "latitude_raw": F.col("Latitude"), "longitude_raw": F.col("Longitude"),
    }
    return raw.select(*[values.get(c, F.lit("")).alias(c) for c in CANONICAL])


def canonical_b(raw: DataFrame) -> DataFrame:
    """Source B: campus, owner, state and postal code have columns of their own."""
    own = {
        "source_primary_id": "Datacenter ID", "datacenter_id": "Datacenter ID", "campus_id": "Campus ID", "campus_name": "Campus Name", "part_of_campus": "Part of Campus?",
        "company_raw": "Company", "facility_owner_raw": "Facility Owner", "facility_name_raw": "Datacenter Name", "street_address_raw": "Street Address", "city_raw": "City",
        "state_raw": "State or Province", "postal_code_raw": "Postal Code", "country_raw": "Country",
    }
    values = {c: _id(raw, n) for c, n in own.items()} | {
        "source": F.lit("B"), "source_row": F.col("source_row").cast("long"), "latitude_raw": F.col("Latitude"), "longitude_raw": F.col("Longitude"),
    }
    return raw.select(*[values.get(c, F.lit("")).alias(c) for c in CANONICAL])


RAW = ["company_raw", "facility_owner_raw", "facility_name_raw", "street_address_raw", "city_raw", "state_raw", "postal_code_raw"]


@lru_cache(2)
def _norms(with_country: bool) -> tuple[list[dict[str, Column]], list[str]]:
    """The steps of ``with_norms`` and the columns that go again. Built once: expressions by name belong to no table.

    The raw fields are folded and compacted as one array by one expression each, not by one for every field.
    """
    raw = RAW
    folded = F.transform(F.array(*[F.col(c).cast("string") for c in raw]), text.ascii_text)
    compacted = F.transform(F.col("__folded"), lambda t: text.compact(t, text.FOLDED))
    f = {c: F.get("__folded", F.lit(k)) for k, c in enumerate(raw)}
    w = {c: F.get("__words", F.lit(k)) for k, c in enumerate(raw)}
    fields = {
        "company_norm": text.company(w["company_raw"], text.COMPACT),
        "facility_owner_norm": text.company(w["facility_owner_raw"], text.COMPACT),
        "facility_name_norm": w["facility_name_raw"],
        "street_address_norm": text.address(w["street_address_raw"], text.COMPACT),
        "city_norm": w["city_raw"],
        "state_norm": text.state(w["state_raw"], text.COMPACT),
        "postal_code_norm": F.coalesce(F.nullif(w["postal_code_raw"], F.lit("")), text.compact(text.postal(f["street_address_raw"], text.FOLDED), text.FOLDED)),
        "latitude": geo.to_float(F.col("latitude_raw")),
        "longitude": geo.to_float(F.col("longitude_raw")),
    }
    first = {"__folded": folded}
    if with_country:  # by itself: filters on it are pushed down, and shouldn't take the other fields with them
        first["__country"] = text.ascii_text(F.col("country_raw"))
        fields["country_standard"] = text.country(F.col("__country"), text.FOLDED)
    lat, lon = F.col("latitude"), F.col("longitude")
    truncated = {"lat_trunc_3": geo.truncate3(lat), "lon_trunc_3": geo.truncate3(lon)}
    last = {
        "coord_trunc_3_key": geo.coordinate_key(F.col("lat_trunc_3"), F.col("lon_trunc_3")),
        "lat_round_4": geo.round_half_even(lat, 4),
        "lon_round_4": geo.round_half_even(lon, 4),
    }
    return [first, {"__words": compacted}, fields, truncated, last], ["__folded", "__words", "__country"]


def with_norms(df: DataFrame, with_country: bool = True) -> DataFrame:
    """The normalized fields beside the raw ones. A missing postal code is looked for in the address."""
    steps, gone = _norms(with_country)
    for step in steps:
        df = df.withColumns(step)
    return df.drop(*gone)
