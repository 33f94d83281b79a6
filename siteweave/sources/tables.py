"""Raw tables of both sources, with fixed schemas, from CSV, Parquet or a workbook; and the derived view of the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteweave.sources.xlsx import read_workbook

SCHEMA_A = "`Site Id` string, `Company Name` string, `DC Name` string, Address string, City string, Country string, Latitude string, Longitude string"
SCHEMA_B = (
    "`Datacenter ID` string, `Campus ID` string, `Campus Name` string, `Part of Campus?` string, Company string, `Facility Owner` string, `Datacenter Name` string, "
    "`Street Address` string, City string, `State or Province` string, `Postal Code` string, Country string, Latitude string, Longitude string"
)
SHEET = "Raw data"


def read_raw(spark: SparkSession, path: str, schema: str, kind: str = "parquet", sheet: str = SHEET) -> DataFrame:
    """A raw table with ``source_row``, the row that it has in a sheet with one header row.

    Workbooks know their rows. Parquet rows are numbered within their file; tables of several files, and CSV, must bring a
    ``source_row`` column of their own, since Spark has no order of rows.
    """
    if kind == "xlsx":
        return read_workbook(spark, path, schema, sheet)
    if kind == "csv":
        return spark.read.schema(schema + ", source_row long").option("header", True).csv(path)
    raw = spark.read.parquet(path)
    return raw if "source_row" in raw.columns else raw.withColumn("source_row", F.col("_metadata.row_index") + 2)


#: Sites of both sources made of the ``part`` table; the same text runs on Spark and DuckDB. Some sites of B stand where one of
#: A does but are others (``odd``), some of A are alone in their city, neighbours of a site compete, and some are on a campus.
SITES_SQL = """
SELECT CASE WHEN r < 2 THEN 'A' ELSE 'B' END AS source, p_partkey + 2 AS source_row,
  CAST(CASE WHEN g % 10 = 0 THEN g * 4 ELSE p_partkey END AS STRING) AS rec_id,
  CASE WHEN odd THEN 'Zeta Works ' || CAST(g AS STRING) WHEN r = 0 THEN p_brand || ' Inc.' WHEN r = 1 THEN 'The ' || p_brand || ' LLC' WHEN r = 2 THEN p_brand || ' & Co' ELSE p_brand END AS company_raw,
  CASE WHEN odd THEN 'Far Hall' ELSE p_name || ' DC' END AS facility_name_raw,
  CASE WHEN odd THEN CAST(900 + g AS STRING) || ' Quarry Pike' ELSE
  CAST(100 + g + CASE WHEN r = 1 AND g % 3 = 0 THEN 1 ELSE 0 END AS STRING)
    || CASE g % 4 WHEN 0 THEN ' Main St' WHEN 1 THEN ' Oak Ave' WHEN 2 THEN ' Park Blvd' ELSE ' Lake Dr' END
    || CASE WHEN r % 2 = 1 THEN ' Suite 5' ELSE '' END || ', City ' || CAST(g % 7 AS STRING) || ', '
    || CASE g % 5 WHEN 0 THEN 'TX' WHEN 1 THEN 'CA' WHEN 2 THEN 'NY' WHEN 3 THEN 'FL' ELSE 'VA' END
    || ' ' || CAST(10000 + g AS STRING) || CASE WHEN g % 6 = 0 THEN '-0001' ELSE '' END END AS street_address_raw,
  CASE WHEN odd THEN 'Farville' WHEN r = 0 AND g % 17 = 5 THEN 'Lone ' || CAST(g AS STRING) ELSE 'City ' || CAST(g % 7 AS STRING) END AS city_raw,
  CASE WHEN odd THEN 'Nevada' ELSE CASE g % 5 WHEN 0 THEN 'Texas' WHEN 1 THEN 'CA' WHEN 2 THEN 'new york' WHEN 3 THEN 'Florida' ELSE 'va' END END AS state_raw,
  CAST(CASE WHEN odd THEN 80000 ELSE 10000 END + g AS STRING) || CASE WHEN g % 6 = 0 THEN '-0001' ELSE '' END AS postal_code_raw,
  CASE WHEN g % 11 = 5 THEN 'Canada' WHEN r = 0 THEN 'USA' WHEN r = 1 THEN 'U.S.' WHEN r = 2 THEN 'The United States' ELSE 'United States of America' END AS country_raw,
  CASE WHEN g % 8 = 7 THEN NULL ELSE CAST(33 AS DOUBLE) + CAST(g % 97 AS DOUBLE) / CAST(100 AS DOUBLE)
    + CASE WHEN r < 2 THEN CAST(0 AS DOUBLE) WHEN g % 4 = 1 THEN CAST(2 AS DOUBLE) / CAST(1000 AS DOUBLE) WHEN g % 4 = 2 THEN CAST(2 AS DOUBLE) / CAST(100 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
    + CASE WHEN r % 2 = 1 AND g % 9 = 4 THEN CAST(3 AS DOUBLE) / CAST(10000 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END END AS latitude,
  CASE WHEN g % 8 = 7 THEN NULL ELSE CAST(-100 AS DOUBLE) - CAST(g % 89 AS DOUBLE) / CAST(100 AS DOUBLE) END AS longitude,
  CASE WHEN r >= 2 AND g % 14 = 2 THEN 'C' || CAST(g AS STRING) END AS campus_id,
  CASE WHEN r >= 2 AND g % 7 = 2 THEN 'Campus No. ' || CAST(g AS STRING) END AS campus_name,
  CASE WHEN r >= 2 AND g % 7 = 2 THEN 'Yes' WHEN r >= 2 THEN 'no' END AS part_of_campus
FROM (SELECT *, g % 13 = 3 AND r >= 2 AS odd FROM (SELECT *, CAST(floor(p_partkey / 4.0) AS BIGINT) AS g, p_partkey % 4 AS r FROM part) s) t
"""


def derived_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``SITES_SQL`` over the part table of a directory."""
    return spark.sql(SITES_SQL.replace("FROM part", "FROM {part}"), part=spark.read.parquet(f"{sf_dir}/part.parquet"))


def raw_a(sites: DataFrame) -> DataFrame:
    names = {"rec_id": "Site Id", "company_raw": "Company Name", "facility_name_raw": "DC Name", "street_address_raw": "Address", "city_raw": "City", "country_raw": "Country", "latitude": "Latitude", "longitude": "Longitude"}
    return sites.where("source = 'A'").select("source_row", *[F.col(c).alias(n) for c, n in names.items()])


def raw_b(sites: DataFrame) -> DataFrame:
    names = {"rec_id": "Datacenter ID", "company_raw": "Company", "facility_name_raw": "Datacenter Name", "street_address_raw": "Street Address", "city_raw": "City", "state_raw": "State or Province", "postal_code_raw": "Postal Code", "country_raw": "Country", "latitude": "Latitude", "longitude": "Longitude", "campus_id": "Campus ID", "campus_name": "Campus Name", "part_of_campus": "Part of Campus?"}
    return sites.where("source = 'B'").select("source_row", *[F.col(c).alias(n) for c, n in names.items()], F.col("company_raw").alias("Facility Owner"))
