"""The whole linkage as a job: ``python -m siteweave.job A B OUT`` reads both tables, writes all tabs and prints the funnel."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from siteweave.plans import linkage
from siteweave.session import ship
from siteweave.sources.sinks import write_tabs
from siteweave.sources.tables import SCHEMA_A, SCHEMA_B, SHEET, read_raw


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("a", help="raw table of source A")
    parser.add_argument("b", help="raw table of source B")
    parser.add_argument("out", help="folder of the tabs, or the workbook that gets them")
    parser.add_argument("--read", choices=["xlsx", "csv", "parquet"], default="xlsx", help="kind of both raw tables")
    parser.add_argument("--write", choices=["xlsx", "csv", "parquet"], default="xlsx", help="kind of the tabs")
    parser.add_argument("--sheet", default=SHEET, help="sheet of the raw tables in their workbooks")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("siteweave").getOrCreate()
    ship(spark)
    a, b = (linkage.normalized(read_raw(spark, path, schema, args.read, args.sheet), s) for path, schema, s in ((args.a, SCHEMA_A, "A"), (args.b, SCHEMA_B, "B")))
    found = linkage.link(a, b)
    tabs = found.tabs()
    write_tabs(tabs, args.out, args.write)
    tabs["summary"].show(truncate=False)
    print(f"wrote {len(tabs)} tabs to {args.out}")


if __name__ == "__main__":
    main()
