"""The nine result tables, each written whole."""

from __future__ import annotations

from pyspark.sql import DataFrame

from siteweave.sources.xlsx import write_workbook

TABS = ["summary", "a_normalized", "b_normalized", "a_deduped", "b_deduped", "match_pairs", "manual_review", "unmatched_a", "unmatched_b"]


def write_tabs(tabs: dict[str, DataFrame], path: str, kind: str = "parquet") -> None:
    """Each tab under ``path``; a tab that is there is replaced. CSV has no lists: those become text. ``xlsx`` is one workbook."""
    if missing := set(TABS) - set(tabs):
        raise ValueError(f"missing: {sorted(missing)}")
    if kind == "xlsx":
        write_workbook({name: tabs[name] for name in TABS}, path)
        return
    for name in TABS:
        df = tabs[name]
        if kind == "csv":
            df = df.selectExpr(*[f"array_join(`{c}`, ' | ') AS `{c}`" if t.startswith("array") else f"`{c}`" for c, t in df.dtypes])
        df.write.mode("overwrite").options(header=True).format(kind).save(f"{path}/{name}")
