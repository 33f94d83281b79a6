"""Workbooks by zip and XML of the standard library: sheets read from any store on executors, and whole workbooks written."""

from __future__ import annotations

import io
import re
import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _column(cell: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", cell)[0]:
        n = 26 * n + ord(c) - 64
    return n - 1


def _text(node) -> str:  # noqa: ANN001
    return "".join(t.text or "" for t in node.iter(f"{_MAIN}t"))


def _targets(book: zipfile.ZipFile) -> dict[str, str]:
    """The part of each sheet, by the sheet's name."""
    links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    return {s.get("name"): links[s.get(_LINK)] for s in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")}


def sheet_names(data: bytes) -> list[str]:
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        return list(_targets(book))


def sheet_rows(data: bytes, sheet: str) -> Iterator[tuple[int, list[str | None]]]:
    """(row number, cells as text) of a sheet; numbers keep their shortest text, booleans are true and false."""
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        names = book.namelist()
        shared = [_text(si) for si in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{_MAIN}si")] if "xl/sharedStrings.xml" in names else []
        targets = _targets(book)
        if sheet not in targets:
            raise ValueError(f"the workbook has no sheet {sheet!r}")
        path = targets[sheet].lstrip("/")
        with book.open(path if path.startswith("xl/") else f"xl/{path}") as stream:
            at = 0
            for _, row in ElementTree.iterparse(stream):
                if row.tag != f"{_MAIN}row":
                    continue
                at = int(row.get("r") or at + 1)
                cells: list[str | None] = []
                for cell in row.iter(f"{_MAIN}c"):
                    k = _column(cell.get("r")) if cell.get("r") else len(cells)
                    cells += [None] * (k + 1 - len(cells))
                    value, kind = cell.find(f"{_MAIN}v"), cell.get("t")
                    if kind == "inlineStr":
                        cells[k] = _text(cell)
                    elif value is not None and value.text is not None:
                        cells[k] = {"s": lambda v: shared[int(v)], "b": lambda v: "true" if v == "1" else "false"}.get(kind, _number)(value.text)
                yield at, cells
                row.clear()


def _number(value: str) -> str:
    try:
        number = float(value)
    except ValueError:
        return value
    return str(int(number)) if number.is_integer() and abs(number) < 1e15 else repr(number)


def read_workbook(spark: SparkSession, path: str, schema: str, sheet: str) -> DataFrame:
    """A sheet, its columns by the names in the first row, as strings; ``source_row`` (long) is the number of a row in the sheet.

    Spark reads the file, from any store; one workbook is one task, since a zip archive can't be split. Rows without any
    value are left out; a column that the sheet doesn't have is null.
    """
    wanted = StructType.fromDDL(schema + ", source_row long")

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in batches:
            for data in files["content"]:
                held = sheet_rows(data, sheet)
                _, header = next(held, (0, []))
                place = {name: k for k, name in enumerate(header) if name is not None}
                out = []
                for at, cells in held:
                    if any(c is not None for c in cells):
                        found = (at if f.name == "source_row" else cells[k] if (k := place.get(f.name, len(cells))) < len(cells) else None for f in wanted.fields)
                        out.append(tuple(found))
                    if len(out) == 10_000:
                        yield pd.DataFrame(out, columns=wanted.names)
                        out = []
                yield pd.DataFrame(out, columns=wanted.names).astype({"source_row": "int64"})

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(rows, wanted)


#: What a sheet holds at most, by the format's own rules.
MOST_ROWS, MOST_NAME = 1_048_576, 31
_ILLEGAL = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]")


def _cell(value) -> str:  # noqa: ANN001
    if value is None:
        return "<c/>"
    if isinstance(value, bool):
        return f'<c t="b"><v>{int(value)}</v></c>'
    if isinstance(value, int | float) and value == value and abs(value) != float("inf"):
        return f"<c><v>{value!r}</v></c>"
    text = " | ".join(map(str, value)) if isinstance(value, list | tuple) else str(value)
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(_ILLEGAL.sub("", text))}</t></is></c>'


def _write_sheet(book: zipfile.ZipFile, number: int, rows: Iterable) -> None:
    with book.open(f"xl/worksheets/sheet{number}.xml", "w", force_zip64=True) as out:
        out.write(f'<worksheet xmlns="{_MAIN[1:-1]}"><sheetData>'.encode())
        for k, row in enumerate(rows):
            if k == MOST_ROWS:
                raise ValueError(f"more than {MOST_ROWS} rows: write Parquet or CSV instead")
            out.write(f"<row>{''.join(map(_cell, row))}</row>".encode())
        out.write(b"</sheetData></worksheet>")


def write_workbook(tabs: dict[str, DataFrame], path: str) -> None:
    """One sheet for each tab, with a header, in any store. Rows come to the driver partition by partition and are not held.

    A workbook that is there keeps the values of its other sheets, as text and numbers without their formats.
    """
    spark = next(iter(tabs.values())).sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(conf)
    old = bytes(spark.read.format("binaryFile").load(path).first().content) if store.exists(place) else b""
    names = [n for n in (sheet_names(old) if old else []) if n not in tabs]
    if long := [n for n in tabs if len(n) > MOST_NAME]:
        raise ValueError(f"names of sheets have at most {MOST_NAME} characters: {long}")
    with tempfile.NamedTemporaryFile(suffix=".xlsx") as local:
        with zipfile.ZipFile(local, "w", zipfile.ZIP_DEFLATED) as book:
            for k, name in enumerate(names):
                _write_sheet(book, k + 1, (cells for _, cells in sheet_rows(old, name)))
            for k, (_, df) in enumerate(tabs.items()):
                rows = (list(r) for r in df.toLocalIterator(prefetchPartitions=True))
                _write_sheet(book, len(names) + k + 1, (r for part in ([df.columns], rows) for r in part))
            names += list(tabs)
            rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
            kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
            sheets = "".join(f'<sheet name={quoteattr(n)} sheetId="{k + 1}" r:id="rId{k + 1}"/>' for k, n in enumerate(names))
            links = "".join(f'<Relationship Id="rId{k + 1}" Type="{rel}/worksheet" Target="worksheets/sheet{k + 1}.xml"/>' for k in range(len(names)))
            types = "".join(f'<Override PartName="/xl/worksheets/sheet{k + 1}.xml" ContentType="{kind}.worksheet+xml"/>' for k in range(len(names)))
            package = "http://schemas.openxmlformats.org/package/2006"
            book.writestr("xl/workbook.xml", f'<workbook xmlns="{_MAIN[1:-1]}" xmlns:r="{rel}"><sheets>{sheets}</sheets></workbook>')
            book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{package}/relationships">{links}</Relationships>')
            book.writestr("_rels/.rels", f'<Relationships xmlns="{package}/relationships"><Relationship Id="rId1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
            book.writestr(
                "[Content_Types].xml",
                f'<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
                f'<Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/>{types}</Types>',
            )
        local.flush()
        store.copyFromLocalFile(False, True, jvm.org.apache.hadoop.fs.Path(f"file://{local.name}"), place)
