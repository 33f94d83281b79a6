import zipfile

from siteweave.sources.tables import SCHEMA_A, read_raw

BOOK = '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="Raw data" sheetId="1" r:id="rId1"/></sheets></workbook>'
LINKS = '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="x" Target="worksheets/sheet1.xml"/></Relationships>'
SHARED = '<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><si><t>Site Id</t></si><si><t>City</t></si><si><r><t>Ren</t></r><r><t>o</t></r></si></sst>'
SHEET = """<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>
<row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row>
<row r="2"><c r="A2"><v>12.0</v></c><c r="C2" t="s"><v>2</v></c></row>
<row r="4"><c r="C4" t="inlineStr"><is><t>Boise</t></is></c></row></sheetData></worksheet>"""


def test_workbook(spark, tmp_path):
    path = tmp_path / "a.xlsx"
    with zipfile.ZipFile(path, "w") as z:
        for name, body in {"xl/workbook.xml": BOOK, "xl/_rels/workbook.xml.rels": LINKS, "xl/sharedStrings.xml": SHARED, "xl/worksheets/sheet1.xml": SHEET}.items():
            z.writestr(name, body)
    rows = read_raw(spark, str(path), SCHEMA_A, "xlsx").orderBy("source_row").collect()
    assert [(r.source_row, r["Site Id"], r.City, r.Latitude) for r in rows] == [(2, "12", "Reno", None), (4, None, "Boise", None)]


def test_parquet_rows_are_numbered(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(3).selectExpr("CAST(id AS STRING) AS `Site Id`").coalesce(1).write.parquet(path)
    assert [(r["Site Id"], r.source_row) for r in read_raw(spark, path, SCHEMA_A).orderBy("source_row").collect()] == [("0", 2), ("1", 3), ("2", 4)]


def test_workbook_of_all_tabs(spark, tmp_path):
    from siteweave.sources.sinks import TABS, write_tabs
    from siteweave.sources.xlsx import sheet_names, sheet_rows

    path = tmp_path / "out.xlsx"
    with zipfile.ZipFile(path, "w") as z:
        for name, body in {"xl/workbook.xml": BOOK, "xl/_rels/workbook.xml.rels": LINKS, "xl/sharedStrings.xml": SHARED, "xl/worksheets/sheet1.xml": SHEET}.items():
            z.writestr(name, body)
    df = spark.createDataFrame([(1, 2.5, "a<b & c", ["x", "y"], True), (2, None, "", [], None)], "ord long, v double, t string, l array<string>, f boolean").orderBy("ord")
    for _ in range(2):  # a tab that is there is replaced
        write_tabs(dict.fromkeys(TABS, df), str(path), "xlsx")
    data = path.read_bytes()
    assert sheet_names(data) == ["Raw data", *TABS]
    assert [cells for _, cells in sheet_rows(data, "match_pairs")] == [["ord", "v", "t", "l", "f"], ["1", "2.5", "a<b & c", "x | y", "true"], ["2", None, "", "", None]]
    assert [r["Site Id"] for r in read_raw(spark, str(path), SCHEMA_A, "xlsx").orderBy("source_row").collect()] == ["12", None]
