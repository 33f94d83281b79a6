import pytest
from pyspark.sql import functions as F

from siteweave.functions import geo, similarity, text


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, v {kind}")
    return [r.x for r in df.select("k", expression(F.col("v")).alias("x")).orderBy("k").collect()]


CASES = [
    (text.ascii_text, [None, "Zürich ", "½ … ™"], ["", "Zurich", "12 ... TM"]),
    (text.compact, ["AT&T  Inc.", "Zürich-Nord #2", "O’Hare"], ["at and t inc", "zurich nord 2", "ohare"]),
    (text.country, ["The United States", "U.S.A.", "us", "Canada", None], ["United States"] * 3 + ["Canada", ""]),
    (text.state, ["New York", "NY", "Ontario", None], ["ny", "ny", "ontario", ""]),
    (text.company, ["The Acme Co., LLC", "AT&T Inc.", "Company"], ["acme", "at and t", ""]),
    (text.address, ["100 Main St.", "5 St Louis Ct"], ["100 main street", "5 street louis court"]),
    (text.postal, ["12345 Main St, Reno, NV 89501", "Reno, NV 89501-0001", "891234"], ["12345", "89501-0001", ""]),
    (
        text.state_in_address,
        ["7 Oak Ave, Reno, NV 89501", "1 A St, Hartford, ct", "5 K St, Washington, DC", "9 Rd Charleston West Virginia", "5 K St Washington DC", "12 Calle Mayor", "1 Virginia Ave, Miami, FL 33101"],
        ["nv", "ct", "dc", "wv", "wa", "", "fl"],
    ),
    (text.street_number, ["suite b 100 main", "5th avenue"], ["100", ""]),
    (text.is_yes, ["Yes", "1", "TRUE", "no"], [True, True, True, False]),
]


@pytest.mark.parametrize(("function", "values", "wanted"), CASES, ids=[c[0].__name__ for c in CASES])
def test_text(spark, function, values, wanted):
    assert column(spark, values, function) == wanted


def test_fold_exact_agrees_on_latin_text(spark):
    values = ["Éclair à la carte", " ñandú ", None, "straße", "½ﬁ"]
    assert column(spark, values, text.fold_exact) == column(spark, values, text.ascii_text)


def test_numbers(spark):
    assert column(spark, ["abc", "NaN", "Infinity", " 1.5 ", None], geo.to_float) == [None, None, None, 1.5, None]
    assert column(spark, [1.001, -0.0004, 33.4485, -112.0739], geo.truncate3, "double") == [1.0, 0.0, 33.448, -112.073]
    assert column(spark, [12.0, 1.5], text.number_text, "double") == ["12", "1.5"]


def test_street_core(spark):
    rows = [("100 main street suite 5 miami", "miami", "", ""), ("9 elm street hartford court 06103", "hartford", "ct", "06103"), ("5 a street fl 2", "", "", "")]
    df = spark.createDataFrame(rows, "a string, c string, s string, p string")
    got = [r.x for r in df.select(text.street_core(*(F.col(c) for c in "acsp")).alias("x")).collect()]
    assert got == ["100 main street", "9 elm street court", "5 a street"]


PAIRS = [
    ("100 main street", "200 main street", 93.3333), ("acme", "acme digital", 100.0), ("acme east", "acme west", 88.8889), ("borealis north", "borealis n1 borealis n2", 72.7273),
    ("abc", "xyz", 0.0), ("", "acme", 0.0), (None, "acme", 0.0), ("a b c", "c b a", 100.0),
]


def test_token_set(spark):
    df = spark.createDataFrame([p[:2] for p in PAIRS], "a string, b string")
    wanted = [pytest.approx(p[2], abs=1e-4) for p in PAIRS]
    assert [similarity.token_set_ratio(*p[:2]) for p in PAIRS] == wanted
    for f in (similarity.token_set, similarity.token_set_native):
        assert [r.x for r in df.select(f(F.col("a"), F.col("b")).alias("x")).collect()] == wanted


def test_common_subsequence():
    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b, 1):
                row[j], last = (last + 1 if x == y else max(row[j], row[j - 1])), row[j]
        return row[-1]

    import random

    draw = random.Random(4)
    for _ in range(300):
        a, b = ("".join(draw.choices("abc ", k=draw.randint(0, 30))) for _ in range(2))
        assert similarity.common_subsequence(a, b) == plain(a, b)


def test_cells_are_stable_and_near(spark):
    df = spark.createDataFrame([(39.80012, -89.65017), (39.80019, -89.65011), (39.9, -89.65), (None, 1.0)], "lat double, lon double")
    cells = [r.x for r in df.select(geo.hex_cell(F.col("lat"), F.col("lon"), "fine").alias("x")).collect()]
    assert cells[0] == cells[1] != cells[2] and cells[3] is None


def test_fold_is_exact_for_every_character(spark):
    import sys
    import unicodedata

    fold = lambda t: unicodedata.normalize("NFKD", t.strip()).encode("ascii", "ignore").decode()
    codes = [c for c in range(128, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}b" for c in codes if fold(chr(c))] + ["".join(map(chr, codes[k : k + 400])) for k in range(0, len(codes), 400)]
    assert column(spark, texts, text.ascii_text) == [fold(t) for t in texts]
