from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from pricelake import functions as fn
from pricelake.functions.text import mark_quoted_brackets
from pricelake.sources.landing import parsed


def apply(spark, values, make, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r.out for r in df.select("i", make(F.col("v")).alias("out")).orderBy("i").collect()]


def test_normalize_price(spark):
    cases = {
        "5,500": 5500.0, "1 2 3": 123.0, "1 000": 1000.0, "　1 ": 1.0, "-": None, "": None, None: None,
        "1e3": 1000.0, "1E+3": 1000.0, "nan": None, "NaN": None, "1d": None, "1f": None, "1_0": None, "0x10": None,
        "0x1p3": None, "5.": 5.0, ".5": 0.5, "+5": 5.0, "-7.25": -7.25, "--5": None, "1.2.3": None, "00012": 12.0,
        "1e400": None, "\x1c5": 5.0, "\t8,000.5\n": 8000.5, "True": None,
    }
    assert apply(spark, list(cases), fn.normalize_price) == list(cases.values())
    assert apply(spark, ["inf", "-inf", "Infinity", "iNf"], fn.normalize_price) == [math.inf, -math.inf, math.inf, math.inf]


def test_clean_price(spark):
    cases = {
        "5,500": 5500.0, " 5,500 ": 5500.0, "1 2 3": None, "-": None, " - ": None, "": None, "  ": None, None: None,
        "1e3": 1000.0, "1d": None, "0x1p3": None, "1_0": 10.0, "1__0": None, "_1": None, "nan": None, ",": None,
        " 7　": 7.0, "1 2": None, "5.": 5.0, "-3": -3.0,
    }
    assert apply(spark, list(cases), fn.clean_price) == list(cases.values())
    assert apply(spark, ["inf"], fn.clean_price) == [math.inf]


def test_date_features(spark):
    days = ["2025-12-29", "2025-02-30", None, "2025/01/01", "2025-12-13"]
    df = fn.add_date_features(spark.createDataFrame([(d,) for d in days], "res_dt string"), "res_dt")
    rows = df.collect()
    first = rows[0]
    assert first.res_dt == dt.date(2025, 12, 29)
    assert (first.year, first.month, first.week_of_year, first.weekday_num) == (2025, 12, 1, 0)
    assert (first.weekday_nm, first.weekend_yn) == ("월요일", False)
    for bad in rows[1:4]:
        assert (bad.res_dt, bad.year, bad.week_of_year, bad.weekday_num) == (None, None, None, None)
        assert (bad.weekday_nm, bad.weekend_yn) == ("알수없음", False)
    assert (rows[4].weekday_nm, rows[4].weekend_yn) == ("토요일", True)


def test_date_features_without_column(spark):
    df = spark.range(1)
    assert fn.add_date_features(df, "res_dt").columns == ["id"]


def test_date_from_parts(spark):
    rows = [
        ("2025", "12/17", dt.date(2025, 12, 17)), ("2025", " 1/5 ", dt.date(2025, 1, 5)), ("2025", "2/30", None),
        ("2025", "1217", None), ("2025", "1/2/3", None), (None, "12/1", None), ("2025", None, None), ("2025", "", None),
        ("2025", "123/1", None), ("2024", "2/29", dt.date(2024, 2, 29)),
    ]
    df = spark.createDataFrame([(i, y, d) for i, (y, d, _) in enumerate(rows)], "i int, y string, d string")
    got = df.select("i", fn.date_from_parts(F.col("y"), F.col("d")).alias("out")).orderBy("i").collect()
    assert [r.out for r in got] == [want for _, _, want in rows]


def test_usual_dates_are_cast(spark):
    """Texts of the usual width go by a cast, and give what the pattern gives."""
    texts = ["1995-04-06", "2024-02-29", "2023-02-29", "1995-13-01", "0000-01-01", "0999-01-01", "1995-4-6", "1995-04-06 ", "1995-04-06\n", "", None]
    frame = spark.createDataFrame([(t, t and t[:4], t and t[5:].replace("-", "/")) for t in texts], "t string, y string, md string")
    by_pattern = F.try_to_date("t", "yyyy-MM-dd")
    rows = frame.select(fn.try_iso_date(F.col("t")).cast("string").alias("got"), by_pattern.cast("string").alias("want")).collect()
    assert [r.got for r in rows] == [r.want for r in rows]
    days = [r.day for r in frame.select(fn.date_from_parts(F.col("y"), F.col("md")).cast("string").alias("day")).collect()]
    assert days[:4] == ["1995-04-06", "2024-02-29", None, None]
    assert days[6:9] == ["1995-04-06"] * 3 and days[9:] == [None, None]
    for date in (fn.try_iso_date(F.col("t")), fn.date_from_parts(F.col("y"), F.col("md"))):
        assert "RLIKE" in frame.select(date)._jdf.queryExecution().analyzed().toString()


def test_padding_keeps_long_values(spark):
    assert apply(spark, ["1", "12", "123", "", None], fn.padded) == ["01", "12", "123", "00", None]


def test_strip(spark):
    values = {" a ": "a", " a b　": "a b", "\t\n": "", "": "", None: None, "가 ": "가", "　가": "가"}
    assert apply(spark, list(values), fn.strip) == list(values.values())


def test_split_name(spark):
    df = spark.createDataFrame([("a/b",), ("a/b/c",), ("a",), ("a / b",), (None,)], "n string")
    item, kind = fn.split_name(F.col("n"))
    got = [tuple(r) for r in df.select(item, kind).collect()]
    assert got == [("a", "b"), ("a", "b/c"), ("a", None), ("a ", " b"), (None, None)]


def test_market_category(spark):
    values = {"x-유통": "유통", "A-B-C": "B", "A - B": "B", "none": "none", None: None, "A-": ""}
    assert apply(spark, list(values), fn.market_category) == list(values.values())


def test_path_attribute(spark):
    path = "file:/x/raw/api-17/dt=2025/product_cls=01/country=%EC%84%9C%EC%9A%B8/item=a+b/data.json"
    for key, want in {"dt": "2025", "country": "서울", "category": None, "item": "a+b"}.items():
        assert apply(spark, [path], lambda c, k=key: fn.path_attribute(fn.path_text(c), k)) == [want]
    assert apply(spark, [path], lambda c: fn.path_attribute(c, "category", "")) == [""]


def test_name_of_code(spark):
    names = {"1": "one"}
    assert apply(spark, ["1", "2", None], lambda c: fn.name_of_code(c, names, "?")) == ["one", "?", "?"]


def test_codes(spark):
    df = spark.createDataFrame([(1, None, 7, "x")], "product_cls_cd int, item_cd int, kind_cd int, kind_nm string")
    assert fn.code_columns(df).first().asDict() == {
        "product_cls_cd": "1", "item_cd": None, "kind_cd": "7", "kind_nm": "x",
    }
    assert fn.pad_codes(df).first().asDict() == {
        "product_cls_cd": "01", "item_cd": None, "kind_cd": "07", "kind_nm": "x",
    }


@pytest.mark.parametrize(
    ("leaf", "want"),
    [
        ("[]", None), ('["x","y"]', "x"), ('"x"', "x"), ('"[]"', "[]"), ('"[x"', "[x"), ("null", None), ("5", "5"),
        ("[[1]]", "[1]"), ('["[z"]', "[z"), (' "[]"', "[]"), ("[null]", None),
    ],
)
def test_first_of_list(spark, leaf, want):
    text = '{"a":"q: \\"[", "k":%s}' % leaf
    value = mark_quoted_brackets(F.lit(text))
    row = spark.range(1).select(
        fn.first_of_list(parsed(value, "struct<k:string>")["k"]).alias("k"), parsed(value, "struct<a:string>")["a"].alias("a")
    )
    assert tuple(row.first()) == (want, 'q: "[')


def test_path_attribute_of_odd_paths(spark):
    paths = ["/dt=/dt=2/x", "dt=1/x", "a/xdt=1/dt=3", "a/dt=", "a", None, "/dt=4"]
    df = spark.createDataFrame([(p,) for p in paths], "path string").select(fn.path_attribute(F.col("path"), "dt").alias("dt"))
    assert [r.dt for r in df.collect()] == ["2", "1", "3", None, None, None, "4"]
    # Only a path whose first such folder is empty is matched to the pattern.
    plan = df._jdf.queryExecution().optimizedPlan().toString().lower()
    assert 0 <= plan.find("split_part" if "split_part" in plan else "substring_index") < plan.find("regexp_extract")
