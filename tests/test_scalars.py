"""Golden tables for the scalar expressions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tradewell.functions import scalars as S


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("y")).collect()[0]["y"]


@pytest.mark.parametrize("x,p,want", [
    (1.005, 2, 1.0), (2.675, 2, 2.68), (0.125, 2, 0.13), (-0.125, 2, -0.13),
    (2.5, 0, 3.0), (-2.5, 0, -3.0), (3.5, 0, 4.0), (2.4, 0, 2.0), (-2.6, 0, -3.0),
    (11.5, 2, 11.5), (4599.5, 0, 4600.0), (0.0, 2, 0.0),
])
def test_round_half_away(spark, x, p, want):
    assert one(spark, S.round_half_away(F.col("x"), p), x, "x double") == want


def test_round_differs_from_spark_round(spark):
    # Spark's round works on the decimal text: 1.005 -> 1.01
    row = spark.createDataFrame([(1.005,)], "x double").select(
        F.round("x", 2).alias("spark"), S.round_half_away(F.col("x"), 2).alias("ours")).collect()[0]
    assert (row.spark, row.ours) == (1.01, 1.0)


@pytest.mark.parametrize("raw,want", [
    ("MCDONALD-SMITH ANN", "McDonald-smith Ann"),
    ("  john \t  doe ", "John Doe"),
    ("o'brien", "O'brien"),
    ("mc", "Mc"),
    ("MCX", "McX"),
    ("jean-luc picard", "Jean-Luc Picard"),
    ("mc-donald", "Mc-donald"),
    ("DOE JANE", "Doe Jane"),
    ("", ""),
])
def test_normalize_name(spark, raw, want):
    assert one(spark, S.normalize_name("x"), raw) == want


@pytest.mark.parametrize("off,title,dirc,ten,rem,want", [
    ("true", "See Remarks", "1", None, "Chief Example Officer", "Chief Example Officer, Director"),
    ("1", None, None, None, None, "See Remarks"),
    ("1", None, None, None, "Boss", "Boss"),
    ("0", "CEO", "0", "0", None, "No Title"),
    ("TRUE", "CEO", None, None, None, "No Title"),
    ("true", "CEO", "true", "1", None, "CEO, Director, 10% Owner"),
    ("true", "", None, None, None, None),                   # empty title element: reject
    ("true", "See Remarks", None, None, "", None),          # empty remarks element: reject
    (None, None, None, "true", None, "10% Owner"),
])
def test_owner_title(spark, off, title, dirc, ten, rem, want):
    df = spark.createDataFrame([(off, title, dirc, ten, rem)], "o string, t string, d string, p string, r string")
    assert df.select(S.owner_title("o", "t", "d", "p", "r").alias("y")).collect()[0].y == want


@pytest.mark.parametrize("code,want", [("P", "P - Purchase"), ("S", "S - Sale"), ("X", "X - OptEx"),
                                       ("D", "D - Sale to Iss"), ("Z", "Z - Unknown"), ("", " - Unknown")])
def test_trade_type(spark, code, want):
    assert one(spark, S.trade_type("x"), code) == want


@pytest.mark.parametrize("text,want", [("2023-01-05-05:00", dt.date(2023, 1, 5)), (" 2024-01-03 ", dt.date(2024, 1, 3)),
                                       ("2024-01-03T10:00:00", dt.date(2024, 1, 3)), ("bad", None), (None, None)])
def test_trade_date_text(spark, text, want):
    assert one(spark, S.trade_date_text("x"), text) == want


@pytest.mark.parametrize("fn,text,want", [
    (S.money_value, "+$10,500", 10500.0), (S.money_value, "-$12,346", -12346.0), (S.money_value, "n/a", None),
    (S.money_price, "$10.50", 10.5), (S.money_price, "$1,234.56", 1234.56), (S.money_price, "n/a", None),
    (S.clean_qty, "+1,000", 1000), (S.clean_qty, "-10", -10), (S.clean_qty, "12.5", None), (S.clean_qty, "n/a", None),
    (S.int_or_zero, "100", 100), (S.int_or_zero, "12.5", 0), (S.int_or_zero, " 7 ", 7), (S.int_or_zero, None, 0),
    (S.float_or_zero, "10.00", 10.0), (S.float_or_zero, "abc", 0.0), (S.float_or_zero, None, 0.0),
])
def test_cleaners(spark, fn, text, want):
    assert one(spark, fn("x"), text) == want


@pytest.mark.parametrize("sep,want", [(";", "CEO, Dir, 10%"), (",", "CEO; Dir; 10%"), ("\t", "CEO; Dir, 10%")])
def test_delimiter_safe(spark, sep, want):
    assert one(spark, S.delimiter_safe("x", sep), "CEO; Dir, 10%") == want


@pytest.mark.parametrize("text,want", [
    ("2024-01-05 16:30:12", dt.datetime(2024, 1, 5, 16, 30, 12)), ("2024-01-05", dt.datetime(2024, 1, 5)),
    ("2024-01-05T16:30:12", dt.datetime(2024, 1, 5, 16, 30, 12)), ("bad", None), ("", None)])
def test_coerce_ts(spark, text, want):
    assert one(spark, S.coerce_ts("x"), text) == want


def test_symbol_and_cik(spark):
    df = spark.createDataFrame([(" msft\t",), ("320193",), ("12345678901",)], "x string")
    rows = df.select(S.symbol("x").alias("s"), S.is_cik(S.symbol("x")).alias("c"),
                     S.pad_cik(S.symbol("x")).alias("p")).collect()
    assert [r.s for r in rows] == ["MSFT", "320193", "12345678901"]
    assert [r.c for r in rows] == [False, True, False]
    assert rows[1].p == "0000320193"


def test_py_ts_text(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 14, 41, 845357),), (dt.datetime(2024, 1, 5, 16, 30, 12),)],
                               "t timestamp_ntz")
    assert [r.y for r in df.select(S.py_ts_text("t").alias("y")).collect()] == [
        "2024-01-01 00:14:41.845357", "2024-01-05 16:30:12"]


def test_parse_param_date():
    d = dt.datetime(2020, 1, 1)
    assert S.parse_param_date("2024-02-03", d) == dt.datetime(2024, 2, 3)
    assert S.parse_param_date("03/02/2024", d) == d
    assert S.parse_param_date(None, d) == d


def test_date_layouts_and_votes(spark):
    import datetime as dt
    cases = {"01/05/2024": dt.datetime(2024, 1, 5), "Jan 5, 2024": dt.datetime(2024, 1, 5), "sept. 5 2024 3:04 pm": dt.datetime(2024, 9, 5, 15, 4),
             "20240105": dt.datetime(2024, 1, 5), "2024-1-5": dt.datetime(2024, 1, 5), "2024-01-05T10:00:00Z": dt.datetime(2024, 1, 5, 10),
             "2024-01-05 10:00+05:30": dt.datetime(2024, 1, 5, 10), "5-Jan-2024": dt.datetime(2024, 1, 5), "12/31/2024 12:00 AM": dt.datetime(2024, 12, 31),
             "1/2/2024 13:00 PM": None, "31/12/2024": None, "2024-02-30": None, "Janx 5, 2024": None, "2024010": None, "": None, "n/a": None}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.x for r in df.select("t", S.coerce_ts("t").alias("x")).collect()} == cases
    assert {r.t: r.x for r in df.select("t", S.coerce_ts("t", True).alias("x")).collect()}["31/12/2024"] == dt.datetime(2024, 12, 31)
    votes = lambda *t: S.votes_day_first(spark.createDataFrame([(x,) for x in t], "t string"), "t")
    assert votes("31/12/2024", "3/4/2024", None) and not votes("3/4/2024") and not votes("31/12/2024", "12/31/2024") and not votes("x")


def test_usual_names_by_one_pass(spark):
    import random
    rnd = random.Random(5)
    signs = "abMCmcZ'.,&-_9@[`{~! \t é"
    names = ["".join(rnd.choice(signs) for _ in range(rnd.randrange(0, 12))) for _ in range(3000)]
    names += ["van der  berg NOT SPECIFIED", "O'BRIEN jr.", "McDONALD x", "smith-jones a", " a", "a ", "x.y/z (ab) 3RD", None]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    rows = df.select("n", S.normalize_name("n").alias("new"), S._normalize_any(F.col("n")).alias("any"),
                     F.col("n").rlike(S._USUAL_NAME).alias("usual")).collect()
    assert [(r.n, r.new) for r in rows] == [(r.n, r["any"]) for r in rows]
    assert sum(bool(r.usual) for r in rows) > 300
    assert rows[3000].usual and rows[3001].usual and not rows[3002].usual and not rows[3003].usual
