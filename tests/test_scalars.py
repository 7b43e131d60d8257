import datetime as dt

from pyspark.sql import functions as F

from lotwise.constants import FORMULA_TEXT_SCALE
from lotwise.functions import scalars as s
from lotwise.operators.quality import too_long
from lotwise.operators.relational import with_total


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first()["x"]


def test_normalisation(spark):
    rows = spark.createDataFrame([("AS123", ""), ("XX123", None), ("AS", "V")], "p string, v string")
    got = rows.select(s.strip_prefix("p").alias("p"), s.or_unknown("v").alias("v")).collect()
    assert [tuple(r) for r in got] == [("123", "Unknown"), ("XX123", "Unknown"), ("", "V")]


def test_keep_part(spark):
    cases = [
        ("", "", "AS1$", False),
        ("", "", "AS1", True),
        (None, "", "AS1$", False),
        (None, None, "AS1$", False),
        (None, "X", "AS1$", True),
        (None, "", "AS1", True),
        ("V", "", "AS1$", True),
        ("V", "X", "XX1", False),
    ]
    df = spark.createDataFrame([c[:3] for c in cases], "s string, m string, p string")
    kept = {tuple(r) for r in df.filter(s.keep_part("s", "m", "p")).collect()}
    assert kept == {c[:3] for c in cases if c[3]}


def test_names_and_text(spark):
    df = spark.createDataFrame([("", "L"), ("F", "L"), (None, "L"), ("F", None)], "f string, l string")
    assert [r[0] for r in df.select(s.full_name("f", "l")).collect()] == ["L", "F L", None, None]
    assert one(spark, s.text(F.lit(1), F.lit("x"), F.lit(2))) == "1x2"
    assert one(spark, s.split_values(F.lit("1, 2,,30"), int)) == [1, 2, 30]
    assert one(spark, s.split_values(F.lit("a,b"))) == ["a", "b"]
    assert s.as_list("1, 2,,30", int) == [1, 2, 30] and s.as_list(None) == []


def test_dates(spark):
    t = s.ntz("2025-01-09 08:00:00")
    assert one(spark, s.minus_years(t, 2)) == dt.datetime(2023, 1, 9, 8)
    assert one(spark, s.week_start(t)) == dt.date(2025, 1, 6)
    assert one(spark, s.week_end(t)) == dt.date(2025, 1, 12)
    assert one(spark, s.add_days(t, 1)) == dt.date(2025, 1, 10)
    assert one(spark, s.days_between(t, s.ntz("2025-01-11"))) == 2
    assert one(spark, s.millis_between(t, s.ntz("2025-01-09 08:00:01.250"))) == 1250
    utc, other = spark.range(1).select(s.local_clock("UTC"), s.local_clock("Asia/Singapore")).first()
    assert other - utc == dt.timedelta(hours=8)


def test_between_optional_drops_null(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "x int")
    assert df.filter(s.between_optional("x")).count() == 2
    assert df.filter(s.between_optional("x", lo=2)).count() == 1


def test_dppm(spark):
    df = spark.createDataFrame([("a", 2, 1000), ("b", 1, 0)], "k string, f long, c long")
    got = dict(map(tuple, df.groupBy("k").agg(s.dppm("f", "c")).collect()))
    assert got == {"a": 2000.0, "b": None}
    assert df.filter("k = 'a'").agg(s.dppm("f", "c", FORMULA_TEXT_SCALE)).first()[0] == 20000.0


def test_total_and_lengths(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 4)], "k string, q long")
    got = {tuple(r) for r in with_total(df, ["k"], "q").collect()}
    assert got == {("a", 1, "Detail"), ("b", 2, "Detail"), (None, 4, "Detail"), (None, 7, "Total")}
    long = spark.createDataFrame([("x" * 28, "y"), ("x", "y" * 17)], "crd string, grn string")
    assert {(r.column, r.length, r.limit) for r in too_long(long).collect()} == {("crd", 28, 27), ("grn", 17, 16)}
