"""Texts compared without case and trailing blanks, and shown as they are."""

import datetime as dt

from plant import at, empty_tables, plant

from lotwise.operators.collation import EXACT, LOOSE
from lotwise.plans import report, trace, weekly
from lotwise.sources.tables import Tables

DAY = (dt.date(2025, 1, 8), dt.date(2025, 1, 9))


def test_groups_show_the_least_spelling(spark):
    df = spark.createDataFrame([("ab ", 1), ("AB", 2), ("Ab", 4), ("b", 8), (None, 16), (None, 32)], "supplier string, n long")
    from pyspark.sql import functions as F

    rows = lambda c: sorted(map(tuple, c.grouped(df, ["supplier"], F.sum("n").alias("n")).collect()), key=str)
    assert rows(LOOSE) == [("AB", 7), ("b", 8), (None, 48)]
    assert len(rows(EXACT)) == 5
    assert sorted(r[0] for r in LOOSE.distinct(df.select("supplier").dropna()).collect()) == ["AB", "b"]
    assert df.filter(LOOSE.is_in("supplier", ["aB  "])).count() == 3 and df.filter(EXACT.is_in("supplier", ["AB"])).count() == 1


def test_joins_keep_texts(spark):
    a = spark.createDataFrame([("x ", 1), ("Y", 2), (None, 3)], "mpn string, a long")
    b = spark.createDataFrame([("X", 10), ("z", 20), (None, 30)], "mpn string, b long")
    rows = lambda how: sorted(map(tuple, LOOSE.joined(a, b, ["mpn"], how).collect()), key=str)
    assert rows("inner") == [("x ", 1, 10)]
    assert rows("left") == [("Y", 2, None), ("x ", 1, 10), (None, 3, None)]
    assert rows("full_outer") == sorted([("x ", 1, 10), ("Y", 2, None), (None, 3, None), ("z", None, 20), (None, None, 30)], key=str)
    assert rows("left_anti") == [("Y", 2), (None, 3)] and rows("left_semi") == [("x ", 1)]


def mixed(spark, compare):
    """A part in two spellings, a lot's supplier in two, and a replacement that names its position in small letters."""
    t = empty_tables(
        spark,
        **plant(
            [(1, "10:00", None), (2, "10:00", None), (3, "10:00", None)],
            [(10, "09:00", None)],
            replaced=[(1, "c1 ", 11), (2, "C1", 12)],
            cr_materials=[(1, "AS100", "res", "R", 2), (2, "as100 ", "cap", "C", 2)],
            cr_grns=[(10, "G10", 1, "V1", "M1"), (11, "G11", 1, "v1 ", "m1"), (12, "G12", 2, "V1", "M1 ")],
        ),
    )
    return Tables(t.table, compare=compare)


def test_daily_report(spark):
    rows = lambda c: sorted(tuple(r)[:6] for r in report.daily_report_range(mixed(spark, c), *DAY).collect())
    assert rows(LOOSE) == [("AS100", "100", "V1", "M1", 3, 0)]
    # Compared as it is, the first unit's position isn't replaced, the part in small letters isn't reported.
    assert rows(EXACT) == [("AS100", "100", "V1", "M1", 2, 0), ("AS100", "100", "v1 ", "m1", 1, 0)]
    dppm = report.with_dppm(report.daily_report_range(mixed(spark, EXACT), *DAY), ["supplier"], compare=LOOSE)
    assert [tuple(r)[:2] for r in dppm.collect()] == [("V1", 3)]
    week = weekly.weekly_consumed(report.daily_report_range(mixed(spark, EXACT), *DAY), compare=LOOSE)
    assert [r.consumed_qty for r in week.collect()] == [3]
    assert report.dppm_slice(report.daily_report_range(mixed(spark, LOOSE), *DAY), suppliers=["v1"], compare=LOOSE).count() == 1


def test_trace_by_serial_number_in_any_spelling(spark):
    units = spark.createDataFrame([("sn1 ", 68), ("SN1", 68)], "serial_number string, customer_id int")
    rows = trace.component_trace(mixed(spark, LOOSE), units).collect()
    assert [(r.serial_number, r.crd, r.grn) for r in rows] == [("SN1", "c1 ", "G11")]
    assert trace.component_trace(mixed(spark, EXACT), units.filter("serial_number = 'sn1 '")).count() == 0
    assert at("10:00") == dt.datetime(2025, 1, 8, 10)
