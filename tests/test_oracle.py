"""Rows of Spark and DuckDB on the smallest files. ``check.py`` does the same for any folder."""

import pytest

import __spark_entry__ as entry
import check
from conftest import SMALL

NAMES = [
    "daily_dppm_report",
    "daily_dppm_backfill",
    "consumed_detail",
    "component_trace",
    "history_all",
    "test_records_filtered",
    "weekly_report_total",
    "reconcile_trace_detail",
    "reconcile_detail_summary",
    "daily_report_loose",
    "trace_loose",
    "weekly_totals",
    "report_differences",
    "backfill_late_repairs",
    "tests_with_counts",
    "history_analysis_only",
    "history_repair_only",
    "history_top_n",
    "repair_records",
    "tests_of_serials",
    "tests_known_lookups",
    "analyses_of_materials",
    "repairs_of_users",
]


@pytest.fixture(scope="module")
def con():
    return check.duck(SMALL)


def test_every_query_has_sql():
    assert set(entry.PLANS) | set(entry.STORED) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_same_rows(spark, con, name):
    got = check.canonical(check.dates_as_time(entry.queries()[name](spark, SMALL).toPandas()))
    want = check.canonical(check.dates_as_time(con.sql(entry.oracle_sql()[name]).df()))
    assert list(got.columns) == list(want.columns)
    assert got.equals(want)


def test_entry(spark):
    assert entry.entry(spark).count() == 147
