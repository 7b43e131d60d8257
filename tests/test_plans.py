"""Shape of the plans: no pair products, no Python in tasks, filters at the scan."""

import contextlib
import datetime as dt
import io

import pytest

import __spark_entry__ as entry
from conftest import SMALL
from lotwise.plans import consumption as cons
from lotwise.plans import report


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", sorted(set(entry.PLANS) | set(entry.STORED)))
def test_no_pair_products(spark, name):
    text = plan(entry.queries()[name](spark, SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "InPandas", "ArrowEvalPython"):
        assert bad not in text


def test_day_filter_and_columns_reach_the_scan(star):
    text = plan(cons.wip_steps(star, dt.date(2025, 1, 8), dt.date(2025, 1, 9)))
    assert "GreaterThanOrEqual(start_time,2025-01-08T00:00)" in text
    assert "LessThan(start_time,2025-01-09T00:00)" in text
    assert "ReadSchema: struct<wip_id:bigint,serial_number:string,customer_id:int>" in text


def test_load_history_is_cut_at_the_scan(star):
    text = plan(report.daily_report_range(star, dt.date(2025, 1, 8), dt.date(2025, 1, 9)))
    assert "LessThanOrEqual(load_time," in text
    assert "Or(IsNull(removal_time),GreaterThanOrEqual(removal_time,2025-01-08T00:00))" in text


def test_matched_loads_are_dealt_by_unit_once(star, spark):
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(cons.loaded_positions(star, cons.wip_steps(star, dt.date(2025, 1, 8), dt.date(2025, 1, 9))))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
    dealt = [line for line in text.splitlines() if line.startswith("Arguments: hashpartitioning(wip_id")]
    assert any("REPARTITION_BY_COL" in line for line in dealt)
    assert not any(f", {other}#" in line for line in dealt for other in ("crd", "run_date", "serial_number"))


def test_history_moves_whole_rows_for_the_order_only(spark):
    for name in ("history_all", "history_analysis_only", "history_repair_only"):
        text = plan(entry.queries()[name](spark, SMALL))
        assert "rangepartitioning(test_start_date_time" in text
        assert "hashpartitioning" not in text and "Join" not in text


def test_block_join_compares_times_at_edges_only(star, spark):
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        steps = cons.wip_steps(star, dt.date(2025, 1, 8), dt.date(2025, 1, 9))
        text = plan(cons.loaded_positions(star, steps))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
    assert "partial_max(rank" in text and "SortAggregate" not in text
    joins = [line for line in text.splitlines() if line.startswith("Join condition:")]
    compared = [line for line in joins if not line.endswith("None")]
    assert len(joins) > 1 and len(compared) == 1 and "isnull(since" in compared[0]
