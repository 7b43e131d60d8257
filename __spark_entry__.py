
from __future__ import annotations

import datetime as dt
import importlib
import importlib.util
import os
import sys
import uuid
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from lotwise.functions import scalars as s  # noqa: E402
from lotwise.operators import quality as qa  # noqa: E402
from lotwise.operators.collation import LOOSE  # noqa: E402
from lotwise.operators.relational import count_by, difference  # noqa: E402
from lotwise.plans import consumption as cons  # noqa: E402
from lotwise.plans import failures as fail  # noqa: E402
from lotwise.plans import history as hist  # noqa: E402
from lotwise.plans import incremental as inc  # noqa: E402
from lotwise.plans import report as rep  # noqa: E402
from lotwise.plans import trace, weekly  # noqa: E402
from lotwise.sources.report_store import ReportStore  # noqa: E402
from lotwise.sources.star import star_folder, star_tables  # noqa: E402
from lotwise.sources.staging import staged  # noqa: E402
from lotwise.sources.tables import Tables  # noqa: E402

DAY = (dt.date(2025, 1, 8), dt.date(2025, 1, 9))
DAYS = (dt.date(2025, 1, 6), dt.date(2025, 1, 13))
PERIOD = dict(start="2025-01-06 00:00:00", end="2025-01-13 00:00:00", language=1)
RETENTION_AS_OF = dt.datetime(2027, 1, 9, 8)

ALL_TESTS = hist.HistoryParams(**PERIOD)
FILTERED = hist.HistoryParams(
    **PERIOD,
    customers="68,110",
    assemblies=list(range(0, 18)),
    families="0,1,2,3",
    factory_routes="0,1",
    route_steps="1,3,4,6",
    steps="101,103,104",
    equipment="0,1,2,3",
    test_users=list(range(0, 20)),
    statuses="P,F",
    loop_begin=1,
    loop_end=2,
    min_process_id=100,
    exclude_rma=True,
)


def widened(df: DataFrame) -> DataFrame:
    """Integer columns as 64-bit, so that both engines show the same types."""
    return df.select(
        *[F.col(f.name).cast("long") if isinstance(f.dataType, T.IntegerType) else F.col(f.name) for f in df.schema]
    )


def _steps(t: Tables) -> DataFrame:
    return cons.wip_steps(t, *DAY)


def _week(t: Tables) -> DataFrame:
    return rep.daily_report_range(t, *DAYS)


def _tests(t: Tables, **kw) -> DataFrame:
    return hist.test_records(t, hist.HistoryParams(**PERIOD, **kw))


def _analyses(t: Tables, **kw) -> DataFrame:
    p = hist.HistoryParams(**PERIOD, **kw)
    return hist.analysis_records(t, hist.record_ids(t, p), p)


def _repairs(t: Tables, **kw) -> DataFrame:
    p = hist.HistoryParams(**PERIOD, **kw)
    tests = staged(hist.record_ids(t, p))
    return hist.repair_records(t, tests, hist.analysis_ids(t, tests, p), p)


def _with(t: Tables, changes: dict[str, Callable[[DataFrame], DataFrame]], **kw) -> Tables:
    """The tables, some of them changed."""
    return Tables(lambda name: changes[name](t[name]) if name in changes else t[name], **kw)


def _mixed_case(t: Tables) -> Tables:
    """Texts of lots, parts and positions in several spellings, compared without case and trailing blanks."""
    spelled = lambda c, by: (
        F.when(F.col(by) % 3 == 0, F.lower(c)).when(F.col(by) % 3 == 1, F.concat(c, F.lit("  "))).otherwise(F.col(c))
    )
    return _with(
        t,
        {
            "cr_grns": lambda df: df.withColumns({"vendor": spelled("vendor", "grn_id"), "mpn": spelled("mpn", "grn_id")}),
            "cr_materials": lambda df: df.withColumn("material", spelled("material", "material_id")),
            "qm_grn_replacement": lambda df: df.withColumn("crd", spelled("crd", "wip_id")),
        },
        compare=LOOSE,
    )


def _known_lookups(t: Tables) -> Tables:
    """Lookup tables that know less than the views that show the same items."""
    route = lambda key, rest: lambda df: t["cr_fmrs_v"].filter(F.col(key) % 4 != rest).select(key).distinct()
    return _with(
        t,
        {
            "cr_equipment": lambda df: t["cr_equipment_v"].filter("equipment_id <> 3").select("equipment_id"),
            "cr_ma_routes": route("factory_ma_route_id", 2),
            "cr_route_steps": route("route_step_id", 1),
            "cr_steps": route("step_id", 0),
        },
    )


SERIALS = [f"SN{2 * k}" for k in range(0, 60_000, 3)]


def _serials(t: Tables) -> DataFrame:
    return _tests(t, serial_numbers=SERIALS, show_labels=False)


def _materials(t: Tables) -> DataFrame:
    wanted = t["cr_materials"].filter("material_id % 4 = 2").select("material_id")
    kinds = t["cr_materials"].filter("pin_count < 25").select("component_type")
    return _analyses(t, materials=wanted, component_types=kinds)


def _planted(t: Tables) -> DataFrame:
    """Differences between a report and itself with some quantities changed, some rows lost, and the others split."""
    keys, measures = ["internal_part", "supplier", "mpn", "start_date"], ["consumed_qty", "failed_qty"]
    report = staged(rep.daily_report_range(t, *DAY).groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures]))
    other = report.filter("consumed_qty % 11 <> 3").withColumn("failed_qty", F.col("failed_qty") + (F.col("consumed_qty") % 7 == 5).cast("int"))
    halves = [other.withColumn("consumed_qty", F.expr(f"(consumed_qty + {k}) div 2")) for k in (0, 1)]
    split = halves[0].unionByName(halves[1].withColumn("failed_qty", F.lit(0).cast("long")))
    return qa.differences_by_range(report, split, keys, measures)


def _units(t: Tables) -> DataFrame:
    return t["wp_wip"].select("serial_number", "customer_id")


def _reconcile_trace(t: Tables) -> DataFrame:
    steps = _steps(t)
    n = F.lit(1).cast("long").alias("positions")
    keys = ["wip_id", "crd", "internal_part", "grn"]
    traced = trace.trace_of_steps(t, steps).select(*keys, n)
    # Dealt by unit like the trace, so that the many rows of that one stay where they are.
    detail = cons.consumed_detail(t, *DAY).select(*keys, n).repartition("wip_id")
    return qa.reconcile(traced, detail, keys, ["positions"])


def _reconcile_summary(t: Tables, history: ReportStore) -> DataFrame:
    """The detail of a day against the written report: the loads are looked up once."""
    shown = [s.or_unknown("supplier").alias("supplier"), s.or_unknown("mpn").alias("mpn")]
    detail = (
        cons.consumed_detail(t, *DAY)
        .filter(s.keep_part("supplier", "mpn", "internal_part"))
        .select("internal_part", *shown, F.lit(1).cast("long").alias("consumed_qty"))
    )
    return qa.reconcile(detail, history.days(DAY[0], DAY[0]), ["internal_part", "supplier", "mpn"], ["consumed_qty"])


def _normalised(t: Tables) -> DataFrame:
    return cons.lots(t).select(
        "grn_id",
        s.strip_prefix("internal_part").alias("customer_part"),
        s.or_unknown("supplier").alias("supplier"),
        s.or_unknown("mpn").alias("mpn"),
        s.or_default(s.keep_part("supplier", "mpn", "internal_part"), False).alias("reported"),
    )


PLANS: dict[str, Callable[[Tables], DataFrame]] = {
    "wip_steps_daily": _steps,
    "wip_assemblies": lambda t: cons.wip_assemblies(t, _steps(t)),
    "consumed_equipment_setup": lambda t: cons.consumed_equipment(t, _steps(t)),
    "consumed_route_step_setup": lambda t: cons.consumed_bins(t, _steps(t)),
    "consumed_replacement": lambda t: cons.consumed_replacement(t, _steps(t)),
    "consumed_detail": lambda t: cons.consumed_detail(t, *DAY),
    "consumed_by_branch": lambda t: count_by(cons.consumed_detail(t, *DAY), ["branch"], "positions"),
    "consumed_qty_daily": lambda t: cons.consumed_qty_of_days(t, *DAY),
    "failed_qty_daily": lambda t: fail.failed_qty(t, *DAY),
    "daily_dppm_report": lambda t: rep.daily_report_range(t, *DAY),
    "daily_dppm_backfill": _week,
    "daily_report_loose": lambda t: rep.daily_report_range(_mixed_case(t), *DAY),
    "trace_loose": lambda t: trace.trace_of_steps(_mixed_case(t), _steps(t)),
    "report_differences": _planted,
    "component_trace": lambda t: trace.component_trace(t, _units(t)),
    "test_records": lambda t: _tests(t),
    "test_records_nolabel": lambda t: _tests(t, show_labels=False),
    "test_records_filtered": lambda t: hist.test_records(t, FILTERED),
    "analysis_records": lambda t: _analyses(
        t,
        correct_only=True,
        component_defects_only=True,
        analysis_start="2025-01-07 00:00:00",
        min_analysis_id=50,
        analysis_users=list(range(0, 24)),
        defects="0,1,2,3",
        defect_categories="0,1",
    ),
    "analysis_exclude_defects": lambda t: _analyses(t, exclude_defects="1,3"),
    "repair_records": lambda t: _repairs(t),
    "failed_replacement_only": lambda t: _repairs(
        t, repair_start=DAY[0], repair_end=DAY[1], replaced_only=True
    ),
    "assembly_test_summary": lambda t: hist.test_history(t, ALL_TESTS, hist.Mode.ASSEMBLY),
    "route_step_test_summary": lambda t: hist.test_history(t, ALL_TESTS, hist.Mode.ROUTE_STEP),
    "total_test_summary": lambda t: hist.test_history(t, ALL_TESTS, hist.Mode.TOTAL),
    "tests_with_counts": lambda t: hist.test_history(t, ALL_TESTS, hist.Mode.COUNTS),
    "history_repair_only": lambda t: hist.test_history(t, ALL_TESTS, hist.Mode.REPAIR),
    "history_analysis_only": lambda t: hist.test_history(t, ALL_TESTS, hist.Mode.ANALYSIS),
    "history_all": lambda t: hist.test_history(t, ALL_TESTS, hist.Mode.ALL),
    "history_top_n": lambda t: hist.test_history(t, hist.HistoryParams(**PERIOD, max_count=100), hist.Mode.ALL),
    "reconcile_trace_detail": _reconcile_trace,
    "tests_of_serials": _serials,
    "tests_known_lookups": lambda t: hist.test_records(_known_lookups(t), FILTERED),
    "analyses_of_materials": _materials,
    "repairs_of_users": lambda t: _repairs(t, repair_users=t["sc_users"].filter("user_id % 3 = 1").select("user_id")),
    "part_supplier_normalised": _normalised,
    "user_full_name": lambda t: t["sc_users"].select(
        "user_id", s.full_name("first_name", "last_name").alias("full_name")
    ),
    "consumed_loaded_only": lambda t: difference(
        cons.consumed_detail(t, *DAY).select("wip_id", "crd", "grn"),
        cons.consumed_replacement(t, _steps(t)).select("wip_id", "crd", "grn"),
    ),
}


REPORT_COLUMNS = ["internal_part", "customer_part", "supplier", "mpn", "consumed_qty", "failed_qty", "start_date"]


def _moved_weeks(report: DataFrame) -> DataFrame:
    """Days of the report moved back by up to two weeks, so that they lie in three weeks around the turn of a year."""
    return report.withColumn("start_date", F.expr("date_sub(start_date, 7 * (day(start_date) % 3))"))


def _late_repairs(t: Tables, history: ReportStore) -> DataFrame:
    """The days of a history that was made without some repairs, and brought up to date when these came."""
    own = ReportStore(history.spark, f"{history.root}-late-{uuid.uuid4().hex}")
    late = F.expr("repair_id % 13 = 5 AND repair_date_time >= '2025-01-08' AND repair_date_time < '2025-01-10'")
    inc.backfill(_with(t, {"qm_repair": lambda df: df.filter(~late)}), own, *DAYS)
    inc.backfill(t, own, *DAYS)
    return own.days().select(*REPORT_COLUMNS)


#: Queries that read the written report history.
STORED: dict[str, Callable[[Tables, ReportStore], DataFrame]] = {
    "dppm_by_supplier": lambda t, h: rep.with_dppm(h.days(), ["supplier"]),
    "dppm_by_part": lambda t, h: rep.with_dppm(h.days(), ["customer_part"]),
    "dppm_slice": lambda t, h: rep.dppm_slice(
        h.days(), suppliers=["VENDOR1", "VENDOR3", "Unknown"], dates=("2025-01-08", "2025-01-10")
    ),
    "weekly_consumed": lambda t, h: h.weeks(DAY[0], DAY[0]),
    "weekly_report_total": lambda t, h: weekly.weekly_report(h.weeks(DAY[0], DAY[0])),
    "weekly_period": lambda t, h: weekly.weekly_period(h.weeks(DAY[0], DAY[0])),
    "weekly_totals": lambda t, h: weekly.weekly_totals(weekly.weekly_consumed(_moved_weeks(h.days()))),
    "retention_2y": lambda t, h: rep.apply_retention(h.days(), RETENTION_AS_OF).select(*REPORT_COLUMNS),
    "reconcile_detail_summary": _reconcile_summary,
    "backfill_late_repairs": _late_repairs,
}


def report_history(spark: SparkSession, sf_dir: str) -> ReportStore:
    """The written report of all days in the files, brought up to date once per application."""
    store = ReportStore(spark, star_folder(spark, sf_dir, "report-history"))
    if not store.index().version:
        inc.backfill(star_tables(spark, sf_dir), store, *DAYS)
    return store


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: daily report of consumed and failed quantities at sf0.001."""
    return queries()["daily_dppm_report"](spark, "/root/testdata/sf0.001")


def _text_operators() -> list:
    """The module with further queries, if the optional subpackage is there; errors inside it are raised."""
    spec = importlib.util.find_spec("lotwise.llm")
    if spec is None or spec.origin is None:  # not there, or an empty folder
        return []
    return [importlib.import_module("lotwise.llm.queries")]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(plan):
        return lambda spark, sf_dir: widened(plan(star_tables(spark, sf_dir)))

    def stored(plan):
        return lambda spark, sf_dir: widened(plan(star_tables(spark, sf_dir), report_history(spark, sf_dir)))

    found = {name: bound(plan) for name, plan in PLANS.items()} | {name: stored(plan) for name, plan in STORED.items()}
    for module in _text_operators():
        found |= module.queries()
    return found


def oracle_sql() -> dict[str, str]:
    from oracle.statements import statements

    found = statements()
    for module in _text_operators():
        found |= module.oracle_sql()
    return found
