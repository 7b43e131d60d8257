"""Test, analysis and repair history with optional filters and seven result forms."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from enum import Enum

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.constants import CORRECT_ANALYSIS, DEFECT_FLAG
from lotwise.functions import scalars as s
from lotwise.operators.filters import filter_if, member_if, optional_in, optional_not_in, status_in
from lotwise.operators.quality import require_active_user
from lotwise.operators.relational import cap, newest_first, ordered, status_counts, with_text
from lotwise.sources.sinks import write_audit
from lotwise.sources.staging import staged
from lotwise.sources.tables import Tables

Ids = str | tuple[int, ...] | list[int] | DataFrame
Texts = str | tuple[str, ...] | list[str] | DataFrame


class Mode(Enum):
    """Result forms, in the order in which the first one asked for wins."""

    ASSEMBLY = "assembly"
    ROUTE_STEP = "route_step"
    TOTAL = "total"
    COUNTS = "counts"
    REPAIR = "repair"
    ANALYSIS = "analysis"
    ALL = "all"


SUMMARIES = (Mode.ASSEMBLY, Mode.ROUTE_STEP, Mode.TOTAL)


def choose_mode(
    assembly: bool = False,
    route_step: bool = False,
    total: bool = False,
    counts: bool = False,
    repair: bool = False,
    analysis: bool = False,
) -> Mode:
    """Mode of the call flags."""
    flags = (assembly, route_step, total, counts, repair, analysis)
    return next((mode for mode, flag in zip(Mode, flags) if flag), Mode.ALL)


@dataclass(frozen=True)
class HistoryParams:
    """Parameters of one call. Lists may be delimited text, any sequence, or a DataFrame of one column; an empty
    sequence keeps all. Statuses are a short list."""

    start: s.DateLike
    end: s.DateLike
    analysis_start: s.DateLike | None = None
    analysis_end: s.DateLike | None = None
    customers: Ids = ()
    assemblies: Ids = ()
    families: Ids = ()
    factory_routes: Ids = ()
    route_steps: Ids = ()
    steps: Ids = ()
    equipment: Ids = ()
    statuses: Texts = ()
    serial_numbers: Texts = ()
    test_users: Ids = ()
    loop_begin: int | None = None
    loop_end: int | None = None
    min_process_id: int | None = None
    min_analysis_id: int | None = None
    defect_categories: Ids = ()
    defects: Ids = ()
    exclude_defects: Ids = ()
    materials: Ids = ()
    component_types: Texts = ()
    analysis_users: Ids = ()
    repair_users: Ids = ()
    correct_only: bool = False
    component_defects_only: bool = False
    repair_start: s.DateLike | None = None
    repair_end: s.DateLike | None = None
    replaced_only: bool = False
    exclude_rma: bool = False
    show_labels: bool = True
    language: int = 0
    max_count: int = 0
    legacy_grn_labels: bool = False


def ids(values: Ids) -> list[int] | DataFrame:
    return values if isinstance(values, DataFrame) else s.as_list(values, int)


def names(values: Texts) -> list[str] | DataFrame:
    return values if isinstance(values, DataFrame) else s.as_list(values)


def any_given(*lists: Ids | Texts) -> bool:
    return any(isinstance(x, DataFrame) or s.as_list(x) for x in lists)


def texts(t: Tables, language: int) -> DataFrame:
    return t["cr_text"].filter(F.col("language_id") == language).select("text_id", "translation")


def user_names(t: Tables, id_name: str, name: str) -> DataFrame:
    return t["sc_users"].select(F.col("user_id").alias(id_name), s.full_name("first_name", "last_name").alias(name))


# --- tests --------------------------------------------------------------------------------

ASSEMBLY_COLUMNS = [
    "assembly_id", "number", "revision", "version", "customer_id", "customer", "division", "family_id", "family",
]
ROUTE_COLUMNS = [
    "test_factory_ma_route_id", "test_route_step_id", "test_factory", "test_manufacturing_area", "test_route",
    "test_route_step",
]
TEST_COLUMNS = [
    "wip_id", "process_id", "serial_number", *ASSEMBLY_COLUMNS, *ROUTE_COLUMNS, "test_step_id", "test_equipment_id",
    "test_equipment", "test_start_date_time", "test_end_date_time", "test_status", "process_loop", "test_loop",
    "test_user_id", "test_user",
]
RECORD_COLUMNS = [*TEST_COLUMNS, "data_label", "data_id"]


def assembly_names(t: Tables, p: HistoryParams) -> DataFrame:
    """Assemblies with customer, division and family in the language, after the list filters."""
    named = texts(t, p.language)
    customers = with_text(with_text(t["cr_customers"], "customer", "customer_name", named), "division", "division_name", named)
    families = with_text(t["cr_families"], "family", "family_name", named)
    df = (
        t["cr_assemblies"]
        .join(customers.select("customer_id", F.col("customer_name").alias("customer"), F.col("division_name").alias("division")), "customer_id")
        .join(families.select("family_id", F.col("family_name").alias("family")), "family_id")
    )
    df = optional_in(df, "customer_id", ids(p.customers), t["cr_customers"])
    df = optional_in(df, "assembly_id", ids(p.assemblies), t["cr_assemblies"])
    df = optional_in(df, "family_id", ids(p.families), t["cr_families"])
    return df.select(*ASSEMBLY_COLUMNS)


def route_names(t: Tables, p: HistoryParams) -> DataFrame:
    """Route steps with their texts in the language, after the list filters."""
    df = t["cr_fmrs_v"].filter(F.col("language_id") == p.language)
    df = optional_in(df, "factory_ma_route_id", ids(p.factory_routes), t["cr_ma_routes"])
    df = optional_in(df, "route_step_id", ids(p.route_steps), t["cr_route_steps"])
    df = optional_in(df, "step_id", ids(p.steps), t["cr_steps"])
    return df.select(
        F.col("factory_ma_route_id").alias("test_factory_ma_route_id"),
        F.col("route_step_id").alias("test_route_step_id"),
        F.col("factory_text").alias("test_factory"),
        F.col("ma_text").alias("test_manufacturing_area"),
        F.col("route_text").alias("test_route"),
        F.col("step_text").alias("test_route_step"),
        F.col("step_id").alias("test_step_id"),
    )


#: What a test row holds before anything is named: numbers, times and the status letter.
TEST_IDS = [
    "wip_id", "process_id", "assembly_id", "test_route_step_id", "test_equipment_id", "test_start_date_time",
    "test_end_date_time", "test_status", "process_loop", "test_loop", "test_user_id",
]


def test_ids(t: Tables, p: HistoryParams, complete: bool = True) -> DataFrame:
    """Tests of the period after all filters, as ``TEST_IDS``; the only scan of the tests.

    ``complete`` also drops the tests that can't be named. Without it a later ``name_tests`` does so, which is the same
    unless rows are cut in between.
    """
    tests = t["qm_test_data"].filter(s.between("start_date_time", s.ntz(p.start), s.ntz(p.end)))
    given = p.loop_begin is not None or p.loop_end is not None
    tests = filter_if(tests, given, s.between_optional("process_loop", p.loop_begin, p.loop_end))
    tests = filter_if(tests, p.min_process_id is not None, s.between_optional("process_id", p.min_process_id))
    tests = optional_in(tests, "equipment_id", ids(p.equipment), t["cr_equipment"])
    tests = optional_in(tests, "user_id", ids(p.test_users), t["sc_users"])
    tests = status_in(tests, s.as_list(p.statuses), t["qm_test_status"], t["cr_text"])
    df = tests.select(
        "wip_id",
        "process_id",
        "assembly_id",
        F.col("route_step_id").alias("test_route_step_id"),
        F.col("equipment_id").alias("test_equipment_id"),
        F.col("start_date_time").alias("test_start_date_time"),
        F.col("stop_date_time").alias("test_end_date_time"),
        "test_status",
        "process_loop",
        "test_loop",
        F.col("user_id").alias("test_user_id"),
    )
    if complete or any_given(p.customers, p.assemblies, p.families):
        df = df.join(assembly_names(t, p).select("assembly_id"), "assembly_id", "left_semi")
    if complete or any_given(p.factory_routes, p.route_steps, p.steps):
        df = df.join(route_names(t, p).select("test_route_step_id"), "test_route_step_id", "left_semi")
    if complete:
        df = df.join(equipment_names(t).select("test_equipment_id"), "test_equipment_id", "left_semi")
        df = df.join(user_names(t, "test_user_id", "test_user").select("test_user_id"), "test_user_id", "left_semi")
    if complete or p.exclude_rma or any_given(p.serial_numbers):
        df = df.join(_units(t, p).select("wip_id"), "wip_id", "left_semi")
    return df.select(*TEST_IDS)


def equipment_names(t: Tables) -> DataFrame:
    return t["cr_equipment_v"].select(
        F.col("equipment_id").alias("test_equipment_id"), F.col("equipment").alias("test_equipment")
    )


def _units(t: Tables, p: HistoryParams) -> DataFrame:
    units = filter_if(t["wp_wip"], p.exclude_rma, F.col("rma") == 0)
    return member_if(units, "serial_number", names(p.serial_numbers)).select("wip_id", "serial_number")


def record_ids(t: Tables, p: HistoryParams, complete: bool = True) -> DataFrame:
    """The tests, one row per data record, with its label and id and nothing named.

    Without labels each test is one row with ``data_id`` 0.
    """
    df = test_ids(t, p, complete)
    if p.show_labels:
        records = t["qm_data_rec"].select("wip_id", "process_id", "data_label", "data_id")
        df = df.join(records, ["wip_id", "process_id"], "left")
        label, data_id = s.or_default("data_label", ""), s.or_default("data_id", 0)
    else:
        label, data_id = F.lit(""), F.lit(0).cast("long")
    return df.select(*TEST_IDS, label.alias("data_label"), data_id.alias("data_id"))


def name_tests(t: Tables, p: HistoryParams, rows: DataFrame) -> DataFrame:
    """Put the descriptive columns of the test to ``rows``, which have ``TEST_IDS``; others stay. Tests that can't be
    named go. The large table, that of the units, comes first, while rows are narrow; rows that have the serial number
    don't need it."""
    if "serial_number" not in rows.columns:
        rows = rows.join(_units(t, p), "wip_id")
    others = [c for c in rows.columns if c not in (*TEST_IDS, "serial_number")]
    return (
        rows.join(assembly_names(t, p), "assembly_id")
        .join(route_names(t, p), "test_route_step_id")
        .join(equipment_names(t), "test_equipment_id")
        .join(user_names(t, "test_user_id", "test_user"), "test_user_id")
        .select(*TEST_COLUMNS, *others)
    )


def test_records(t: Tables, p: HistoryParams) -> DataFrame:
    """Tests of the period with their descriptive columns, one row per data record."""
    return name_tests(t, p, record_ids(t, p, complete=False))


# --- analyses and repairs -----------------------------------------------------------------

ANALYSIS_COLUMNS = [
    "analysis_wip_id", "analysis_process_id", "analysis_data_id", "analysis_id", "defect_id", "defect",
    "defect_category_id", "defect_category", "material_id", "material", "material_descr", "component_type",
    "pin_count", "defect_count", "defect_location", "equipment_or_route_step_id", "is_equipment",
    "feeder_tray_track_id", "defect_detail", "analysis_user_id", "analysis_user", "analysis_date_time",
]

REPAIR_COLUMNS = [
    "repair_wip_id", "repair_process_id", "repair_data_id", "repair_analysis_id", "repair_id", "repair_category_id",
    "repair_category", "repaired_by_id", "repaired_by", "repair_date_time", "repair_detail", "memo", "old_grn_id",
    "old_grn", "new_grn_id", "new_grn",
]


def _defect_links(t: Tables, p: HistoryParams) -> DataFrame:
    """Links from data records to the analyses of defects."""
    links = t["qm_data_analysis"].filter(F.col("associated_defect_flag") == DEFECT_FLAG)
    return filter_if(links, p.correct_only, F.col("analysis_status") == CORRECT_ANALYSIS)


def _record_keys(tests: DataFrame) -> DataFrame:
    return tests.filter("data_id <> 0").select("wip_id", "process_id", "data_id")


def defect_names(t: Tables, p: HistoryParams) -> DataFrame:
    named = texts(t, p.language)
    categories = with_text(t["qm_defect_category"], "defect_category", "category_name", named)
    defects = with_text(t["qm_defects"], "defect", "defect_name", named)
    df = defects.join(categories.select("defect_category_id", "category_name"), "defect_category_id")
    df = optional_in(df, "defect_id", ids(p.defects), t["qm_defects"])
    df = optional_not_in(df, "defect_id", ids(p.exclude_defects), t["qm_defects"])
    df = optional_in(df, "defect_category_id", ids(p.defect_categories), t["qm_defect_category"])
    return df.select(
        "defect_id",
        F.col("defect_name").alias("defect"),
        "defect_category_id",
        F.col("category_name").alias("defect_category"),
    )


ANALYSIS_IDS = ["analysis_wip_id", "analysis_process_id", "analysis_data_id", "analysis_id"]
REPAIR_IDS = [
    "repair_wip_id", "repair_process_id", "repair_data_id", "repair_analysis_id", "repair_id", "old_grn_id", "new_grn_id",
]


def _materials(t: Tables, p: HistoryParams) -> DataFrame:
    return member_if(t["cr_materials"], "component_type", names(p.component_types))


def analysis_ids(t: Tables, tests: DataFrame, p: HistoryParams) -> DataFrame:
    """Defect analyses of the tests, as ``ANALYSIS_IDS``. Tests without labels have no data id, so they have none.

    An analysis counts only if its defect, material and analyst are known, so their keys are looked up here already.
    """
    bounds = [None if d is None else s.ntz(d) for d in (p.analysis_start, p.analysis_end)]
    # Without bounds only analyses without a date go.
    analyses = t["qm_analysis"].filter(s.between_optional("analysis_date_time", *bounds))
    given = p.min_analysis_id is not None
    analyses = filter_if(analyses, given, s.between_optional("analysis_id", p.min_analysis_id))
    analyses = filter_if(analyses, p.component_defects_only, F.col("material_id") != 0)
    analyses = member_if(analyses, "material_id", ids(p.materials))
    analyses = optional_in(analyses, "analysis_by_id", ids(p.analysis_users), t["sc_users"], "user_id")
    analyses = (
        analyses.join(defect_names(t, p).select("defect_id"), "defect_id", "left_semi")
        .join(_materials(t, p).select("material_id"), "material_id", "left_semi")
        .join(user_names(t, "analysis_by_id", "analysis_user").select("analysis_by_id"), "analysis_by_id", "left_semi")
        .select("analysis_id")
    )
    links = _defect_links(t, p).filter("data_id <> 0").select("wip_id", "process_id", "data_id", "analysis_id")
    found = links.join(_record_keys(tests), ["wip_id", "process_id", "data_id"]).join(analyses, "analysis_id", "left_semi")
    return found.select(*[F.col(c.removeprefix("analysis_") if c != "analysis_id" else c).alias(c) for c in ANALYSIS_IDS])


def name_analyses(t: Tables, p: HistoryParams, rows: DataFrame) -> DataFrame:
    """Put the columns of the analysis to ``rows``, which have its id from ``analysis_ids``; rows without an analysis keep
    NULLs. Rows meet the analysis before its texts, so that only ids move; an analysis that can't be named goes."""
    known = ["_material", "_defect", "_user"]
    materials = _materials(t, p).select(
        "material_id", "material", F.col("descr").alias("material_descr"), "component_type", "pin_count"
    )
    named = [
        (materials, "material_id"),
        (defect_names(t, p), "defect_id"),
        (user_names(t, "analysis_user_id", "analysis_user"), "analysis_user_id"),
    ]
    own = [
        "analysis_id", "defect_id", "material_id", "defect_count", "defect_location", "equipment_or_route_step_id",
        "is_equipment", "feeder_tray_track_id", "defect_detail", "analysis_date_time",
    ]
    analyses = t["qm_analysis"].select(*own, F.col("analysis_by_id").alias("analysis_user_id"))
    found = rows.join(analyses, "analysis_id", "left")
    for mark, (names_, key) in zip(known, named):
        found = found.join(names_.withColumn(mark, F.lit(True)), key, "left")
    whole = F.col("analysis_id").isNull() | F.expr(" AND ".join(f"{mark} IS NOT NULL" for mark in known))
    others = [c for c in rows.columns if c != "analysis_id"]
    return found.filter(whole).select("analysis_id", *others, *[c for c in ANALYSIS_COLUMNS if c not in ANALYSIS_IDS])


def analysis_records(t: Tables, tests: DataFrame, p: HistoryParams) -> DataFrame:
    """Defect analyses of the tests with their descriptive columns."""
    return name_analyses(t, p, analysis_ids(t, tests, p)).select(*ANALYSIS_COLUMNS)


def _repair_categories(t: Tables, p: HistoryParams) -> DataFrame:
    named = with_text(t["qm_repair_category"], "repair_category", "category_name", texts(t, p.language))
    return named.select("repair_category_id", F.col("category_name").alias("repair_category"))


def repair_ids(t: Tables, tests: DataFrame, analyses: DataFrame, p: HistoryParams) -> DataFrame:
    """Repairs of those analyses, as ``REPAIR_IDS``.

    An analysis that serves several records gives its repair once per pair of them. ``repair_start`` and ``repair_end``
    bound the rework date (half-open), and ``replaced_only`` keeps repairs that replaced a lot.
    """
    repairs = optional_in(
        t["qm_repair"].filter("repair_id <> 0"), "repaired_by_id", ids(p.repair_users), t["sc_users"], "user_id"
    )
    if p.repair_start is not None:
        repairs = repairs.filter(F.col("repair_date_time") >= s.ntz(p.repair_start))
    if p.repair_end is not None:
        repairs = repairs.filter(F.col("repair_date_time") < s.ntz(p.repair_end))
    repairs = (
        repairs.join(_repair_categories(t, p).select("repair_category_id"), "repair_category_id", "left_semi")
        .join(user_names(t, "repaired_by_id", "repaired_by").select("repaired_by_id"), "repaired_by_id", "left_semi")
        .select("repair_id")
    )
    replacements = t["qm_grn_replacement"].filter("repair_id <> 0").select("repair_id", "old_grn_id", "new_grn_id")
    analysed = analyses.select(
        F.col("analysis_wip_id").alias("wip_id"), F.col("analysis_process_id").alias("process_id"), "analysis_id"
    )
    links = (
        _defect_links(t, p)
        .filter("data_id <> 0 AND repair_id <> 0")
        .select("wip_id", "process_id", "data_id", "analysis_id", "repair_id")
    )
    found = (
        links.join(_record_keys(tests), ["wip_id", "process_id", "data_id"])
        .join(analysed, ["wip_id", "process_id", "analysis_id"])
        .join(repairs, "repair_id", "left_semi")
        .join(replacements, "repair_id", "inner" if p.replaced_only else "left")
    )
    own = {"repair_wip_id": "wip_id", "repair_process_id": "process_id", "repair_data_id": "data_id", "repair_analysis_id": "analysis_id"}
    return found.select(*[F.col(own.get(c, c)).alias(c) for c in REPAIR_IDS])


def name_repairs(t: Tables, p: HistoryParams, rows: DataFrame) -> DataFrame:
    """Put the columns of the repair and the texts of its lots to ``rows``, which have their ids; rows without a repair
    keep NULLs. Old and new lot texts stand with their own ids; ``legacy_grn_labels`` swaps the two texts as the
    former list did. The lots come first, while rows are ids."""
    repairs = (
        t["qm_repair"]
        .join(_repair_categories(t, p), "repair_category_id")
        .join(user_names(t, "repaired_by_id", "repaired_by"), "repaired_by_id")
        .select("repair_id", *[c for c in REPAIR_COLUMNS if c not in (*REPAIR_IDS, "old_grn", "new_grn")])
    )
    lot = t["cr_grns"].select("grn_id", "grn")
    shown = {"old_grn_id": "old_grn", "new_grn_id": "new_grn"}
    if p.legacy_grn_labels:
        shown = {"old_grn_id": "new_grn", "new_grn_id": "old_grn"}
    for lot_id, name in shown.items():
        rows = rows.join(lot.select(F.col("grn_id").alias(lot_id), F.col("grn").alias(name)), lot_id, "left")
    return rows.join(repairs, "repair_id", "left")


def repair_records(t: Tables, tests: DataFrame, analyses: DataFrame, p: HistoryParams) -> DataFrame:
    """Repairs of those analyses with the replaced and the new lot."""
    return name_repairs(t, p, repair_ids(t, tests, analyses, p)).select(*REPAIR_COLUMNS)


# --- result forms -------------------------------------------------------------------------


def assembly_test_summary(tests: DataFrame) -> DataFrame:
    return ordered(status_counts(tests, ASSEMBLY_COLUMNS), ["number", "revision", "version"])


def route_step_test_summary(tests: DataFrame) -> DataFrame:
    return ordered(
        status_counts(tests, ROUTE_COLUMNS), ["test_factory", "test_manufacturing_area", "test_route", "test_route_step"]
    )


def total_test_summary(tests: DataFrame) -> DataFrame:
    return status_counts(tests)


def _join_analyses(tests: DataFrame, analyses: DataFrame, how: str) -> DataFrame:
    on = [
        F.col("wip_id") == F.col("analysis_wip_id"),
        F.col("process_id") == F.col("analysis_process_id"),
        F.col("data_id") == F.col("analysis_data_id"),
    ]
    return tests.join(analyses, on, how)


def _join_repairs(df: DataFrame, repairs: DataFrame, how: str) -> DataFrame:
    on = [
        F.col("analysis_wip_id") == F.col("repair_wip_id"),
        F.col("analysis_process_id") == F.col("repair_process_id"),
        F.col("analysis_data_id") == F.col("repair_data_id"),
        F.col("analysis_id") == F.col("repair_analysis_id"),
    ]
    return df.join(repairs, on, how)


def with_repairs(analyses: DataFrame, repairs: DataFrame, mode: Mode = Mode.ALL) -> DataFrame:
    return _join_repairs(analyses, repairs, "inner" if mode is Mode.REPAIR else "left")


def with_analyses(tests: DataFrame, found: DataFrame, mode: Mode = Mode.ALL) -> DataFrame:
    return _join_analyses(tests, found, "left" if mode is Mode.ALL else "inner")


def history_rows(tests: DataFrame, analyses: DataFrame, repairs: DataFrame, mode: Mode = Mode.ALL) -> DataFrame:
    """Tests with their analyses and repairs: all tests, those analysed, or those repaired. Repairs are put to the analyses
    first, so that the tests, which are most, are joined once."""
    return with_analyses(tests, with_repairs(analyses, repairs, mode), mode)


def tests_with_counts(tests: DataFrame, analyses: DataFrame, repairs: DataFrame) -> DataFrame:
    """One row per test with the numbers of joined label, analysis and repair rows. Only ids are joined and grouped."""
    return (
        history_rows(tests, analyses, repairs)
        .groupBy(*TEST_IDS)
        .agg(
            F.count("data_label").alias("data_label_count"),
            F.count("analysis_wip_id").alias("analysis_records"),
            F.count("repair_wip_id").alias("repair_records"),
        )
    )


ROW_ORDER = ["process_id", "data_id", "analysis_id", "repair_id", "new_grn_id", "old_grn_id"]

#: What analyses and repairs repeat of the rows they are joined to: their own id and, if that is there, the same values.
REPEATED = {
    "analysis_id": {"analysis_wip_id": "wip_id", "analysis_process_id": "process_id", "analysis_data_id": "data_id"},
    "repair_id": {
        "repair_wip_id": "wip_id", "repair_process_id": "process_id", "repair_data_id": "data_id",
        "repair_analysis_id": "analysis_id",
    },
}


def without_repeated(named: DataFrame) -> DataFrame:
    return named.drop(*[c for columns in REPEATED.values() for c in columns])


def with_repeated(rows: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """The columns of a history; those that ``without_repeated`` left out are told from the others, in types of ``kinds``."""
    same = {c: (mark, of) for mark, columns in REPEATED.items() for c, of in columns.items()}
    again = {c: F.when(F.col(mark).isNotNull(), F.col(of)).cast(kinds[c]).alias(c) for c, (mark, of) in same.items()}
    return rows.select(*[again.get(c, F.col(c)) for c in (*RECORD_COLUMNS, *ANALYSIS_COLUMNS, *REPAIR_COLUMNS)])


def test_history(
    t: Tables,
    p: HistoryParams,
    mode: Mode = Mode.ALL,
    user_id: int | None = None,
    stage: Callable[[DataFrame], DataFrame] = staged,
) -> DataFrame:
    """Result of one call in the form of ``mode``, ordered, and cut to ``max_count`` rows if set.

    The user, if given, must be active. Only what the mode needs is built. Tests, analyses and repairs are found, joined,
    counted, ordered and cut as ids; what describes them is joined to the rows that are left. The ids of the
    records and of the analyses are read by several joins: ``stage`` writes them once, by default to the folder that
    executors share. Without a cap so are the analyses with their repairs, the counts, and the rows before they are ordered. The row cap applies to the ordered result only, so it never loses tests that an analysis
    needs. Keys of tables that describe (units, users, materials, lots and so on) are taken as unique.
    """
    if user_id is not None:
        require_active_user(t["sc_users"], user_id)
    if mode in SUMMARIES:
        tests = test_records(t, p)
        if mode is Mode.TOTAL:
            return cap(total_test_summary(tests), p.max_count)
        return cap((assembly_test_summary if mode is Mode.ASSEMBLY else route_step_test_summary)(tests), p.max_count)
    tests = stage(record_ids(t, p, complete=bool(p.max_count)))
    analyses = stage(analysis_ids(t, tests, p))
    repairs = repair_ids(t, tests, analyses, p)
    time = "test_start_date_time"
    if mode is Mode.COUNTS:
        counted = tests_with_counts(tests, analyses, repairs)
        chosen = cap(newest_first(counted, time, "process_id"), p.max_count) if p.max_count else stage(counted)
        return cap(newest_first(name_tests(t, p, chosen), time, "process_id"), p.max_count)
    if p.max_count:
        rows = cap(newest_first(history_rows(tests, analyses, repairs, mode), time, *ROW_ORDER), p.max_count)
        # Large tables are joined to narrow rows; the texts of small ones come last, so that only the order moves them.
        units = rows.join(_units(t, p), "wip_id")
        named = name_tests(t, p, name_analyses(t, p, name_repairs(t, p, units)))
    else:
        # Repairs and analyses are named before they meet the tests, so that rows of all three move only once before the
        # order. Each part is written: what it has shuffled needn't be kept for the next one.
        found = stage(with_repairs(name_analyses(t, p, analyses), name_repairs(t, p, repairs), mode))
        named = name_tests(t, p, with_analyses(tests.join(_units(t, p), "wip_id"), found, mode))
    rows = without_repeated(named)
    rows = newest_first(rows if p.max_count else stage(rows), time, *ROW_ORDER)
    return cap(with_repeated(rows, dict(named.dtypes)), p.max_count)


def audited_history(
    t: Tables,
    p: HistoryParams,
    mode: Mode,
    user_id: int,
    action: Callable[[DataFrame], object],
    audit: str,
    zone: str = "UTC",
) -> object:
    """``timed_history`` that appends the record of the finished call to the audit table at ``audit``."""
    result, record = timed_history(t, p, mode, user_id, action, zone)
    write_audit(t["sc_users"].sparkSession, audit, **record)
    return result


def timed_history(
    t: Tables, p: HistoryParams, mode: Mode, user_id: int, action: Callable[[DataFrame], object], zone: str = "UTC"
) -> tuple[object, dict]:
    """Run ``action`` on the history and return its result with the audit record of the call."""
    import zoneinfo

    def clock():
        return dt.datetime.now(zoneinfo.ZoneInfo(zone)).replace(tzinfo=None)

    start = clock()
    result = action(test_history(t, p, mode, user_id))
    return result, {"procedure": "test_history", "user_id": user_id, "start": start, "end": clock()}
