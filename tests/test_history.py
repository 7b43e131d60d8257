import pytest
from plant import DIMENSIONS, at, empty_tables

from lotwise.sources.schemas import LOOKUPS
from lotwise.sources.tables import Tables
from lotwise.plans import history as h

PARAMS = dict(start="2025-01-08", end="2025-01-09")


def tiny(spark, **more):
    tables = DIMENSIONS | dict(
        wp_wip=[(1, "SN1", 68, 0), (2, "SN2", 68, 1)],
        qm_test_data=[
            (1, 100, 7, 1, 3, 5, "F", 1, 1, at("10:00"), at("10:05")),
            (2, 200, 7, 1, 3, 5, "P", 1, 1, at("11:00"), at("11:05")),
        ],
        qm_data_rec=[(1, 100, 1000, "DL")],
        qm_data_analysis=[(1, 100, 1000, 70, 90, "F", "C")],
        qm_analysis=[(70, 1, 0, 1, 6, "C1", 0, 0, 0, "D", at("12:00"))],
        qm_repair=[(90, 0, 5, "RD", "memo", at("13:00"))],
        qm_grn_replacement=[(1, "C1", 10, 11, 90)],
        qm_defects=[(0, 3, 0)],
        qm_defect_category=[(0, 3)],
        qm_repair_category=[(0, 3)],
        qm_test_status=[(101,), (102,)],
        cr_text=[(3, 0, "text"), (101, 0, "P"), (102, 0, "F")],
        cr_customers=[(68, 3, 3)],
        cr_families=[(1, 3)],
        cr_assemblies=[(7, "ASM", "R", "V", 68, 1)],
        cr_fmrs_v=[(1, 1, 101, 0, "FA", "MA", "RT", "ST")],
        cr_equipment_v=[(3, "EQ")],
        sc_users=[(5, "", "Last", 1), (6, "First", "Last", 0)],
    )
    return empty_tables(spark, **(tables | more))


def test_texts_of_small_tables_move_last(spark):
    """Large tables are joined while rows are narrow: few shuffles carry the assembly's texts."""
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.debug.maxToStringFields": "1000"}
    keep = {k: spark.conf.get(k) for k in off}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        rows = h.test_history(tiny(spark), h.HistoryParams(**PARAMS), stage=lambda df: df)
        text = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    lines = text.splitlines()
    # Each shuffle of joined rows stands above the projection that says what it carries.
    wide = [i for i, x in enumerate(lines) if "Exchange" in x and any("revision" in y and "analysis_id" in y for y in lines[i + 1 : i + 3])]
    assert 1 <= len(wide) <= 4


def test_an_analysis_that_cannot_be_named_goes(spark):
    """Of two rows of one analysis the one with an unknown material is left out, as it was when texts were joined first."""
    known, unknown = (70, 1, 0, 1, 6, "C1", 0, 0, 0, "D", at("12:00")), (70, 99, 0, 1, 6, "C2", 0, 0, 0, "D", at("12:00"))
    p = h.HistoryParams(**PARAMS)
    found = h.test_history(tiny(spark, qm_analysis=[known, unknown]), p, stage=lambda df: df).collect()
    assert [(r.wip_id, r.analysis_id, r.material, r.defect_location) for r in found if r.analysis_id] == [(1, 70, "AS100", "C1")]
    assert [r.wip_id for r in found if r.analysis_id is None] == [2]


def test_mode_order():
    assert h.choose_mode() is h.Mode.ALL
    assert h.choose_mode(analysis=True, repair=True) is h.Mode.REPAIR
    assert h.choose_mode(route_step=True, assembly=True, total=True) is h.Mode.ASSEMBLY
    assert h.choose_mode(total=True, route_step=True) is h.Mode.ROUTE_STEP
    assert h.choose_mode(counts=True, repair=True) is h.Mode.COUNTS


def test_all_and_lot_labels(spark):
    t = tiny(spark)
    rows = h.test_history(t, h.HistoryParams(**PARAMS)).collect()
    assert [(r.process_id, r.analysis_id, r.repair_id) for r in rows] == [(200, None, None), (100, 70, 90)]
    r = rows[1]
    assert (r.old_grn_id, r.old_grn, r.new_grn_id, r.new_grn) == (10, "G10", 11, "G11")
    assert (r.test_user, r.analysis_user) == ("Last", "First Last")
    legacy = h.test_history(t, h.HistoryParams(**PARAMS, legacy_grn_labels=True), h.Mode.REPAIR).collect()
    assert [(r.old_grn_id, r.old_grn, r.new_grn_id, r.new_grn) for r in legacy] == [(10, "G11", 11, "G10")]
    assert len(h.test_history(t, h.HistoryParams(**PARAMS, max_count=1)).collect()) == 1


def test_without_labels_nothing_is_analysed(spark):
    p = h.HistoryParams(**PARAMS, show_labels=False)
    rows = h.test_history(tiny(spark), p).collect()
    assert [(r.data_id, r.data_label, r.analysis_id) for r in rows] == [(0, "", None)] * 2
    assert h.test_history(tiny(spark), p, h.Mode.ANALYSIS).count() == 0


@pytest.mark.parametrize(
    "filters,left",
    [
        (dict(statuses="P"), [200]),
        (dict(statuses="A"), []),
        (dict(serial_numbers=["SN1"]), [100]),
        (dict(exclude_rma=True), [100]),
        (dict(customers="68,110"), [100, 200]),
        (dict(customers="110"), []),
        (dict(equipment="3", route_steps="1", steps="101", factory_routes="1"), [100, 200]),
        (dict(test_users="6"), []),
        (dict(min_process_id=150), [200]),
        (dict(loop_begin=2), []),
    ],
)
def test_filters(spark, filters, left):
    rows = h.test_records(tiny(spark), h.HistoryParams(**PARAMS, **filters)).collect()
    assert sorted({r.process_id for r in rows}) == left


@pytest.mark.parametrize(
    "filters,n",
    [
        (dict(defects="0"), 1),
        (dict(exclude_defects="0"), 0),
        (dict(materials="1", component_types="R"), 1),
        (dict(component_types="C"), 0),
        (dict(analysis_users="6"), 1),
        (dict(analysis_start="2025-01-08 12:30:00"), 0),
        (dict(analysis_end="2025-01-08 12:00:00"), 1),
        (dict(defect_categories="1"), 0),
    ],
)
def test_analysis_filters(spark, filters, n):
    assert h.test_history(tiny(spark), h.HistoryParams(**PARAMS, **filters), h.Mode.ANALYSIS).count() == n


def test_repair_filters(spark):
    count = lambda **kw: h.test_history(tiny(spark), h.HistoryParams(**PARAMS, **kw), h.Mode.REPAIR).count()
    assert count(repair_users="5") == 1 and count(repair_users="6") == 0
    assert count(repair_start="2025-01-08 13:00:00") == 1 and count(repair_end="2025-01-08 13:00:00") == 0
    assert count(replaced_only=True) == 1


def test_ids_first_texts_last(spark):
    """Tests are scanned once; what is joined, counted, sorted and cut holds no texts but the record's label."""
    t, p = tiny(spark), h.HistoryParams(**PARAMS, max_count=1)
    seen = []
    scans = []
    counted = Tables(lambda name: scans.append(name) or t[name])
    counted._seen = {}
    rows = h.test_history(counted, p, stage=lambda df: seen.append(df.columns) or df.checkpoint())
    assert [r.process_id for r in rows.collect()] == [200] and scans.count("qm_test_data") == 1
    assert seen == [[*h.TEST_IDS, "data_label", "data_id"], h.ANALYSIS_IDS]
    text = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "qm_test_data" not in text and "GlobalLimit 1" in text


def test_lists_as_relations(spark):
    one = lambda v, kind: spark.createDataFrame([(v,)], f"v {kind}")
    count = lambda **kw: h.test_history(tiny(spark), h.HistoryParams(**PARAMS, **kw), h.Mode.REPAIR).count()
    assert count(serial_numbers=one("SN1", "string"), materials=one(1, "long"), repair_users=one(5, "int")) == 1
    assert count(serial_numbers=one("SN2", "string")) == count(materials=one(2, "long")) == 0


def test_empty_total_is_null(spark):
    row = h.test_history(tiny(spark, qm_test_data=[]), h.HistoryParams(**PARAMS), h.Mode.TOTAL).first()
    assert tuple(row) == (None, None, None)


def test_user_must_be_active(spark):
    t = tiny(spark)
    h.test_history(t, h.HistoryParams(**PARAMS), h.Mode.TOTAL, user_id=5)
    for user in (6, 99):
        with pytest.raises(PermissionError):
            h.test_history(t, h.HistoryParams(**PARAMS), h.Mode.TOTAL, user_id=user)


def test_staged_and_timed(spark, tmp_path):
    from lotwise.sources.star import shared_folder

    shared_folder(spark)
    t, p = tiny(spark), h.HistoryParams(**PARAMS)
    staged = h.test_history(t, p, h.Mode.COUNTS, stage=lambda df: df.checkpoint()).collect()
    assert [(r.process_id, r.data_label_count, r.analysis_records, r.repair_records) for r in staged] == [
        (200, 1, 0, 0),
        (100, 1, 1, 1),
    ]
    path = str(tmp_path / "audit")
    assert h.audited_history(t, p, h.Mode.ALL, 5, lambda df: df.count(), path) == 2
    assert [(r.procedure, r.user_id) for r in spark.read.parquet(path).collect()] == [("test_history", 5)]
    n, audit = h.timed_history(t, p, h.Mode.ALL, 5, lambda df: df.count())
    assert n == 2 and audit["user_id"] == 5 and audit["start"] <= audit["end"]


pytestmark = pytest.mark.usefixtures("interpreted")


def test_unreadable_lookup_is_an_error():
    def load(name):
        raise PermissionError(name)

    with pytest.raises(PermissionError):
        Tables(load)[next(iter(LOOKUPS))]
    with pytest.raises(ValueError):
        Tables(load, absent=["wp_wip"])
