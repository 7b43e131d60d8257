import datetime as dt
import random

import pytest
from plant import empty_tables, plant

from lotwise.operators.relational import rank_latest_load, top1
from lotwise.plans import consumption as cons
from lotwise.plans import trace
from lotwise.sources.tables import Tables

DAY = (dt.date(2025, 1, 8), dt.date(2025, 1, 9))


def detail(t, days=DAY):
    rows = cons.consumed_detail(t, *days).collect()
    return sorted((r.run_date.day, r.wip_id, r.crd, r.grn, r.branch) for r in rows)


def test_units_sharing_a_serial_stay_apart(spark):
    units = [(1, "SN", 68, 0), (2, "SN", 110, 0), (3, "SN", 200, 0)]
    steps = [(1, "10:00", "10:01"), (2, "12:00", "12:01"), (3, "12:00", "12:01")]
    t = empty_tables(spark, **plant(steps, [(10, "09:00", "11:00"), (11, "11:30", None)], units=units))
    assert detail(t) == [(8, 1, "C1", "G10", "EquipmentSetup"), (8, 2, "C1", "G11", "EquipmentSetup")]


def test_equal_load_times_take_the_higher_lot(spark):
    t = empty_tables(spark, **plant([(1, "10:00", None)], [(10, "09:00", None), (11, "09:00", None)]))
    assert detail(t) == [(8, 1, "C1", "G11", "EquipmentSetup")]


def test_latest_load_still_on_wins_over_a_later_removed_one(spark):
    loads = [(10, "09:00", "11:00"), (11, "09:30", "09:40"), (12, "08:00", None)]
    t = empty_tables(spark, **plant([(1, "10:00", "10:01")], loads))
    assert detail(t) == [(8, 1, "C1", "G10", "EquipmentSetup")]


def test_enclosed_load_does_not_match(spark):
    t = empty_tables(spark, **plant([(1, "09:00", "13:00")], [(10, "10:00", "12:00")]))
    assert detail(t) == []


def test_lots_of_unknown_material_are_passed_over(spark):
    t = empty_tables(spark, **plant([(1, "10:00", None)], [(10, "08:00", None), (13, "09:00", None)]))
    assert detail(t) == [(8, 1, "C1", "G10", "EquipmentSetup")]


def test_both_routes_count_and_replacement_takes_over(spark):
    base = dict(steps=[(1, "10:00", None)], loads=[(10, "09:00", None)], bins=[(11, "09:00", None)])
    assert detail(empty_tables(spark, **plant(**base))) == [
        (8, 1, "B1", "G11", "RouteStepSetup"),
        (8, 1, "C1", "G10", "EquipmentSetup"),
    ]
    with_new = plant(**base, replaced=[(1, "C1", 12), (1, "C1", 12), (1, "B1", 0)])
    assert detail(empty_tables(spark, **with_new)) == [
        (8, 1, "B1", "G11", "RouteStepSetup"),
        (8, 1, "C1", "G12", "Replacement"),
    ]


def test_replacement_repeats_on_each_day_of_the_unit(spark):
    steps = [(1, "10:00", None), (1, "2025-01-09 10:00:00", None)]
    t = empty_tables(spark, **plant(steps, replaced=[(1, "C9", 12)]))
    assert detail(t, (DAY[0], dt.date(2025, 1, 10))) == [
        (8, 1, "C9", "G12", "Replacement"),
        (9, 1, "C9", "G12", "Replacement"),
    ]


def test_no_steps_no_rows(spark):
    t = empty_tables(spark, **plant([(1, "2025-02-01 10:00:00", None)], [(10, "09:00", None)]))
    assert detail(t) == []
    steps = cons.wip_steps(t, *DAY)
    assert cons.consumed_equipment(t, steps).count() == cons.consumed_bins(t, steps).count() == 0


def by_hand(steps, loads):
    """Latest matching load per unit, by testing every pair."""
    found = {}
    for wip, a, b in steps:
        for lot, lo, hi in loads:
            on = any(x is not None and x >= lo and (hi is None or x <= hi) for x in (a, b))
            if on:
                found[wip] = max(found.get(wip, (lo, lot)), (lo, lot))
    return sorted((wip, f"G{lot}") for wip, (_, lot) in found.items())


@pytest.mark.parametrize("seed", [1, 2])
def test_busy_machine_equals_every_pair(spark, seed):
    """One machine has all steps and all loads, with times to the microsecond."""
    rnd = random.Random(seed)
    start = dt.datetime(2025, 1, 8)

    def when(lo=0, hi=86_400_000_000):
        return start + dt.timedelta(microseconds=rnd.randrange(lo, hi))

    steps = []
    for wip in range(150):
        a = when()
        steps.append((wip, a, None if rnd.random() < 0.1 else a + dt.timedelta(minutes=rnd.randrange(90))))
    loads = []
    for lot in range(100, 400):
        lo = when(-86_400_000_000)
        span = rnd.choice([1, 30, 600])
        loads.append((lot, lo, None if rnd.random() < 0.02 else lo + dt.timedelta(minutes=span)))
    text = lambda x: None if x is None else x.isoformat(sep=" ")
    tables = plant(
        [(w, text(a), text(b)) for w, a, b in steps], [(lot, text(a), text(b)) for lot, a, b in loads]
    ) | dict(cr_grns=[(lot, f"G{lot}", 1, "V", "M") for lot, _, _ in loads])
    t = empty_tables(spark, **tables)
    got = sorted((r.wip_id, r.grn) for r in cons.consumed_detail(t, *DAY).collect())
    assert got == by_hand(steps, loads)


def test_trace_lists_all_lots_of_all_days(spark):
    steps = [(1, "10:00", None), (1, "2025-01-20 10:00:00", None)]
    loads = [(10, "09:00", "11:00"), (11, "08:00", "11:00"), (12, "2025-01-19 00:00:00", None)]
    t = empty_tables(spark, **plant(steps, loads, replaced=[(1, "C9", 12)]))
    units = spark.createDataFrame([("SN1", 68), ("SN1", 110)], "serial_number string, customer_id int")
    rows = sorted((r.crd, r.grn) for r in trace.component_trace(t, units).collect())
    assert rows == [("C1", "G10"), ("C1", "G11"), ("C1", "G12"), ("C9", "G12")]
    assert [r.grn for r in trace.unit_trace(t, units).collect()] == ["G10", "G11", "G12", "G12"]


def test_counting_per_lot_first_changes_nothing(star):
    direct = cons.consumed_qty(cons.consumed_detail(star, *DAY)).collect()
    early = cons.consumed_qty_of_days(star, *DAY).collect()
    assert sorted(map(str, direct)) == sorted(map(str, early))


def test_latest_load_is_rank_one(star, spark):
    loads = star["ct_component_use"]
    ranked = top1(rank_latest_load(loads, ["equipment_setup_id", "feeder_tray_track_id"]))
    from lotwise.operators.relational import latest_load

    best = latest_load(loads, ["equipment_setup_id", "feeder_tray_track_id"])
    assert ranked.select(*best.columns).exceptAll(best).isEmpty()
    assert ranked.count() == best.count()


def test_rank_orders_like_time_and_lot(spark):
    from pyspark.sql import functions as F

    from lotwise.operators.relational import load_rank, lot_of

    times = ["1969-12-31 23:59:59.999999", "2025-03-30 02:30:00", "2025-03-30 03:30:00", "2025-01-08 10:00:00.000001", "9999-12-31 23:59:59"]
    rows = [(dt.datetime.fromisoformat(x), lot) for x in times for lot in (-(2**63), -1, 0, 7, 2**63 - 1)]
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        df = spark.createDataFrame(rows, "load_time timestamp_ntz, grn_id long").withColumn("rank", load_rank())
        got = [tuple(r) for r in df.orderBy("rank").select("load_time", "grn_id", lot_of().alias("lot")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [g[:2] for g in got] == sorted(rows) and all(g[1] == g[2] for g in got)
    assert df.select(F.countDistinct("rank")).first()[0] == len(rows)


def test_edge_normalisation(spark):
    rows = spark.createDataFrame([(1, "sn1  ", 68, 0)], "wip_id long, serial_number string, customer_id int, rma int")
    t = Tables.of({"wp_wip": rows}, rtrim=True, upper_keys=True)
    assert t["wp_wip"].first()["serial_number"] == "SN1"


def test_zoned_times_become_local(spark):
    rows = spark.sql("SELECT 1L AS wip_id, TIMESTAMP '2025-01-08 10:00:00' AS start_time")
    t = Tables.of({"wp_wip_route_steps": rows})
    assert t["wp_wip_route_steps"].schema["start_time"].dataType.simpleString() == "timestamp_ntz"


def test_loads_of_a_slot_share_their_edges(spark):
    """However many loads were taken off at one moment, a step there meets few of them."""
    from lotwise.operators.intervals import is_edge, time_grid

    loads = [(lot, f"0{lot % 10}:{lot // 10:02}", "12:00") for lot in range(100, 400)] + [(400, "11:00", "13:00")]
    steps = [(1, "12:00", "12:01"), (2, "12:14", "12:20")]
    tables = plant(steps, loads) | dict(cr_grns=[(lot, f"G{lot}", 1, "V", "M") for lot, _, _ in loads])
    t = empty_tables(spark, **tables)
    grid = time_grid(cons.wip_steps(t, *DAY), cons.STEP_TIMES)
    ends = cons.loads_by_block(t, grid).filter(is_edge()).filter("grn_id < 400 AND shiftright(block, 6) = 48")
    assert ends.count() == 300 and ends.select("since", "removal_time").distinct().count() == 1
    assert detail(t) == [(8, 1, "C1", "G400", "EquipmentSetup"), (8, 2, "C1", "G400", "EquipmentSetup")]
    cells = ends.withColumn("tick", cons.F.shiftright("block", 6))
    kept = [*cons.CELL_KEYS, "slot", "since", "removal_time", "rank"]
    whole = cells.withColumns({c: cons.F.lit(None).cast("timestamp_ntz") for c in ("since", "removal_time")})
    older, newer = cells.filter("grn_id = 100").select(kept), whole.filter("grn_id = 309").select(kept)
    assert cons._not_outdone(older.union(newer)).count() == 1 and cons._not_outdone(older).count() == 1


pytestmark = pytest.mark.usefixtures("interpreted")
