"""Consumed components of the units that had a production step on a day.

The unit id and the run date are part of every key, so all units and all days are worked on at
once. Load times are matched through time blocks (see ``operators.intervals``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotwise.constants import EQUIPMENT_SETUP, REPLACEMENT, REPORT_CUSTOMERS, ROUTE_STEP_SETUP
from lotwise.functions.scalars import DateLike, as_date, in_list, in_window
from lotwise.operators.collation import EXACT, Comparison
from lotwise.operators.intervals import TimeGrid, active_within, on_at, time_grid
from lotwise.operators.relational import count_by, latest_rank, load_rank, lot_of, union_bag
from lotwise.sources.tables import Tables

# Keys that differ most come first: sorting and hashing compare them first.
POSITION_KEYS = ["wip_id", "crd", "run_date", "serial_number", "branch"]
BLOCK_KEYS = ["block", "setup_id", "branch"]
CELL_KEYS = ["tick", "setup_id", "branch"]
STEP_TIMES = ["start_time", "end_time"]

# Equipment of setups that hold for a route step on any equipment.
ANY_EQUIPMENT = -1


@dataclass(frozen=True)
class LoadRoute:
    """One way a lot gets to a position: setup, load history, and the positions a slot feeds."""

    branch: str
    setup: str
    setup_id: str
    by_equipment: bool
    loads: str
    slot: str
    slots: str
    slot_id: str
    positions: str

    def setups(self, t: Tables) -> DataFrame:
        equipment = F.col("equipment_id").cast("long") if self.by_equipment else F.lit(ANY_EQUIPMENT).cast("long")
        return t[self.setup].select(
            F.lit(self.branch).alias("branch"),
            F.col(self.setup_id).cast("long").alias("setup_id"),
            F.col("assembly_id").cast("long").alias("assembly_id"),
            F.col("route_step_id").cast("long").alias("route_step_id"),
            equipment.alias("setup_equipment"),
        )

    def load_history(self, t: Tables) -> DataFrame:
        return t[self.loads].select(
            F.lit(self.branch).alias("branch"),
            F.col(self.setup_id).cast("long").alias("setup_id"),
            F.col(self.slot).cast("long").alias("slot"),
            "grn_id",
            "load_time",
            "removal_time",
        )

    def slot_positions(self, t: Tables) -> DataFrame:
        slots = t[self.slots].select(
            F.col(self.setup_id).cast("long").alias("setup_id"),
            F.col(self.slot).cast("long").alias("slot"),
            self.slot_id,
        )
        return slots.join(t[self.positions], self.slot_id).select(
            F.lit(self.branch).alias("branch"), "setup_id", "slot", "crd"
        )


EQUIPMENT_ROUTE = LoadRoute(
    branch=EQUIPMENT_SETUP,
    setup="ct_equipment_setup",
    setup_id="equipment_setup_id",
    by_equipment=True,
    loads="ct_component_use",
    slot="feeder_tray_track_id",
    slots="ct_equipment_setup_feeders",
    slot_id="feeder_id",
    positions="ct_feeder_crds",
)

BIN_ROUTE = LoadRoute(
    branch=ROUTE_STEP_SETUP,
    setup="ct_route_step_setup",
    setup_id="route_step_setup_id",
    by_equipment=False,
    loads="ct_component_use_bins",
    slot="bin",
    slots="ct_route_step_setup_bins",
    slot_id="route_step_setup_bin_id",
    positions="ct_bin_crds",
)

LOAD_ROUTES = (EQUIPMENT_ROUTE, BIN_ROUTE)


# --- units of the day ---------------------------------------------------------------------


def wip_steps(t: Tables, start: DateLike, end: DateLike, customers: Sequence[int] = REPORT_CUSTOMERS) -> DataFrame:
    """Steps started in ``[start, end)`` on units of the customers, with serial number and day."""
    steps = t["wp_wip_route_steps"].filter(in_window("start_time", start, end))
    units = t["wp_wip"].filter(in_list("customer_id", customers)).select("wip_id", "serial_number")
    return steps.join(units, "wip_id").select(
        "wip_id",
        "serial_number",
        "start_time",
        "end_time",
        "route_step_id",
        "equipment_id",
        as_date("start_time").alias("run_date"),
    )


def wip_assemblies(t: Tables, steps: DataFrame) -> DataFrame:
    """Assemblies of the units that have a step."""
    return t["wp_assembly_route_wip"].join(steps.select("wip_id"), "wip_id", "left_semi").select(
        "wip_id", "assembly_id"
    )


def lots(t: Tables) -> DataFrame:
    """Lots with the attributes of their material. Lots of unknown materials are not used."""
    return t["cr_grns"].join(t["cr_materials"], "material_id").select(
        "grn_id",
        F.col("material").alias("internal_part"),
        "descr",
        "grn",
        F.col("vendor").alias("supplier"),
        "mpn",
    )


def known_lots(t: Tables) -> DataFrame:
    return t["cr_grns"].join(t["cr_materials"].select("material_id"), "material_id", "left_semi").select("grn_id")


# --- loads at the time of a step ------------------------------------------------------------


def setups_of_steps(t: Tables, steps: DataFrame, routes: Sequence[LoadRoute] = LOAD_ROUTES) -> DataFrame:
    """Setups in force for each step. Each step is looked up once per kind of setup, in one
    equi-join; the assembly join is keyed by unit like the join that made the steps."""
    equipment = [
        F.struct(
            F.lit(r.branch).alias("branch"),
            (F.col("equipment_id").cast("long") if r.by_equipment else F.lit(ANY_EQUIPMENT).cast("long")).alias(
                "setup_equipment"
            ),
        )
        for r in routes
    ]
    assemblies = t["wp_assembly_route_wip"].select("wip_id", F.col("assembly_id").cast("long").alias("assembly_id"))
    lookups = (
        steps.join(assemblies, "wip_id")
        .withColumn("route_step_id", F.col("route_step_id").cast("long"))
        .withColumn("look", F.explode(F.array(*equipment)))
        .select("*", "look.branch", "look.setup_equipment")
        .drop("look")
    )
    setups = union_bag(*[r.setups(t) for r in routes])
    return lookups.join(setups, ["assembly_id", "route_step_id", "setup_equipment", "branch"])


def loads_by_block(t: Tables, grid: TimeGrid, routes: Sequence[LoadRoute] = LOAD_ROUTES) -> DataFrame:
    """Loads of known lots that touch the grid, one row per time block they cover. The part of the load in the
    tick stands in ``since`` and ``removal_time`` at edges only, where times are compared."""
    loads = union_bag(*[r.load_history(t).filter(active_within("load_time", "removal_time", grid)) for r in routes])
    loads = loads.join(known_lots(t), "grn_id", "left_semi").withColumn("rank", load_rank())
    since, until = grid.edge_part("load_time", "removal_time")
    return grid.covering(loads, "load_time", "removal_time").select(
        *BLOCK_KEYS, "slot", "grn_id", "rank", since.alias("since"), until.alias("removal_time")
    )


def _not_outdone(found: DataFrame) -> DataFrame:
    """Without edges whose load is older than one that is on for the whole tick at the same slot."""
    whole = F.max(F.when(F.col("since").isNull(), F.col("rank"))).over(Window.partitionBy(*CELL_KEYS, "slot"))
    outdone = F.col("since").isNotNull() & (F.col("rank") <= F.col("_whole"))
    return found.withColumn("_whole", whole).filter(~F.coalesce(outdone, F.lit(False))).drop("_whole")


def loaded_positions(
    t: Tables, steps: DataFrame, routes: Sequence[LoadRoute] = LOAD_ROUTES
) -> DataFrame | None:
    """Lot at each position of each unit: the latest load that was on at the start or the end of
    one of the unit's steps of the day. Positions replaced later are left out. None if no steps.

    Per block only the latest load is kept, at edges the latest of those that share a part of the tick. What is on at a setup is then found once
    per cell, a setup in a tick that any step looks at: of the blocks around the tick the latest load of each slot is
    carried down to it, and edges that are older than it go. A step has a row per tick it looks at and meets one load per slot there, and those at
    the tick's edges; it isn't multiplied by blocks. However many steps a setup has, its cells are as many as ticks.
    What steps meet is dealt by unit once: the few rows that share a position lie apart until then, and what one look meets
    stays together. A replacement applies to a whole position, so dropping replaced positions after the choice equals
    dropping them before.
    """
    grid = time_grid(steps, STEP_TIMES)
    if grid is None:
        return None
    positions = union_bag(*[r.slot_positions(t) for r in routes])
    edge = ["since", "removal_time"]
    best = latest_rank(loads_by_block(t, grid, routes), [*BLOCK_KEYS, "slot", *edge])
    looks = grid.ticks(setups_of_steps(t, steps, routes), STEP_TIMES).select(
        *CELL_KEYS, *STEP_TIMES, "run_date", "wip_id", "serial_number"
    )
    cells = grid.blocks_of(looks.select(*CELL_KEYS).distinct())
    found = latest_rank(cells.join(best, BLOCK_KEYS), [*CELL_KEYS, "slot", *edge])
    found = _not_outdone(found).join(positions, ["setup_id", "slot", "branch"]).drop("slot")
    on = looks.join(found, CELL_KEYS).filter(on_at(STEP_TIMES, *edge))
    dealt = on.select(*POSITION_KEYS, "rank").repartition("wip_id")
    latest = latest_rank(dealt, POSITION_KEYS, t.compare).select(*POSITION_KEYS, lot_of().alias("grn_id"))
    gone = F.coalesce(F.array_contains("_gone", t.compare.key("crd")), F.lit(False))
    return latest.join(replaced_positions(t), "wip_id", "left").filter(~gone).drop("_gone")


def replaced_positions(t: Tables) -> DataFrame:
    """Units with the positions that a replacement took, as one list, so that a unit's rows meet it where they lie."""
    taken = F.collect_set(t.compare.key("crd")).alias("_gone")
    return t["qm_grn_replacement"].filter("new_grn_id > 0").groupBy("wip_id").agg(taken)


# --- consumed detail ----------------------------------------------------------------------


def _detail(df: DataFrame) -> DataFrame:
    return df.select(
        "run_date",
        F.col("wip_id").cast("long").alias("wip_id"),
        "crd",
        "internal_part",
        "descr",
        "grn",
        "supplier",
        "mpn",
        "serial_number",
        "branch",
        F.lit(1).alias("sort"),
    )


def _loaded_detail(t: Tables, steps: DataFrame, routes: Sequence[LoadRoute]) -> DataFrame | None:
    found = loaded_positions(t, steps, routes)
    return None if found is None else _detail(found.join(lots(t), "grn_id"))


def _nothing(t: Tables, steps: DataFrame) -> DataFrame:
    return consumed_replacement(t, steps).filter(F.lit(False))


def consumed_equipment(t: Tables, steps: DataFrame) -> DataFrame:
    """Lots consumed from equipment feeders: the latest per position."""
    found = _loaded_detail(t, steps, [EQUIPMENT_ROUTE])
    return _nothing(t, steps) if found is None else found


def consumed_bins(t: Tables, steps: DataFrame) -> DataFrame:
    """Lots consumed from the bins of a route step: the latest per position."""
    found = _loaded_detail(t, steps, [BIN_ROUTE])
    return _nothing(t, steps) if found is None else found


def consumed_replacement(t: Tables, steps: DataFrame) -> DataFrame:
    """Lots put in by a replacement on units that have a step of the day: each one once, on
    every such day."""
    units = steps.select("run_date", "wip_id", "serial_number").distinct()
    new_lots = t["qm_grn_replacement"].filter("new_grn_id > 0").select(
        "wip_id", "crd", F.col("new_grn_id").alias("grn_id")
    )
    found = units.join(new_lots, "wip_id").join(lots(t), "grn_id")
    return t.compare.distinct(_detail(found.withColumn("branch", F.lit(REPLACEMENT))))


def consumed_detail(
    t: Tables, start: DateLike, end: DateLike, customers: Sequence[int] = REPORT_CUSTOMERS
) -> DataFrame:
    """Every consumed position of the days: feeders, bins and replacements as one bag."""
    steps = wip_steps(t, start, end, customers)
    replaced = consumed_replacement(t, steps)
    loaded = _loaded_detail(t, steps, LOAD_ROUTES)
    return replaced if loaded is None else union_bag(loaded, replaced)


# --- quantities ---------------------------------------------------------------------------

QTY_KEYS = ["run_date", "internal_part", "supplier", "mpn"]


def _consumed_groups(counts: DataFrame, merge_unknown: bool, compare: Comparison = EXACT) -> DataFrame:
    """Sum partial counts of raw (part, supplier, mpn) groups and show them in report form.

    Groups are formed on raw values, so blank and NULL suppliers of one part stay two rows that
    both read Unknown; ``merge_unknown`` forms them on the shown values instead.
    """
    shown = [compare.or_unknown(c).alias(c) for c in ("supplier", "mpn")]
    df = counts.filter(compare.keep_part("supplier", "mpn", "internal_part"))
    if merge_unknown:
        df = df.select("run_date", "internal_part", *shown, "n")
    df = compare.grouped(df, QTY_KEYS, F.sum("n").alias("consumed_qty"))
    return df.select(
        "internal_part",
        compare.strip_prefix("internal_part").alias("customer_part"),
        *shown,
        "run_date",
        "consumed_qty",
    )


def consumed_qty(detail: DataFrame, merge_unknown: bool = False, compare: Comparison = EXACT) -> DataFrame:
    """Consumed quantity per day, part, supplier and MPN of a consumed detail."""
    counts = detail.filter("sort = 1").select(*QTY_KEYS, F.lit(1).cast("long").alias("n"))
    return _consumed_groups(counts, merge_unknown, compare)


def consumed_qty_of_days(
    t: Tables,
    start: DateLike,
    end: DateLike,
    customers: Sequence[int] = REPORT_CUSTOMERS,
    merge_unknown: bool = False,
) -> DataFrame:
    """The same from the tables. Positions are counted per lot first, so that lot and material
    texts are joined to one row per lot and day instead of one per consumed component."""
    steps = wip_steps(t, start, end, customers)
    counts = count_by(consumed_replacement(t, steps), QTY_KEYS)
    loaded = loaded_positions(t, steps)
    if loaded is not None:
        per_lot = count_by(loaded, ["run_date", "grn_id"]).join(lots(t), "grn_id")
        counts = union_bag(per_lot.select(*QTY_KEYS, "n"), counts)
    return _consumed_groups(counts, merge_unknown, t.compare)
