"""A small made-up plant for hand-computed cases."""

import datetime as dt

import pyarrow as pa
from pyspark.sql.pandas.types import to_arrow_schema

from lotwise.sources.schemas import LOOKUPS, TABLES, struct
from lotwise.sources.tables import Tables


def empty_tables(spark, **rows):
    """All tables with their declared schema, filled with the given row tuples. Arrow input stays
    a local relation, so a tiny plan starts no job per table."""

    def frame(name, ddl):
        schema = struct(ddl)
        given = rows.get(name, [])
        arrow = to_arrow_schema(schema)
        columns = [pa.array([r[i] for r in given], f.type) for i, f in enumerate(arrow)]
        return spark.createDataFrame(pa.table(columns, schema=arrow), schema)

    return Tables.of({name: frame(name, ddl) for name, ddl in TABLES.items()}, absent=[n for n in LOOKUPS if n not in TABLES])


def at(text):
    return None if text is None else dt.datetime.fromisoformat(text if " " in text else f"2025-01-08 {text}:00")


DIMENSIONS = dict(
    cr_materials=[(1, "AS100", "res", "R", 2), (2, "AS200", "cap", "C", 2), (3, "XX300", "ic", "U", 8)],
    cr_grns=[(10, "G10", 1, "V1", "M1"), (11, "G11", 1, "V2", "M2"), (12, "G12", 2, "", ""), (13, "G13", 9, "V9", "M9"),
             (14, "G14", 2, None, None)],
    ct_equipment_setup=[(5, 7, 1, 3)],
    ct_equipment_setup_feeders=[(5, 50, 0)],
    ct_feeder_crds=[(50, "C1")],
    ct_route_step_setup=[(6, 7, 1)],
    ct_route_step_setup_bins=[(6, 0, 60)],
    ct_bin_crds=[(60, "B1")],
)


def plant(steps, loads=(), bins=(), replaced=(), units=None, **more):
    """steps: (wip, start, end); loads and bins: (lot, load, removal); replaced: (wip, crd, new lot)."""
    wips = sorted({x[0] for x in steps})
    return dict(
        DIMENSIONS,
        wp_wip=units or [(w, f"SN{w}", 68, 0) for w in wips],
        wp_assembly_route_wip=[(w, 7) for w in wips],
        wp_wip_route_steps=[(w, 1, 3, at(a), at(b)) for w, a, b in steps],
        ct_component_use=[(5, lot, 0, at(a), at(b)) for lot, a, b in loads],
        ct_component_use_bins=[(6, lot, 0, at(a), at(b)) for lot, a, b in bins],
        qm_grn_replacement=[(w, crd, 1, new, 900) for w, crd, new in replaced],
    ) | more
