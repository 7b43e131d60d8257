"""Table and result schemas as DDL text."""

from __future__ import annotations

from pyspark.sql import types as T

TABLES: dict[str, str] = {
    "wp_wip": "wip_id long, serial_number string, customer_id int, rma int",
    "wp_wip_route_steps": "wip_id long, route_step_id int, equipment_id long, start_time timestamp_ntz, end_time timestamp_ntz",
    "wp_assembly_route_wip": "wip_id long, assembly_id long",
    "cr_materials": "material_id long, material string, descr string, component_type string, pin_count int",
    "cr_grns": "grn_id long, grn string, material_id long, vendor string, mpn string",
    "ct_equipment_setup": "equipment_setup_id long, assembly_id long, route_step_id int, equipment_id long",
    "ct_component_use": "equipment_setup_id long, grn_id long, feeder_tray_track_id long, load_time timestamp_ntz, removal_time timestamp_ntz",
    "ct_equipment_setup_feeders": "equipment_setup_id long, feeder_id long, feeder_tray_track_id long",
    "ct_feeder_crds": "feeder_id long, crd string",
    "ct_route_step_setup": "route_step_setup_id long, assembly_id long, route_step_id int",
    "ct_component_use_bins": "route_step_setup_id long, grn_id long, bin long, load_time timestamp_ntz, removal_time timestamp_ntz",
    "ct_route_step_setup_bins": "route_step_setup_id long, bin long, route_step_setup_bin_id long",
    "ct_bin_crds": "route_step_setup_bin_id long, crd string",
    "qm_grn_replacement": "wip_id long, crd string, old_grn_id long, new_grn_id long, repair_id long",
    "qm_test_data": "wip_id long, process_id long, assembly_id long, route_step_id int, equipment_id long, user_id long, test_status string, process_loop long, test_loop int, start_date_time timestamp_ntz, stop_date_time timestamp_ntz",
    "qm_data_rec": "wip_id long, process_id long, data_id long, data_label string",
    "qm_data_analysis": "wip_id long, process_id long, data_id long, analysis_id long, repair_id long, associated_defect_flag string, analysis_status string",
    "qm_analysis": "analysis_id long, material_id long, defect_id long, defect_count long, analysis_by_id long, defect_location string, equipment_or_route_step_id long, is_equipment long, feeder_tray_track_id long, defect_detail string, analysis_date_time timestamp_ntz",
    "qm_repair": "repair_id long, repair_category_id long, repaired_by_id long, repair_detail string, memo string, repair_date_time timestamp_ntz",
    "qm_defects": "defect_id int, defect int, defect_category_id int",
    "qm_defect_category": "defect_category_id int, defect_category int",
    "qm_repair_category": "repair_category_id int, repair_category int",
    "qm_test_status": "test_status int",
    "cr_text": "text_id int, language_id int, translation string",
    "cr_customers": "customer_id int, customer int, division int",
    "cr_families": "family_id int, family int",
    "cr_assemblies": "assembly_id int, number string, revision string, version string, customer_id int, family_id int",
    "cr_fmrs_v": "factory_ma_route_id int, route_step_id int, step_id int, language_id int, factory_text string, ma_text string, route_text string, step_text string",
    "cr_equipment_v": "equipment_id int, equipment string",
    "sc_users": "user_id int, first_name string, last_name string, active int",
}

# Membership sets of the history filters. Where a source lacks one, the keys of the view that
# shows the same items are used.
LOOKUPS: dict[str, tuple[str, str]] = {
    "cr_ma_routes": ("cr_fmrs_v", "factory_ma_route_id"),
    "cr_route_steps": ("cr_fmrs_v", "route_step_id"),
    "cr_steps": ("cr_fmrs_v", "step_id"),
    "cr_equipment": ("cr_equipment_v", "equipment_id"),
}

DETAIL = (
    "run_date date, wip_id long, crd string, internal_part string, descr string, grn string, "
    "supplier string, mpn string, serial_number string, branch string, sort int"
)

REPORT = (
    "internal_part string, customer_part string, supplier string, mpn string, consumed_qty long, "
    "failed_qty long, start_date date, insert_datetime timestamp_ntz, snapshot_date date"
)

WEEKLY = (
    "customer_part string, supplier string, mpn string, start_date date, end_date date, monday_date date, "
    "consumed_qty long"
)

AUDIT = "procedure string, elapsed_ms long, user_id long, start_time timestamp_ntz"


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
