"""Portable SQL that derives the manufacturing tables from the star-schema tables.

The text is the input specification in ``FIXTURES.md`` section 3. Spark and the DuckDB
oracle both run it, so both engines see the same input rows. Later recipes read earlier ones.
"""

RECIPES: dict[str, str] = {
    "wp_wip": """
        SELECT o_orderkey AS wip_id, concat('SN', o_orderkey - o_orderkey % 2) AS serial_number, CASE o_orderkey % 3 WHEN 0 THEN 68 WHEN 1 THEN 110 ELSE 200 END AS customer_id, CASE WHEN o_orderpriority='1-URGENT' THEN 1 ELSE 0 END AS rma
        FROM orders
    """,
    "wp_wip_route_steps": """
        SELECT l_orderkey AS wip_id, l_linenumber AS route_step_id, l_suppkey % 5 AS equipment_id, TIMESTAMP '2025-01-06 00:00:00' + INTERVAL '1' HOUR * (24*((l_orderkey + CASE WHEN l_linenumber>=6 THEN 1 ELSE 0 END) % 7) + l_partkey % 24) AS start_time, CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE TIMESTAMP '2025-01-06 00:00:00' + INTERVAL '1' HOUR * (24*((l_orderkey + CASE WHEN l_linenumber>=6 THEN 1 ELSE 0 END) % 7) + l_partkey % 24) + INTERVAL '1' MINUTE * CAST(l_quantity AS INT) END AS end_time
        FROM lineitem
    """,
    "wp_assembly_route_wip": """
        SELECT o_orderkey AS wip_id, o_orderkey % 20 AS assembly_id FROM orders
    """,
    "cr_materials": """
        SELECT p_partkey AS material_id, concat(CASE WHEN p_size % 5 = 0 THEN 'XX' ELSE 'AS' END, p_partkey, CASE WHEN p_partkey % 9 = 0 THEN '$' ELSE '' END) AS material, p_name AS descr, p_type AS component_type, p_size AS pin_count
        FROM part
    """,
    "cr_grns": """
        SELECT p_partkey + 1 AS grn_id, concat('G', p_partkey) AS grn, p_partkey - p_partkey % 2 AS material_id, CASE WHEN p_partkey % 22 = 0 OR p_partkey % 18 = 0 THEN '' WHEN p_partkey % 22 = 1 THEN NULL ELSE concat('VENDOR', p_partkey % 20) END AS vendor, CASE WHEN (p_partkey - p_partkey % 2) % 14 = 0 OR p_partkey % 18 = 0 THEN '' WHEN p_partkey % 17 = 0 THEN NULL ELSE concat('MPN', (p_partkey - p_partkey % 2) % 40) END AS mpn
        FROM part
    """,
    "ct_equipment_setup": """
        SELECT n_nationkey*100 + ln*10 + r_regionkey AS equipment_setup_id, n_nationkey AS assembly_id, ln AS route_step_id, r_regionkey AS equipment_id
        FROM nation
        CROSS JOIN region
        CROSS JOIN (SELECT DISTINCT l_linenumber AS ln
        FROM lineitem) q
        WHERE n_nationkey < 20
    """,
    "ct_component_use": """
        SELECT (l_orderkey % 20)*100 + l_linenumber*10 + l_suppkey % 5 AS equipment_setup_id, l_partkey + 1 AS grn_id, l_partkey % 4 AS feeder_tray_track_id, TIMESTAMP '2025-01-05 00:00:00' + INTERVAL '1' HOUR * ((l_partkey*7 + l_suppkey*13) % 192) + INTERVAL '1' MINUTE * (CASE WHEN l_partkey % 6 = 0 THEN 10 ELSE 0 END) AS load_time, CASE WHEN l_partkey % 6 = 0 THEN TIMESTAMP '2025-01-05 00:00:00' + INTERVAL '1' HOUR * ((l_partkey*7 + l_suppkey*13) % 192) + INTERVAL '1' MINUTE * 20 WHEN l_suppkey % 8 = 0 THEN NULL ELSE TIMESTAMP '2025-01-05 00:00:00' + INTERVAL '1' HOUR * ((l_partkey*7 + l_suppkey*13) % 192 + 4 + CAST(l_quantity AS INT)) END AS removal_time
        FROM lineitem
    """,
    "ct_equipment_setup_feeders": """
        SELECT e.equipment_setup_id, e.equipment_setup_id*4 + r_regionkey AS feeder_id, r_regionkey AS feeder_tray_track_id
        FROM ct_equipment_setup e
        CROSS JOIN region
        WHERE r_regionkey < 4
    """,
    "ct_feeder_crds": """
        SELECT feeder_id, concat('C', feeder_id % 50) AS crd FROM ct_equipment_setup_feeders
    """,
    "ct_route_step_setup": """
        SELECT DISTINCT assembly_id*10 + route_step_id AS route_step_setup_id, assembly_id, route_step_id
        FROM ct_equipment_setup
    """,
    "ct_component_use_bins": """
        SELECT (l_orderkey % 20)*10 + l_linenumber AS route_step_setup_id, l_partkey + 1 AS grn_id, l_partkey % 3 AS bin, TIMESTAMP '2025-01-05 00:00:00' + INTERVAL '1' HOUR * ((l_partkey*5 + l_suppkey*11) % 192) + INTERVAL '1' MINUTE * (CASE WHEN l_partkey % 6 = 0 THEN 10 ELSE 0 END) AS load_time, CASE WHEN l_partkey % 6 = 0 THEN TIMESTAMP '2025-01-05 00:00:00' + INTERVAL '1' HOUR * ((l_partkey*5 + l_suppkey*11) % 192) + INTERVAL '1' MINUTE * 20 WHEN l_suppkey % 9 = 0 THEN NULL ELSE TIMESTAMP '2025-01-05 00:00:00' + INTERVAL '1' HOUR * ((l_partkey*5 + l_suppkey*11) % 192 + 2 + CAST(l_quantity AS INT)) END AS removal_time
        FROM lineitem
        WHERE l_linestatus = 'O'
    """,
    "ct_route_step_setup_bins": """
        SELECT s.route_step_setup_id, r_regionkey AS bin, s.route_step_setup_id*3 + r_regionkey AS route_step_setup_bin_id
        FROM ct_route_step_setup s
        CROSS JOIN region
        WHERE r_regionkey < 3
    """,
    "ct_bin_crds": """
        SELECT route_step_setup_bin_id, concat('B', route_step_setup_bin_id % 30) AS crd
        FROM ct_route_step_setup_bins
    """,
    "qm_grn_replacement": """
        SELECT l_orderkey AS wip_id, concat('C', l_partkey % 50) AS crd, CASE WHEN l_partkey % 19 = 0 THEN -1 ELSE l_partkey + 1 END AS old_grn_id, CASE WHEN l_linenumber = 7 THEN 0 ELSE (l_partkey + 8) % (SELECT count(*)
        FROM part) + 1 END AS new_grn_id, l_orderkey*10 + l_linenumber AS repair_id
        FROM lineitem
        WHERE l_returnflag = 'R' AND l_linestatus = 'F'
    """,
    "qm_test_data": """
        SELECT l_orderkey AS wip_id, l_orderkey*10 + l_linenumber AS process_id, l_orderkey % 20 AS assembly_id, l_linenumber AS route_step_id, min(l_suppkey % 5) AS equipment_id, min(l_suppkey % 25) AS user_id, min(l_partkey) AS part_key, max(CASE l_returnflag WHEN 'R' THEN 'F' WHEN 'A' THEN 'A' ELSE 'P' END) AS test_status, 1 + l_orderkey % 3 AS process_loop, 1 + l_linenumber % 2 AS test_loop, min(TIMESTAMP '2025-01-06 00:00:00' + INTERVAL '1' HOUR * (24*(l_orderkey % 7) + l_partkey % 24)) AS start_date_time, min(TIMESTAMP '2025-01-06 00:00:00' + INTERVAL '1' HOUR * (24*(l_orderkey % 7) + l_partkey % 24 + 1)) AS stop_date_time
        FROM lineitem
        GROUP BY l_orderkey, l_linenumber
    """,
    "qm_data_rec": """
        SELECT t.wip_id, t.process_id, t.process_id*2 + r_regionkey AS data_id, t.part_key, concat('DL', r_regionkey) AS data_label
        FROM qm_test_data t
        CROSS JOIN region
        WHERE r_regionkey < 2 AND t.test_status <> 'P'
    """,
    "qm_data_analysis": """
        SELECT wip_id, process_id, data_id, data_id AS analysis_id, CASE WHEN data_id % 4 = 1 THEN 0 ELSE process_id END AS repair_id, CASE WHEN data_id % 5 = 0 THEN 'P' ELSE 'F' END AS associated_defect_flag, CASE WHEN data_id % 3 = 0 THEN 'I' ELSE 'C' END AS analysis_status
        FROM qm_data_rec
    """,
    "qm_analysis": """
        SELECT data_id AS analysis_id, CASE WHEN data_id % 10 = 3 THEN data_id % (SELECT count(*)
        FROM part) ELSE part_key - part_key % 2 END AS material_id, data_id % 5 AS defect_id, 1 + data_id % 3 AS defect_count, data_id % 25 AS analysis_by_id, concat('C', data_id % 50) AS defect_location, data_id % 5 AS equipment_or_route_step_id, data_id % 2 AS is_equipment, data_id % 4 AS feeder_tray_track_id, concat('D', data_id % 7) AS defect_detail, TIMESTAMP '2025-01-06 00:00:00' + INTERVAL '1' HOUR * (data_id % 168) AS analysis_date_time
        FROM qm_data_rec
    """,
    "qm_repair": """
        SELECT process_id AS repair_id, process_id % 5 AS repair_category_id, wip_id % 25 AS repaired_by_id, concat('RD', process_id % 3) AS repair_detail, concat('memo', process_id % 11) AS memo, start_date_time + INTERVAL '1' HOUR * (process_id % 48) AS repair_date_time
        FROM qm_test_data
        WHERE test_status <> 'P'
    """,
    "cr_text": """
        SELECT n_nationkey AS text_id, r_regionkey AS language_id, concat(n_name, '_L', r_regionkey) AS translation
        FROM nation
        CROSS JOIN region
        UNION ALL SELECT 100 + r_regionkey, 0, CASE r_regionkey WHEN 0 THEN 'P' WHEN 1 THEN 'F' ELSE 'A' END
        FROM region
        WHERE r_regionkey < 3
    """,
    "cr_customers": """
        SELECT CASE r_regionkey WHEN 0 THEN 68 WHEN 1 THEN 110 ELSE 200 END AS customer_id, r_regionkey AS customer, r_regionkey + 5 AS division
        FROM region
        WHERE r_regionkey < 3
    """,
    "cr_families": """
        SELECT r_regionkey AS family_id, r_regionkey + 10 AS family FROM region
    """,
    "cr_assemblies": """
        SELECT n_nationkey AS assembly_id, concat('ASM', n_nationkey) AS number, concat('R', n_nationkey % 3) AS revision, 'V1' AS version, CASE n_nationkey % 3 WHEN 0 THEN 68 WHEN 1 THEN 110 ELSE 200 END AS customer_id, n_nationkey % 5 AS family_id
        FROM nation
        WHERE n_nationkey < 20
    """,
    "cr_fmrs_v": """
        SELECT q.ln % 3 AS factory_ma_route_id, q.ln AS route_step_id, 100 + q.ln AS step_id, r_regionkey AS language_id, concat('FACTORY', q.ln % 2) AS factory_text, concat('MA', q.ln % 3) AS ma_text, concat('ROUTE', q.ln % 3) AS route_text, concat('STEP', q.ln) AS step_text
        FROM region
        CROSS JOIN (SELECT DISTINCT l_linenumber AS ln
        FROM lineitem) q
    """,
    "cr_equipment_v": """
        SELECT r_regionkey AS equipment_id, concat('EQ', r_regionkey) AS equipment FROM region
    """,
    "sc_users": """
        SELECT n_nationkey AS user_id, CASE WHEN n_nationkey % 5 = 0 THEN '' ELSE concat('F', n_nationkey) END AS first_name, concat('L', n_nationkey) AS last_name, CASE WHEN n_nationkey = 24 THEN 0 ELSE 1 END AS active
        FROM nation
    """,
    "qm_defects": """
        SELECT r_regionkey AS defect_id, r_regionkey + 15 AS defect, r_regionkey % 2 AS defect_category_id
        FROM region
    """,
    "qm_defect_category": """
        SELECT r_regionkey AS defect_category_id, r_regionkey + 20 AS defect_category
        FROM region
        WHERE r_regionkey < 2
    """,
    "qm_repair_category": """
        SELECT r_regionkey AS repair_category_id, r_regionkey + 20 AS repair_category FROM region
    """,
    "qm_test_status": """
        SELECT 100 + r_regionkey AS test_status FROM region WHERE r_regionkey < 3
    """,
}
