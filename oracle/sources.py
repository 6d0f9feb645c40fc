"""The warehouse and legacy tables again, in DuckDB SQL over the test tables."""

LINE = (
    "(l_orderkey * 1000003 + (l_partkey * 7919 + l_suppkey * 104729 + l_linenumber * 15485863"
    " + CAST(l_quantity AS INT)) % 1000003)"
)
DIAGNOSIS = """CASE l_partkey % 40
  WHEN 0 THEN 'F17' WHEN 1 THEN 'F17.0' WHEN 2 THEN 'F17.1' WHEN 3 THEN 'F17.2' WHEN 4 THEN 'F17.3'
  WHEN 5 THEN 'F17.4' WHEN 6 THEN 'F17.7' WHEN 7 THEN 'F17.9' WHEN 8 THEN 'T65.2' WHEN 9 THEN 'Z72.0'
  ELSE 'D' || l_partkey END"""
POSTCODE = """CASE WHEN c_custkey % 4 = 0 THEN 'QX' || (c_custkey % 9 + 1) || ' 1AA'
  WHEN c_custkey % 4 = 1 THEN 'QX1' || (c_custkey % 9 + 1) || ' 2BB'
  WHEN c_custkey % 4 = 2 THEN 'QX11CC' ELSE NULL END"""
USER = "'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0')"
PART = "'Customer#' || lpad(CAST(l_partkey AS VARCHAR), 9, '0')"
OWNER = "'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')"


def days(column, n):
    return f"({column} + to_days(CAST({n} AS INT)))"


def hours(column, n):
    return f"({column} + to_hours(CAST({n} AS INT)))"


def periods(modulus):
    return f"""
    SELECT CASE WHEN o_orderkey % {modulus} = 0 THEN '' ELSE '-' END || o_orderkey AS id, o_custkey AS patient_id,
      CASE WHEN o_orderkey % {modulus} = 0 THEN o_orderkey ELSE -1 - o_orderkey END AS admissions_id,
      CAST(o_orderdate AS DATE) AS started_on, {hours('o_orderdate', 'o_orderkey % 24')} AS started_at,
      CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE {days('o_orderdate', 'o_orderkey % 5 + 1')} END AS ended_at,
      CAST(o_orderkey % 2 AS INT) AS l2, CAST(o_orderkey % 3 AS INT) AS l3,
      CAST(o_orderkey % 4 AS INT) AS bc, CAST(o_orderkey % 5 AS INT) AS ac,
      CAST(o_orderkey % 6 AS INT) AS br, CAST(o_orderkey % 7 AS INT) AS ar,
      CAST(o_orderkey % 8 AS INT) AS renal, CAST(o_orderkey % 9 AS INT) AS neuro,
      CAST(o_orderkey % 10 AS INT) AS derm, CAST(o_orderkey % 11 AS INT) AS liver
    FROM orders"""


SOURCES = {
    # --- live warehouse -------------------------------------------------------------------------
    "w_cohort": """
    SELECT CASE WHEN c_custkey % 97 = 3 THEN NULL ELSE c_name END AS k, DATE '1998-01-01' AS dateadded
    FROM customer WHERE c_custkey % 3 <> 0
    UNION ALL
    SELECT CASE WHEN c_custkey % 2 = 0 THEN lower(c_name) || '  ' ELSE c_name END, DATE '1999-01-01'
    FROM customer WHERE c_custkey % 5 = 1""",
    "w_members": "SELECT upper(rtrim(k)) FROM w_cohort WHERE k IS NOT NULL",
    "w_patient": f"""
    SELECT c_custkey AS id, c_name AS system_number,
      CASE c_custkey % 5 WHEN 0 THEN 'M' WHEN 1 THEN 'F' WHEN 2 THEN 'U' WHEN 3 THEN 'X' END AS sex,
      DATE '1930-01-01' + CAST(c_custkey % 25000 AS INT) AS dob,
      CASE WHEN c_custkey % 13 = 0 THEN {days("TIMESTAMP '2000-01-01'", 'c_custkey % 300')} END AS dod,
      c_nationkey AS ethnic, {POSTCODE} AS postcode
    FROM customer""",
    "w_ethnic": "SELECT CASE WHEN n_nationkey < 20 THEN n_nationkey ELSE -1 - n_nationkey END AS code, n_name AS name FROM nation",
    "w_imd": """
    SELECT 'QX' || (n_nationkey + 1) || ' 1AA' AS pc, n_nationkey % 10 + 1 AS decile
    FROM nation WHERE n_nationkey < 9
    UNION ALL
    SELECT 'QX1' || (n_nationkey - 8) || ' 2BB', n_nationkey % 10 + 1
    FROM nation WHERE n_nationkey BETWEEN 9 AND 13
    UNION ALL
    SELECT 'QX2' || n_nationkey || ' 3CC', n_nationkey % 10 + 1 FROM nation WHERE n_nationkey > 13""",
    "w_admissions": f"""
    SELECT o_orderkey AS id, o_custkey AS patient_id,
      {hours('o_orderdate', 'o_orderkey % 24')} AS admitted,
      CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE {days('o_orderdate', 'o_orderkey % 15 + 1')} END AS discharged,
      o_orderpriority AS moa, o_orderstatus AS soa, o_orderstatus AS modi, o_custkey % 25 AS ward_code
    FROM orders""",
    "w_moa": """
    SELECT CASE r_regionkey WHEN 0 THEN '1-URGENT' WHEN 1 THEN '2-HIGH' WHEN 2 THEN '3-MEDIUM'
        WHEN 3 THEN '4-NOT SPECIFIED' ELSE '5-LOW' END AS code,
      'M' || r_regionkey AS nc, r_name AS nc_name, CAST(r_regionkey = 4 AS INT) AS deleted FROM region""",
    "w_soa": """
    SELECT CASE r_regionkey WHEN 0 THEN 'F' WHEN 1 THEN 'O' WHEN 4 THEN '-' ELSE 'P' END AS code,
      'S' || r_regionkey AS nc, r_name AS nc_name, CAST(r_regionkey = 2 AS INT) AS deleted
    FROM region""",
    "w_mod": """
    SELECT CASE r_regionkey WHEN 0 THEN 'F' WHEN 1 THEN 'O' WHEN 2 THEN 'P' ELSE '-' END AS code,
      'X' || r_regionkey AS nc, r_name AS nc_name, CAST(r_regionkey = 1 AS INT) AS deleted
    FROM region""",
    "w_episodes": f"""
    SELECT {LINE} AS id, l_orderkey AS admissions_id, l_shipdate AS started,
      {days('l_shipdate', 'l_linenumber')} AS ended, l_suppkey % 10 AS specialty FROM lineitem""",
    "w_specialty": """
    SELECT CASE WHEN n_nationkey < 9 THEN n_nationkey ELSE -1 - n_nationkey END AS code,
      CAST(n_nationkey * 10 + 100 AS VARCHAR) AS dhss, n_name AS name,
      CAST(n_nationkey = 8 AS INT) AS deleted FROM nation""",
    "w_ward": "SELECT n_nationkey AS code, n_name AS ward, CAST(n_nationkey % 6 = 0 AS INT) AS deleted FROM nation",
    "w_hospital": "SELECT n_nationkey % 5 AS code, CAST(n_nationkey >= 10 AS INT) AS deleted FROM nation",
    "w_diagnoses": f"""
    SELECT {LINE} AS ce_id, CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_shipdate END AS dated,
      l_linenumber AS num, {DIAGNOSIS} AS who_code, 'D' || l_partkey AS code FROM lineitem
    UNION ALL
    SELECT {LINE}, CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_shipdate END,
      l_linenumber, {DIAGNOSIS}, 'D' || l_partkey FROM lineitem WHERE l_linenumber = 1""",
    "w_mf_diagnosis": """
    SELECT CASE WHEN p_partkey % 7 = 0 THEN '-' ELSE 'D' END || p_partkey AS code, p_name AS descr,
      CAST(p_size % 10 = 0 AS INT) AS deleted FROM part""",
    "w_opcs": """
    SELECT CASE WHEN p_partkey % 7 = 0 THEN '-' ELSE 'P' END || p_partkey AS code, p_name AS descr,
      CAST(p_size % 10 = 0 AS INT) AS deleted FROM part""",
    "w_procedures": f"""
    SELECT CASE WHEN l_returnflag = 'N' THEN -1 - {LINE} ELSE {LINE} END AS ce_id, l_shipdate AS dated,
      l_linenumber AS num, 'P' || l_partkey AS code,
      CASE WHEN l_linenumber <= 2 THEN CAST(l_orderkey AS VARCHAR) END AS nonunique_id FROM lineitem""",
    "w_transfers": f"""
    SELECT CASE WHEN l_linenumber = 1 THEN left(CAST(l_orderkey AS VARCHAR), 1) || ' : '
        || substring(CAST(l_orderkey AS VARCHAR), 2) ELSE 'T: ' || {LINE} END AS id,
      l_suppkey AS patient_id, l_orderkey AS admissions_id, l_shipdate AS started,
      CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE {days('l_shipdate', 'l_linenumber')} END AS ended,
      l_suppkey % 30 AS to_ward, 'BED' || (l_partkey % 20) AS to_bed, l_suppkey % 7 AS hospital
    FROM lineitem""",
    "w_ccp": periods(6),
    "w_ccp_base": periods(4),
    "w_rpd": "SELECT 'RPD' || c_custkey AS rpd, c_name AS hospital_number FROM customer",
    "w_orders_file": """
    SELECT o_orderkey AS num, 'RPD' || o_custkey AS d_level, o_custkey % 25 AS c_level,
      'LAB' || (o_orderkey % 4) AS lab FROM orders""",
    "w_haem_results": f"""
    SELECT 'H' || o_orderkey AS isrn, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey ELSE -1 - o_orderkey END AS order_no,
      o_orderdate AS collected, {hours('o_orderdate', 'o_orderkey % 24')} AS received FROM orders""",
    "w_haem_tests": """
    SELECT l_orderkey AS id, CAST(CAST(l_quantity AS INT) AS VARCHAR) AS result,
      CASE l_linenumber % 3 WHEN 0 THEN 'g/L' WHEN 1 THEN 'mmol' END AS units, l_shipdate AS resulted,
      CASE l_linenumber % 4 WHEN 0 THEN l_partkey || '{' || l_suppkey || '.25'
        WHEN 1 THEN '<' || l_partkey || '{' || l_suppkey WHEN 2 THEN CAST(l_partkey AS VARCHAR) END AS rng,
      'T' || l_suppkey AS code_key, 'H' || l_orderkey AS isrn, 'ORD' || (l_suppkey % 7) AS order_name,
      l_returnflag AS flag, CASE l_partkey % 3 WHEN 0 THEN 'N' WHEN 1 THEN 'Y' END AS suppressed,
      l_shipdate AS received FROM lineitem""",
    "w_tests_haem": """
    SELECT CASE WHEN s_suppkey % 6 = 0 THEN '-' ELSE 'T' END || s_suppkey AS id, s_name AS name FROM supplier""",
    "w_tests_micro": """
    SELECT CASE WHEN s_suppkey % 5 = 0 THEN '-' ELSE 'T' END || s_suppkey AS id, s_name AS name FROM supplier""",
    "w_micro_results": f"""
    SELECT 'M' || o_orderkey AS isrn, CASE WHEN o_orderkey % 2 = 1 THEN o_orderkey ELSE -1 - o_orderkey END AS order_no,
      o_orderdate AS collected, {hours('o_orderdate', 'o_orderkey % 24')} AS received,
      'SITE' || (o_orderkey % 6) AS site FROM orders""",
    "w_micro_tests": f"""
    SELECT {LINE} AS id, 'M' || l_orderkey AS isrn, 'MO' || (l_suppkey % 7) AS order_code,
      'MICRO ORDER ' || (l_suppkey % 7) AS order_name,
      CASE l_partkey % 8 WHEN 0 THEN 'VCOV' WHEN 1 THEN 'VCOV3' WHEN 2 THEN 'VCOV4' WHEN 3 THEN 'VCOV5'
        WHEN 4 THEN 'VBIR' WHEN 5 THEN 'VBIR' ELSE 'MCS' END AS code,
      'T' || l_suppkey AS code_key, 'R' || (l_partkey % 10) AS expansion,
      {days('l_shipdate', '1')} AS resulted FROM lineitem""",
    "w_organisms": f"""
    SELECT {LINE} AS test_id,
      CASE (l_suppkey + k) % 4 WHEN 0 THEN 'SARS-CoV-2' WHEN 1 THEN 'human cov variant'
        WHEN 2 THEN 'Rhinovirus' END AS organism,
      'OC' || ((l_suppkey + k) % 6) AS code, (l_partkey + k) % 6 AS quantifier
    FROM lineitem JOIN (VALUES (1), (2)) copies(k) ON k <= l_partkey % 3""",
    "w_mf_organisms": """
    SELECT CASE WHEN n_nationkey < 5 THEN 'OC' ELSE '-' END || n_nationkey AS code,
      CASE WHEN n_nationkey = 4 THEN 'X' ELSE 'O' END AS category FROM nation""",
    "w_quantities": """
    SELECT CASE WHEN n_nationkey < 5 THEN n_nationkey ELSE -1 - n_nationkey END AS id,
      CASE WHEN n_nationkey = 3 THEN NULL ELSE '* ' || n_name || ' *' END AS descr,
      CASE n_nationkey WHEN 0 THEN 'Y' WHEN 1 THEN 'N' END AS significant FROM nation""",
    "w_request_source": """
    SELECT CASE WHEN n_nationkey < 13 THEN n_nationkey % 10 ELSE -1 - n_nationkey % 10 END AS id FROM nation""",
    "w_person": "SELECT c_custkey AS id, c_name AS external_id FROM customer",
    "w_medication": f"""
    SELECT o_orderkey AS id, o_custkey AS person_id,
      CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_custkey END AS product_id,
      'MED' || (o_custkey % 50) AS name, {hours('o_orderdate', 'o_orderkey % 24')} AS created,
      o_orderpriority AS method,
      CASE WHEN o_orderkey % 2 = 0 THEN left(CAST(o_orderkey AS VARCHAR), 1) || ' : '
        || substring(CAST(o_orderkey AS VARCHAR), 2) END AS wardstay
    FROM orders""",
    "w_admin": f"""
    SELECT {LINE} AS id, l_orderkey AS medication_id, {hours('l_shipdate', 'l_linenumber')} AS at,
      l_linenumber AS dose_id, CAST(l_quantity AS INT) AS dose,
      CASE l_linenumber % 3 WHEN 0 THEN 'mg' WHEN 1 THEN 'ml' END AS unit, l_suppkey % 5 AS roa,
      l_linenumber * 2 AS rate, 'ml/h' AS rate_unit, l_suppkey % 7 AS form FROM lineitem""",
    "w_dose": f"""
    SELECT {LINE} AS id, l_orderkey AS medication_id, CAST(l_quantity AS INT) AS min_dose,
      CASE l_linenumber % 3 WHEN 0 THEN 'mg' WHEN 1 THEN 'ml' END AS unit, l_suppkey % 7 AS form,
      l_suppkey % 6 AS freq, l_suppkey % 5 AS roa FROM lineitem""",
    "w_product": "SELECT p_partkey AS id FROM part",
    "w_class_product": """
    SELECT CASE WHEN p_partkey % 17 = 0 THEN -1 - p_partkey ELSE p_partkey END AS product_id,
      (p_partkey + k) % 42 AS brand_id
    FROM part JOIN (VALUES (0), (7)) second(k) ON k = 0 OR p_size % 2 = 0""",
    "w_brand": """
    SELECT CASE WHEN p_partkey IN (40, 41) THEN -1 - p_partkey ELSE p_partkey END AS id, p_partkey % 22 AS ais_id
    FROM part""",
    "w_ais": """
    SELECT CASE WHEN n_nationkey < 20 THEN n_nationkey ELSE -1 - n_nationkey END AS id, n_nationkey % 9 AS class_id
    FROM nation""",
    "w_class": """
    SELECT CASE WHEN n_nationkey < 8 THEN n_nationkey ELSE -1 - n_nationkey END AS id,
      CASE WHEN n_nationkey = 5 THEN NULL ELSE n_name END AS name FROM nation""",
    "w_route": """
    SELECT CASE WHEN n_nationkey < 5 THEN n_nationkey % 4 ELSE -1 - n_nationkey % 4 END AS reference, n_name AS name
    FROM nation""",
    "w_form": """
    SELECT CASE WHEN n_nationkey < 6 THEN n_nationkey ELSE -1 - n_nationkey END AS code, n_name AS name FROM nation""",
    "w_freq": """
    SELECT CASE WHEN n_nationkey < 5 THEN n_nationkey ELSE -1 - n_nationkey END AS code,
      (n_nationkey + 1) || ' a day' AS narrative FROM nation""",
    "w_exams": f"SELECT l_orderkey AS event_key, {LINE} AS exam_key, 'EX' || l_suppkey AS examination FROM lineitem",
    "w_events": f"""
    SELECT o_orderkey AS event_key, {hours('o_orderdate', 'o_orderkey % 24')} AS requested FROM orders""",
    "w_examcd": """
    SELECT CASE WHEN s_suppkey % 8 = 0 THEN '-' ELSE 'EX' END || s_suppkey AS code, s_name AS name FROM supplier""",
    "w_cris_orders": f"""
    SELECT 'RO' || {LINE} AS order_id, CASE WHEN l_linenumber <= 4 THEN {LINE} ELSE -1 - {LINE} END AS exam_key,
      l_partkey AS paslink, {days('l_shipdate', '2')} AS scheduled FROM lineitem""",
    "w_his": "SELECT c_custkey AS paslink, c_name AS his_id FROM customer",
    "w_ed": f"""
    SELECT {USER} AS k, event_id AS visitid, CAST(ts AS DATE) AS arrived_on,
      CASE WHEN event_id % 7 = 0 THEN '' ELSE strftime(ts, '%H%M') END AS arrived_at,
      event_id % 3 AS mode_code, event_type AS mode_name, CAST(ts AS DATE) + 1 AS left_on,
      CASE WHEN event_id % 5 = 0 THEN NULL ELSE strftime(ts, '%H%M') END AS left_at,
      event_id % 4 AS dest_id, 'DEST' || (event_id % 4) AS dest, 'C' || (user_id % 20) AS problem
    FROM events""",
    "w_obs": f"""
    SELECT CAST(event_id AS INT) AS obs_id, {USER} AS k, ts,
      CASE WHEN event_type <> 'view' THEN CAST(trunc(value * 100) AS INT) END AS hr,
      CASE WHEN event_type = 'click' THEN 'bpm' END AS hr_units,
      CASE WHEN event_type = 'view' THEN CAST(user_id AS VARCHAR) END AS temp,
      CASE WHEN event_id % 3 = 0 THEN event_type END AS pain FROM events""",
    "w_participant": """
    SELECT 'HCVPt' || substring(sha256('salt' || c_name), 1, 16) AS pid,
      CASE WHEN c_custkey % 15 = 14 THEN '-' || c_name WHEN c_custkey % 4 = 1 THEN upper(c_name) ELSE c_name END AS k
    FROM customer""",
    "w_code_list": """
    SELECT CASE WHEN p_partkey % 3 = 1 THEN 'D' ELSE '-' END || p_partkey AS icd10,
      CASE WHEN k = 0 THEN p_type ELSE p_brand END AS factor, p_partkey * 2 + k AS line_no
    FROM part JOIN (VALUES (0), (1)) second(k) ON k = 0 OR p_size % 2 = 0""",
    # --- legacy tables --------------------------------------------------------------------------
    "g_demographics": f"""
    SELECT c_custkey AS id, 'PI' || c_custkey AS participant_identifier, 'NHS' || c_custkey AS nhs_number,
      c_name AS uhl_system_number, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'GP' || c_nationkey END AS gp_practice,
      CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE CAST(c_custkey % 90 AS INT) END AS age,
      CASE WHEN c_custkey % 9 = 0 THEN DATE '2000-01-01' + CAST(c_custkey % 300 AS INT) END AS date_of_death,
      {POSTCODE} AS postcode, CASE WHEN c_custkey % 5 = 4 THEN NULL ELSE CAST(c_custkey % 3 AS INT) END AS sex,
      CASE WHEN c_nationkey < 20 THEN CAST(c_nationkey AS VARCHAR) END AS ethnic_category FROM customer""",
    "g_virology": f"""
    SELECT {PART} AS k, 'LAB' || (l_suppkey % 3) AS laboratory_code, 'OC' || l_linenumber AS order_code,
      CASE WHEN l_linenumber = 2 THEN NULL ELSE 'ORDER ' || l_linenumber END AS order_name,
      'TC' || (l_suppkey % 9) AS test_code, l_linestatus AS test_name,
      CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END AS test_result, l_shipdate AS collected,
      CASE WHEN l_linenumber = 3 THEN NULL ELSE {hours('l_shipdate', 'l_linenumber')} END AS received,
      {days('l_shipdate', '1')} AS available FROM lineitem""",
    "g_emergency": f"""
    SELECT {USER} AS k, date_trunc('hour', ts) AS arrived,
      CASE WHEN event_id % 5 = 0 THEN NULL ELSE date_trunc('hour', ts) + to_hours(3) END AS departed,
      CASE WHEN event_id % 6 = 0 THEN NULL ELSE event_id % 3 END AS mode_code, event_type AS mode_text,
      event_id % 4 AS dep_code, CASE WHEN event_id % 4 = 1 THEN NULL ELSE 'DEST' || (event_id % 4) END AS dep_text,
      user_id % 20 AS complaint_code, props AS complaint_text FROM events""",
    "g_episode": f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS spell_id, 'E' || o_orderkey AS episode_id, {OWNER} AS k,
      {hours('o_orderdate', 'o_orderkey % 24')} AS admitted,
      CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE {days('o_orderdate', 'o_orderkey % 15 + 1')} END AS discharged,
      o_orderkey % 4 AS num, left(o_orderpriority, 1) AS moa, o_orderpriority AS moa_name,
      o_orderstatus AS status, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 'SOURCE ' || o_orderstatus END AS source,
      o_custkey % 10 AS spec FROM orders""",
    "g_diagnosis": f"""
    SELECT CAST(l_orderkey AS VARCHAR) AS spell_id, CAST({LINE} AS VARCHAR) AS episode_id, {PART} AS k, l_linenumber AS num,
      {DIAGNOSIS} AS code, 'NAME ' || l_partkey AS name FROM lineitem""",
    "g_procedure": f"""
    SELECT CAST(l_orderkey AS VARCHAR) AS spell_id, CAST({LINE} AS VARCHAR) AS episode_id, {PART} AS k,
      CASE WHEN l_linenumber = 4 THEN NULL ELSE l_linenumber END AS num, 'P' || l_partkey AS code,
      CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE 'NAME ' || l_partkey END AS name
    FROM lineitem""",
    "g_transfer": f"""
    SELECT CAST(l_orderkey AS VARCHAR) AS spell_id, {PART} AS k, l_shipdate AS at,
      CASE l_linenumber % 3 WHEN 0 THEN 'ADMISSION' WHEN 1 THEN 'TRANSFER' ELSE 'DISCHARGE' END AS kind,
      CAST(l_suppkey % 30 AS VARCHAR) AS ward_code,
      CASE WHEN l_suppkey % 30 < 25 THEN 'WARD ' || (l_suppkey % 30) END AS ward_name,
      'HOSPITAL ' || (l_suppkey % 3) AS hospital FROM lineitem""",
    "g_lab": f"""
    SELECT {PART} AS k, CAST({LINE} AS VARCHAR) AS line_id, l_suppkey, l_partkey, l_linenumber, l_returnflag, l_linestatus,
      CAST(l_quantity AS INT) AS qty, l_shipdate FROM lineitem""",
    "g_observation": f"""
    SELECT {USER} AS k, ts, event_type AS name, CAST(CAST(trunc(value * 100) AS INT) AS VARCHAR) AS val,
      CASE WHEN event_id % 2 = 0 THEN 'bpm' END AS units,
      CASE WHEN event_id % 5 < 3 THEN CAST(CAST(trunc(value) AS INT) AS VARCHAR) END AS ews FROM events""",
    "g_ccp": f"SELECT o_orderkey AS ok, {OWNER} AS k, o_orderdate FROM orders",
    "g_order": f"""
    SELECT {OWNER} AS k, o_orderdate AS requested, 'EX' || (o_custkey % 40) AS code, o_orderpriority AS descr,
      CASE o_orderkey % 3 WHEN 0 THEN 'CT' WHEN 1 THEN 'XR' END AS modality FROM orders""",
}
