"""The test tables dressed up as a hospital warehouse.

Every table is a projection of one test table (two for a handful), so its size
grows with the test data.  Nothing here is real data.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardloom import Catalog, Params

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,"
    " props string",
}

# study windows that suit the dates of the test data
PARAMS = Params(
    study_start=datetime(1997, 1, 1),
    cutoff=datetime(2000, 6, 30),
    as_of=datetime(2000, 12, 31),
    provenance="Test Centre",
    organisation="TEST",
    salt="test-salt",
)
#: for the tables made from ``events``
EVENT_PARAMS = Params(
    study_start=datetime(2024, 1, 5),
    cutoff=datetime(2024, 1, 20),
    as_of=datetime(2024, 12, 31),
    provenance="Test Centre",
    organisation="TEST",
    salt="test-salt",
)

# tells the lines of an order apart; their numbers alone do not
LINE_ID = (
    "(l_orderkey * 1000003 + (l_partkey * 7919 + l_suppkey * 104729 + l_linenumber * 15485863"
    " + cast(l_quantity as int)) % 1000003)"
)
SPLIT_ORDER = "concat(substring({0}, 1, 1), ' : ', substring({0}, 2))"
# fixed values: codes that occur in the filters of the jobs
SMOKING = "array('F17', 'F17.0', 'F17.1', 'F17.2', 'F17.3', 'F17.4', 'F17.7', 'F17.9', 'T65.2', 'Z72.0')"
ICD = f"case when l_partkey % 40 < 10 then element_at({SMOKING}, cast(l_partkey % 40 + 1 as int)) else concat('D', l_partkey) end"
POSTCODE = (
    "case c_custkey % 4 when 0 then concat('QX', c_custkey % 9 + 1, ' 1AA')"
    " when 1 then concat('QX1', c_custkey % 9 + 1, ' 2BB') when 2 then 'QX11CC' end"
)
USER_KEY = "concat('Customer#', lpad(cast(user_id as string), 9, '0'))"
PART_KEY = "concat('Customer#', lpad(cast(l_partkey as string), 9, '0'))"
ORDER_KEY = "concat('Customer#', lpad(cast(o_custkey as string), 9, '0'))"


def _days(column: str, days: str) -> str:
    return f"timestampadd(DAY, cast({days} as int), {column})"


def _hours(column: str, hours: str) -> str:
    return f"timestampadd(HOUR, cast({hours} as int), {column})"


def _missing(key: str, matched: str) -> str:
    """A numeric key that nothing refers to, but where ``matched`` holds."""
    return f"case when {matched} then {key} else -1 - ({key}) end"


# name -> (test table, columns as "expression as name"); every row of the test table is there
WAREHOUSE: dict[str, tuple[str, list[str]]] = {
    "PATIENT": (
        "customer",
        [
            "c_custkey as ID",
            "c_name as SYSTEM_NUMBER",
            "case c_custkey % 5 when 0 then 'M' when 1 then 'F' when 2 then 'U' when 3 then 'X' end as Sex",
            "date_add(date'1930-01-01', cast(c_custkey % 25000 as int)) as PATIENT_DATE_OF_BIRTH",
            "case when c_custkey % 13 = 0 then "
            + _days("timestamp_ntz'2000-01-01 00:00:00'", "c_custkey % 300")
            + " end as DATE_OF_DEATH",
            "c_nationkey as ETHNIC_ORIGIN_CODE",
            f"{POSTCODE} as Post_Code",
        ],
    ),
    "MF_ETHNIC_ORIGIN": ("nation", [_missing("n_nationkey", "n_nationkey < 20") + " as code", "n_name as ethnic_origin"]),
    "ADMISSIONS": (
        "orders",
        [
            "o_orderkey as ID",
            "o_custkey as PATIENT_ID",
            _hours("o_orderdate", "o_orderkey % 24") + " as ADMISSION_DATE_TIME",
            "case when o_orderkey % 10 <> 0 then "
            + _days("o_orderdate", "o_orderkey % 15 + 1")
            + " end as DISCHARGE_DATE_TIME",
            "o_orderpriority as METHOD_OF_ADMISSION_CODE",
            "o_orderstatus as SOURCE_OF_ADMISSION_CODE",
            "o_orderstatus as METHOD_OF_DISCHARGE_CODE",
            "o_custkey % 25 as ward_code",
        ],
    ),
    "MF_METHOD_OF_ADMISSION": (
        "region",
        [
            "element_at(array('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'),"
            " r_regionkey + 1) as CODE",
            "concat('M', r_regionkey) as NC_ADMISSION_METHOD",
            "r_name as NC_ADMISSION_METHOD_NAME",
            "case when r_regionkey = 4 then 1 else 0 end as LOGICALLY_DELETED_FLAG",
        ],
    ),
    "MF_SOURCE_OF_ADMISSION": (
        "region",
        [
            "element_at(array('F', 'O', 'P', 'P', '-'), r_regionkey + 1) as CODE",
            "concat('S', r_regionkey) as NC_SOURCE_OF_ADMISSION",
            "r_name as NC_SOURCE_OF_ADMISSION_NAME",
            "case when r_regionkey = 2 then 1 else 0 end as LOGICALLY_DELETED_FLAG",
        ],
    ),
    "MF_METHOD_OF_DISCHARGE": (
        "region",
        [
            "element_at(array('F', 'O', 'P', '-', '-'), r_regionkey + 1) as CODE",
            "concat('X', r_regionkey) as NC_DISCHARGE_METHOD",
            "r_name as NC_DISCHARGE_METHOD_NAME",
            "case when r_regionkey = 1 then 1 else 0 end as LOGICALLY_DELETED_FLAG",
        ],
    ),
    "CONSULTANT_EPISODES": (
        "lineitem",
        [
            f"{LINE_ID} as ID",
            "l_orderkey as ADMISSIONS_ID",
            "l_shipdate as CONS_EPISODE_START_DATE_TIME",
            _days("l_shipdate", "l_linenumber") + " as CONS_EPISODE_END_DATE_TIME",
            "l_suppkey % 10 as SPECIALTY_CODE",
            "l_linenumber as EPISODE_NUMBER",
        ],
    ),
    "MF_SPECIALTY": (
        "nation",
        [
            _missing("n_nationkey", "n_nationkey < 9") + " as CODE",
            "cast(n_nationkey * 10 + 100 as string) as DHSS_CODE",
            "n_name as NC_SPECIALTY_NAME",
            "case when n_nationkey = 8 then 1 else 0 end as LOGICALLY_DELETED_FLAG",
        ],
    ),
    "MF_WARD": (
        "nation",
        [
            "n_nationkey as CODE",
            "n_name as WARD",
            "case when n_nationkey % 6 = 0 then 1 else 0 end as LOGICALLY_DELETED_FLAG",
        ],
    ),
    # two current rows for every code
    "MF_HOSPITAL": (
        "nation",
        [
            "n_nationkey % 5 as CODE",
            "n_name as HOSPITAL",
            "case when n_nationkey >= 10 then 1 else 0 end as LOGICALLY_DELETED_FLAG",
        ],
    ),
    "MF_DIAGNOSIS": (
        "part",
        [
            "concat(case when p_partkey % 7 <> 0 then 'D' else '-' end, p_partkey) as DIAGNOSIS_CODE",
            "p_name as DIAGNOSIS_DESCRIPTION",
            "case when p_size % 10 = 0 then 1 else 0 end as LOGICALLY_DELETED_FLAG",
        ],
    ),
    "MF_OPCS4": (
        "part",
        [
            "concat(case when p_partkey % 7 <> 0 then 'P' else '-' end, p_partkey) as PROCEDURE_CODE",
            "p_name as PROCEDURE_DESCRIPTION",
            "case when p_size % 10 = 0 then 1 else 0 end as LOGICALLY_DELETED_FLAG",
        ],
    ),
    "PROCEDURES": (
        "lineitem",
        [
            _missing(LINE_ID, "l_returnflag <> 'N'") + " as CONSULTANT_EPISODES_ID",
            "l_shipdate as PROCEDURE_DATE",
            "l_linenumber as PROCEDURE_NUMBER",
            "concat('P', l_partkey) as PROCEDURE_CODE",
            "case when l_linenumber <= 2 then cast(l_orderkey as string) end as NONUNIQUE_ID",
        ],
    ),
    "TRANSFERS": (
        "lineitem",
        [
            "case when l_linenumber = 1 then "
            + SPLIT_ORDER.format("cast(l_orderkey as string)")
            + f" else concat('T: ', {LINE_ID}) end as ID",
            "l_suppkey as PATIENT_ID",
            "l_orderkey as ADMISSIONS_ID",
            "l_shipdate as TRANSFER_DATE_TIME",
            "case when l_linenumber % 4 <> 0 then "
            + _days("l_shipdate", "l_linenumber")
            + " end as TRANSFER_END_DATE_TIME",
            "l_suppkey % 30 as TO_WARD",
            "concat('BED', l_partkey % 20) as to_bed",
            "l_suppkey % 7 as TO_HOSPITAL_CODE",
        ],
    ),
    "REQUEST_PATIENT_DETAILS": (
        "customer",
        ["concat('RPD', c_custkey) as Request_Patient_Details", "c_name as Hospital_Number"],
    ),
    "ORDERS_FILE": (
        "orders",
        [
            "o_orderkey as Order_Number",
            "concat('RPD', o_custkey) as D_Level_Pointer",
            "o_custkey % 25 as C_Level_Pointer",
            "concat('LAB', o_orderkey % 4) as Lab_Ref_No",
        ],
    ),
    "HAEM_RESULTS_FILE": (
        "orders",
        [
            "concat('H', o_orderkey) as ISRN",
            _missing("o_orderkey", "o_orderkey % 2 = 0") + " as Order_No",
            "o_orderdate as WHO_COLLECTION_DATE_TIME",
            _hours("o_orderdate", "o_orderkey % 24") + " as WHO_RECEIVE_DATE_TIME",
        ],
    ),
    "HAEM_TESTS": (
        "lineitem",
        [
            "l_orderkey as id",
            "cast(cast(l_quantity as int) as string) as Result",
            "concat('X', l_partkey % 10) as Result_Expansion",
            "case l_linenumber % 3 when 0 then 'g/L' when 1 then 'mmol' end as Units",
            "l_shipdate as WHO_RESULTED_DATE_TIME",
            "case l_linenumber % 4 when 0 then concat(l_partkey, '{', l_suppkey, '.25')"
            " when 1 then concat('<', l_partkey, '{', l_suppkey) when 2 then cast(l_partkey as string)"
            " end as Reference_Range",
            "concat('T', l_suppkey) as Test_Code_Key",
            "concat('H', l_orderkey) as Haem_Results_File",
            "concat('ORD', l_suppkey % 7) as Order_Code_Expansion",
            "l_returnflag as result_flag",
            "case l_partkey % 3 when 0 then 'N' when 1 then 'Y' end as Result_Suppressed_Flag",
            "l_shipdate as WHO_Receive_Date",
        ],
    ),
    "MF_TEST_CODES_HAEM_WHO": (
        "supplier",
        [
            "concat(case when s_suppkey % 6 <> 0 then 'T' else '-' end, s_suppkey) as Test_Codes_Row_ID",
            "s_name as Test_Expansion",
        ],
    ),
    "MF_TEST_CODES_MICRO_WHO": (
        "supplier",
        [
            "concat(case when s_suppkey % 5 <> 0 then 'T' else '-' end, s_suppkey) as Test_Codes_Row_ID",
            "s_name as Test_Expansion",
        ],
    ),
    "MICRO_RESULTS_FILE": (
        "orders",
        [
            "concat('M', o_orderkey) as ISRN",
            _missing("o_orderkey", "o_orderkey % 2 = 1") + " as Order_No",
            "o_orderdate as WHO_COLLECTION_DATE_TIME",
            _hours("o_orderdate", "o_orderkey % 24") + " as WHO_RECEIVE_DATE_TIME",
            "concat('SITE', o_orderkey % 6) as specimen_site",
        ],
    ),
    "MICRO_TESTS": (
        "lineitem",
        [
            f"{LINE_ID} as Micro_Tests",
            "concat('M', l_orderkey) as Micro_Results_File",
            "concat('MO', l_suppkey % 7) as Order_code",
            "concat('MICRO ORDER ', l_suppkey % 7) as Order_Code_Expan",
            "case l_partkey % 8 when 0 then 'VCOV' when 1 then 'VCOV3' when 2 then 'VCOV4'"
            " when 3 then 'VCOV5' when 4 then 'VBIR' when 5 then 'VBIR' else 'MCS' end as Test_code",
            "concat('T', l_suppkey) as Test_Code_Key",
            "concat('R', l_partkey % 10) as Result_Expansion",
            _days("l_shipdate", "1") + " as WHO_TEST_RESULTED_DATE_TIME",
        ],
    ),
    "MF_ORGANISM_CODES": (
        "nation",
        [
            "concat(case when n_nationkey < 5 then 'OC' else '-' end, n_nationkey) as Organism_code",
            "case when n_nationkey = 4 then 'X' else 'O' end as Organism_category",
        ],
    ),
    "MF_QUANTITY_CODES": (
        "nation",
        [
            _missing("n_nationkey", "n_nationkey < 5") + " as APEX_ID",
            "case when n_nationkey <> 3 then concat('* ', n_name, ' *') end as Quantity_Description",
            "case n_nationkey when 0 then 'Y' when 1 then 'N' end as Rec_as_Signif_Growth",
        ],
    ),
    # the first three sources are there twice
    "REQUEST_SOURCE_DETAILS": (
        "nation",
        [_missing("n_nationkey % 10", "n_nationkey < 13") + " as Request_Source_Details"],
    ),
    "tciPerson": ("customer", ["c_custkey as id", "c_name as externalId"]),
    "tciMedication": (
        "orders",
        [
            "o_orderkey as id",
            "o_custkey as personId",
            "case when o_orderkey % 11 <> 0 then o_custkey end as udmProductID",
            "concat('MED', o_custkey % 50) as medicationName",
            _hours("o_orderdate", "o_orderkey % 24") + " as createdOn",
            "o_orderpriority as prescribeMethodName",
            "case when o_orderkey % 2 = 0 then "
            + SPLIT_ORDER.format("cast(o_orderkey as string)")
            + " end as WHO_PRESCRIBED_WARDSTAY_ID",
        ],
    ),
    "tciAdminEvent": (
        "lineitem",
        [
            f"{LINE_ID} as id",
            "l_orderkey as medicationid",
            _hours("l_shipdate", "l_linenumber") + " as eventDateTime",
            "l_linenumber as doseId",
            "cast(l_quantity as int) as dose",
            "case l_linenumber % 3 when 0 then 'mg' when 1 then 'ml' end as doseUnit",
            "l_suppkey % 5 as roa",
            "l_linenumber * 2 as rate",
            "'ml/h' as rateUnit",
            "l_suppkey % 7 as formCode",
        ],
    ),
    "tciMedicationDose": (
        "lineitem",
        [
            f"{LINE_ID} as id",
            "l_orderkey as medicationid",
            "cast(l_quantity as int) as minDose",
            "case l_linenumber % 3 when 0 then 'mg' when 1 then 'ml' end as doseUnit",
            "l_suppkey % 7 as formCode",
            "l_suppkey % 6 as frequency",
            "l_suppkey % 5 as roa",
        ],
    ),
    "udmProduct": ("part", ["p_partkey as ID"]),
    "udmDrugClassBrand": (
        "part",
        [_missing("p_partkey", "p_partkey not in (40, 41)") + " as ID", "p_partkey % 22 as DrugClassActiveIngredientSetID"],
    ),
    "udmDrugClassAIS": ("nation", [_missing("n_nationkey", "n_nationkey < 20") + " as ID", "n_nationkey % 9 as DrugClassID"]),
    "udmDrugClass": (
        "nation",
        [_missing("n_nationkey", "n_nationkey < 8") + " as ID", "case when n_nationkey <> 5 then n_name end as name"],
    ),
    # the first route is there twice
    "MF_DOSAGE_ASSIST_ROUTE_OF_ADMINISTRATION_WHO": (
        "nation",
        [_missing("n_nationkey % 4", "n_nationkey < 5") + " as reference", "n_name as name"],
    ),
    "MF_DOSAGE_ASSIST_FORM_CODES_WHO": (
        "nation",
        [_missing("n_nationkey", "n_nationkey < 6") + " as CODE", "n_name as Name"],
    ),
    "MF_DOSAGE_ASSIST_FREQUENCY_WHO": (
        "nation",
        [_missing("n_nationkey", "n_nationkey < 5") + " as CODE", "concat(n_nationkey + 1, ' a day') as frequency_narrative"],
    ),
    "CRIS_EXAMS_TBL": (
        "lineitem",
        ["l_orderkey as EVENT_KEY", f"{LINE_ID} as EXAM_KEY", "concat('EX', l_suppkey) as EXAMINATION"],
    ),
    "CRIS_EVENTS_TBL": (
        "orders",
        [
            "o_orderkey as EVENT_KEY",
            _hours("o_orderdate", "o_orderkey % 24") + " as Request_Date_Time",
        ],
    ),
    "CRIS_EXAMCD_TBL": (
        "supplier",
        ["concat(case when s_suppkey % 8 <> 0 then 'EX' else '-' end, s_suppkey) as CODE", "s_name as NAME"],
    ),
    "CRIS_ORDERS_TBL": (
        "lineitem",
        [
            f"concat('RO', {LINE_ID}) as ORDER_ID",
            _missing(LINE_ID, "l_linenumber <= 4") + " as EXAM_KEY",
            "l_partkey as PASLINK_KEY",
            _days("l_shipdate", "2") + " as SCHEDULE_DATE",
        ],
    ),
    "CRIS_HIS_TBL": ("customer", ["c_custkey as PASLINK_KEY", "c_name as HIS_ID"]),
    "F_PAT_PRESENT": (
        "events",
        [
            f"{USER_KEY} as PP_IDENTIFIER",
            "event_id as visitid",
            "cast(ts as date) as ARRIVAL_DATE",
            "case when event_id % 7 = 0 then '' else date_format(ts, 'HHmm') end as ARRIVAL_TIME",
            "event_id % 3 as PP_ARRIVAL_TRANS_MODE_CODE",
            "event_type as PP_ARRIVAL_TRANS_MODE_NAME",
            "date_add(cast(ts as date), 1) as DISCHARGE_DATE",
            "case when event_id % 5 <> 0 then date_format(ts, 'HHmm') end as DISCHARGE_TIME",
            "event_id % 4 as PP_DEP_DEST_ID",
            "concat('DEST', event_id % 4) as PP_DEP_DEST",
            "concat('C', user_id % 20) as PP_PRESENTING_PROBLEM_CODE",
        ],
    ),
    # "signup" has no score and "lost" no value column: neither is a measure
    "ObsExport": (
        "events",
        [
            "cast(event_id as int) as ObsId",
            f"{USER_KEY} as `System Number > Patient ID`",
            "ts as Timestamp",
            "case when event_type <> 'view' then cast(value * 100 as int) end as `Heart Rate`",
            "case when event_type = 'click' then 'bpm' end as `Heart Rate_units`",
            "cast(value as int) as `Heart Rate_ews`",
            "case when event_type = 'view' then cast(user_id as string) end as Temp",
            "'C' as Temp_units",
            "cast(value as int) as Temp_EWS",
            "case when event_id % 3 = 0 then event_type end as Pain",
            "cast(null as string) as Pain_units",
            "cast(value as int) as Pain_Ews",
            "event_type as signup",
            "'none' as signup_units",
            "cast(value as int) as lost_ews",
        ],
    ),
    # some keys are in another case than that of the patients
    "participant": (
        "customer",
        [
            "concat('HCVPt', substring(sha2(concat('salt', c_name), 256), 1, 16)) as participant_identifier",
            "case when c_custkey % 15 = 14 then concat('-', c_name) when c_custkey % 4 = 1 then upper(c_name)"
            " else c_name end as uhl_system_number",
        ],
    ),
}

LEGACY: dict[str, tuple[str, list[str]]] = {
    "demographics": (
        "customer",
        [
            "c_custkey as id",
            "concat('PI', c_custkey) as participant_identifier",
            "concat('NHS', c_custkey) as nhs_number",
            "c_name as uhl_system_number",
            "case when c_custkey % 4 <> 0 then concat('GP', c_nationkey) end as gp_practice",
            "case when c_custkey % 6 <> 0 then cast(c_custkey % 90 as int) end as age",
            "case when c_custkey % 9 = 0 then date_add(date'2000-01-01', cast(c_custkey % 300 as int)) end"
            " as date_of_death",
            f"{POSTCODE} as postcode",
            "case when c_custkey % 5 <> 4 then cast(c_custkey % 3 as int) end as sex",
            "case when c_nationkey < 20 then cast(c_nationkey as string) end as ethnic_category",
        ],
    ),
    "virology": (
        "lineitem",
        [
            f"{PART_KEY} as uhl_system_number",
            "concat('LAB', l_suppkey % 3) as laboratory_code",
            "concat('OC', l_linenumber) as order_code",
            "case when l_linenumber <> 2 then concat('ORDER ', l_linenumber) end as order_name",
            "concat('TC', l_suppkey % 9) as test_code",
            "l_linestatus as test_name",
            "case when l_returnflag <> 'N' then l_returnflag end as test_result",
            "l_shipdate as sample_collected_date_time",
            "case when l_linenumber <> 3 then " + _hours("l_shipdate", "l_linenumber") + " end"
            " as sample_received_date_time",
            _days("l_shipdate", "1") + " as sample_available_date_time",
        ],
    ),
    "emergency": (
        "events",
        [
            "event_id as visitid",
            f"{USER_KEY} as uhl_system_number",
            "cast(date_trunc('HOUR', ts) as timestamp_ntz) as arrival_datetime",
            "case when event_id % 5 <> 0 then " + _hours("cast(date_trunc('HOUR', ts) as timestamp_ntz)", "3") + " end"
            " as departure_datetime",
            "case when event_id % 6 <> 0 then cast(event_id % 3 as int) end as arrival_mode_code",
            "event_type as arrival_mode_text",
            "cast(event_id % 4 as int) as departure_code",
            "case when event_id % 4 <> 1 then concat('DEST', event_id % 4) end as departure_text",
            "cast(user_id % 20 as int) as complaint_code",
            "props as complaint_text",
        ],
    ),
    "episode": (
        "orders",
        [
            "cast(o_orderkey as string) as spell_id",
            "concat('E', o_orderkey) as episode_id",
            f"{ORDER_KEY} as uhl_system_number",
            _hours("o_orderdate", "o_orderkey % 24") + " as admission_datetime",
            "case when o_orderkey % 10 <> 0 then "
            + _days("o_orderdate", "o_orderkey % 15 + 1")
            + " end as discharge_datetime",
            "cast(o_orderkey % 4 as int) as order_no_of_episode",
            "substring(o_orderpriority, 1, 1) as admission_method_code",
            "o_orderpriority as admission_method_name",
            "o_orderstatus as admission_source_code",
            "case when o_orderstatus <> 'P' then concat('SOURCE ', o_orderstatus) end as admission_source_name",
            "o_orderstatus as discharge_method_code",
            "cast(null as string) as discharge_method_name",
            "cast(o_custkey % 10 as string) as speciality_code",
            "concat('SPEC', o_custkey % 10) as speciality_name",
            "cast(null as string) as treatment_function_code",
            "cast(null as string) as treatment_function_name",
        ],
    ),
    "diagnosis": (
        "lineitem",
        [
            "cast(l_orderkey as string) as spell_id",
            f"cast({LINE_ID} as string) as episode_id",
            f"{PART_KEY} as uhl_system_number",
            "l_linenumber as diagnosis_number",
            f"{ICD} as diagnosis_code",
            "concat('NAME ', l_partkey) as diagnosis_name",
        ],
    ),
    "procedure": (
        "lineitem",
        [
            "cast(l_orderkey as string) as spell_id",
            f"cast({LINE_ID} as string) as episode_id",
            f"{PART_KEY} as uhl_system_number",
            "case when l_linenumber <> 4 then l_linenumber end as procedure_number",
            "concat('P', l_partkey) as procedure_code",
            "case when l_partkey % 7 <> 0 then concat('NAME ', l_partkey) end as procedure_name",
        ],
    ),
    "transfer": (
        "lineitem",
        [
            "cast(l_orderkey as string) as spell_id",
            f"cast({LINE_ID} as string) as transfer_id",
            "case l_linenumber % 3 when 0 then 'ADMISSION' when 1 then 'TRANSFER' else 'DISCHARGE' end"
            " as transfer_type",
            f"{PART_KEY} as uhl_system_number",
            "l_shipdate as transfer_datetime",
            "cast(l_suppkey % 30 as string) as ward_code",
            "case when l_suppkey % 30 < 25 then concat('WARD ', l_suppkey % 30) end as ward_name",
            "concat('HOSPITAL ', l_suppkey % 3) as hospital",
        ],
    ),
    "blood_test": (
        "lineitem",
        [
            f"{PART_KEY} as uhl_system_number",
            "concat('TC', l_suppkey % 9) as test_code",
            "concat('TEST ', l_suppkey % 9) as test_name",
            "cast(cast(l_quantity as int) as string) as result",
            "case when l_linenumber = 1 then 'seen' end as result_expansion",
            "'g/L' as result_units",
            "l_shipdate as sample_collected_datetime",
            _days("l_shipdate", "1") + " as result_datetime",
            "cast(l_suppkey as decimal(10,0)) as lower_range",
            "cast(l_suppkey + 10 as decimal(10,0)) as higher_range",
        ],
    ),
    "microbiology_test": (
        "lineitem",
        [
            f"{PART_KEY} as uhl_system_number",
            "concat('MO', l_suppkey % 7) as order_code",
            "concat('MICRO ORDER ', l_suppkey % 7) as order_name",
            "l_shipdate as sample_collected_datetime",
            _hours("l_shipdate", "l_linenumber") + " as sample_received_datetime",
            _days("l_shipdate", "1") + " as result_datetime",
            "concat('SITE', l_suppkey % 6) as specimen_site",
            "case when l_partkey % 3 = 0 then concat('ORGANISM ', l_partkey % 5) end as organism",
            "l_returnflag as result",
        ],
    ),
    "prescribing": (
        "lineitem",
        [
            f"cast({LINE_ID} as string) as order_id",
            f"{PART_KEY} as uhl_system_number",
            "l_linestatus as method_name",
            "concat('MED', l_partkey % 50) as medication_name",
            "cast(cast(l_quantity as int) as string) as min_dose",
            "cast(cast(l_quantity as int) * 2 as string) as max_does",
            "'mg' as does_units",
            "concat('FORM', l_suppkey % 6) as form",
            "concat(l_suppkey % 5 + 1, ' a day') as frequency",
            "case when l_suppkey % 5 < 4 then concat('ROUTE', l_suppkey % 5) end as route",
            "l_shipdate as ordered_datetime",
        ],
    ),
    "administration": (
        "lineitem",
        [
            f"cast({LINE_ID} as string) as administration_id",
            f"{PART_KEY} as uhl_system_number",
            _hours("l_shipdate", "l_linenumber") + " as administration_datetime",
            "concat('MED', l_partkey % 50) as medication_name",
            "cast(cast(l_quantity as int) as string) as dose",
            "'mg' as dose_unit",
            "concat('FORM', l_suppkey % 6) as form_name",
            "case when l_suppkey % 5 < 4 then concat('ROUTE', l_suppkey % 5) end as route_name",
        ],
    ),
    "observation": (
        "events",
        [
            "event_id as observation_id",
            f"{USER_KEY} as uhl_system_number",
            "ts as observation_datetime",
            "event_type as observation_name",
            "cast(cast(value * 100 as int) as string) as observation_value",
            "case when event_id % 5 < 3 then cast(cast(value as int) as string) end as observation_ews",
            "case when event_id % 2 = 0 then 'bpm' end as observation_units",
        ],
    ),
    "critical_care_period": (
        "orders",
        [
            "cast(o_orderkey as string) as ccp_id",
            f"{ORDER_KEY} as uhl_system_number",
            "concat('TF', o_orderkey % 4) as treatment_function_name",
            "o_orderdate as start_datetime",
            *[
                f"cast(o_orderkey % {n} as string) as {name}"
                for n, name in enumerate(
                    [
                        "basic_respiratory_support_days",
                        "advanced_respiratory_support_days",
                        "basic_cardiovascular_support_days",
                        "advanced_cardiovascular_support_days",
                        "renal_support_days",
                        "neurological_support_days",
                        "dermatological_support_days",
                        "liver_support_days",
                        "critical_care_level_2_days",
                        "critical_care_level_3_days",
                    ],
                    start=2,
                )
            ],
            _days("o_orderdate", "o_orderkey % 5 + 1") + " as discharge_datetime",
        ],
    ),
    "order": (
        "orders",
        [
            "cast(o_orderkey as string) as order_id",
            f"{ORDER_KEY} as uhl_system_number",
            "o_orderdate as request_datetime",
            "concat('EX', o_custkey % 40) as examination_code",
            "o_orderpriority as examination_description",
            "cast(null as string) as snomed_code",
            "case o_orderkey % 3 when 0 then 'CT' when 1 then 'XR' end as modality",
        ],
    ),
}

DAY_COUNTS = [
    "CRITICAL_CARE_LEVEL2_DAYS",
    "CRITICAL_CARE_LEVEL3_DAYS",
    "BASIC_CARDIO_LEVEL_DAYS",
    "ADVANCED_CARDIO_LEVEL_DAYS",
    "BASIC_RESP_LEVEL_DAYS",
    "ADVANCED_RESP_LEVEL_DAYS",
    "RENAL_SUPPORT_DAYS",
    "NEURO_SUPPORT_DAYS",
    "DERM_SUPPORT_DAYS",
    "LIVER_SUPPORT_DAYS",
]

for _name, _modulus in (
    ("WHO_INQUIRE_CRITICAL_CARE_PERIODS", 6),
    ("WHO_INQUIRE_CRITICAL_CARE_PERIODS_BASE", 4),
):
    WAREHOUSE[_name] = (
        "orders",
        [
            f"concat(case when o_orderkey % {_modulus} = 0 then '' else '-' end, o_orderkey) as ID",
            "o_custkey as PATIENT_ID",
            _missing("o_orderkey", f"o_orderkey % {_modulus} = 0") + " as ADMISSIONS_ID",
            "cast(o_orderdate as date) as CCP_START_DATE",
            _hours("o_orderdate", "o_orderkey % 24") + " as CCP_START_DATE_TIME",
            "case when o_orderkey % 9 <> 0 then "
            + _days("o_orderdate", "o_orderkey % 5 + 1")
            + " end as CCP_END_DATE_TIME",
            *[f"cast(o_orderkey % {n} as int) as {c}" for n, c in enumerate(DAY_COUNTS, start=2)],
        ],
    )


def _cohort(customer: DataFrame) -> DataFrame:
    """Some patients twice, the second time in another case and with trailing spaces; some NULL keys."""
    first = customer.filter("c_custkey % 3 <> 0").selectExpr(
        "case when c_custkey % 97 <> 3 then c_name end as UHL_System_Number", "date'1998-01-01' as dateadded"
    )
    second = customer.filter("c_custkey % 5 = 1").selectExpr(
        "case when c_custkey % 2 = 0 then concat(lower(c_name), '  ') else c_name end as UHL_System_Number",
        "date'1999-01-01' as dateadded",
    )
    return first.unionAll(second)


def _diagnoses(lineitem: DataFrame) -> DataFrame:
    """The first diagnosis of a spell is recorded twice."""
    rows = lineitem.selectExpr(
        f"{LINE_ID} as CONSULTANT_EPISODES_ID",
        "case when l_partkey % 7 <> 0 then l_shipdate end as DIAGNOSIS_DATE",
        "l_linenumber as DIAGNOSIS_NUMBER",
        f"{ICD} as WHO_DIAGNOSIS_CODE",
        "concat('D', l_partkey) as DIAGNOSIS_CODE",
    )
    return rows.withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.when(F.col("DIAGNOSIS_NUMBER") == 1, 2).otherwise(1)))
    ).drop("_copy")


def _organisms(lineitem: DataFrame) -> DataFrame:
    """None to two organisms per test."""
    return (
        lineitem.selectExpr(
            f"{LINE_ID} as Micro_Tests",
            "l_partkey",
            "l_suppkey",
            "explode(slice(array(1, 2), 1, cast(l_partkey % 3 as int))) as k",
        )
        .selectExpr(
            "Micro_Tests",
            "case (l_suppkey + k) % 4 when 0 then 'SARS-CoV-2' when 1 then 'human cov variant'"
            " when 2 then 'Rhinovirus' end as Organism",
            "concat('OC', (l_suppkey + k) % 6) as Organism_Code",
            "(l_partkey + k) % 6 as Quantifier",
        )
    )


def _product_brands(part: DataFrame) -> DataFrame:
    """One or two brands per product, none for some."""
    return (
        part.selectExpr("p_partkey", "explode(sequence(0, 1 - p_size % 2)) as k").selectExpr(
            _missing("p_partkey", "p_partkey % 17 <> 0") + " as ProductID", "(p_partkey + 7 * k) % 42 as DrugClassBrandID"
        )
    )


def _postcodes(nation: DataFrame) -> DataFrame:
    """Deprivation of some postcodes."""
    return nation.selectExpr(
        "case when n_nationkey < 9 then concat('QX', n_nationkey + 1, ' 1AA')"
        " when n_nationkey < 14 then concat('QX1', n_nationkey - 8, ' 2BB')"
        " else concat('QX2', n_nationkey, ' 3CC') end as UNIT_POSTCODE",
        "n_nationkey % 10 + 1 as IMD_DECILE",
    )


def _code_list(part: DataFrame) -> DataFrame:
    """Risk factor lines: two for products of even size."""
    return (
        part.selectExpr("p_partkey", "p_type", "p_brand", "explode(sequence(0, 1 - p_size % 2)) as k").selectExpr(
            "concat(case when p_partkey % 3 = 1 then 'D' else '-' end, p_partkey) as ICD10",
            "case when k = 0 then p_type else p_brand end as Risk_Factor",
            "p_partkey * 2 + k as line_no",
        )
    )


#: tables that take more than a projection: name -> (test table, builder)
BUILT = {
    "all_suspected_covid": ("customer", _cohort),
    "DIAGNOSES": ("lineitem", _diagnoses),
    "MICRO_ORGANISMS": ("lineitem", _organisms),
    "udmDrugClassProduct": ("part", _product_brands),
    "MF_POSTCODE_REFERENCE_WHO": ("nation", _postcodes),
    "risk_factor_codes": ("part", _code_list),
}


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _catalog(spark: SparkSession, sf_dir: str, tables: dict, built: dict) -> Catalog:
    def projection(source: str, columns: list[str]):
        return lambda: raw(spark, sf_dir, source).selectExpr(*columns)

    def builder(source: str, build):
        return lambda: build(raw(spark, sf_dir, source))

    return Catalog(
        {
            **{name: projection(*spec) for name, spec in tables.items()},
            **{name: builder(*spec) for name, spec in built.items()},
        }
    )


def warehouse(spark: SparkSession, sf_dir: str) -> Catalog:
    """The live warehouse, its code lists and a registry that lacks some patients."""
    return _catalog(spark, sf_dir, WAREHOUSE, BUILT)


def legacy(spark: SparkSession, sf_dir: str) -> Catalog:
    """The older table set under the views."""
    return _catalog(spark, sf_dir, LEGACY, {})
