"""Source tables and the columns the jobs read from them."""

from __future__ import annotations

from pyspark.errors import AnalysisException

from wardloom.sources.catalog import Catalog

_CODE_FILE = "CODE LOGICALLY_DELETED_FLAG"
_PERIODS = (
    "ID PATIENT_ID ADMISSIONS_ID CCP_START_DATE CCP_START_DATE_TIME CCP_END_DATE_TIME"
    " CRITICAL_CARE_LEVEL2_DAYS CRITICAL_CARE_LEVEL3_DAYS BASIC_CARDIO_LEVEL_DAYS"
    " ADVANCED_CARDIO_LEVEL_DAYS BASIC_RESP_LEVEL_DAYS ADVANCED_RESP_LEVEL_DAYS"
    " RENAL_SUPPORT_DAYS NEURO_SUPPORT_DAYS DERM_SUPPORT_DAYS LIVER_SUPPORT_DAYS"
)

#: logical name -> columns; ``ObsExport`` also has three columns per measure
SOURCE_TABLES = {
    name: columns.split()
    for name, columns in {
        # cohort and patients
        "all_suspected_covid": "UHL_System_Number dateadded",
        "PATIENT": "ID SYSTEM_NUMBER Sex PATIENT_DATE_OF_BIRTH DATE_OF_DEATH ETHNIC_ORIGIN_CODE Post_Code",
        "MF_ETHNIC_ORIGIN": "code ethnic_origin",
        "MF_POSTCODE_REFERENCE_WHO": "UNIT_POSTCODE IMD_DECILE",
        # spells
        "ADMISSIONS": "ID PATIENT_ID ADMISSION_DATE_TIME DISCHARGE_DATE_TIME METHOD_OF_ADMISSION_CODE"
        " SOURCE_OF_ADMISSION_CODE METHOD_OF_DISCHARGE_CODE ward_code",
        "CONSULTANT_EPISODES": "ID ADMISSIONS_ID CONS_EPISODE_START_DATE_TIME CONS_EPISODE_END_DATE_TIME"
        " SPECIALTY_CODE",
        "DIAGNOSES": "CONSULTANT_EPISODES_ID DIAGNOSIS_DATE DIAGNOSIS_NUMBER DIAGNOSIS_CODE"
        " WHO_DIAGNOSIS_CODE",
        "PROCEDURES": "CONSULTANT_EPISODES_ID PROCEDURE_DATE PROCEDURE_NUMBER PROCEDURE_CODE NONUNIQUE_ID",
        "TRANSFERS": "ID PATIENT_ID ADMISSIONS_ID TRANSFER_DATE_TIME TRANSFER_END_DATE_TIME TO_WARD to_bed"
        " TO_HOSPITAL_CODE",
        "WHO_INQUIRE_CRITICAL_CARE_PERIODS": _PERIODS,
        "WHO_INQUIRE_CRITICAL_CARE_PERIODS_BASE": _PERIODS,
        "MF_METHOD_OF_ADMISSION": f"{_CODE_FILE} NC_ADMISSION_METHOD NC_ADMISSION_METHOD_NAME",
        "MF_SOURCE_OF_ADMISSION": f"{_CODE_FILE} NC_SOURCE_OF_ADMISSION NC_SOURCE_OF_ADMISSION_NAME",
        "MF_METHOD_OF_DISCHARGE": f"{_CODE_FILE} NC_DISCHARGE_METHOD NC_DISCHARGE_METHOD_NAME",
        "MF_SPECIALTY": f"{_CODE_FILE} DHSS_CODE NC_SPECIALTY_NAME",
        "MF_WARD": f"{_CODE_FILE} WARD",
        "MF_HOSPITAL": _CODE_FILE,
        "MF_DIAGNOSIS": "DIAGNOSIS_CODE DIAGNOSIS_DESCRIPTION LOGICALLY_DELETED_FLAG",
        "MF_OPCS4": "PROCEDURE_CODE PROCEDURE_DESCRIPTION LOGICALLY_DELETED_FLAG",
        "risk_factor_codes": "ICD10 Risk_Factor line_no",
        # laboratory
        "REQUEST_PATIENT_DETAILS": "Request_Patient_Details Hospital_Number",
        "REQUEST_SOURCE_DETAILS": "Request_Source_Details",
        "ORDERS_FILE": "Order_Number D_Level_Pointer C_Level_Pointer Lab_Ref_No",
        "HAEM_RESULTS_FILE": "ISRN Order_No WHO_COLLECTION_DATE_TIME WHO_RECEIVE_DATE_TIME",
        "HAEM_TESTS": "Result Units WHO_RESULTED_DATE_TIME Reference_Range Test_Code_Key Haem_Results_File"
        " Order_Code_Expansion result_flag Result_Suppressed_Flag WHO_Receive_Date",
        "MF_TEST_CODES_HAEM_WHO": "Test_Codes_Row_ID Test_Expansion",
        "MICRO_RESULTS_FILE": "ISRN Order_No WHO_COLLECTION_DATE_TIME WHO_RECEIVE_DATE_TIME specimen_site",
        "MICRO_TESTS": "Micro_Tests Micro_Results_File Order_code Order_Code_Expan Test_code Test_Code_Key"
        " Result_Expansion WHO_TEST_RESULTED_DATE_TIME",
        "MICRO_ORGANISMS": "Micro_Tests Organism Organism_Code Quantifier",
        "MF_TEST_CODES_MICRO_WHO": "Test_Codes_Row_ID Test_Expansion",
        "MF_ORGANISM_CODES": "Organism_code Organism_category",
        "MF_QUANTITY_CODES": "APEX_ID Quantity_Description Rec_as_Signif_Growth",
        # medication
        "tciPerson": "id externalId",
        "tciMedication": "id personId udmProductID medicationName createdOn prescribeMethodName"
        " WHO_PRESCRIBED_WARDSTAY_ID",
        "tciAdminEvent": "id medicationid eventDateTime doseId dose doseUnit roa rate rateUnit formCode",
        "tciMedicationDose": "id medicationid minDose doseUnit formCode frequency roa",
        "udmProduct": "ID",
        "udmDrugClassProduct": "ProductID DrugClassBrandID",
        "udmDrugClassBrand": "ID DrugClassActiveIngredientSetID",
        "udmDrugClassAIS": "ID DrugClassID",
        "udmDrugClass": "ID name",
        "MF_DOSAGE_ASSIST_FORM_CODES_WHO": "CODE Name",
        "MF_DOSAGE_ASSIST_FREQUENCY_WHO": "CODE frequency_narrative",
        "MF_DOSAGE_ASSIST_ROUTE_OF_ADMINISTRATION_WHO": "reference name",
        # radiology
        "CRIS_EXAMS_TBL": "EVENT_KEY EXAM_KEY EXAMINATION",
        "CRIS_EVENTS_TBL": "EVENT_KEY Request_Date_Time",
        "CRIS_EXAMCD_TBL": "CODE NAME",
        "CRIS_ORDERS_TBL": "ORDER_ID EXAM_KEY PASLINK_KEY SCHEDULE_DATE",
        "CRIS_HIS_TBL": "PASLINK_KEY HIS_ID",
        # emergency and observations
        "F_PAT_PRESENT": "PP_IDENTIFIER visitid ARRIVAL_DATE ARRIVAL_TIME PP_ARRIVAL_TRANS_MODE_CODE"
        " PP_ARRIVAL_TRANS_MODE_NAME DISCHARGE_DATE DISCHARGE_TIME PP_DEP_DEST_ID PP_DEP_DEST"
        " PP_PRESENTING_PROBLEM_CODE",
    }.items()
}
SOURCE_TABLES["ObsExport"] = ["ObsId", "System Number > Patient ID", "Timestamp"]


def _columns(catalog: Catalog, name: str) -> set[str]:
    """Lower-case column names; none where there is no such table."""
    try:
        return {c.lower() for c in catalog[name].columns}
    except (KeyError, AnalysisException):
        return set()


def missing_columns(catalog: Catalog) -> dict[str, list[str]]:
    """Columns the jobs need and a catalog lacks, per table; names compare without case."""
    lacking = {}
    for name, columns in SOURCE_TABLES.items():
        present = _columns(catalog, name)
        missing = [c for c in columns if c.lower() not in present]
        if missing:
            lacking[name] = missing
    return lacking
