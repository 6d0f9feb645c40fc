"""Columns of each target table, in order.

A type is given where it follows from the job; ``any`` columns take the type
they have in the source.  Text limits are the declared ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from wardloom.operators.quality import QualityError

KEY = "uhl_system_number"
KEY_LENGTH = 30
ANY = "any"
TEXT = "string"
TIME = "timestamp_ntz"

CONTRACTS: dict[str, dict[str, str]] = {
    "demographics": {
        KEY: TEXT,
        "gender": TEXT,
        "gender_desc": TEXT,
        "age": "int",
        "death_date": ANY,
        "ethnicity": ANY,
        "ethnicity_desc": TEXT,
        "Smoking_status": TEXT,
        "BMI": TEXT,
        "postcode": TEXT,
        "IMD_Decile": ANY,
    },
    "blood_test": {
        KEY: TEXT,
        "laboratory_department": TEXT,
        "order_name": TEXT,
        "test_name": TEXT,
        "test_result": TEXT,
        "test_result_unit": TEXT,
        "sample_collected_date_time": TIME,
        "result_available_date_time": TIME,
        "result_flag": TEXT,
        "result_lower_range": "decimal(18,5)",
        "result_upper_range": "decimal(18,5)",
    },
    "virology": {
        KEY: TEXT,
        "laboratory_department": TEXT,
        "order_name": TEXT,
        "test_name": TEXT,
        "test_result": TEXT,
        "test_result_unit": TEXT,
        "result_flag": TEXT,
        "sample_collected_date_time": TIME,
        "sample_received_date_time": TIME,
        "result_available_date_time": TIME,
    },
    "orders": {
        KEY: TEXT,
        "order_id": ANY,
        "order_type": TEXT,
        "order_description": TEXT,
        "order_date_time": TIME,
    },
    "observations": {
        KEY: TEXT,
        "observation_id": "int",
        "observation_code": TEXT,
        "observation_name": TEXT,
        "observation_datetime": TIME,
        "observation_start_datetime": TIME,
        "observation_end_datetime": TIME,
        "observation_result": TEXT,
        "observation_unit": TEXT,
    },
    "administration": {
        KEY: TEXT,
        "prescription_order_id": ANY,
        "therapeutical_class": TEXT,
        "medication_name": TEXT,
        "administration_datetime": TIME,
        "dosage_unit": TEXT,
        "route": TEXT,
    },
    "prescribing": {
        KEY: TEXT,
        "prescription_order_id": ANY,
        "order_date_time": TIME,
        "prescription_type": TEXT,
        "therapeutical_class": TEXT,
        "medication_name": TEXT,
        "ordered_dose": ANY,
        "ordered_frequency": TEXT,
        "ordered_drug_form": TEXT,
        "ordered_unit": TEXT,
        "ordered_route": TEXT,
        "admission_medicine_y_n": TEXT,
        "gp_to_continue": TEXT,
    },
    "microbiology_test": {
        KEY: TEXT,
        "order_code": TEXT,
        "collection_date_time": TIME,
        "site": TEXT,
        "organism_or_bug": TEXT,
        "sensitivity": TEXT,
    },
    "transfer": {
        KEY: TEXT,
        "spell_identifier": ANY,
        "episode_identifier": TEXT,
        "ward_start_date_time": TIME,
        "ward_end_date_time": TIME,
        "ward_name": TEXT,
        "bed_name": TEXT,
    },
    "procedures": {
        KEY: TEXT,
        "spell_identifier": ANY,
        "episode_identifier": ANY,
        "procedure_date": ANY,
        "procedure_position": ANY,
        "procedure_code_opcs": TEXT,
        "procedure_name_opcs": TEXT,
        "procedure_code_snomed": TEXT,
        "procedure_name_snomed": TEXT,
    },
    "diagnosis": {
        KEY: TEXT,
        "spell_identifier": ANY,
        "episode_identifier": ANY,
        "diagnosis_date_time": ANY,
        "diagnosis_position": ANY,
        "diagnosis_code_icd": TEXT,
        "diagnosis_description_icd": TEXT,
        "diagnosis_code_snomed": TEXT,
        "diagnosis_description_snomed": TEXT,
    },
    "episodes": {
        KEY: TEXT,
        "spell_identifier": ANY,
        "episode_identifier": ANY,
        "arrival_dt_tm": TIME,
        "departure_dt_tm": TIME,
        "admission_date_time": TIME,
        "discharge_date_time": TIME,
        "episode_start_time": TIME,
        "episode_end_time": TIME,
        "order_no_of_episode": "bigint",
        "admission_method": ANY,
        "admission_method_desc": TEXT,
        "admission_source": ANY,
        "admission_source_desc": TEXT,
        "discharge_method": ANY,
        "discharge_method_desc": TEXT,
        "main_specialty_code": ANY,
        "main_specialty_code_desc": TEXT,
        "treatment_function_code": TEXT,
        "treatment_function_code_desc": TEXT,
    },
    "emergency": {
        KEY: TEXT,
        "ae_visit_id": ANY,
        "arrival_date_time": TIME,
        "arrival_mode": ANY,
        "arrival_mode_desc": TEXT,
        "departure_date_time": TIME,
        "discharge_destination": ANY,
        "discharge_destination_desc": TEXT,
        "complaint": ANY,
    },
    "icu_admissions": {
        KEY: TEXT,
        "icu_encounter_identifier": ANY,
        "hospital_admission_datetime": TIME,
        "hospital_discharge_datetime": TIME,
        "icu_admission_datetime": TIME,
        "icu_discharge_datetime": TIME,
        "admission_ward": TEXT,
    },
    "icu_organsupport": {
        KEY: TEXT,
        "icu_encounter_identifier": ANY,
        "admission_ward": TEXT,
        "wardstaydate": TIME,
        "hospital_admission_datetime": TIME,
        "hospital_discharge_datetime": TIME,
        "level_2": ANY,
        "level_3": ANY,
        "basic_cardiovascular_support_day": ANY,
        "advanced_cardiovascular_support_day": ANY,
        "basic_respiratory_support_day": ANY,
        "advanced_respiratory_support_day": ANY,
        "renal_support_day": ANY,
        "neurological_support_day": ANY,
        "dermatological_support_day": ANY,
        "liver_support_day": ANY,
        "gastrointestinal_support_day": "int",
    },
    "icu_medication": {
        KEY: TEXT,
        "icu_encounter_identifier": TEXT,
        "medication_name": TEXT,
        "administration_datetime": TIME,
        "dose": ANY,
        "dosage_unit": TEXT,
        "scheduled_datetime": TIME,
        "route": TEXT,
        "form_name": TEXT,
        "total_volume": TEXT,
        "total_volume_unit": TEXT,
        "base_volume": TEXT,
        "base_volume_unit": TEXT,
        "rate_adm": ANY,
        "rate_adm_unit": TEXT,
        "amount": TEXT,
        "amount_unit": TEXT,
    },
    "icu_procedures": {
        KEY: TEXT,
        "icu_encounter_identifier": ANY,
        "procedure_datetime": ANY,
        "procedure_type": TEXT,
        "procedure_desc": TEXT,
        "icu_ward": ANY,
    },
    "riskfactors": {
        KEY: TEXT,
        "icd_code": TEXT,
        "snomed_code": TEXT,
        "code_description": TEXT,
        "risk_factor_date_time": TIME,
        "risk_factor_name": TEXT,
    },
}

#: limits besides that of the key
TEXT_LIMITS: dict[str, dict[str, int]] = {
    "observations": {
        "observation_code": 100,
        "observation_name": 100,
        "observation_result": 50,
        "observation_unit": 50,
    },
    "blood_test": {
        "laboratory_department": 20,
        "order_name": 30,
        "test_result": 8,
        "test_result_unit": 12,
        "result_flag": 2,
    },
    "riskfactors": {
        "icd_code": 50,
        "risk_factor_name": 500,
    },
}

#: columns besides the key that have to hold a value
REQUIRED: dict[str, tuple[str, ...]] = {"observations": ("observation_id",)}

#: tables with one row per patient
UNIQUE_KEY = frozenset({"demographics"})


def text_limits(table: str) -> dict[str, int]:
    """Limits of a table; the key of observations is declared wider than that of the others."""
    key_length = 50 if table == "observations" else KEY_LENGTH
    return {KEY: key_length, **TEXT_LIMITS.get(table, {})}


def require_contract(rows: DataFrame, table: str) -> None:
    """Raise unless the columns, their order and their types are as agreed."""
    contract = CONTRACTS[table]
    if rows.columns != list(contract):
        raise QualityError(f"{table}: columns {rows.columns} instead of {list(contract)}")
    wrong = {c: t for c, t in rows.dtypes if contract[c] not in (ANY, t)}
    if wrong:
        raise QualityError(f"{table}: unexpected types {wrong}")
