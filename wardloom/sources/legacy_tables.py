"""Declared schemas of the older table set under the legacy views."""

from __future__ import annotations

from pyspark.sql import types as T

_IDS = "id int, {0}, uhl_system_number string"

LEGACY_SCHEMAS = {
    "demographics": "id int, participant_identifier string, nhs_number string, uhl_system_number string,"
    " gp_practice string, age int, date_of_death date, postcode string, sex int, ethnic_category string",
    "virology": _IDS.format("test_id int")
    + ", laboratory_code string, order_code string, order_name string, test_code string, test_name string,"
    " organism string, test_result string, sample_collected_date_time timestamp_ntz,"
    " sample_received_date_time timestamp_ntz, sample_available_date_time timestamp_ntz, order_status string",
    "emergency": _IDS.format("visitid int")
    + ", arrival_datetime timestamp_ntz, departure_datetime timestamp_ntz, arrival_mode_code int,"
    " arrival_mode_text string, departure_code int, departure_text string, complaint_code int,"
    " complaint_text string",
    "episode": _IDS.format("spell_id string, episode_id string")
    + ", admission_datetime timestamp_ntz, discharge_datetime timestamp_ntz, order_no_of_episode int,"
    " admission_method_code string, admission_method_name string, admission_source_code string,"
    " admission_source_name string, discharge_method_code string, discharge_method_name string,"
    " speciality_code string, speciality_name string, treatment_function_code string,"
    " treatment_function_name string",
    "diagnosis": _IDS.format("spell_id string, episode_id string, diagnosis_id string")
    + ", diagnosis_number int, diagnosis_code string, diagnosis_name string",
    "procedure": _IDS.format("spell_id string, episode_id string, procedure_id string")
    + ", procedure_number int, procedure_code string, procedure_name string",
    "transfer": _IDS.format("spell_id string, transfer_id string, transfer_type string")
    + ", transfer_datetime timestamp_ntz, ward_code string, ward_name string, hospital string",
    "blood_test": _IDS.format("test_id int")
    + ", test_code string, test_name string, result string, result_expansion string, result_units string,"
    " sample_collected_datetime timestamp_ntz, result_datetime timestamp_ntz, lower_range decimal(10,0),"
    " higher_range decimal(10,0)",
    "microbiology_test": _IDS.format("test_id int")
    + ", order_code string, order_name string, test_code string, test_name string, organism string,"
    " result string, sample_collected_datetime timestamp_ntz, sample_received_datetime timestamp_ntz,"
    " result_datetime timestamp_ntz, specimen_site string",
    "prescribing": _IDS.format("order_id string")
    + ", method_name string, order_type int, medication_name string, min_dose string, max_does string,"
    " frequency string, form string, does_units string, route string, ordered_datetime timestamp_ntz",
    "administration": _IDS.format("administration_id string")
    + ", administration_datetime timestamp_ntz, medication_name string, dose_id string, dose string,"
    " dose_unit string, form_name string, route_name string",
    "observation": _IDS.format("observation_id int")
    + ", observation_datetime timestamp_ntz, observation_name string, observation_value string,"
    " observation_ews string, observation_units string",
    "critical_care_period": _IDS.format("ccp_id string")
    + ", local_identifier string, treatment_function_code string, treatment_function_name string,"
    " start_datetime timestamp_ntz, location string, basic_respiratory_support_days string,"
    " advanced_respiratory_support_days string, basic_cardiovascular_support_days string,"
    " advanced_cardiovascular_support_days string, renal_support_days string,"
    " neurological_support_days string, dermatological_support_days string, liver_support_days string,"
    " critical_care_level_2_days string, critical_care_level_3_days string, discharge_datetime timestamp_ntz",
    "order": _IDS.format("order_id string, order_key string")
    + ", scheduled_datetime timestamp_ntz, request_datetime timestamp_ntz, examination_code string,"
    " examination_description string, snomed_code string, modality string",
}


def legacy_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(LEGACY_SCHEMAS[table])
