"""Days of organ support per critical care period."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wardloom.functions.scalars import null_of
from wardloom.params import Params
from wardloom.plans.extracts._critical_care import cohort_periods
from wardloom.sources.catalog import Catalog

#: exported column -> source column
SUPPORT_DAYS = {
    "level_2": "CRITICAL_CARE_LEVEL2_DAYS",
    "level_3": "CRITICAL_CARE_LEVEL3_DAYS",
    "basic_cardiovascular_support_day": "BASIC_CARDIO_LEVEL_DAYS",
    "advanced_cardiovascular_support_day": "ADVANCED_CARDIO_LEVEL_DAYS",
    "basic_respiratory_support_day": "BASIC_RESP_LEVEL_DAYS",
    "advanced_respiratory_support_day": "ADVANCED_RESP_LEVEL_DAYS",
    "renal_support_day": "RENAL_SUPPORT_DAYS",
    "neurological_support_day": "NEURO_SUPPORT_DAYS",
    "dermatological_support_day": "DERM_SUPPORT_DAYS",
    "liver_support_day": "LIVER_SUPPORT_DAYS",
}


def build(catalog: Catalog, params: Params) -> DataFrame:
    rows = cohort_periods(
        catalog,
        catalog["WHO_INQUIRE_CRITICAL_CARE_PERIODS_BASE"],
        params,
        wardstaydate="CCP_START_DATE_TIME",
        **SUPPORT_DAYS,
    )
    return rows.select(
        "uhl_system_number",
        "icu_encounter_identifier",
        "admission_ward",
        "wardstaydate",
        "hospital_admission_datetime",
        "hospital_discharge_datetime",
        *SUPPORT_DAYS,
        null_of("int").alias("gastrointestinal_support_day"),
    )
