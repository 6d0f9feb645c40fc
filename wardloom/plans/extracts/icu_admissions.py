"""Critical care admissions."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wardloom.params import Params
from wardloom.plans.extracts._critical_care import cohort_periods
from wardloom.sources.catalog import Catalog


def build(catalog: Catalog, params: Params) -> DataFrame:
    rows = cohort_periods(
        catalog,
        catalog["WHO_INQUIRE_CRITICAL_CARE_PERIODS"],
        params,
        icu_admission_datetime="CCP_START_DATE_TIME",
        icu_discharge_datetime="CCP_END_DATE_TIME",
    )
    return rows.select(
        "uhl_system_number",
        "icu_encounter_identifier",
        "hospital_admission_datetime",
        "hospital_discharge_datetime",
        "icu_admission_datetime",
        "icu_discharge_datetime",
        "admission_ward",
    )
