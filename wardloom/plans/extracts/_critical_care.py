"""Critical care periods with their patient and admission."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardloom.functions.predicates import from_start
from wardloom.operators.joins import current, left_lookup
from wardloom.params import Params
from wardloom.plans.spells import cohort_patients
from wardloom.sources.catalog import Catalog


def cohort_periods(catalog: Catalog, periods: DataFrame, params: Params, **measures: str) -> DataFrame:
    """Periods started in the study; ``measures`` maps new column -> period column."""
    started = (
        periods.filter(from_start("CCP_START_DATE", params.study_start))
        .filter(from_start("CCP_START_DATE_TIME", params.study_start))
        .select(
            F.col("PATIENT_ID").alias("patient_id"),
            F.col("ADMISSIONS_ID").alias("spell_identifier"),
            F.col("ID").alias("icu_encounter_identifier"),
            *[F.col(c).alias(name) for name, c in measures.items()],
        )
    )
    admissions = catalog["ADMISSIONS"].select(
        F.col("ID").alias("spell_identifier"),
        F.col("ADMISSION_DATE_TIME").alias("hospital_admission_datetime"),
        F.col("DISCHARGE_DATE_TIME").alias("hospital_discharge_datetime"),
        F.col("ward_code").alias("ward_code"),
    )
    rows = started.join(cohort_patients(catalog), "patient_id").join(admissions, "spell_identifier")
    return left_lookup(rows, current(catalog["MF_WARD"]), "ward_code", "CODE", admission_ward="WARD")
