"""Drug administrations prescribed during a critical care period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardloom.functions.keys import normalise_id
from wardloom.functions.predicates import after
from wardloom.functions.scalars import null_of
from wardloom.operators.joins import left_lookup
from wardloom.params import Params
from wardloom.plans.extracts._medication import cohort_medication, product_classes
from wardloom.sources.catalog import Catalog


def build(catalog: Catalog, params: Params) -> DataFrame:
    events = (
        catalog["tciAdminEvent"]
        .filter(after("eventDateTime", params.study_start))
        .select(
            F.col("medicationid").alias("medication_id"),
            F.col("eventDateTime").alias("administration_datetime"),
            "dose",
            F.col("doseUnit").alias("dosage_unit"),
            F.col("roa").alias("roa"),
            F.col("formCode").alias("form_code"),
            F.col("rate").alias("rate_adm"),
            F.col("rateUnit").alias("rate_adm_unit"),
        )
    )
    periods = catalog["WHO_INQUIRE_CRITICAL_CARE_PERIODS"].select(F.col("ID").cast("string").alias("period"))
    medication = (
        cohort_medication(catalog)
        .withColumn("icu_encounter_identifier", normalise_id("wardstay_id"))
        .join(periods, F.col("icu_encounter_identifier") == F.col("period"), "left_semi")
    )
    # neither the ward stay nor the drug class is read, but each match repeats the row
    medication = left_lookup(medication, catalog["TRANSFERS"], "wardstay_id", "ID")
    medication = medication.join(product_classes(catalog).select("product_id"), "product_id")
    rows = events.join(medication, "medication_id")
    rows = left_lookup(
        rows, catalog["MF_DOSAGE_ASSIST_ROUTE_OF_ADMINISTRATION_WHO"], "roa", "reference", route="name"
    )
    rows = left_lookup(rows, catalog["MF_DOSAGE_ASSIST_FORM_CODES_WHO"], "form_code", "CODE", form_name="Name")
    return rows.select(
        "uhl_system_number",
        "icu_encounter_identifier",
        "medication_name",
        "administration_datetime",
        "dose",
        "dosage_unit",
        F.col("created_on").alias("scheduled_datetime"),
        "route",
        "form_name",
        null_of("string").alias("total_volume"),
        null_of("string").alias("total_volume_unit"),
        null_of("string").alias("base_volume"),
        null_of("string").alias("base_volume_unit"),
        "rate_adm",
        "rate_adm_unit",
        null_of("string").alias("amount"),
        null_of("string").alias("amount_unit"),
    )
