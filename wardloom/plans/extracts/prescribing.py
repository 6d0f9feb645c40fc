"""Prescribed doses, one row per drug class of the product."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardloom.functions.predicates import after
from wardloom.functions.scalars import null_of
from wardloom.operators.joins import left_lookup
from wardloom.params import Params
from wardloom.plans.extracts._medication import cohort_medication, product_classes
from wardloom.sources.catalog import Catalog


def build(catalog: Catalog, params: Params) -> DataFrame:
    medication = cohort_medication(catalog).filter(after("created_on", params.study_start))
    doses = catalog["tciMedicationDose"].select(
        F.col("id").alias("prescription_order_id"),
        F.col("medicationid").alias("medication_id"),
        F.col("minDose").alias("ordered_dose"),
        F.col("doseUnit").alias("ordered_unit"),
        F.col("formCode").alias("form_code"),
        F.col("frequency").alias("frequency_code"),
        F.col("roa").alias("roa"),
    )
    rows = doses.join(medication, "medication_id")
    rows = left_lookup(
        rows, catalog["MF_DOSAGE_ASSIST_FORM_CODES_WHO"], "form_code", "CODE", ordered_drug_form="Name"
    )
    rows = left_lookup(
        rows,
        catalog["MF_DOSAGE_ASSIST_FREQUENCY_WHO"],
        "frequency_code",
        "CODE",
        ordered_frequency="frequency_narrative",
    )
    rows = left_lookup(
        rows, catalog["MF_DOSAGE_ASSIST_ROUTE_OF_ADMINISTRATION_WHO"], "roa", "reference", ordered_route="name"
    )
    # last, as it multiplies the rows
    rows = rows.join(product_classes(catalog), "product_id")
    return rows.select(
        "uhl_system_number",
        "prescription_order_id",
        F.col("created_on").alias("order_date_time"),
        F.col("method_name").alias("prescription_type"),
        F.col("class_name").alias("therapeutical_class"),
        "medication_name",
        "ordered_dose",
        "ordered_frequency",
        "ordered_drug_form",
        "ordered_unit",
        "ordered_route",
        null_of("string").alias("admission_medicine_y_n"),
        null_of("string").alias("gp_to_continue"),
    )
