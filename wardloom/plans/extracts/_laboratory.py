"""Joins shared by the two microbiology laboratory jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardloom.operators.joins import in_cohort
from wardloom.sources.catalog import Catalog


def cohort_results(catalog: Catalog, in_study: Column) -> DataFrame:
    """Microbiology results of cohort patients that satisfy ``in_study``, with order and patient."""
    results = (
        catalog["MICRO_RESULTS_FILE"]
        .filter(in_study)
        .select(
            F.col("ISRN").alias("result_id"),
            F.col("Order_No").alias("order_no"),
            F.col("WHO_COLLECTION_DATE_TIME").alias("collected"),
            F.col("WHO_RECEIVE_DATE_TIME").alias("received"),
            F.col("specimen_site").alias("site"),
        )
    )
    orders = catalog["ORDERS_FILE"].select(
        F.col("Order_Number").alias("order_no"),
        F.col("D_Level_Pointer").alias("requester"),
        F.col("C_Level_Pointer").alias("request_source"),
        F.col("Lab_Ref_No").alias("laboratory_department"),
    )
    patients = in_cohort(
        catalog["REQUEST_PATIENT_DETAILS"].select(
            F.col("Request_Patient_Details").alias("requester"),
            F.col("Hospital_Number").alias("uhl_system_number"),
        ),
        "uhl_system_number",
        catalog["all_suspected_covid"],
    )
    # the cohort's orders first: of the results, only theirs go further
    cohort_orders = orders.join(patients, "requester").drop("requester")
    return results.join(cohort_orders, "order_no").drop("order_no")
