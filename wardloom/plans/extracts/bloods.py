"""Blood tests with their reference range."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardloom.functions.keys import match_key
from wardloom.functions.predicates import from_start, n_or_null
from wardloom.functions.scalars import parse_reference_range
from wardloom.operators.joins import COHORT_KEY, left_lookup
from wardloom.params import Params
from wardloom.sources.catalog import Catalog

#: a catalog may hold the cohort's results, written and checked before they are used
PATIENT_RESULTS = "staged_patient_results"


def cohort_requesters(catalog: Catalog) -> DataFrame:
    """Laboratory patient records of cohort patients, each once."""
    cohort = (
        catalog["all_suspected_covid"]
        .filter(F.col(COHORT_KEY).isNotNull())
        .select(match_key(COHORT_KEY).alias("match_key"), F.col(COHORT_KEY).alias("uhl_system_number"))
    )
    requesters = catalog["REQUEST_PATIENT_DETAILS"].select(
        F.col("Request_Patient_Details").alias("requester"),
        match_key("Hospital_Number").alias("match_key"),
    )
    return (
        cohort.join(requesters, "match_key")
        .groupBy("requester", "match_key")
        .agg(F.min("uhl_system_number").alias("uhl_system_number"))
        .drop("match_key")
    )


def cohort_orders(catalog: Catalog) -> DataFrame:
    """Orders of cohort patients; the small side comes first, so that no other order is shuffled further."""
    orders = catalog["ORDERS_FILE"].select(
        F.col("Order_Number").alias("order_no"),
        F.col("D_Level_Pointer").alias("requester"),
        F.col("Lab_Ref_No").alias("laboratory_department"),
    )
    return orders.join(cohort_requesters(catalog), "requester").drop("requester")


def patient_results(catalog: Catalog, params: Params) -> DataFrame:
    """Results of cohort patients, received from the study start on."""
    if PATIENT_RESULTS in catalog:
        return catalog[PATIENT_RESULTS]
    results = (
        catalog["HAEM_RESULTS_FILE"]
        .filter(from_start("WHO_RECEIVE_DATE_TIME", params.study_start))
        .select(
            F.col("ISRN").alias("result_id"),
            F.col("Order_No").alias("order_no"),
            F.col("WHO_COLLECTION_DATE_TIME").alias("sample_collected_date_time"),
        )
    )
    return results.join(cohort_orders(catalog), "order_no").drop("order_no")


def build(catalog: Catalog, params: Params) -> DataFrame:
    tests = (
        catalog["HAEM_TESTS"]
        .filter(n_or_null("Result_Suppressed_Flag"))
        .filter(from_start("WHO_Receive_Date", params.study_start))
        .select(
            F.col("Haem_Results_File").alias("result_id"),
            F.col("Order_Code_Expansion").alias("order_name"),
            F.col("Result").alias("test_result"),
            F.col("Units").alias("test_result_unit"),
            F.col("WHO_RESULTED_DATE_TIME").alias("result_available_date_time"),
            F.col("result_flag"),
            F.col("Reference_Range").alias("reference_range"),
            F.col("Test_Code_Key").alias("test_code_key"),
        )
    )
    rows = tests.join(patient_results(catalog, params), "result_id")
    rows = left_lookup(
        rows,
        catalog["MF_TEST_CODES_HAEM_WHO"],
        "test_code_key",
        "Test_Codes_Row_ID",
        test_name="Test_Expansion",
    )
    lower, upper = parse_reference_range("reference_range")
    return rows.select(
        "uhl_system_number",
        "laboratory_department",
        "order_name",
        "test_name",
        "test_result",
        "test_result_unit",
        "sample_collected_date_time",
        "result_available_date_time",
        "result_flag",
        lower.alias("result_lower_range"),
        upper.alias("result_upper_range"),
    )
