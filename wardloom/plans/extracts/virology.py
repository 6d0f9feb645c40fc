"""Coronavirus tests: four direct tests, and respiratory panels that found a coronavirus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardloom.functions.predicates import from_start, one_of
from wardloom.functions.scalars import clean_quantity, contains_text, null_of
from wardloom.operators.joins import left_lookup
from wardloom.params import Params
from wardloom.plans.extracts._laboratory import cohort_results
from wardloom.sources.catalog import Catalog

# fixed values
DIRECT_TESTS = ["VCOV", "VCOV3", "VCOV4", "VCOV5"]
PANEL_TEST = "VBIR"
ORGANISM_TEXT = "CoV"


def build(catalog: Catalog, params: Params) -> DataFrame:
    tests = (
        catalog["MICRO_TESTS"]
        .filter(one_of("Test_code", [*DIRECT_TESTS, PANEL_TEST]))
        .select(
            F.col("Micro_Tests").alias("test_id"),
            F.col("Micro_Results_File").alias("result_id"),
            F.col("Order_Code_Expan").alias("order_name"),
            F.col("Test_code").alias("test_code"),
            F.col("Test_Code_Key").alias("test_code_key"),
            F.col("Result_Expansion").alias("result_expansion"),
            F.col("WHO_TEST_RESULTED_DATE_TIME").alias("result_available_date_time"),
        )
    )
    in_study = from_start("WHO_COLLECTION_DATE_TIME", params.study_start)
    rows = tests.join(cohort_results(catalog, in_study), "result_id")
    rows = left_lookup(
        rows, catalog["MICRO_ORGANISMS"], "test_id", "Micro_Tests", organism="Organism", quantifier="Quantifier"
    )
    is_panel = one_of("test_code", [PANEL_TEST])
    found = contains_text("organism", ORGANISM_TEXT, params.ignore_case)
    rows = rows.filter(one_of("test_code", DIRECT_TESTS) | (is_panel & found))
    rows = left_lookup(
        rows,
        catalog["MF_TEST_CODES_MICRO_WHO"],
        "test_code_key",
        "Test_Codes_Row_ID",
        test_name="Test_Expansion",
    )
    rows = left_lookup(
        rows, catalog["MF_QUANTITY_CODES"], "quantifier", "APEX_ID", quantity="Quantity_Description"
    )
    # nothing is read from the request source, but a repeated source repeats the row
    rows = left_lookup(rows, catalog["REQUEST_SOURCE_DETAILS"], "request_source", "Request_Source_Details")
    return rows.select(
        "uhl_system_number",
        "laboratory_department",
        "order_name",
        "test_name",
        F.when(is_panel, clean_quantity("quantity")).otherwise(F.col("result_expansion")).alias("test_result"),
        null_of("string").alias("test_result_unit"),
        null_of("string").alias("result_flag"),
        F.col("collected").alias("sample_collected_date_time"),
        F.col("received").alias("sample_received_date_time"),
        "result_available_date_time",
    )
