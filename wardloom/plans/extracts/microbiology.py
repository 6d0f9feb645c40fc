"""Microbiology tests, one row per organism found."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardloom.functions.predicates import from_start, one_of
from wardloom.operators.joins import inner_lookup
from wardloom.params import Params
from wardloom.plans.extracts._laboratory import cohort_results
from wardloom.sources.catalog import Catalog

ORGANISM_CATEGORY = "O"


def organisms_found(catalog: Catalog) -> DataFrame:
    """Organisms of the right category with a known quantity."""
    rows = catalog["MICRO_ORGANISMS"].select(
        F.col("Micro_Tests").alias("test_id"),
        F.col("Organism").alias("organism"),
        F.col("Organism_Code").alias("organism_code"),
        F.col("Quantifier").alias("quantifier"),
    )
    codes = catalog["MF_ORGANISM_CODES"].filter(F.col("Organism_category") == ORGANISM_CATEGORY)
    rows = inner_lookup(rows, codes, "organism_code", "Organism_code")
    rows = inner_lookup(
        rows,
        catalog["MF_QUANTITY_CODES"],
        "quantifier",
        "APEX_ID",
        quantity="Quantity_Description",
        significant="Rec_as_Signif_Growth",
    )
    growth = F.when(one_of("significant", ["Y"]), "Yes").otherwise("No")
    return rows.select("test_id", "organism", "quantity", growth.alias("significant_growth"))


def build(catalog: Catalog, params: Params) -> DataFrame:
    tests = catalog["MICRO_TESTS"].select(
        F.col("Micro_Tests").alias("test_id"),
        F.col("Micro_Results_File").alias("result_id"),
        F.col("Order_code").alias("order_code"),
        F.col("Result_Expansion").alias("result_expansion"),
    )
    in_study = from_start("WHO_RECEIVE_DATE_TIME", params.study_start)
    rows = tests.join(cohort_results(catalog, in_study), "result_id")
    rows = rows.join(organisms_found(catalog), "test_id", "left")
    return rows.select(
        "uhl_system_number",
        "order_code",
        F.col("collected").alias("collection_date_time"),
        "site",
        F.col("organism").alias("organism_or_bug"),
        F.coalesce("quantity", "result_expansion").alias("sensitivity"),
    )
