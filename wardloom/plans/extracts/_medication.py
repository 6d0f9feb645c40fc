"""The walk from a product to its drug classes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardloom.operators.joins import in_cohort, inner_lookup
from wardloom.sources.catalog import Catalog


def product_classes(catalog: Catalog) -> DataFrame:
    """One row per product and drug class.

    The walk ends in an inner join, so a product without a class, or whose
    class chain is broken, drops out whatever the joins on the way.
    """
    rows = catalog["udmProduct"].select(F.col("ID").alias("product_id"))
    rows = inner_lookup(
        rows, catalog["udmDrugClassProduct"], "product_id", "ProductID", brand_id="DrugClassBrandID"
    )
    rows = inner_lookup(
        rows,
        catalog["udmDrugClassBrand"],
        "brand_id",
        "ID",
        ingredient_set_id="DrugClassActiveIngredientSetID",
    )
    rows = inner_lookup(rows, catalog["udmDrugClassAIS"], "ingredient_set_id", "ID", class_id="DrugClassID")
    rows = inner_lookup(rows, catalog["udmDrugClass"], "class_id", "ID", class_name="name")
    return rows.select("product_id", "class_name")


def cohort_people(catalog: Catalog) -> DataFrame:
    people = catalog["tciPerson"].select(
        F.col("id").alias("person_id"), F.col("externalId").alias("uhl_system_number")
    )
    return in_cohort(people, "uhl_system_number", catalog["all_suspected_covid"])


def cohort_medication(catalog: Catalog) -> DataFrame:
    """Medication of cohort patients."""
    medication = catalog["tciMedication"].select(
        F.col("id").alias("medication_id"),
        F.col("personId").alias("person_id"),
        F.col("udmProductID").alias("product_id"),
        F.col("medicationName").alias("medication_name"),
        F.col("createdOn").alias("created_on"),
        F.col("prescribeMethodName").alias("method_name"),
        F.col("WHO_PRESCRIBED_WARDSTAY_ID").alias("wardstay_id"),
    )
    return medication.join(cohort_people(catalog), "person_id").drop("person_id")
