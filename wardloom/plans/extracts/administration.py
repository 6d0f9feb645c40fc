"""Drug administrations with the classes of the drug in one text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardloom.functions.predicates import after
from wardloom.operators.joins import left_lookup
from wardloom.params import Params
from wardloom.plans.extracts._medication import cohort_medication, product_classes
from wardloom.sources.catalog import Catalog


def classes_by_product(catalog: Catalog) -> DataFrame:
    """The class names of each product; a class without a name counts as a space."""
    return (
        product_classes(catalog)
        .groupBy("product_id")
        .agg(F.collect_list(F.coalesce("class_name", F.lit(" "))).alias("classes"))
    )


def class_texts(used: DataFrame, classes: DataFrame) -> DataFrame:
    """The text of each different list of products and their numbers of events: the classes of all, once for each event.

    There are far fewer lists than groups of events, and only lists and texts are joined.
    """
    one = used.distinct().withColumn("one", F.explode("products"))
    one = one.join(classes, F.col("one.product_id") == F.col("product_id"))
    times = F.array_repeat("classes", F.col("one.events").cast("int"))
    each = one.select("products", F.flatten(times).alias("classes"))
    lists = each.groupBy("products").agg(F.flatten(F.collect_list("classes")).alias("classes"))
    return lists.select("products", F.array_join(F.array_sort("classes"), ", ").alias("therapeutical_class"))


def build(catalog: Catalog, params: Params) -> DataFrame:
    events = (
        catalog["tciAdminEvent"]
        .filter(after("eventDateTime", params.study_start))
        .select(
            F.col("id").alias("prescription_order_id"),
            F.col("medicationid").alias("medication_id"),
            F.col("eventDateTime").alias("administration_datetime"),
            F.col("doseId").alias("dose_id"),
            "dose",
            F.col("doseUnit").alias("dosage_unit"),
            F.col("roa").alias("roa"),
        )
    )
    classes = classes_by_product(catalog)
    # an event carries the id of its product only, and is dropped if that has no class
    medication = cohort_medication(catalog).join(classes.select("product_id"), "product_id", "left_semi")
    rows = events.join(medication, "medication_id")
    rows = left_lookup(
        rows, catalog["MF_DOSAGE_ASSIST_ROUTE_OF_ADMINISTRATION_WHO"], "roa", "reference", route="name"
    )
    group = (
        "uhl_system_number",
        "prescription_order_id",
        "administration_datetime",
        "medication_name",
        "dose_id",
        "dose",
        "dosage_unit",
        "route",
    )
    counted = rows.groupBy(*group, "product_id").agg(F.count(F.lit(1)).alias("events"))
    grouped = counted.groupBy(*group).agg(
        F.array_sort(F.collect_list(F.struct("product_id", "events"))).alias("products")
    )
    named = grouped.join(class_texts(grouped.select("products"), classes), "products")
    # dose and its id are part of the group but not of the result, so rows may repeat
    return named.select(
        "uhl_system_number",
        "prescription_order_id",
        "therapeutical_class",
        "medication_name",
        "administration_datetime",
        "dosage_unit",
        "route",
    )
