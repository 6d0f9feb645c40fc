"""Radiology orders requested between the study start and now."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardloom.functions.predicates import from_start, until
from wardloom.operators.joins import in_cohort, inner_lookup
from wardloom.params import Params
from wardloom.sources.catalog import Catalog


def build(catalog: Catalog, params: Params) -> DataFrame:
    exams = catalog["CRIS_EXAMS_TBL"].select(
        F.col("EVENT_KEY").alias("event_key"),
        F.col("EXAM_KEY").alias("exam_key"),
        F.col("EXAMINATION").alias("examination"),
    )
    events = (
        catalog["CRIS_EVENTS_TBL"]
        .filter(from_start("Request_Date_Time", params.study_start))
        .filter(until("Request_Date_Time", params.as_of, params.time_zone))
    )
    requests = catalog["CRIS_ORDERS_TBL"].select(
        F.col("ORDER_ID").alias("order_id"),
        F.col("EXAM_KEY").alias("exam_key"),
        F.col("PASLINK_KEY").alias("paslink_key"),
        F.col("SCHEDULE_DATE").alias("order_date_time"),
    )
    people = in_cohort(
        catalog["CRIS_HIS_TBL"].select(
            F.col("PASLINK_KEY").alias("paslink_key"), F.col("HIS_ID").alias("uhl_system_number")
        ),
        "uhl_system_number",
        catalog["all_suspected_covid"],
    )
    # the patient side first: it removes most rows before the exams are joined
    rows = requests.join(people, "paslink_key").join(exams, "exam_key")
    rows = inner_lookup(rows, events, "event_key", "EVENT_KEY")
    rows = inner_lookup(
        rows, catalog["CRIS_EXAMCD_TBL"], "examination", "CODE", order_type="CODE", order_description="NAME"
    )
    return rows.select("uhl_system_number", "order_id", "order_type", "order_description", "order_date_time")
