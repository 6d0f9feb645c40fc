"""Emergency department visits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardloom.functions.predicates import from_start
from wardloom.functions.scalars import hhmm_to_timestamp
from wardloom.operators.joins import in_cohort
from wardloom.params import Params
from wardloom.sources.catalog import Catalog


def build(catalog: Catalog, params: Params) -> DataFrame:
    visits = catalog["F_PAT_PRESENT"].filter(from_start("ARRIVAL_DATE", params.study_start))
    return in_cohort(visits, "PP_IDENTIFIER", catalog["all_suspected_covid"]).select(
        F.col("PP_IDENTIFIER").alias("uhl_system_number"),
        F.col("visitid").alias("ae_visit_id"),
        hhmm_to_timestamp("ARRIVAL_DATE", "ARRIVAL_TIME").alias("arrival_date_time"),
        F.col("PP_ARRIVAL_TRANS_MODE_CODE").alias("arrival_mode"),
        F.col("PP_ARRIVAL_TRANS_MODE_NAME").alias("arrival_mode_desc"),
        hhmm_to_timestamp("DISCHARGE_DATE", "DISCHARGE_TIME").alias("departure_date_time"),
        F.col("PP_DEP_DEST_ID").alias("discharge_destination"),
        F.col("PP_DEP_DEST").alias("discharge_destination_desc"),
        F.col("PP_PRESENTING_PROBLEM_CODE").alias("complaint"),
    )
