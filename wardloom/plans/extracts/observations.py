"""Observations, from one column per measure to one row per value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardloom.functions.predicates import from_start
from wardloom.functions.scalars import null_of
from wardloom.operators.joins import in_cohort
from wardloom.operators.reshape import find_measures, unpivot_measures
from wardloom.params import Params
from wardloom.sources.catalog import Catalog

PATIENT_COLUMN = "`System Number > Patient ID`"


def build(catalog: Catalog, params: Params) -> DataFrame:
    wide = catalog["ObsExport"]
    measures = find_measures(wide.columns)
    rows = in_cohort(
        wide.filter(from_start("Timestamp", params.study_start)),
        F.col(PATIENT_COLUMN),
        catalog["all_suspected_covid"],
    )
    long = unpivot_measures(
        rows,
        [PATIENT_COLUMN, "ObsId", "Timestamp"],
        measures,
        "observation_code",
        "observation_result",
        "observation_unit",
    )
    return long.select(
        F.col(PATIENT_COLUMN).alias("uhl_system_number"),
        F.col("ObsId").cast("int").alias("observation_id"),
        "observation_code",
        F.col("observation_code").alias("observation_name"),
        F.col("Timestamp").alias("observation_datetime"),
        null_of("timestamp_ntz").alias("observation_start_datetime"),
        null_of("timestamp_ntz").alias("observation_end_datetime"),
        "observation_result",
        "observation_unit",
    )
