"""Diagnoses of cohort episodes, without repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardloom.functions.scalars import null_of
from wardloom.operators.joins import current, left_lookup
from wardloom.params import Params
from wardloom.plans.spells import spell_episodes
from wardloom.sources.catalog import Catalog


def build(catalog: Catalog, params: Params) -> DataFrame:
    diagnoses = catalog["DIAGNOSES"].select(
        F.col("CONSULTANT_EPISODES_ID").alias("episode_identifier"),
        F.col("DIAGNOSIS_DATE").alias("diagnosis_date_time"),
        F.col("DIAGNOSIS_NUMBER").alias("diagnosis_position"),
        F.col("WHO_DIAGNOSIS_CODE").alias("diagnosis_code_icd"),
        F.col("DIAGNOSIS_CODE").alias("diagnosis_code"),
    )
    rows = diagnoses.join(spell_episodes(catalog, params), "episode_identifier")
    rows = left_lookup(
        rows,
        current(catalog["MF_DIAGNOSIS"]),
        "diagnosis_code",
        "DIAGNOSIS_CODE",
        diagnosis_description_icd="DIAGNOSIS_DESCRIPTION",
    )
    distinct = rows.select(
        "uhl_system_number",
        "spell_identifier",
        "episode_identifier",
        "diagnosis_date_time",
        "diagnosis_position",
        "diagnosis_code_icd",
        "diagnosis_description_icd",
    ).distinct()
    return distinct.select(
        "*",
        null_of("string").alias("diagnosis_code_snomed"),
        null_of("string").alias("diagnosis_description_snomed"),
    )
