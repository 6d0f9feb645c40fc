"""Cohort patients, their hospital spells and episodes: the start of most jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardloom.functions.predicates import after
from wardloom.operators.joins import in_cohort
from wardloom.params import Params
from wardloom.sources.catalog import Catalog

#: a catalog may hold these two, written once and shared by the jobs of a run
SPELLS = "staged_spells"
SPELL_EPISODES = "staged_spell_episodes"


def cohort_patients(catalog: Catalog) -> DataFrame:
    patients = catalog["PATIENT"].select(
        F.col("ID").alias("patient_id"), F.col("SYSTEM_NUMBER").alias("uhl_system_number")
    )
    return in_cohort(patients, "uhl_system_number", catalog["all_suspected_covid"])


def spells(catalog: Catalog, params: Params) -> DataFrame:
    """Spells of cohort patients admitted after the study start."""
    if SPELLS in catalog:
        return catalog[SPELLS]
    admissions = catalog["ADMISSIONS"].select(
        F.col("ID").alias("spell_identifier"),
        F.col("PATIENT_ID").alias("patient_id"),
        F.col("ADMISSION_DATE_TIME").alias("admission_date_time"),
        F.col("DISCHARGE_DATE_TIME").alias("discharge_date_time"),
        F.col("METHOD_OF_ADMISSION_CODE").alias("method_of_admission_code"),
        F.col("SOURCE_OF_ADMISSION_CODE").alias("source_of_admission_code"),
        F.col("METHOD_OF_DISCHARGE_CODE").alias("method_of_discharge_code"),
    )
    return (
        admissions.filter(after("admission_date_time", params.study_start))
        .join(cohort_patients(catalog), "patient_id")
        .drop("patient_id")
    )


def consultant_episodes(catalog: Catalog) -> DataFrame:
    return catalog["CONSULTANT_EPISODES"].select(
        F.col("ADMISSIONS_ID").alias("spell_identifier"),
        F.col("ID").alias("episode_identifier"),
        F.col("CONS_EPISODE_START_DATE_TIME").alias("episode_start_time"),
        F.col("CONS_EPISODE_END_DATE_TIME").alias("episode_end_time"),
        F.col("SPECIALTY_CODE").alias("specialty_code"),
    )


def spell_episodes(catalog: Catalog, params: Params) -> DataFrame:
    """Keys of patient, spell and episode, one row per consultant episode."""
    if SPELL_EPISODES in catalog:
        return catalog[SPELL_EPISODES]
    keys = spells(catalog, params).select("uhl_system_number", "spell_identifier")
    episodes = consultant_episodes(catalog).select("spell_identifier", "episode_identifier")
    return keys.join(episodes, "spell_identifier")
