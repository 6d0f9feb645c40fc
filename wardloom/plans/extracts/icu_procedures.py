"""Procedures recorded against a critical care period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardloom.functions.keys import normalise_id
from wardloom.functions.predicates import after
from wardloom.operators.joins import current, left_lookup
from wardloom.params import Params
from wardloom.plans.spells import cohort_patients, spell_episodes
from wardloom.sources.catalog import Catalog


def cohort_transfers(catalog: Catalog, params: Params) -> DataFrame:
    """Ward stays of cohort patients under their plain id."""
    transfers = (
        catalog["TRANSFERS"]
        .filter(after("TRANSFER_DATE_TIME", params.study_start))
        .select(
            F.col("PATIENT_ID").alias("patient_id"),
            normalise_id("ID").alias("transfer_id"),
            F.col("TO_WARD").alias("to_ward"),
        )
    )
    return transfers.join(cohort_patients(catalog), "patient_id").select("transfer_id", "to_ward")


def build(catalog: Catalog, params: Params) -> DataFrame:
    procedures = catalog["PROCEDURES"].select(
        F.col("CONSULTANT_EPISODES_ID").alias("episode_identifier"),
        F.col("PROCEDURE_DATE").alias("procedure_datetime"),
        F.col("PROCEDURE_CODE").alias("procedure_type"),
        F.col("NONUNIQUE_ID").cast("string").alias("period_key"),
    )
    periods = catalog["WHO_INQUIRE_CRITICAL_CARE_PERIODS"].select(
        F.col("ID").cast("string").alias("period_key"), F.col("ID").alias("icu_encounter_identifier")
    )
    rows = procedures.join(periods, "period_key")
    rows = rows.join(spell_episodes(catalog, params), "episode_identifier")
    rows = left_lookup(
        rows,
        current(catalog["MF_OPCS4"]),
        "procedure_type",
        "PROCEDURE_CODE",
        procedure_desc="PROCEDURE_DESCRIPTION",
    )
    rows = left_lookup(
        rows, cohort_transfers(catalog, params), "period_key", "transfer_id", icu_ward="to_ward"
    )
    return rows.select(
        "uhl_system_number",
        "icu_encounter_identifier",
        "procedure_datetime",
        "procedure_type",
        "procedure_desc",
        "icu_ward",
    )
