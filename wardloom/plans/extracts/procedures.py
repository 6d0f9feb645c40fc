"""Procedures of cohort episodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardloom.functions.scalars import null_of
from wardloom.operators.joins import current, left_lookup
from wardloom.params import Params
from wardloom.plans.spells import spell_episodes
from wardloom.sources.catalog import Catalog


def build(catalog: Catalog, params: Params) -> DataFrame:
    procedures = catalog["PROCEDURES"].select(
        F.col("CONSULTANT_EPISODES_ID").alias("episode_identifier"),
        F.col("PROCEDURE_DATE").alias("procedure_date"),
        F.col("PROCEDURE_NUMBER").alias("procedure_position"),
        F.col("PROCEDURE_CODE").alias("procedure_code_opcs"),
    )
    rows = procedures.join(spell_episodes(catalog, params), "episode_identifier")
    rows = left_lookup(
        rows,
        current(catalog["MF_OPCS4"]),
        "procedure_code_opcs",
        "PROCEDURE_CODE",
        procedure_name_opcs="PROCEDURE_DESCRIPTION",
    )
    return rows.select(
        "uhl_system_number",
        "spell_identifier",
        "episode_identifier",
        "procedure_date",
        "procedure_position",
        "procedure_code_opcs",
        "procedure_name_opcs",
        null_of("string").alias("procedure_code_snomed"),
        null_of("string").alias("procedure_name_snomed"),
    )
