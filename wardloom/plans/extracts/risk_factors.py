"""Diagnoses that count as a risk factor."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardloom.functions.scalars import as_timestamp, null_of
from wardloom.operators.joins import current, inner_lookup, left_lookup
from wardloom.params import Params
from wardloom.plans.spells import spell_episodes
from wardloom.sources.catalog import Catalog
from wardloom.sources.lookup import concat_by_code


def build(catalog: Catalog, params: Params) -> DataFrame:
    """``risk_factor_codes`` is a code list as read by ``sources.lookup``."""
    source = catalog["DIAGNOSES"]
    diagnoses = source.select(
        F.col("CONSULTANT_EPISODES_ID").alias("episode_identifier"),
        F.col("WHO_DIAGNOSIS_CODE").alias("icd_code"),
        as_timestamp(source, "DIAGNOSIS_DATE").alias("risk_factor_date_time"),
    )
    # the code list first: it removes most diagnoses before the episodes are joined
    rows = inner_lookup(
        diagnoses,
        concat_by_code(catalog["risk_factor_codes"]),
        "icd_code",
        "icd10",
        risk_factor_name="description",
    )
    rows = rows.join(spell_episodes(catalog, params), "episode_identifier")
    rows = left_lookup(
        rows,
        current(catalog["MF_DIAGNOSIS"]),
        "icd_code",
        "DIAGNOSIS_CODE",
        code_description="DIAGNOSIS_DESCRIPTION",
    )
    return rows.select(
        "uhl_system_number",
        "icd_code",
        null_of("string").alias("snomed_code"),
        "code_description",
        "risk_factor_date_time",
        "risk_factor_name",
    )
