"""Consultant episodes, numbered within their spell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardloom.functions.scalars import null_of
from wardloom.operators.joins import current, inner_lookup
from wardloom.operators.timeline import sequence_in_group
from wardloom.params import Params
from wardloom.plans.spells import consultant_episodes, spells
from wardloom.sources.catalog import Catalog


def episode_rows(catalog: Catalog, params: Params) -> DataFrame:
    """Episodes whose four codes are all current; the others are left out.

    The codes of a spell are looked up before its episodes are joined.
    """
    rows = spells(catalog, params)
    rows = inner_lookup(
        rows,
        current(catalog["MF_METHOD_OF_ADMISSION"]),
        "method_of_admission_code",
        "CODE",
        admission_method="NC_ADMISSION_METHOD",
        admission_method_desc="NC_ADMISSION_METHOD_NAME",
    )
    rows = inner_lookup(
        rows,
        current(catalog["MF_SOURCE_OF_ADMISSION"]),
        "source_of_admission_code",
        "CODE",
        admission_source="NC_SOURCE_OF_ADMISSION",
        admission_source_desc="NC_SOURCE_OF_ADMISSION_NAME",
    )
    rows = inner_lookup(
        rows,
        current(catalog["MF_METHOD_OF_DISCHARGE"]),
        "method_of_discharge_code",
        "CODE",
        discharge_method="NC_DISCHARGE_METHOD",
        discharge_method_desc="NC_DISCHARGE_METHOD_NAME",
    )
    rows = rows.join(consultant_episodes(catalog), "spell_identifier")
    return inner_lookup(
        rows,
        current(catalog["MF_SPECIALTY"]),
        "specialty_code",
        "CODE",
        main_specialty_code="DHSS_CODE",
        main_specialty_code_desc="NC_SPECIALTY_NAME",
    )


def build(catalog: Catalog, params: Params) -> DataFrame:
    numbered = sequence_in_group(
        episode_rows(catalog, params),
        ["spell_identifier"],
        ["episode_start_time", "episode_identifier"],
        "order_no_of_episode",
    )
    return numbered.select(
        "uhl_system_number",
        "spell_identifier",
        "episode_identifier",
        null_of("timestamp_ntz").alias("arrival_dt_tm"),
        null_of("timestamp_ntz").alias("departure_dt_tm"),
        "admission_date_time",
        "discharge_date_time",
        "episode_start_time",
        "episode_end_time",
        "order_no_of_episode",
        "admission_method",
        "admission_method_desc",
        "admission_source",
        "admission_source_desc",
        "discharge_method",
        "discharge_method_desc",
        "main_specialty_code",
        "main_specialty_code_desc",
        null_of("string").alias("treatment_function_code"),
        null_of("string").alias("treatment_function_code_desc"),
    )
