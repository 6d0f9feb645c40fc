"""Ward stays of cohort spells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardloom.functions.scalars import null_of
from wardloom.operators.joins import current, left_lookup
from wardloom.params import Params
from wardloom.plans.spells import spells
from wardloom.sources.catalog import Catalog


def build(catalog: Catalog, params: Params) -> DataFrame:
    transfers = catalog["TRANSFERS"].select(
        F.col("ADMISSIONS_ID").alias("spell_identifier"),
        F.col("TRANSFER_DATE_TIME").alias("ward_start_date_time"),
        F.col("TRANSFER_END_DATE_TIME").alias("ward_end_date_time"),
        F.col("TO_WARD").alias("ward_code"),
        F.col("to_bed").alias("bed_name"),
        F.col("TO_HOSPITAL_CODE").alias("hospital_code"),
    )
    rows = transfers.join(spells(catalog, params), "spell_identifier")
    rows = left_lookup(rows, current(catalog["MF_WARD"]), "ward_code", "CODE", ward_name="WARD")
    # nothing is read from the hospital, but a repeated code repeats the row
    rows = left_lookup(rows, current(catalog["MF_HOSPITAL"]), "hospital_code", "CODE")
    return rows.select(
        "uhl_system_number",
        "spell_identifier",
        null_of("string").alias("episode_identifier"),
        "ward_start_date_time",
        "ward_end_date_time",
        "ward_name",
        "bed_name",
    )
