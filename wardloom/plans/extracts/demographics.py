"""One row per cohort patient."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardloom.functions.keys import match_key
from wardloom.functions.predicates import one_of
from wardloom.functions.scalars import age_at, null_of, recode
from wardloom.operators.joins import COHORT_KEY, left_lookup
from wardloom.operators.timeline import latest_per_key
from wardloom.params import Params
from wardloom.plans.spells import spell_episodes
from wardloom.sources.catalog import Catalog

# fixed values: smoking diagnoses and the coding of sex
SMOKING_CODES = ["F17", "F17.0", "F17.1", "F17.2", "F17.3", "F17.4", "F17.7", "F17.9", "T65.2", "Z72.0"]
GENDER_CODES = {"U": "0", "M": "1", "F": "2"}
GENDER_NAMES = {"U": "Not Known", "M": "Male", "F": "Female"}
GENDER_OTHER = ("9", "Not Specified")


def smoking_status(catalog: Catalog, params: Params) -> DataFrame:
    """The most recent smoking diagnosis per patient."""
    diagnoses = (
        catalog["DIAGNOSES"]
        .filter(one_of("WHO_DIAGNOSIS_CODE", SMOKING_CODES))
        .select(
            F.col("CONSULTANT_EPISODES_ID").alias("episode_identifier"),
            "DIAGNOSIS_DATE",
            "DIAGNOSIS_NUMBER",
            "WHO_DIAGNOSIS_CODE",
        )
    )
    rows = spell_episodes(catalog, params).join(diagnoses, "episode_identifier")
    return latest_per_key(
        rows,
        match_key("uhl_system_number").alias("match_key"),
        "WHO_DIAGNOSIS_CODE",
        ["DIAGNOSIS_DATE", "DIAGNOSIS_NUMBER", "WHO_DIAGNOSIS_CODE"],
        "recent_smoking_status",
    )


def first_added(catalog: Catalog) -> DataFrame:
    """Cohort keys with the date on which each was first added."""
    return (
        catalog["all_suspected_covid"]
        .filter(F.col(COHORT_KEY).isNotNull())
        .groupBy(match_key(COHORT_KEY).alias("match_key"))
        .agg(F.min(COHORT_KEY).alias("uhl_system_number"), F.min("dateadded").alias("dateadded"))
    )


def build(catalog: Catalog, params: Params) -> DataFrame:
    patients = catalog["PATIENT"].select(
        match_key("SYSTEM_NUMBER").alias("match_key"),
        "Sex",
        F.col("PATIENT_DATE_OF_BIRTH").alias("born"),
        F.col("DATE_OF_DEATH").alias("death_date"),
        F.col("ETHNIC_ORIGIN_CODE").alias("ethnicity"),
        F.col("Post_Code").alias("postcode"),
    )
    rows = first_added(catalog).join(patients, "match_key")
    rows = rows.join(smoking_status(catalog, params), "match_key", "left")
    rows = left_lookup(
        rows, catalog["MF_POSTCODE_REFERENCE_WHO"], "postcode", "UNIT_POSTCODE", IMD_Decile="IMD_DECILE"
    )
    rows = left_lookup(rows, catalog["MF_ETHNIC_ORIGIN"], "ethnicity", "code", ethnicity_desc="ethnic_origin")
    people = rows.groupBy(
        "match_key",
        "Sex",
        "born",
        "death_date",
        "ethnicity",
        "ethnicity_desc",
        "postcode",
        "IMD_Decile",
        "recent_smoking_status",
    ).agg(F.min("uhl_system_number").alias("uhl_system_number"), F.min("dateadded").alias("dateadded"))
    code, name = GENDER_OTHER
    return people.select(
        "uhl_system_number",
        recode("Sex", GENDER_CODES, code).alias("gender"),
        recode("Sex", GENDER_NAMES, name).alias("gender_desc"),
        age_at("born", "dateadded").alias("age"),
        "death_date",
        "ethnicity",
        "ethnicity_desc",
        F.col("recent_smoking_status").alias("Smoking_status"),
        null_of("string").alias("BMI"),
        "postcode",
        "IMD_Decile",
    )
