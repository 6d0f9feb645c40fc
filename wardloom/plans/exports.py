"""Pseudonymised, date-limited rows of each target table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardloom.functions.keys import match_key
from wardloom.functions.predicates import timestamp, within_cutoff
from wardloom.functions.scalars import has_short_outcode, null_of, outcode_live
from wardloom.params import Params
from wardloom.plans.registry import IDENTIFIER, KEY

PROVENANCE = "brc_name"


@dataclass(frozen=True)
class Export:
    """What one export takes from its target table."""

    target: str
    columns: tuple[str, ...]
    #: dates that must not be after the cut-off
    dates: tuple[str, ...] = ()
    subject: str = "subject"
    #: columns that are not taken over as they are
    computed: tuple[tuple[str, Callable[[], Column]], ...] = ()
    keep: Callable[[], Column] | None = None


#: file name -> export; column order is that of the file
EXPORTS = {
    "demographics": Export(
        target="demographics",
        subject="Subject",
        columns=(
            "gender",
            "gender_desc",
            "age",
            "death_date",
            "ethnicity",
            "ethnicity_desc",
            "Smoking_status",
            "BMI",
            "postcode",
            "IMD_Decile",
        ),
        computed=(("postcode", lambda: outcode_live("postcode")),),
        keep=lambda: has_short_outcode("postcode"),
    ),
    "administration": Export(
        target="administration",
        columns=(
            "prescription_order_id",
            "therapeutical_class",
            "medication_name",
            "administration_datetime",
            "dosage_unit",
            "route",
        ),
        dates=("administration_datetime",),
    ),
    "bloods": Export(
        target="blood_test",
        columns=(
            "laboratory_department",
            "order_name",
            "test_name",
            "test_result",
            "test_result_unit",
            "sample_collected_date_time",
            "result_available_date_time",
            "result_flag",
            "result_lower_range",
            "result_upper_range",
        ),
        dates=("sample_collected_date_time", "result_available_date_time"),
    ),
    "diagnoses": Export(
        target="diagnosis",
        columns=(
            "spell_identifier",
            "episode_identifier",
            "diagnosis_date_time",
            "diagnosis_position",
            "diagnosis_code_icd",
            "diagnosis_description_icd",
            "diagnosis_code_snomed",
            "diagnosis_description_snomed",
        ),
        dates=("diagnosis_date_time",),
    ),
    "emergency": Export(
        target="emergency",
        columns=(
            "ae_visit_id",
            "arrival_date_time",
            "arrival_mode",
            "arrival_mode_desc",
            "departure_date_time",
            "discharge_destination",
            "discharge_destination_desc",
            "complaint",
        ),
        dates=("arrival_date_time", "departure_date_time"),
    ),
    "episodes": Export(
        target="episodes",
        columns=(
            "spell_identifier",
            "episode_identifier",
            "arrival_dt_tm",
            "departure_dt_tm",
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
            "treatment_function_code",
            "treatment_function_code_desc",
        ),
        dates=("admission_date_time", "discharge_date_time", "episode_start_time", "episode_end_time"),
    ),
    "icu_admissions": Export(
        target="icu_admissions",
        columns=(
            "icu_encounter_identifier",
            "hospital_admission_datetime",
            "hospital_discharge_datetime",
            "icu_admission_datetime",
            "icu_discharge_datetime",
            "admission_ward",
        ),
        dates=(
            "hospital_admission_datetime",
            "hospital_discharge_datetime",
            "icu_admission_datetime",
            "icu_discharge_datetime",
        ),
    ),
    "icu_medication": Export(
        target="icu_medication",
        columns=(
            "icu_encounter_identifier",
            "medication_name",
            "administration_datetime",
            "dose",
            "dosage_unit",
            "scheduled_datetime",
            "route",
            "site",
            "formulation",
            "total_volume",
            "total_volume_unit",
            "base_volume",
            "base_volume_unit",
            "rate_adm",
            "rate_adm_unit",
            "amount",
            "amount_unit",
        ),
        computed=(
            ("site", lambda: null_of("string")),
            ("formulation", lambda: F.col("form_name")),
        ),
        dates=("administration_datetime",),
    ),
    "icu_organsupport": Export(
        target="icu_organsupport",
        columns=(
            "icu_encounter_identifier",
            "admission_ward",
            "wardstaydate",
            "hospital_admission_datetime",
            "hospital_discharge_datetime",
            "level_2",
            "level_3",
            "basic_cardiovascular_support_day",
            "advanced_cardiovascular_support_day",
            "basic_respiratory_support_day",
            "advanced_respiratory_support_day",
            "renal_support_day",
            "neurological_support_day",
            "dermatological_support_day",
            "liver_support_day",
            "gastrointestinal_support_day",
        ),
        dates=("hospital_admission_datetime", "hospital_discharge_datetime"),
    ),
    "icu_procedures": Export(
        target="icu_procedures",
        columns=(
            "icu_encounter_identifier",
            "procedure_datetime",
            "procedure_type",
            "procedure_desc",
            "icu_ward",
        ),
        dates=("procedure_datetime",),
    ),
    "microbiology": Export(
        target="microbiology_test",
        columns=("order_code", "collection_date_time", "site", "organism_or_bug", "sensitivity"),
        dates=("collection_date_time",),
    ),
    "observations": Export(
        target="observations",
        columns=(
            "observation_code",
            "observation_name",
            "observation_datetime",
            "observation_start_datetime",
            "observation_end_datetime",
            "observation_result",
            "observation_unit",
        ),
        dates=("observation_datetime", "observation_start_datetime", "observation_end_datetime"),
    ),
    "orders": Export(
        target="orders",
        columns=("order_id", "order_type", "order_description", "order_date_time"),
        dates=("order_date_time",),
    ),
    "prescribing": Export(
        target="prescribing",
        columns=(
            "prescription_order_id",
            "order_date_time",
            "prescription_type",
            "therapeutical_class",
            "medication_name",
            "ordered_dose",
            "ordered_frequency",
            "ordered_drug_form",
            "ordered_unit",
            "ordered_route",
            "admission_medicine_y_n",
            "gp_to_continue",
        ),
        dates=("order_date_time",),
    ),
    "procedures": Export(
        target="procedures",
        columns=(
            "spell_identifier",
            "episode_identifier",
            "procedure_position",
            "procedure_code_opcs",
            "procedure_name_opcs",
            "procedure_code_snomed",
            "procedure_name_snomed",
        ),
        dates=("procedure_date",),
    ),
    "transfer": Export(
        target="transfer",
        columns=(
            "spell_identifier",
            "episode_identifier",
            "ward_start_date_time",
            "ward_end_date_time",
            "ward_name",
            "bed_name",
        ),
        dates=("ward_start_date_time", "ward_end_date_time"),
    ),
    "virology": Export(
        target="virology",
        columns=(
            "laboratory_department",
            "order_name",
            "test_name",
            "test_result",
            "test_result_unit",
            "result_flag",
            "sample_collected_date_time",
            "sample_received_date_time",
            "result_available_date_time",
        ),
        dates=("sample_collected_date_time", "sample_received_date_time", "result_available_date_time"),
    ),
    "riskfactors": Export(
        target="riskfactors",
        columns=(
            "icd_code",
            "snomed_code",
            "code_description",
            "risk_factor_date_time",
            "risk_factor_name",
        ),
        dates=("risk_factor_date_time",),
    ),
}


def eligible_patients(episodes: DataFrame, params: Params) -> DataFrame:
    """Keys of patients with an admission up to the cut-off, each once."""
    admitted = episodes.filter(F.col("admission_date_time") <= timestamp(params.cutoff))
    return admitted.select(match_key(KEY).alias("eligible_key")).distinct()


def exported_patients(registry: DataFrame, eligible: DataFrame) -> DataFrame:
    """Keys, as they are compared, and identifiers of the registered patients who are eligible."""
    people = registry.select(match_key(KEY).alias("_key"), IDENTIFIER)
    return people.join(eligible, F.col("_key") == F.col("eligible_key"), "left_semi")


def export_rows(
    export: Export, target: DataFrame, registry: DataFrame, eligible: DataFrame, params: Params
) -> DataFrame:
    """The rows of one export; the patient key does not leave this function."""
    # patients are few beside the rows: settle who is exported before touching the rows
    people = exported_patients(registry, eligible)
    return rows_of_patients(export, target, match_key(KEY), people, F.col("_key"), params)


def rows_of_patients(
    export: Export, target: DataFrame, key: Column, people: DataFrame, people_key: Column, params: Params
) -> DataFrame:
    """As ``export_rows``, for patients with their identifiers; keys are given as they are compared."""
    rows = target
    for date in export.dates:
        rows = rows.filter(within_cutoff(date, params.cutoff))
    if export.keep:
        rows = rows.filter(export.keep())
    computed = dict(export.computed)
    rows = rows.select(
        key.alias("_key"),
        *[computed[c]().alias(c) if c in computed else F.col(c) for c in export.columns],
    )
    people = people.select(people_key.alias("_key"), F.col(IDENTIFIER).alias(export.subject))
    return rows.join(people, "_key").select(
        export.subject, *export.columns, F.lit(params.provenance).alias(PROVENANCE)
    )
