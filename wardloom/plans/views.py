"""The fifteen views over the older table set."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardloom.functions.keys import match_key, match_text
from wardloom.functions.predicates import timestamp
from wardloom.functions.scalars import blank_if_null, outcode_legacy
from wardloom.operators.timeline import with_next_events
from wardloom.params import Params
from wardloom.sources.catalog import Catalog

KEY = "uhl_system_number"


@dataclass(frozen=True)
class View:
    """Columns one view takes from its table."""

    table: str
    columns: tuple[str, ...]
    #: columns shown as text, blank where missing
    blank: frozenset[str] = frozenset()
    #: view column -> table column, where the names differ
    renamed: dict[str, str] = field(default_factory=dict)

    def select(self):
        for name in self.columns:
            column = F.col(self.renamed.get(name, name))
            yield (blank_if_null(column) if name in self.blank else column).alias(name)


def _all_blank(table: str, *columns: str, **renamed: str) -> View:
    return View(table, columns, frozenset(columns), renamed)


#: views that join a table to the patients that may be shown
FACT_VIEWS = {
    "administration": View(
        "administration",
        ("administration_datetime", "medication_name", "dose", "dose_unit", "route_name", "form_name"),
    ),
    "bloods": View(
        "blood_test",
        (
            "test_code",
            "test_name",
            "result",
            "result_expansion",
            "result_units",
            "sample_collected_datetime",
            "result_datetime",
            "lower_range",
            "higher_range",
        ),
    ),
    "diagnosis": View(
        "diagnosis", ("spell_id", "episode_id", "diagnosis_number", "diagnosis_code", "diagnosis_name")
    ),
    "emergency": _all_blank(
        "emergency",
        "arrival_datetime",
        "departure_datetime",
        "arrival_mode_code",
        "arrival_mode_text",
        "departure_code",
        "departure_text",
        "complaint_code",
        "complaint_text",
    ),
    "episode": _all_blank(
        "episode",
        "spell_id",
        "episode_id",
        "admission_datetime",
        "discharge_datetime",
        "order_no_of_episode",
        "admission_method_code",
        "admission_method_name",
        "admission_source_code",
        "admission_source_name",
        "discharge_method_code",
        "discharge_method_name",
        "speciality_code",
        "speciality_name",
        "treatment_function_code",
        "treatment_function_name",
    ),
    "icu": View(
        "critical_care_period",
        (
            "critical_care_id",
            "treatment_function_name",
            "start_datetime",
            "basic_respiratory_support_days",
            "advanced_respiratory_support_days",
            "basic_cardiovascular_support_days",
            "advanced_cardiovascular_support_days",
            "renal_support_days",
            "neurological_support_days",
            "dermatological_support_days",
            "liver_support_days",
            "critical_care_level_2_days",
            "critical_care_level_3_days",
            "discharge_datetime",
        ),
        renamed={"critical_care_id": "ccp_id"},
    ),
    "microbiology": View(
        "microbiology_test",
        (
            "order_code",
            "order_name",
            "sample_collected_datetime",
            "sample_received_datetime",
            "result_datetime",
            "specimen_site",
            "organism",
            "result",
        ),
    ),
    "observations": View(
        "observation",
        (
            "observation_datetime",
            "observation_name",
            "observation_value",
            "observation_units",
            "observation_ews",
        ),
    ),
    "order": View(
        "order",
        ("request_datetime", "examination_code", "examination_description", "modality", "snomed_code"),
    ),
    "prescribing": View(
        "prescribing",
        (
            "order_id",
            "method_name",
            "medication_name",
            "min_dose",
            "max_does",
            "does_units",
            "form",
            "frequency",
            "route",
            "ordered_datetime",
        ),
    ),
    "procedure": View(
        "procedure",
        ("spell_id", "episode_id", "procedure_number", "procedure_code", "procedure_name"),
        blank=frozenset({"procedure_number", "procedure_code", "procedure_name"}),
    ),
    "virology": _all_blank(
        "virology",
        "laboratory_code",
        "order_code",
        "order_name",
        "test_code",
        "test_name",
        "test_result",
        "sample_collected_date_time",
        "sample_received_date_time",
        "result_available_date_time",
        result_available_date_time="sample_available_date_time",
    ),
}


def _provenance(params: Params):
    return F.lit(params.provenance).alias("BRC"), F.lit(params.organisation).alias("Organisation")


def demographics_filtered(catalog: Catalog, params: Params) -> DataFrame:
    """Patients admitted up to the cut-off."""
    admitted = (
        catalog["episode"]
        .filter(F.col("admission_datetime") <= timestamp(params.cutoff))
        .select(match_key(KEY).alias("_admitted"))
        .distinct()
    )
    return catalog["demographics"].join(admitted, match_key(KEY) == F.col("_admitted"), "left_semi")


def demographics_exports(catalog: Catalog, params: Params) -> DataFrame:
    return demographics_filtered(catalog, params).select(
        *_provenance(params),
        F.col("participant_identifier").alias("Subject"),
        blank_if_null("gp_practice").alias("gp_practice"),
        blank_if_null("age").alias("age"),
        blank_if_null("date_of_death").alias("date_of_death"),
        outcode_legacy("postcode").alias("postcode_outcode"),
        blank_if_null("sex").alias("gender"),
        blank_if_null("ethnic_category").alias("ethnic_category"),
    )


def shown_patients(catalog: Catalog, params: Params) -> DataFrame:
    """Patient keys with the pseudonym under which they are shown."""
    people = catalog["demographics"].select(
        match_key(KEY).alias("_key"), F.col("participant_identifier").alias("Subject")
    )
    shown = demographics_exports(catalog, params).select(match_key("Subject").alias("_shown"))
    return people.join(shown, match_key("Subject") == F.col("_shown")).select("_key", "Subject")


def fact_view(view: View, catalog: Catalog, params: Params) -> DataFrame:
    needed = {view.renamed.get(name, name) for name in view.columns}
    rows = catalog[view.table].select(match_key(KEY).alias("_key"), *sorted(needed))
    # texts are made after the join, which then moves the narrower source columns
    return rows.join(shown_patients(catalog, params), "_key").select(
        *_provenance(params), "Subject", *view.select()
    )


def movement(catalog: Catalog, params: Params) -> DataFrame:
    """Each ward movement with the next later one of its spell.

    Movements at the same time each count, on both sides; the last time of a
    spell has no next one and is left out.  Spells are compared as codes are.
    """
    transfers = catalog["transfer"].filter(F.col("spell_id").isNotNull())
    transfers = transfers.select(
        KEY, "spell_id", "transfer_datetime", "transfer_type", "hospital", "ward_code", "ward_name"
    )
    spell = match_text("spell_id").alias("spell")
    followed = with_next_events(
        transfers, [spell], "transfer_datetime", "transfer_type", "end_datetime", "end_type"
    )
    patients = demographics_filtered(catalog, params).select(
        match_key(KEY).alias("_key"), F.col("participant_identifier").alias("Subject")
    )
    # null-safe, so that no filter on the key gets below the shuffle that both uses of it share
    same = match_key(KEY).eqNullSafe(F.col("_key"))
    rows = followed.join(patients.filter(F.col("_key").isNotNull()), same)
    return rows.select(
        *_provenance(params),
        "Subject",
        blank_if_null("spell_id").alias("spell_id"),
        blank_if_null("transfer_datetime").alias("start_datetime"),
        blank_if_null("transfer_type").alias("start_type"),
        blank_if_null("end_datetime").alias("end_datetime"),
        blank_if_null("end_type").alias("end_type"),
        blank_if_null("hospital").alias("hospital"),
        blank_if_null("ward_code").alias("ward_code"),
        blank_if_null("ward_name").alias("ward_name"),
    )


def _fact_builder(view: View):
    return lambda catalog, params: fact_view(view, catalog, params)


#: published name -> builder
VIEWS = {
    "demographics_filtered": demographics_filtered,
    "demographics_exports": demographics_exports,
    "movement_export": movement,
    **{f"{name}_export": _fact_builder(view) for name, view in FACT_VIEWS.items()},
}


def publish_views(catalog: Catalog, params: Params) -> list[str]:
    """Make every view whose table is in the catalog available to SQL; return the names."""
    needed = {"movement_export": "transfer", **{f"{n}_export": v.table for n, v in FACT_VIEWS.items()}}
    published = []
    for name, build in VIEWS.items():
        if needed.get(name, "demographics") in catalog:
            build(catalog, params).createOrReplaceTempView(name)
            published.append(name)
    return published
