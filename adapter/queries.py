"""Every query on the test data: operators, extracts, exports and legacy views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adapter import clinic
from wardloom import Catalog
from wardloom.functions import predicates as P
from wardloom.functions import scalars as S
from wardloom.functions.keys import match_key, normalise_id
from wardloom.operators import joins, quality, reshape, timeline
from wardloom.plans import registry
from wardloom.plans.exports import EXPORTS, eligible_patients, export_rows
from wardloom.plans.extracts import EXTRACTS, _medication, bloods, demographics, episodes, microbiology, virology
from wardloom.plans.views import VIEWS
from wardloom.session import configure, shared_folder
from wardloom.sinks.delimited import read_export, write_delimited
from wardloom.sinks.targets import TargetStore
from wardloom.sources.lookup import concat_by_code, read_code_list

Query = Callable[[SparkSession, str], DataFrame]
PARAMS = clinic.PARAMS

#: query name -> (target table, export name)
JOBS = {
    "demographics": ("demographics", "demographics"),
    "bloods": ("blood_test", "bloods"),
    "virology": ("virology", "virology"),
    "orders": ("orders", "orders"),
    "observations": ("observations", "observations"),
    "administration": ("administration", "administration"),
    "prescribing": ("prescribing", "prescribing"),
    "microbiology": ("microbiology_test", "microbiology"),
    "transfers": ("transfer", "transfer"),
    "procedures": ("procedures", "procedures"),
    "diagnoses": ("diagnosis", "diagnoses"),
    "episodes": ("episodes", "episodes"),
    "emergency": ("emergency", "emergency"),
    "icu_admissions": ("icu_admissions", "icu_admissions"),
    "icu_organsupport": ("icu_organsupport", "icu_organsupport"),
    "icu_medication": ("icu_medication", "icu_medication"),
    "icu_procedures": ("icu_procedures", "icu_procedures"),
    "risk_factors": ("riskfactors", "riskfactors"),
}


def _params(target: str):
    return clinic.EVENT_PARAMS if target in ("observations", "emergency") else PARAMS


def _eligible(catalog: Catalog) -> DataFrame:
    return eligible_patients(episodes.episode_rows(catalog, PARAMS), PARAMS)


def extract(job: str, catalog: Catalog) -> DataFrame:
    target, _ = JOBS[job]
    return EXTRACTS[target](catalog, _params(target))


def export(job: str, catalog: Catalog) -> DataFrame:
    target, name = JOBS[job]
    return export_rows(
        EXPORTS[name], extract(job, catalog), catalog["participant"], _eligible(catalog), _params(target)
    )


# --- projections -------------------------------------------------------------------------------


def project_rename(c: Catalog) -> DataFrame:
    from wardloom.plans.extracts.icu_organsupport import SUPPORT_DAYS

    return c["WHO_INQUIRE_CRITICAL_CARE_PERIODS_BASE"].select(
        F.col("ID").alias("icu_encounter_identifier"),
        *[F.col(source).alias(name) for name, source in SUPPORT_DAYS.items()],
    )


def null_placeholders(c: Catalog) -> DataFrame:
    return c["ADMISSIONS"].select(
        F.col("ID").alias("spell_identifier"),
        S.null_of("timestamp_ntz").alias("arrival_dt_tm"),
        S.null_of("string").alias("treatment_function_code"),
        S.null_of("int").alias("gastrointestinal_support_day"),
    )


def recode_simple_case(c: Catalog) -> DataFrame:
    code, name = demographics.GENDER_OTHER
    return c["PATIENT"].select(
        F.col("SYSTEM_NUMBER").alias("system_number"),
        S.recode("Sex", demographics.GENDER_CODES, code).alias("gender"),
        S.recode("Sex", demographics.GENDER_NAMES, name).alias("gender_desc"),
    )


def _tests_with_organisms(c: Catalog) -> DataFrame:
    tests = c["MICRO_TESTS"].select(
        F.col("Micro_Tests").alias("test_id"),
        F.col("Test_code").alias("test_code"),
        F.col("Result_Expansion").alias("result_expansion"),
    )
    return joins.left_lookup(
        tests, c["MICRO_ORGANISMS"], "test_id", "Micro_Tests", organism="Organism", quantifier="Quantifier"
    )


def case_cleaned_result(c: Catalog) -> DataFrame:
    rows = joins.left_lookup(
        _tests_with_organisms(c),
        c["MF_QUANTITY_CODES"],
        "quantifier",
        "APEX_ID",
        quantity="Quantity_Description",
    )
    result = F.when(F.col("test_code") == virology.PANEL_TEST, S.clean_quantity("quantity"))
    return rows.select("test_id", result.otherwise(F.col("result_expansion")).alias("test_result"))


def significant_growth_flag(c: Catalog) -> DataFrame:
    return microbiology.organisms_found(c).select("test_id", "organism", "significant_growth")


def parse_reference_range(c: Catalog) -> DataFrame:
    lower, upper = S.parse_reference_range("Reference_Range")
    return c["HAEM_TESTS"].select(
        F.col("id").alias("test_id"),
        F.col("Reference_Range").alias("reference_range"),
        lower.alias("result_lower_range"),
        upper.alias("result_upper_range"),
    )


def unpivot_observations(c: Catalog) -> DataFrame:
    wide = c["ObsExport"]
    key = "`System Number > Patient ID`"
    long = reshape.unpivot_measures(
        wide,
        [key, "ObsId"],
        reshape.find_measures(wide.columns),
        "observation_code",
        "observation_result",
        "observation_unit",
    )
    return long.select(
        F.col(key).alias("uhl_system_number"),
        F.col("ObsId").alias("observation_id"),
        "observation_code",
        "observation_result",
        "observation_unit",
    )


# --- filters -----------------------------------------------------------------------------------


def _admissions(c: Catalog) -> DataFrame:
    return c["ADMISSIONS"].select(
        F.col("ID").alias("id"),
        F.col("ADMISSION_DATE_TIME").alias("admitted"),
        F.col("DISCHARGE_DATE_TIME").alias("discharged"),
    )


def study_start_strict(c: Catalog) -> DataFrame:
    return _admissions(c).filter(P.after("admitted", PARAMS.study_start)).drop("discharged")


def study_start_inclusive(c: Catalog) -> DataFrame:
    return _admissions(c).filter(P.from_start("admitted", PARAMS.study_start)).drop("discharged")


def half_open_interval(c: Catalog) -> DataFrame:
    return (
        c["CRIS_EVENTS_TBL"]
        .select(F.col("EVENT_KEY").alias("event_key"), F.col("Request_Date_Time").alias("requested"))
        .filter(P.from_start("requested", PARAMS.study_start) & P.until("requested", PARAMS.as_of))
    )


def in_list(c: Catalog) -> DataFrame:
    return (
        c["DIAGNOSES"]
        .filter(P.one_of("WHO_DIAGNOSIS_CODE", demographics.SMOKING_CODES))
        .select(
            F.col("CONSULTANT_EPISODES_ID").alias("ce_id"),
            F.col("DIAGNOSIS_NUMBER").alias("num"),
            F.col("WHO_DIAGNOSIS_CODE").alias("who_code"),
        )
    )


def or_like_outer(c: Catalog) -> DataFrame:
    direct, panel = P.one_of("test_code", virology.DIRECT_TESTS), P.one_of("test_code", [virology.PANEL_TEST])
    found = S.contains_text("organism", virology.ORGANISM_TEXT, PARAMS.ignore_case)
    return (
        _tests_with_organisms(c)
        .filter(direct | (panel & found))
        .select("test_id", "test_code", "organism")
    )


def flag_n_or_null(c: Catalog) -> DataFrame:
    return (
        c["HAEM_TESTS"]
        .filter(P.n_or_null("Result_Suppressed_Flag"))
        .select(F.col("id").alias("test_id"), F.col("Result_Suppressed_Flag").alias("suppressed"))
    )


def null_tolerant_cutoff(c: Catalog) -> DataFrame:
    return _admissions(c).filter(
        P.within_cutoff("admitted", PARAMS.cutoff) & P.within_cutoff("discharged", PARAMS.cutoff)
    )


def left_join_soft_delete(c: Catalog) -> DataFrame:
    rows = c["DIAGNOSES"].select(
        F.col("CONSULTANT_EPISODES_ID").alias("ce_id"),
        F.col("DIAGNOSIS_NUMBER").alias("num"),
        F.col("DIAGNOSIS_CODE").alias("code"),
    )
    return joins.left_lookup(
        rows, joins.current(c["MF_DIAGNOSIS"]), "code", "DIAGNOSIS_CODE", descr="DIAGNOSIS_DESCRIPTION"
    )


def inner_join_soft_delete(c: Catalog) -> DataFrame:
    rows = c["ADMISSIONS"].select(
        F.col("ID").alias("id"),
        F.col("METHOD_OF_ADMISSION_CODE").alias("method"),
        F.col("SOURCE_OF_ADMISSION_CODE").alias("source"),
    )
    methods, sources = (joins.current(c[f"MF_{t}_OF_ADMISSION"]) for t in ("METHOD", "SOURCE"))
    rows = joins.inner_lookup(rows, methods, "method", "CODE", admission_method="NC_ADMISSION_METHOD")
    rows = joins.inner_lookup(rows, sources, "source", "CODE", admission_source="NC_SOURCE_OF_ADMISSION")
    return rows.select("id", "admission_method", "admission_source")


def _postcodes(c: Catalog) -> DataFrame:
    return c["PATIENT"].select(F.col("ID").alias("id"), F.col("Post_Code").alias("postcode"))


def postcode_filter(c: Catalog) -> DataFrame:
    return _postcodes(c).filter(S.has_short_outcode("postcode"))


# --- joins -------------------------------------------------------------------------------------


def inner_join_chain(c: Catalog) -> DataFrame:
    rows = c["CRIS_EXAMS_TBL"].select(
        F.col("EVENT_KEY").alias("event_key"),
        F.col("EXAM_KEY").alias("exam_key"),
        F.col("EXAMINATION").alias("examination"),
    )
    rows = joins.inner_lookup(
        rows, c["CRIS_ORDERS_TBL"], "exam_key", "EXAM_KEY", order_id="ORDER_ID", paslink="PASLINK_KEY"
    )
    rows = joins.inner_lookup(rows, c["CRIS_EVENTS_TBL"], "event_key", "EVENT_KEY", requested="Request_Date_Time")
    rows = joins.inner_lookup(rows, c["CRIS_HIS_TBL"], "paslink", "PASLINK_KEY", his_id="HIS_ID")
    rows = joins.inner_lookup(rows, c["CRIS_EXAMCD_TBL"], "examination", "CODE", order_description="NAME")
    return rows.select("order_id", "order_description", "requested", "his_id")


def left_join_dim(c: Catalog) -> DataFrame:
    rows = c["PATIENT"].select(
        F.col("ID").alias("id"), F.col("ETHNIC_ORIGIN_CODE").alias("ethnic"), F.col("Post_Code").alias("pc")
    )
    rows = joins.left_lookup(rows, c["MF_ETHNIC_ORIGIN"], "ethnic", "code", ethnicity_desc="ethnic_origin")
    rows = joins.left_lookup(
        rows, c["MF_POSTCODE_REFERENCE_WHO"], "pc", "UNIT_POSTCODE", imd_decile="IMD_DECILE"
    )
    return rows.drop("pc")


def left_join_derived(c: Catalog) -> DataFrame:
    tests = c["MICRO_TESTS"].select(
        F.col("Micro_Tests").alias("test_id"), F.col("Result_Expansion").alias("result_expansion")
    )
    return tests.join(microbiology.organisms_found(c), "test_id", "left").select(
        "test_id", "organism", F.coalesce("quantity", "result_expansion").alias("sensitivity")
    )


def cohort_semi_join(c: Catalog) -> DataFrame:
    people = c["PATIENT"].select(F.col("ID").alias("id"), F.col("SYSTEM_NUMBER").alias("system_number"))
    return joins.in_cohort(people, "system_number", c["all_suspected_covid"])


def eligibility_semi_join(c: Catalog) -> DataFrame:
    rows = extract("transfers", c).select("uhl_system_number", "spell_identifier", "ward_start_date_time")
    return joins.semi_on_key(rows, "uhl_system_number", _eligible(c), "eligible_key")


def normalised_key_semi_join(c: Catalog) -> DataFrame:
    rows = c["tciMedication"].select(
        F.col("id"), normalise_id("WHO_PRESCRIBED_WARDSTAY_ID").alias("icu_encounter_identifier")
    )
    periods = c["WHO_INQUIRE_CRITICAL_CARE_PERIODS"].select(F.col("ID").alias("period"))
    return rows.join(periods, F.col("icu_encounter_identifier") == F.col("period"), "left_semi")


def anti_join_missing(c: Catalog) -> DataFrame:
    people = extract("demographics", c).select("uhl_system_number")
    return joins.missing_on_key(people, "uhl_system_number", c["participant"], "uhl_system_number")


def fanout_left_join(c: Catalog) -> DataFrame:
    rows = c["TRANSFERS"].select(
        F.col("ID").alias("id"),
        F.col("TRANSFER_DATE_TIME").alias("started"),
        F.col("TO_HOSPITAL_CODE").alias("hospital"),
    )
    return joins.left_lookup(rows, joins.current(c["MF_HOSPITAL"]), "hospital", "CODE").drop("hospital")


def bridge_fanout(c: Catalog) -> DataFrame:
    medication = c["tciMedication"].select(
        "id", F.col("medicationName").alias("medication_name"), F.col("udmProductID").alias("product_id")
    )
    return medication.join(_medication.product_classes(c), "product_id").drop("product_id")


# --- aggregates and windows --------------------------------------------------------------------


def group_min_age(c: Catalog) -> DataFrame:
    patients = c["PATIENT"].select(
        match_key("SYSTEM_NUMBER").alias("match_key"), F.col("PATIENT_DATE_OF_BIRTH").alias("born")
    )
    people = demographics.first_added(c).join(patients, "match_key")
    return (
        people.groupBy("match_key", "born")
        .agg(F.min("uhl_system_number").alias("uhl_system_number"), F.min("dateadded").alias("dateadded"))
        .select("uhl_system_number", S.age_at("born", "dateadded").alias("age"))
    )


def string_agg_classes(c: Catalog) -> DataFrame:
    from wardloom.plans.extracts.administration import classes_by_product

    return classes_by_product(c).select(
        "product_id", F.array_join(F.array_sort("classes"), ", ").alias("therapeutical_class")
    )


def distinct_rows(c: Catalog) -> DataFrame:
    return (
        c["DIAGNOSES"]
        .select(
            F.col("CONSULTANT_EPISODES_ID").alias("ce_id"),
            F.col("DIAGNOSIS_NUMBER").alias("num"),
            F.col("WHO_DIAGNOSIS_CODE").alias("who_code"),
            F.col("DIAGNOSIS_DATE").alias("dated"),
        )
        .distinct()
    )


def row_number_episode(c: Catalog) -> DataFrame:
    rows = c["CONSULTANT_EPISODES"].select(
        F.col("ADMISSIONS_ID").alias("spell_identifier"),
        F.col("ID").alias("episode_identifier"),
        F.col("CONS_EPISODE_START_DATE_TIME").alias("started"),
    )
    return timeline.sequence_in_group(
        rows, ["spell_identifier"], ["started", "episode_identifier"], "order_no_of_episode"
    ).drop("started")


def last_value_recent(c: Catalog) -> DataFrame:
    return demographics.smoking_status(c, PARAMS)


# --- scalars -----------------------------------------------------------------------------------


def hhmm_timestamp(c: Catalog) -> DataFrame:
    return c["F_PAT_PRESENT"].select(
        "visitid",
        S.hhmm_to_timestamp("ARRIVAL_DATE", "ARRIVAL_TIME").alias("arrival_date_time"),
        S.hhmm_to_timestamp("DISCHARGE_DATE", "DISCHARGE_TIME").alias("departure_date_time"),
    )


def outcode_live(c: Catalog) -> DataFrame:
    return _postcodes(c).select("id", S.outcode_live("postcode").alias("postcode"))


def outcode_legacy(c: Catalog) -> DataFrame:
    return _postcodes(c).select("id", S.outcode_legacy("postcode").alias("postcode_outcode"))


# --- checks ------------------------------------------------------------------------------------


def dq_duplicate_keys(c: Catalog) -> DataFrame:
    rows = c["DIAGNOSES"].select(
        F.col("CONSULTANT_EPISODES_ID").alias("ce_id"), F.col("DIAGNOSIS_NUMBER").alias("num")
    )
    return quality.duplicate_keys(rows, "ce_id", "num")


def dq_null_keys(c: Catalog) -> DataFrame:
    return quality.null_keys(c["all_suspected_covid"], "UHL_System_Number", "dateadded")


def dq_max_length(c: Catalog) -> DataFrame:
    limits = {"Request_Patient_Details": 50, "Hospital_Number": 40}
    return quality.over_length(c["REQUEST_PATIENT_DETAILS"], limits)


# --- sources and sinks -------------------------------------------------------------------------


def register_participants(c: Catalog) -> DataFrame:
    return registry.register_participants(extract("demographics", c), c["participant"], PARAMS)


def _written_code_list(c: Catalog) -> DataFrame:
    """The code list written as CSV files in line order, and read back."""
    lines = c["risk_factor_codes"]
    spark = lines.sparkSession
    folder = shared_folder(spark, "scratch")
    in_order = lines.repartitionByRange("line_no").sortWithinPartitions("line_no")
    in_order.select("ICD10", "Risk_Factor").write.option("header", True).csv(folder)
    return read_code_list(spark, folder)


def csv_lookup(c: Catalog) -> DataFrame:
    return _written_code_list(c).select(
        F.col("ICD10").alias("icd10"), F.col("Risk_Factor").alias("factor"), "line_no"
    )


def lookup_concat(c: Catalog) -> DataFrame:
    return concat_by_code(_written_code_list(c)).select("icd10", "description")


def replace_table(c: Catalog) -> DataFrame:
    rows = extract("transfers", c)
    store = TargetStore(rows.sparkSession, shared_folder(rows.sparkSession, "scratch"))
    store.replace("transfer", rows.limit(0))
    store.replace("transfer", rows)
    return store.read("transfer")


def export_csv_rows(c: Catalog) -> DataFrame:
    rows = export("observations", c)
    spark = rows.sparkSession
    folder = shared_folder(spark, "scratch")
    write_delimited(rows, folder)
    return read_export(spark, folder)


WAREHOUSE_QUERIES: dict[str, Callable[[Catalog], DataFrame]] = {
    f.__name__: f
    for f in (
        project_rename,
        null_placeholders,
        recode_simple_case,
        case_cleaned_result,
        significant_growth_flag,
        parse_reference_range,
        unpivot_observations,
        study_start_strict,
        study_start_inclusive,
        half_open_interval,
        in_list,
        or_like_outer,
        flag_n_or_null,
        null_tolerant_cutoff,
        left_join_soft_delete,
        inner_join_soft_delete,
        postcode_filter,
        inner_join_chain,
        left_join_dim,
        left_join_derived,
        cohort_semi_join,
        eligibility_semi_join,
        normalised_key_semi_join,
        anti_join_missing,
        fanout_left_join,
        bridge_fanout,
        group_min_age,
        string_agg_classes,
        distinct_rows,
        row_number_episode,
        last_value_recent,
        hhmm_timestamp,
        outcode_live,
        outcode_legacy,
        dq_duplicate_keys,
        dq_null_keys,
        dq_max_length,
        register_participants,
        csv_lookup,
        lookup_concat,
        replace_table,
        export_csv_rows,
    )
}
WAREHOUSE_QUERIES["cohort_join_distinct"] = bloods.cohort_requesters
WAREHOUSE_QUERIES["left_then_inner"] = _medication.product_classes


def movement_next_event(c: Catalog) -> DataFrame:
    rows = c["transfer"].select("spell_id", "transfer_datetime")
    return timeline.next_event_times(rows, ["spell_id"], "transfer_datetime", "next_datetime")


def _on_warehouse(build: Callable[[Catalog], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(clinic.warehouse(configure(spark), sf_dir))


def _on_legacy(build: Callable[[Catalog], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(clinic.legacy(configure(spark), sf_dir))


def _job(kind: Callable[[str, Catalog], DataFrame], job: str) -> Query:
    return _on_warehouse(lambda c: kind(job, c))


def _view(name: str) -> Query:
    return _on_legacy(lambda c: VIEWS[name](c, PARAMS))


def all_queries() -> dict[str, Query]:
    return {
        **{name: _on_warehouse(build) for name, build in WAREHOUSE_QUERIES.items()},
        "movement_next_event": _on_legacy(movement_next_event),
        **{f"extract_{job}": _job(extract, job) for job in JOBS},
        **{f"export_{job}": _job(export, job) for job in JOBS},
        **{f"view_{name.removesuffix('_export')}": _view(name) for name in VIEWS},
    }
