"""Refresh all target tables, export all files."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardloom.functions.keys import match_key
from wardloom.operators.quality import require_target, require_unique, require_unique_patients
from wardloom.params import Params
from wardloom.plans import registry as registry_plan
from wardloom.plans.contracts import KEY, REQUIRED, UNIQUE_KEY, require_contract, text_limits
from wardloom.plans.exports import EXPORTS, eligible_patients, exported_patients, rows_of_patients
from wardloom.plans.extracts import EXTRACTS, bloods
from wardloom.plans.spells import SPELL_EPISODES, SPELLS, spell_episodes, spells
from wardloom.sinks.delimited import write_delimited
from wardloom.sinks.targets import PATIENT, ConflictError, TargetStore
from wardloom.sources.catalog import Catalog
from wardloom.sources.lookup import check_code_list, concat_by_code

REGISTRY = "participant"
PARTICIPANTS = "staged_participants"
ELIGIBLE = "staged_eligible"
STAGED = (SPELLS, SPELL_EPISODES, bloods.PATIENT_RESULTS, PARTICIPANTS, ELIGIBLE)

#: targets that start from the cohort's spells or episodes
FROM_SPELLS = {
    "demographics",
    "transfer",
    "procedures",
    "diagnosis",
    "episodes",
    "icu_procedures",
    "riskfactors",
}

#: order of the rows in the files of a target
ORDER = {
    "episodes": (KEY, "spell_identifier", "order_no_of_episode"),
    "transfer": (KEY, "ward_start_date_time"),
}


def check_target(table: str):
    """The checks a target table has to pass before it is published."""

    exported = {c for e in EXPORTS.values() if e.target == table for c in e.columns}

    def check(rows: DataFrame) -> None:
        columns = [c for c in rows.columns if c in exported]
        require_target(rows, KEY, text_limits(table), columns, table, REQUIRED.get(table, ()))
        if table in UNIQUE_KEY:
            require_unique_patients(rows, KEY, table)

    return check


def refresh(table: str, catalog: Catalog, store: TargetStore, params: Params) -> DataFrame:
    """Replace one target table."""
    if table == "blood_test":
        catalog = with_patient_results(catalog, store, params)
    if table == "riskfactors":
        check_code_list(concat_by_code(catalog["risk_factor_codes"]))
    rows = EXTRACTS[table](catalog, params)
    require_contract(rows, table)
    published = store.replace(table, rows, check_target(table), ORDER.get(table, ()), match_key(KEY))
    if table == "demographics":
        update_registry(published, store, params)
    return published


def update_registry(people: DataFrame, store: TargetStore, params: Params, tries: int = 10) -> None:
    """Give new patients an identifier; existing ones keep theirs.

    If another run has added to the registry since this one has read it, the new
    identifiers are made once more, for those who still have none.
    """
    for left in reversed(range(tries)):
        version = store.version(REGISTRY)
        known = store.read_appended(REGISTRY, registry_plan.SCHEMA, version)
        new = store.replace(PARTICIPANTS, registry_plan.new_participants(people, known, params))
        if not new.head(1):
            return
        registry_plan.check_new(new, known)
        try:
            store.append(REGISTRY, new, version)
            return
        except ConflictError:
            if not left:
                raise


def with_patient_results(catalog: Catalog, store: TargetStore, params: Params) -> Catalog:
    """Write the cohort's blood results once, and check what was written."""
    require_unique(bloods.cohort_requesters(catalog), "requester", table="blood test patients")
    results = store.replace(
        bloods.PATIENT_RESULTS,
        bloods.patient_results(catalog, params),
        lambda rows: require_unique(rows, "result_id", table="blood test patient results"),
    )
    return catalog.with_tables(**{bloods.PATIENT_RESULTS: results})


def with_shared_spells(catalog: Catalog, store: TargetStore, params: Params) -> Catalog:
    """Write the cohort's spells and episodes once for the jobs that start from them."""
    staged = catalog.with_tables(**{SPELLS: store.replace(SPELLS, spells(catalog, params))})
    episodes = store.replace(SPELL_EPISODES, spell_episodes(staged, params))
    return staged.with_tables(**{SPELL_EPISODES: episodes})


def refresh_all(
    catalog: Catalog,
    store: TargetStore,
    params: Params,
    tables: Sequence[str] | None = None,
    at_once: int = 1,
) -> None:
    """Replace the given target tables, demographics (with the registry) first.

    The others do not depend on each other; ``at_once`` of them run side by side.
    """
    tables = list(EXTRACTS) if tables is None else [t for t in EXTRACTS if t in set(tables)]
    if len(FROM_SPELLS.intersection(tables)) > 1:
        catalog = with_shared_spells(catalog, store, params)
    if "demographics" in tables:
        refresh("demographics", catalog, store, params)
        tables.remove("demographics")
    _each(lambda table: refresh(table, catalog, store, params), tables, at_once)


def export_all(
    store: TargetStore,
    folder: str,
    params: Params,
    names: Sequence[str] | None = None,
    single_file: bool = False,
    at_once: int = 1,
) -> None:
    """Write the given exports as ``<folder>/<name>.csv``.

    Who is exported is worked out once and laid out by patient as the targets
    are, so that their rows are not shuffled.
    """
    known = store.read_appended(REGISTRY, registry_plan.SCHEMA)
    people = exported_patients(known, eligible_patients(store.read("episodes"), params))
    store.replace(ELIGIBLE, people, patient=F.col("_key"))

    def write(name: str) -> None:
        write_delimited(exported(name, store, params), f"{folder}/{name}.csv", single_file)

    _each(write, EXPORTS if names is None else names, at_once)


def exported(name: str, store: TargetStore, params: Params) -> DataFrame:
    """The rows of one export, from the store; who is exported has been worked out."""
    export, key = EXPORTS[name], F.col(PATIENT)
    target, people = store.read_by_patient(export.target), store.read_by_patient(ELIGIBLE)
    return rows_of_patients(export, target, key, people, key, params)


def _each(job: Callable[[str], object], names: Iterable[str], at_once: int) -> None:
    """Run a job per name; the first failure is raised."""
    with ThreadPoolExecutor(at_once) as pool:
        for _ in pool.map(job, names):
            pass
