"""The pseudonym registry: one stable identifier per patient key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardloom.functions.keys import match_key
from wardloom.operators.joins import missing_on_key
from wardloom.operators.quality import QualityError, require_unique, require_unique_patients
from wardloom.params import Params

KEY = "uhl_system_number"
IDENTIFIER = "participant_identifier"
SCHEMA = f"{IDENTIFIER} string, {KEY} string"


def new_participants(people: DataFrame, registry: DataFrame, params: Params) -> DataFrame:
    """Identifiers for the people who have none yet.

    The identifier is the start of a salted digest of the key, so a run that is
    repeated after a failure gives the same ones; where that start is taken, by
    the registry or another new key, it is the whole digest.  The salt must be
    kept secret and must not change during a study.
    """
    if not params.salt:
        raise ValueError("a salt is needed to allocate identifiers")
    missing = missing_on_key(people.select(KEY), KEY, registry, KEY)
    people = missing.groupBy(match_key(KEY).alias("_key")).agg(F.min(KEY).alias(KEY))
    digest = F.sha2(F.concat(F.lit(params.salt), F.col("_key")), 256)
    short = F.concat(F.lit(params.id_prefix), F.substring(digest, 1, params.id_digits))
    named = people.select(KEY, short.alias("_short"), F.concat(F.lit(params.id_prefix), digest).alias("_whole"))
    shared = named.groupBy("_short").agg(F.count(F.lit(1)).alias("_keys")).filter("_keys > 1")
    known = registry.select(F.col(IDENTIFIER).alias("_taken"))
    taken = known.unionByName(shared.select(F.col("_short").alias("_taken"))).distinct()
    identifier = F.when(F.col("_taken").isNull(), F.col("_short")).otherwise(F.col("_whole"))
    return named.join(taken, F.col("_short") == F.col("_taken"), "left").select(identifier.alias(IDENTIFIER), KEY)


def register_participants(people: DataFrame, registry: DataFrame, params: Params) -> DataFrame:
    """The registry with the new people added."""
    return registry.select(IDENTIFIER, KEY).unionByName(new_participants(people, registry, params))


def check_registry(registry: DataFrame) -> None:
    """Raise unless identifiers and keys are both unique."""
    require_unique(registry, IDENTIFIER, table="participant")
    require_unique_patients(registry, KEY, table="participant")


def check_new(new: DataFrame, known: DataFrame) -> None:
    """Raise unless the registry stays unique when ``new`` is added to it.

    What was added before has been checked then: only the new rows are grouped,
    and the known ones are looked up by the new identifiers and keys, which a
    runtime filter or a broadcast of the few new rows reduces as they are read.
    """
    check_registry(new)
    for column, form in ((IDENTIFIER, F.col), (KEY, match_key)):
        added = new.select(form(column).alias("_added"))
        if known.join(added, form(column) == F.col("_added"), "left_semi").head(1):
            raise QualityError(f"participant: {column} is not unique")
