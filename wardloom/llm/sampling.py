"""Bounded samples of rows to fit models on."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardloom.llm.common import remainder


def sample_keys(rows: DataFrame, key: str, label: str | None, divisor: int, held_out: int, most: int) -> dict:
    """Keys of at most ``most`` rows of each label, the first by a hash of the key, with their labels.

    Rows whose key has the crc32 remainder ``held_out``, and rows without key or label, are not among them. A bound on
    the hash, from the number of rows of each label, leaves a few more than ``most`` of each, whatever the size of the
    table; only these are put in order. Labels are as many as a model has rows for on the driver.
    """
    value = F.col(label) if label else F.lit(1)
    usable = rows.select(F.col(key).alias("key"), value.alias("label"), F.xxhash64(F.col(key)).alias("hash")).filter(
        (remainder(F.col("key"), divisor) != held_out) & F.col("label").isNotNull()
    )
    # six standard deviations more than wanted, as a share of all hashes
    enough = most + 6 * math.sqrt(most) + 50
    share = F.least(F.lit(1.0), F.lit(enough) / F.count("*"))
    bounds = usable.groupBy("label").agg((share * F.lit(2.0**64) - F.lit(2.0**63)).alias("bound"))
    near = usable.join(F.broadcast(bounds.withColumnRenamed("label", "of")), F.col("label") == F.col("of"))
    near = near.filter(F.col("hash").cast("double") <= F.col("bound")).select("label", "hash", "key").distinct()
    order = Window.partitionBy("label").orderBy("hash", "key")
    chosen = near.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most)
    return {r["key"]: r["label"] for r in chosen.collect()}


def among(rows: DataFrame, key: str, chosen: Iterable) -> DataFrame:
    """The rows whose key is one of ``chosen``, which the plan holds as a table, not as one expression each."""
    kind = rows.schema[key].dataType.simpleString()
    keys = rows.sparkSession.createDataFrame([(k,) for k in chosen], f"chosen {kind}")
    return rows.join(F.broadcast(keys), F.col(key) == F.col("chosen"), "left_semi")


def held_out(key: Column, divisor: int, value: int) -> Column:
    """Whether a key's crc32 has that remainder; a null key is not held out."""
    return F.coalesce(remainder(key, divisor) == value, F.lit(False))
