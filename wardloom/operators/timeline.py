"""Latest value, sequence number and next event within a group.

Rows are dealt once, by group and slice of time, so a group of any size is spread over many tasks.  What a slice needs
to know of the others, the number of rows before it or the first event after it, is aggregated per slice from the same
dealt rows and handed back as one small row.  Both uses read all columns, so Spark runs their shuffle, and the plan
below it, once.  Rows that meet the values of their next events are dealt by group and time; only the different values
go to slices.  Everything is one lazy plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

#: length of a slice; a century has under a million, as many small rows as one task reads for a group
SLICE = "HOUR"


def latest_per_key(rows: DataFrame, key: Column, value: str, order: Sequence[str], name: str) -> DataFrame:
    """The value of the last row per key, NULL order values coming first.

    An aggregate, so rows of one key are combined before they are shuffled.
    """
    return rows.groupBy(key).agg(F.max_by(value, F.struct(*order)).alias(name))


def _dealt(rows: DataFrame, group: Sequence[Column | str], time: str, every: str) -> DataFrame:
    """With ``_at``, the group and the slice, by which rows are dealt; both may be NULL, as parts of a key that is not."""
    at = F.struct(F.struct(*group).alias("whole"), F.date_trunc(every, time).alias("slice"))
    return rows.withColumn("_at", at).repartition("_at")


def _per_slice(dealt: DataFrame, *values: Column) -> DataFrame:
    """Aggregates per slice, made from the shuffle that ``dealt`` is: they refer to all of its columns."""
    kept = [c for c in dealt.columns if c != "_at"]
    return dealt.groupBy("_at").agg(*values, F.max(F.hash(*kept)).alias("_seen")).filter("_seen IS NOT NULL").drop("_seen")


def sequence_in_group(
    rows: DataFrame, group: Sequence[str], order: Sequence[str], name: str, every: str = SLICE
) -> DataFrame:
    """Number the rows of each group from 1.

    ``order`` starts with a timestamp, whose NULLs come first, and should end in a unique column.  Rows of a group that
    fall into one slice, or have no time, are sorted by one task.
    """
    dealt = _dealt(rows, group, order[0], every)
    sizes = _per_slice(dealt, F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy("_at.whole").orderBy("_at.slice").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_at", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_at").orderBy(*order))
    numbered = dealt.withColumn("_place", place).join(before, "_at")
    return numbered.select(*rows.columns, (F.col("_before") + F.col("_place")).alias(name))


def next_event_times(rows: DataFrame, group: Sequence[str], time: str, name: str, every: str = SLICE) -> DataFrame:
    """Each distinct time of a group with the next later one; the last time is left out."""
    times = rows.select(*group, time).filter(F.col(time).isNotNull()).distinct()
    dealt = _dealt(times, group, time, every)
    firsts = _per_slice(dealt, F.min(time).alias("_first"))
    following = F.lead("_first").over(Window.partitionBy("_at.whole").orderBy("_at.slice"))
    after = firsts.select("_at", following.alias("_after"))
    within = F.lead(time).over(Window.partitionBy("_at").orderBy(time))
    found = dealt.withColumn("_within", within).join(after, "_at")
    return found.select(*times.columns, F.coalesce("_within", "_after").alias(name)).filter(F.col(name).isNotNull())


def with_next_events(
    rows: DataFrame,
    group: Sequence[Column | str],
    time: str,
    value: str,
    next_time: str,
    next_value: str,
    every: str = SLICE,
) -> DataFrame:
    """Each row once for every row at the next later time of its group, with that time and that row's ``value``.

    Rows without a time, and those at the last time of their group, are left out.  Rows are dealt by group and time, once.
    Of the rows at one time only the different values travel, with their number: to their slice, whose earlier times they
    follow, and from there, where they are a slice's first, to the first ones of the group's other slices.
    """
    kept = rows.filter(F.col(time).isNotNull()).withColumn("_of", F.struct(*group))
    # a hash comes first in each key, as it decides nearly all comparisons
    dealt = kept.withColumn("_hash", F.xxhash64("_of", time)).repartition("_hash", "_of", time)
    values = dealt.groupBy("_hash", "_of", time, value).agg(F.count(F.lit(1)).alias("_n"), F.max(F.hash(*rows.columns)).alias("_seen"))
    values = values.filter("_seen IS NOT NULL").select(
        "_of", F.col(time).alias("_time"), F.col(value).alias("_value"), "_n", F.date_trunc(every, time).alias("_slice")
    )

    last = F.max("_time").over(_ordered("_slice").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    sliced = _with_hash(values, "_slice").withColumn("_last", last)
    within = _with_previous(sliced, "_time", "_slice", "_within")
    # values that have found their time stay with their slice, the others meet those of their group
    apart = within.withColumn("_own", F.when(F.col("_within").isNotNull(), F.col("_slice")))
    found = _with_previous(_with_hash(apart, "_own"), "_last", "_own", "_before")
    found = found.withColumn("_follows", F.coalesce("_within", "_before")).filter("_follows IS NOT NULL")
    upcoming = found.select(F.xxhash64("_of", "_follows").alias("_hash"), "_of", "_follows", "_time", "_value", "_n")

    same = (dealt["_hash"] == upcoming["_hash"]) & (dealt["_of"] == upcoming["_of"]) & (dealt[time] == upcoming["_follows"])
    each = dealt.join(upcoming, same).select(*rows.columns, F.col("_time").alias(next_time), "_value", "_n")
    again = F.explode(F.array_repeat("_value", F.col("_n").cast("int")))
    return each.select(*rows.columns, next_time, again.alias(next_value))


def _with_hash(events: DataFrame, part: str) -> DataFrame:
    return events.withColumn("_part", F.xxhash64("_of", part))


def _ordered(part: str) -> WindowSpec:
    return Window.partitionBy("_part", "_of", part).orderBy("_time")


def _with_previous(events: DataFrame, carried: str, part: str, name: str) -> DataFrame:
    """With ``carried`` of the next earlier time in the same part of a group; NULL at the first time."""
    order = _ordered(part)
    later = F.lag("_time").over(order) < F.col("_time")
    stepped = events.withColumn("_step", F.when(later, F.lag(carried).over(order)))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return stepped.withColumn(name, F.last("_step", ignorenulls=True).over(upto)).drop("_step")
