"""Documents in the order of their ids, each with the text of the document after it."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardloom.llm.common import batches

#: Most ranges that ids are cut into. Ranges are read as streams, so that they may be of any size.
MOST_RANGES = 10_000
RANGE_BYTES = 32 << 20

Texts = list[str]


def map_with_next(docs: DataFrame, key: str, text: str, make: Callable[[pa.Array, Texts, str], list[pa.Array]], kinds: str) -> DataFrame:
    """The columns that ``make`` gives for the documents, in descending order of an integer key.

    ``make`` gets keys, whole texts (null: empty) and the text after the last of them; the document after the last of all
    is the first. Documents with equal keys follow in the order of their texts; null keys come last. Ids are cut into
    ranges at percentiles, each document goes to the task of its range, and the first of each range to the task before,
    too: texts are shuffled once, and no task holds more than one batch.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0
    shuffles = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(MOST_RANGES, max(shuffles, -(-size // RANGE_BYTES)))
    steps = F.array(*(F.lit((k + 1) / ranges) for k in range(ranges)))
    heads = rows.agg(F.percentile_approx("key", steps, 10 * ranges).alias("heads")).first()["heads"] or []
    heads = sorted(set(heads) | ({rows.agg(F.max("key")).first()[0]} if heads else set()), reverse=True)
    # a range reaches from its head, an id that is there, down to the next one; nulls belong to the last
    known = F.array(*map(F.lit, heads)).cast("array<long>")
    count = max(1, len(heads))
    own = F.when(F.col("key").isNull(), F.lit(count)).otherwise(F.size(F.filter(known, lambda h: h >= F.col("key")))) - 1
    ranged = rows.withColumn("range", own.cast("int"))
    is_head = F.array_contains(known, F.col("key"))
    if heads:
        before = F.pmod(F.col("range") - 1, F.lit(count))
        places = F.when(is_head, F.array(_place(F.col("range"), 0), _place(before, 1))).otherwise(F.array(_place(F.col("range"), 0)))
    else:  # no key at all: one range, which is followed by itself
        places = F.array(_place(F.lit(0), 0), _place(F.lit(0), 1))
    dealt = ranged.select("key", "text", F.explode(places).alias("place")).select("key", "text", "place.range", "place.following")
    sorted_rows = dealt.repartitionById(count, "range").sortWithinPartitions("following", F.desc_nulls_last("key"), "text")

    def run(read: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[pa.Array, Texts] | None = None
        for batch in batches(read):
            keys, texts, following = batch.column("key"), batch.column("text").to_pylist(), batch.column("following").to_pylist()
            mine = following.index(1) if 1 in following else len(following)
            if mine:
                if held:
                    yield _batch(held[0], make(*held, texts[0]))
                held = keys.slice(0, mine), texts[:mine]
            if mine < len(following):
                if held:
                    yield _batch(held[0], make(*held, texts[mine]))
                return

    return sorted_rows.mapInArrow(run, f"key long, {kinds}").withColumnRenamed("key", key)


def _place(at, following: int):
    return F.struct(at.cast("int").alias("range"), F.lit(following).alias("following"))


def _batch(keys: pa.Array, columns: list[pa.Array]) -> pa.RecordBatch:
    return pa.record_batch([keys, *columns], names=[str(k) for k in range(len(columns) + 1)])
