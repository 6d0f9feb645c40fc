"""Exact dedup by an extendible-hash index on shared files.

Pass one hashes every text and writes the entries of the index, a key and what is known of its rows, to the shared folder.
The directory of the index has one entry for each prefix of the keys: it is doubled, and buckets that hold more than
their capacity are split by one more bit, until none does. Pass two sends the texts of keys that several rows share to
the owners of their buckets. An owner reads a range of keys in order and chains the texts of each key, comparing
bytes, so that texts of one key that differ are entries of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardloom.llm.common import batches, join_by_weight, likely, settle

#: Keys of a bucket; buckets that the directory starts with at most (beyond, buckets hold more keys); doublings after that.
CAPACITY, BUCKETS, DOUBLINGS = 1 << 9, 1 << 14, 6
#: Bytes of texts that a task holds to combine equal ones before they are shuffled.
HELD = 32 << 20


def directory(keys: DataFrame, capacity: int = CAPACITY, buckets: int = BUCKETS, doublings: int = DOUBLINGS) -> np.ndarray:
    """The bucket, a number in the order of keys, of each prefix of the keys; the length is a power of two.

    ``keys`` has one row per ``key`` (long). The first depth gives buckets about half full. Each doubling splits the
    buckets that are still overfull; those of the last depth stay as they are, as owners read keys as a stream. At most
    ``buckets`` * 2 ** ``doublings`` entries, 4 MB, whatever the number of keys.
    """
    count = keys.count()
    first = min(max(0, (2 * count // capacity).bit_length() - 1), buckets.bit_length() - 1)
    capacity = max(capacity, 2 * count >> first)
    last = first + doublings
    cells = keys.groupBy(_prefix(F.col("key"), last).alias("cell")).agg(F.count("*").alias("n"))
    depth = F.lit(last)
    for d in reversed(range(first, last)):
        load = F.sum("n").over(Window.partitionBy(F.shiftright("cell", last - d)))
        depth = F.when(load <= capacity, d).otherwise(depth)
    found = cells.select("cell", depth.alias("depth")).toArrow()
    depths = np.full(1 << last, first, np.int64)
    depths[found.column("cell").to_numpy()] = found.column("depth").to_numpy()
    # an empty cell belongs to the bucket around it
    place = np.arange(1 << last)
    for d in range(first + 1, last + 1):
        deep = np.unique(place[depths >= d] >> (last - d + 1))
        inside = np.isin(place >> (last - d + 1), deep)
        depths[inside] = np.maximum(depths[inside], d)
    heads = (place >> (last - depths)) << (last - depths)
    return np.unique(heads, return_inverse=True)[1].astype(np.int32)


def _prefix(key: Column, bits: int) -> Column:
    """The first bits of a key, in the order of keys: the sign bit is turned."""
    if bits == 0:
        return F.lit(0).cast("long")
    return F.shiftrightunsigned(key.bitwiseXOR(F.lit(-(1 << 63))), 64 - bits)


def _combined(places: np.ndarray, most: int):
    """Equal texts of what a task reads, once, as far as ``most`` bytes reach, with the bucket of their key."""
    bits = len(places).bit_length() - 1

    def run(read: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, bytes]] = set()
        held = 0

        def said() -> pa.RecordBatch:
            keys = np.array([k for k, _ in seen], np.int64)
            prefix = (keys.view(np.uint64) ^ np.uint64(1 << 63)) >> np.uint64(64 - bits) if bits else np.zeros(len(keys), np.uint64)
            columns = [pa.array(places[prefix.astype(np.int64)]), pa.array(keys), pa.array([t for _, t in seen], pa.binary())]
            return pa.record_batch(columns, names=["bucket", "key", "text"])

        for batch in batches(read):
            for row in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if row not in seen:
                    seen.add(row)
                    held += len(row[1]) + 100
                    if held > most:
                        yield said()
                        seen.clear()
                        held = 0
        if seen:
            yield said()

    return run


def _chained(read: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, digest and chain (number of different texts of the key) of every text; rows come in the order of keys."""
    key, chain = None, []

    def said() -> pa.RecordBatch:
        digests = [hashlib.sha256(t).hexdigest() for t in chain]
        if len(set(digests)) < len(chain):
            raise ValueError("different texts with the same SHA-256")
        return pa.record_batch([pa.array([key] * len(chain), pa.int64()), pa.array(digests), pa.array([len(chain)] * len(chain), pa.int64())], names=["key", "digest", "chain"])

    for batch in batches(read):
        for k, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
            if k != key:
                if chain:
                    yield said()
                key, chain = k, [text]
            elif not any(len(text) == len(t) and text == t for t in chain):
                chain.append(text)
    if chain:
        yield said()


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", bits: int = 64, capacity: int = CAPACITY) -> DataFrame:
    """key, keep_id, group_size, kept and text_sha256 of every row.

    Texts are equal when their bytes are; null counts as empty, so null and empty texts are one group. ``keep_id`` is the
    largest key of the group (null only if no row of it has one), ``group_size`` its rows, repeated rows included.
    Exactly one row of each group is kept: of several with the largest key, any. Texts may be of any length; a task holds one text of each chain of colliding keys. An empty table gives an empty one. Other
    columns, whatever their names, are not read. ``bits`` cuts the hash, for tests of collisions; ``capacity`` is that
    of a bucket, in keys.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    # an arithmetic shift and back: the first bits of the hash
    hashed = F.shiftleft(F.shiftright(F.xxhash64(body), 64 - bits), 64 - bits) if bits < 64 else F.xxhash64(body)
    plain = docs.select(F.col(key).alias("id"), hashed.alias("hash"), body.alias("body"))
    rows = settle(plain.select("id", "hash", F.sha2(F.col("body").cast("binary"), 256).alias("sha"), F.monotonically_increasing_id().alias("row")))
    total = rows.count()
    # the largest id and a row that has it; without any id, some row
    best = (F.count("*").alias("n"), F.max("id").alias("top"), F.coalesce(F.max_by("row", "id"), F.min("row")).alias("stays"))
    entries = settle(rows.groupBy(F.col("hash").alias("key")).agg(*best).filter("n > 1"))

    places = directory(entries.select("key"), capacity)
    shared = plain.select(F.col("hash").alias("key"), F.col("body").cast("binary").alias("text")).filter(likely(entries.select("key"), "key"))
    dealt = shared.mapInArrow(_combined(places, HELD), "bucket int, key long, text binary").repartition("bucket").sortWithinPartitions("key")
    chains = settle(dealt.mapInArrow(_chained, "key long, digest string, chain long"))

    # a key with one text names it; where texts collide, their digests tell rows apart
    groups = entries.join(chains.filter("chain = 1").select("key"), "key").withColumn("digest", F.lit(None).cast("string"))
    told = chains.filter("chain > 1").select("key", "digest")
    if not told.isEmpty():
        several = entries.select("key", F.col("n").alias("weight")).join(told, "key")
        apart = join_by_weight(rows, several, (F.col("hash") == F.col("key")) & (F.col("sha") == F.col("digest")), "weight", total)
        groups = groups.unionByName(apart.filter("digest IS NOT NULL").groupBy("key", "digest").agg(*best))
    groups = settle(groups)
    on = (F.col("hash") == F.col("key")) & (F.col("digest").isNull() | (F.col("digest") == F.col("sha")))
    found = join_by_weight(rows, groups, on, "n", total)
    alone = F.col("n").isNull()
    return found.select(
        F.col("id").alias(key),
        F.when(alone, F.col("id")).otherwise(F.col("top")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("stays"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
