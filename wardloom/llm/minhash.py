"""Near-duplicate documents by circulant MinHash.

Two permutations of the 32-bit integers make the whole signature: the first scatters a document's shingles, the second
is applied to them after a circular shift by k and gives coordinate k, for every k. Signatures are cut into bands,
documents that share a band are candidates, and a link is confirmed on the whole shingle sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardloom.llm.common import batches, mix64, settle, shingle_hashes, utf8, word_hashes
from wardloom.llm.lsh import DEALT, bucket_numbers, dealt, parts_of, similar

#: Bands and rows: at a similarity of 0.8, one pair in 300,000 shares no band.
BANDS, ROWS = 32, 5
#: Coordinates; those beyond the bands only sharpen the comparison of sketches.
COORDINATES = 256
#: Bytes of texts that are hashed at once: what comes of them stays in the cache of a core.
SLICE = 1 << 19


def scatter(hashes: np.ndarray) -> np.ndarray:
    """The first permutation, on hashes cut to 32 bits."""
    return (mix64(hashes ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)).astype(np.uint32)


def permuted(x: np.ndarray, out: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """The second permutation: rounds of shifts and odd factors, each of them a bijection of 32-bit integers."""
    np.right_shift(x, 16, out=spare)
    np.bitwise_xor(x, spare, out=out)
    out *= np.uint32(0x7FEB352D)
    np.right_shift(out, 15, out=spare)
    out ^= spare
    out *= np.uint32(0x846CA68B)
    np.right_shift(out, 16, out=spare)
    out ^= spare
    return out


def signatures(hashes: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """One row of ``size`` coordinates for each set; each set holds at least one hash."""
    made = np.empty((len(first) - 1, size), np.uint32)
    x = scatter(hashes)
    out, spare, shifted = np.empty_like(x), np.empty_like(x), np.empty_like(x)
    for k in range(size):
        np.add(x, np.uint32(k), out=shifted)  # wraps around: the circular shift
        made[:, k] = np.minimum.reduceat(permuted(shifted, out, spare), first[:-1])
    return made


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    made = np.zeros((len(signature), bands), np.uint64)
    for r in range(rows):
        made = mix64(made + signature[:, r : bands * rows : rows].astype(np.uint64) + np.uint64(1))
    return made.view(np.int64)


def _sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    hashes, first = shingle_hashes(*word_hashes(*utf8(texts)), width)
    return [np.unique(hashes[a:b]) for a, b in zip(first, first[1:], strict=False)]


def _name(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def shingled(docs: DataFrame, key: str, text: str, width: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """key, n (shingles), id (of the set), bands (their buckets) and sketch of each row; without words: no id, bands and sketch."""

    def run(read: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(read, SLICE):
            hashes, first = shingle_hashes(*word_hashes(*utf8(batch.column("text"))), width)
            sets = [np.unique(hashes[a:b]) for a, b in zip(first, first[1:], strict=False)]
            sizes = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(sizes)
            made: list = [None] * len(sets)
            sketch: list = [None] * len(sets)
            if len(full):
                ends = np.concatenate([[0], np.cumsum(sizes[full])])
                signed = signatures(np.concatenate([sets[k] for k in full]), ends, COORDINATES)
                for k, h, c in zip(full, bucket_numbers(band_hashes(signed, bands, rows)), signed.astype(np.uint8), strict=True):
                    made[k], sketch[k] = h, c.tobytes()
            names = [_name(s) if len(s) else None for s in sets]
            yield pa.record_batch(
                [batch.column("key"), pa.array(sizes), pa.array(names, pa.binary()), pa.array(made, pa.list_(pa.int64())), pa.array(sketch, pa.binary())],
                names=["key", "n", "id", "bands", "sketch"],
            )

    rows_ = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows_.schema["key"].dataType.simpleString()
    return rows_.mapInArrow(run, f"key {kind}, n long, id binary, bands array<long>, sketch binary")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """key, n_shingles, component_id and set_id of every row.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case; a text of fewer than ``width`` words is one shingle. Null and
    empty texts, and those without words, are linked with nothing. Rows with equal sets form one class and are compared
    once. ``component_id`` is the smallest key that links lead to, nulls aside: a repeated key gets one component per
    set, and a row of a null key only a null one if no linked row has a key. Other columns are not read.
    """
    rows = settle(shingled(docs, key, text, width))
    classes = rows.filter("n > 0").groupBy("id").agg(F.min("key").alias("least"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    classes = settle(classes.withColumn("handle", F.xxhash64("id")))

    def named(read: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(read):
            sets = _sets(batch.column("text"), width)
            columns = [pa.array([_name(s) if len(s) else None for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())]
            yield pa.record_batch(columns, names=["id", "set"])

    def fetch(handles: DataFrame) -> DataFrame:
        wanted = classes.join(handles, "handle", "left_semi")
        texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
        found = texts.join(wanted.select("least").distinct(), F.col("key").eqNullSafe(F.col("least")), "left_semi")
        sets = found.select("text").mapInArrow(named, "id binary, set binary")
        # a key that comes with several texts finds sets that nobody asked for, and equal ones
        return sets.dropDuplicates(["id"]).join(wanted.drop("least"), "id")

    parts = parts_of(classes.count() * BANDS)

    def banded(read: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = ((b.column("handle").to_numpy(), b.column("bands").flatten().to_numpy().reshape(-1, BANDS)) for b in batches(read))
        yield from dealt(lists, parts)

    roots = similar(classes.select("handle", "bands").mapInArrow(banded, DEALT), fetch, "set", _unpacked, percent)
    joined = classes.select("id", "least").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    least = joined.groupBy("root").agg(F.min("least").alias("component"))
    found = settle(joined.join(least, "root").select("id", "component"))
    return rows.join(found, "id", "left").select(
        F.col("key").alias(key),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNull(), F.col("key")).otherwise(F.col("component")).alias("component_id"),
        F.col("id").alias("set_id"),
    )


def _unpacked(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), np.uint64) for x in column]
