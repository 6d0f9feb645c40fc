"""Helpers that the operators of this package share."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Code points that no case folding, normal form or regular expression dialect treats in its own way.
PLAIN_LATIN = "\\t\\n\\r\\x20-\\x7e\\u00a1-\\u00ac\\u00ae-\\u012f\\u0131-\\u0177"


#: Bytes that Spark hands to a Python worker at once.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only a local session that names none gets one of its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not context.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="wardloom-checkpoints-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """``df`` computed once, as a table in the shared folder: lost executors cost nothing, and its size is known."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def reachable(spark: SparkSession) -> None:
    """Lets Python workers import this library from where the driver did; what --py-files brings them comes first.

    Unless the session says otherwise, they get batches of a few megabytes at most, whatever the length of texts.
    """
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*paths, root]))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reachable(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def remainder(key: Column, divisor: int) -> Column:
    """crc32 of a key's text, modulo ``divisor``; of a null key: null."""
    return F.crc32(key.cast("string").cast("binary")) % divisor


def slices(batch: pa.RecordBatch, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``max_bytes`` at most, but for single larger rows."""
    step = max(1, int(batch.num_rows * max_bytes / max(batch.nbytes, 1)))
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


def batches(read: Iterator[pa.RecordBatch], max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches of a task in ``slices``.

    At the end the worker, which Spark keeps for later tasks, gives back what it has no more use for.
    """
    try:
        for batch in read:
            yield from slices(batch, max_bytes)
    finally:
        give_back()


def give_back() -> None:
    """Memory that this process has freed, to the system."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of unsigned 64-bit integers in which every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the start of each row, with one more offset at the end; nulls are empty."""
    column = column.fill_null("")
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, kind, column.offset + len(column) + 1)[column.offset :].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[starts[0] : starts[-1]], starts - starts[0]


#: Bytes that separate words: space and the control characters from tab to carriage return.
SEPARATORS = np.zeros(256, bool)
SEPARATORS[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
_BASE = 0x9E3779B97F4A7C15 | 1


def word_hashes(raw: np.ndarray, starts: np.ndarray, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each row, with A-Z in lower case, and the first word of each row.

    A word is ``[^\\x20\\x09-\\x0D]+``; the second result has one more entry at the end. A word's hash is a polynomial
    in its bytes modulo 2**64, mixed; with ``most``, in so many first bytes.
    """
    rows = len(starts) - 1
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64)
    inside = ~SEPARATORS[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = starts[:-1][starts[:-1] < len(raw)]
    begins[cuts] = inside[cuts]
    first = np.flatnonzero(begins)
    counts = np.searchsorted(first, starts)
    if not len(first):
        return np.zeros(0, np.uint64), counts
    at = np.arange(len(raw)) - np.repeat(first, np.diff(np.append(first, len(raw)))) if first[0] == 0 else None
    if at is None:
        at = np.arange(first[0], len(raw)) - np.repeat(first, np.diff(np.append(first, len(raw))))
    at[~inside[first[0] :]] = 0
    top = int(at.max()) + 1
    powers = np.empty(top, np.uint64)
    powers[0] = 1
    if top > 1:
        powers[1:] = np.uint64(_BASE)
        with np.errstate(over="ignore"):
            np.multiply.accumulate(powers, out=powers)
    terms = (LOWER[raw[first[0] :]].astype(np.uint64) + np.uint64(1)) * powers[at]
    terms[~inside[first[0] :]] = 0
    if most is not None:
        terms[at >= most] = 0
    return mix64(np.add.reduceat(terms, first - first[0])), counts


def shingle_hashes(words: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``width`` words of each row and the first of each row, with one more entry at the end.

    A row of fewer words has its whole sequence as its only shingle, and one without words has none.
    """
    sizes = np.diff(counts)
    many = np.where(sizes >= width, sizes - width + 1, np.minimum(sizes, 1))
    first = np.concatenate([[0], np.cumsum(many)])
    rows = np.repeat(np.arange(len(sizes)), many)
    at = counts[:-1][rows] + np.arange(first[-1]) - first[:-1][rows]
    left = np.minimum(sizes[rows], width)
    out = np.zeros(len(at), np.uint64)
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    for k in range(width):
        step = mix64(out + padded[at + k] + np.uint64(k + 1))
        out = np.where(left > k, step, out)
    return out, first


def likely(members: DataFrame, column: str, most: int = 1 << 27) -> Column:
    """Whether a long is perhaps among ``members``: true for all of them, and for one in 16 others as long as ``most`` allows.

    A map of 16 bits a member, of at most ``most`` bits, made by Spark, goes to the driver and into the plan. It spares a
    join the shuffle of most rows that it would drop; the join stays.
    """
    bits = min(most, 1 << max(16, (16 * members.count()).bit_length()))
    place = F.pmod(F.xxhash64(column), F.lit(bits))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))
    words = members.select(F.shiftright(place, 6).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    found = words.toArrow()
    table = np.zeros(bits // 64, np.int64)
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy()

    @F.arrow_udf("boolean")
    def held(places: pa.Array) -> pa.Array:
        at = places.to_numpy()
        return pa.array((table[at >> 6] >> (at & 63)) & 1 == 1, pa.bool_())

    return held(place)


#: Keys that may hold more than one in so many of all rows: no more than so many keys can.
HEAVY = 1000


def join_by_weight(rows: DataFrame, groups: DataFrame, on: Column, weight: str, total: int, most: int = HEAVY) -> DataFrame:
    """``rows`` left-joined with ``groups``, whose ``weight`` says how many of the ``total`` rows each of them meets.

    Groups that meet more than one in ``most`` rows, fewer than ``most`` of them, are sent to all tasks, so that no task
    of the shuffled rest reads more than that share of the rows for one key. The columns of the two must differ.
    """
    heavy = F.col(weight) * most > total
    large = F.broadcast(groups.filter(heavy))
    rest = rows.join(large, on, "left_anti").join(groups.filter(~heavy), on, "left")
    return rows.join(large, on).unionByName(rest)


def text_scores(score: Callable[[pa.Array], np.ndarray], max_bytes: int = 2 << 20) -> Callable[[Column], Column]:
    """``score`` as a column function of whole texts; null texts count as empty."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        batch = pa.record_batch([texts], names=["text"])
        parts = [score(part.column("text")) for part in slices(batch, max_bytes)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return scored
