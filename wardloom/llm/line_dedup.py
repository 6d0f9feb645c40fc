"""Fuzzy line dedup: MinHash over character shingles, exact Jaccard, union-find.

Every distinct line becomes a signature of the least hashes of its character shingles. Lines that agree in a band are
candidates, links are confirmed on the whole shingle sets, and one line of each component stays: the first by document
and position.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardloom.llm.common import batches, join_by_weight, likely, mix64, settle, utf8
from wardloom.llm.lsh import DEALT, bucket_numbers, dealt, parts_of, similar
from wardloom.llm.minhash import band_hashes

#: Characters of a shingle; bands and rows: at a similarity of 0.8, one pair in 550 shares no band; at 0.9, one in 10**5.
WIDTH, BANDS, ROWS = 7, 12, 4
#: Bytes of lines that are hashed at once: what comes of them stays in the cache of a core.
SLICE = 1 << 17
#: Shorter lines are left alone: none but blank ones. Those under WIDTH have one shingle, so only equal ones are linked.
LEAST = 1
#: What a line holds that is not blank: anything but white space, as Unicode has it.
INK = r"(?U)\S"


def shingles(lines: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``width`` characters from each position, and where each line's begin; a shorter line has one."""
    lines = lines.fill_null("")
    sizes = pc.utf8_length(lines).to_numpy(zero_copy_only=False).astype(np.int64)
    raw = utf8(lines)[0]
    points = raw if len(raw) == sizes.sum() else np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32)
    # the runs that begin at the last characters are no line's
    chars = np.zeros(len(points) + width - 1, np.uint64)
    np.add(points, np.uint64(1), out=chars[: len(points)])
    first = np.concatenate([[0], np.cumsum(np.maximum(sizes - width + 1, np.minimum(sizes, 1)))])
    starts = np.cumsum(sizes) - sizes
    begins = np.ones(len(points), bool)
    for k in range(1, width):
        begins[(starts + sizes - k)[sizes > k]] = False
    hashes = mix64(_rolled(chars, width)[begins])
    for k in np.flatnonzero((sizes > 0) & (sizes < width)):  # the whole line, by itself
        value = np.uint64(sizes[k])
        for c in chars[starts[k] : starts[k] + sizes[k]]:
            value = mix64(np.array([value ^ c]))[0]
        hashes[first[k]] = value
    return hashes, first


def _rolled(chars: np.ndarray, width: int) -> np.ndarray:
    """Polynomials of the ``width`` characters from each position that has so many, made from those of half as many."""
    if width == 1:
        return chars
    low, many = width // 2, len(chars) - width + 1
    half = _rolled(chars, low)
    base = np.uint64(pow(0x9E3779B97F4A7C15, width - low, 1 << 64))
    made = half[:many] * base
    if width % 2:
        made += half[low : low + many] * np.uint64(0x9E3779B97F4A7C15)
        made += chars[width - 1 :]
    else:
        made += half[low : low + many]
    return made


def sorted_sets(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different hashes of each line, sorted, and where each line's begin."""
    hashes = hashes.copy()
    for a, b in itertools.pairwise(first.tolist()):
        hashes[a:b].sort()
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    new[first[:-1][np.diff(first) > 0]] = True
    return hashes[new], np.concatenate([[0], np.cumsum(new)])[first]


def signatures(hashes: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """The least value of each of ``size`` permutations, x -> a * x mod 2**32 with a odd, of the mixed hashes of a set."""
    factors = np.random.default_rng(7).integers(1, 1 << 32, size, np.uint32) | np.uint32(1)
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    made = np.empty((len(first) - 1, size), np.uint32)
    out = np.empty_like(x)
    for k in range(size):
        np.multiply(x, factors[k], out=out)
        made[:, k] = np.minimum.reduceat(out, first[:-1])
    return made


def _banded(read: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The handles of lines, and their buckets."""
    for batch in batches(read, SLICE):
        signed = signatures(*shingles(batch.column("line")), BANDS * ROWS)
        yield batch.column("handle").to_numpy(), bucket_numbers(band_hashes(signed, BANDS, ROWS))


def _signed(read: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines with n (different shingles), bands and sketch."""
    for batch in batches(read, SLICE):
        hashes, first = shingles(batch.column("line"))
        signed = signatures(hashes, first, BANDS * ROWS)
        buckets = bucket_numbers(band_hashes(signed, BANDS, ROWS))
        lists = pa.ListArray.from_arrays(np.arange(0, buckets.size + 1, BANDS, dtype=np.int32), buckets.ravel())
        sizes = np.diff(sorted_sets(hashes, first)[1])
        sketch = pa.array(signed.astype(np.uint8).view(f"V{signed.shape[1]}").ravel().tolist(), pa.binary())
        columns = [*(batch.column(c) for c in ("handle", "id", "line")), pa.array(sizes, pa.int64()), lists, sketch]
        yield pa.record_batch(columns, names=["handle", "id", "line", "n", "bands", "sketch"])


def _lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, version (a hash of the text), at (from 0) and line of every line of every row."""
    version = F.xxhash64(text).alias("version")
    return docs.select(F.col(key).alias("key"), version, F.posexplode(F.split(F.col(text), "\n")).alias("at", "line"))


def _name(line: Column) -> Column:
    return F.unhex(F.md5(line.cast("binary")))


def _compared(least: int) -> Column:
    # nearly all lines show by their first character that they are not blank
    begin = F.ascii(F.ltrim("line"))
    inked = ((begin > 0x20) & (begin < 0x7F)) | F.col("line").rlike(INK)
    return inked if least <= 1 else (F.length(F.trim("line")) >= least) & inked


def removals(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80, least: int = LEAST) -> DataFrame:
    """key, version, at, kept_key and kept_at of every line that goes, with the line that stays in its place."""
    lines = _lines(docs, key, text).filter(_compared(least))
    distinct = settle(lines.groupBy("line").agg(F.count("*").alias("times")).withColumns({"id": _name(F.col("line")), "handle": F.xxhash64("line")}))

    def fetch(handles: DataFrame) -> DataFrame:
        found = distinct.select("handle", "id", "line").filter(likely(handles, "handle"))
        signed = "handle long, id binary, line string, n long, bands array<long>, sketch binary"
        return found.join(handles, "handle", "left_semi").mapInArrow(_signed, signed)

    parts = parts_of(distinct.count() * BANDS)
    banded = distinct.select("handle", "line").mapInArrow(lambda read: dealt(_banded(read), parts), DEALT)
    roots = similar(banded, fetch, "line", _Sets, percent)
    # lines that occur once and resemble no other need no more looking at
    repeated = distinct.filter("times > 1").select("id")
    doubtful = settle(repeated.join(roots, "id", "full").select("id", F.coalesce("root", "id").alias("root")))
    places = lines.select("key", "version", "at", _name(F.col("line")).alias("id"))
    placed = settle(places.join(doubtful, "id"))
    kept = placed.groupBy("root").agg(F.min(F.struct(F.col("key").isNull().alias("none"), "key", "version", "at")).alias("kept"), F.count("*").alias("many"))
    kept = settle(kept.withColumnRenamed("root", "group"))
    total = kept.agg(F.sum("many")).first()[0] or 0
    # keys may be null or repeat with other texts: a row goes by its key and a hash of its text
    same = F.col("key").eqNullSafe(F.col("kept.key")) & (F.col("version") == F.col("kept.version"))
    stays = same & (F.col("at") == F.col("kept.at"))
    found = join_by_weight(placed, kept, placed["root"] == kept["group"], "many", total)
    return found.filter(~stays).select("key", "version", "at", F.col("kept.key").alias("kept_key"), F.col("kept.at").alias("kept_at"))


class _Sets(Sequence):
    """The shingle sets of lines, each sorted."""

    def __init__(self, lines: pa.Array) -> None:
        self.values, self.first = sorted_sets(*shingles(lines))

    def __len__(self) -> int:
        return len(self.first) - 1

    def __getitem__(self, k: int) -> np.ndarray:
        if not 0 <= k < len(self):
            raise IndexError(k)
        return self.values[self.first[k] : self.first[k + 1]]


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80, least: int = LEAST) -> DataFrame:
    """All columns of ``docs`` with the lines that stay in ``text``, plus ``_lines_removed`` (the number of the others).

    Lines end at line feeds. Lines of white space, and those of fewer than ``least`` characters, blank ends aside, always stay. Of each component
    of lines whose shingle sets have 100 * intersection >= ``percent`` * union the first line stays, by key (null last)
    and position. Rows that repeat in key and text keep their lines as one row does; rows that share a key, or have none,
    with other texts are rows of their own, in the order of a hash of their texts. Null texts stay null, empty ones empty.
    Other columns may have any name; one called ``_lines_removed`` is replaced.
    """
    left = rebuilt(docs, key, text, percent, least)
    columns = [F.col("body").alias(c) if c == text else F.col("doc").getField(c).alias(c) for c in docs.columns if c != "_lines_removed"]
    return left.select(*columns, F.col("removed").alias("_lines_removed"))


def rebuilt(docs: DataFrame, key: str, text: str, percent: int = 80, least: int = LEAST) -> DataFrame:
    """doc (all columns of a row), body (its text with the lines that stay) and removed (the number of the others)."""
    gone = removals(docs, key, text, percent, least).groupBy(F.col("key").alias("gone_key"), F.col("version").alias("gone_version"))
    gone = gone.agg(F.collect_set("at").alias("gone"))
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), F.col(key).alias("key"), F.col(text).alias("text"))
    same = F.col("key").eqNullSafe(F.col("gone_key")) & (F.xxhash64("text") == F.col("gone_version"))
    joined = whole.join(gone, same, "left")
    lines = F.split("text", "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
    # the array of one array splits the text once, not once a line
    picked = F.transform(F.array(lines), lambda own: F.transform(left, lambda at: F.get(own, at)))
    some = F.col("gone").isNotNull() & F.col("text").isNotNull()
    body = F.when(some, F.array_join(picked[0], "\n")).otherwise(F.col("text"))
    return joined.select("doc", body.alias("body"), F.when(some, F.size("gone")).otherwise(0).alias("removed"))


def line_report(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80, least: int = LEAST) -> DataFrame:
    """key, line_no, kept, kept_key and kept_line of every line: the line itself, or the one that stays for it."""
    feeds = F.octet_length(text) - F.octet_length(F.replace(F.col(text), F.lit("\n"), F.lit("")))
    whole = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("version"), feeds.alias("last")).filter("last IS NOT NULL")
    gone = removals(docs, key, text, percent, least).dropDuplicates(["key", "version", "at"])
    gone = gone.groupBy(F.col("key").alias("k"), F.col("version").alias("v"))
    gone = gone.agg(F.collect_list(F.struct("at", F.lit(False).alias("kept"), "kept_key", "kept_at")).alias("gone"))
    same = F.col("key").eqNullSafe(F.col("k")) & (F.col("version") == F.col("v"))
    every = F.sequence(F.lit(0), "last")
    left = F.when(F.col("gone").isNull(), every).otherwise(F.array_except(every, F.col("gone.at")))
    own = F.transform(left, lambda at: F.struct(at.alias("at"), F.lit(True).alias("kept"), F.col("key").alias("kept_key"), at.alias("kept_at")))
    joined = whole.join(gone, same, "left").select("key", F.inline(F.when(F.col("gone").isNull(), own).otherwise(F.concat(own, "gone"))))
    return joined.select(F.col("key").alias(key), F.col("at").alias("line_no"), "kept", F.col("kept_key"), F.col("kept_at").alias("kept_line"))
