"""Links and components of similar sets, from the bands of their MinHash signatures.

Sets that agree in a band are candidates. In each bucket every set is first held against one leader, so that a bucket of
any size gives no more pairs than it has sets; sets that are linked with the same leader need no comparing. Buckets that
hold others, too, then are compared in memory, cell by cell: first the sketches of the signatures, then the whole sets.
Sets with the most frequent root meet only those with other roots. A bucket with very many others is dealt anew by the
rarest elements of its sets, of which linked sets share one, where that takes fewer copies: sets which have only what all
have in common then never meet. A cell writes only links that connect something, not pairs. So each link that could
change the components is found, and all are confirmed on whole sets.
"""

from __future__ import annotations

import itertools
import operator
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardloom.llm.common import batches, mix64, settle, slices
from wardloom.llm.components import components

#: Sets of a block; copies of a set, for as many cells, up to which a bucket is compared without looking for another way.
BLOCK, COPIES = 512, 16
#: The last bits of a bucket's number say of which band it is.
BAND_BITS = 6
#: Rows of bands in a part, about, and those that a task deals out, or holds of one part, at once; columns of what is dealt.
PART, DEALT_AT_ONCE = 1 << 15, 1 << 19
DEALT = "part long, bucket array<long>, handle array<long>"
#: Pairs of a cell whose sketches are compared at once; cells of so few sets are compared together, so many pairs at once.
AT_ONCE, SMALL, TOGETHER = 1 << 12, 64, 1 << 15

Sets = Callable[[pa.Array], Sequence[np.ndarray]]


def bucket_numbers(band_hashes: np.ndarray) -> np.ndarray:
    """The buckets of sets, a column for each band, from the hashes of their bands."""
    bands = np.arange(band_hashes.shape[1], dtype=np.uint64)
    mixed = mix64(band_hashes.view(np.uint64) + (bands + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    low = np.uint64((1 << BAND_BITS) - 1)
    return ((mixed & ~low) | bands).view(np.int64)


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if not len(x) or not len(y):
        return False
    common = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def _confirmed(pairs: DataFrame, sets: DataFrame, data: str, unpack: Sets, percent: int) -> DataFrame:
    """id_a, id_b of the pairs of handles whose sets have 100 * intersection >= percent * union."""
    left = sets.select(F.col("handle").alias("a"), F.col("id").alias("id_a"), F.col(data).alias("set_a"))
    right = sets.select(F.col("handle").alias("b"), F.col("id").alias("id_b"), F.col(data).alias("set_b"))

    def run(read: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(read, 1 << 19):
            both = zip(unpack(batch.column("set_a")), unpack(batch.column("set_b")), strict=True)
            keep = pa.array([_linked(x, y, percent) for x, y in both], pa.bool_())
            yield pa.record_batch([batch.column("id_a"), batch.column("id_b")], names=["id_a", "id_b"]).filter(keep)

    joined = pairs.join(left, "a").join(right, "b").select("id_a", "id_b", "set_a", "set_b")
    return joined.mapInArrow(run, "id_a binary, id_b binary")


def parts_of(rows: int) -> int:
    """How many parts the numbers of buckets are cut into, for so many rows of bands: a power of two."""
    return 1 << max(0, (rows // PART).bit_length())


def dealt(read: Iterable[tuple[np.ndarray, np.ndarray]], parts: int) -> Iterator[pa.RecordBatch]:
    """part, bucket and handle (lists of one length): the bands of sets, from their handles and ``bucket_numbers``.

    Equal buckets are in one part. A row holds what many sets have there, so that Spark shuffles few rows.
    """

    def made() -> Iterator[pa.RecordBatch]:
        handle = np.repeat(np.concatenate(handles), buckets[0].shape[1])
        bucket = np.concatenate([b.ravel() for b in buckets])
        part = (bucket >> BAND_BITS) & (parts - 1)
        order = np.argsort(part.astype(np.uint16) if parts <= 1 << 16 else part, kind="stable")
        part = part[order]
        starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        ends = pa.array(np.append(starts, len(part)), pa.int32())
        lists = [pa.ListArray.from_arrays(ends, pa.array(x[order])) for x in (bucket, handle)]
        yield from slices(pa.record_batch([pa.array(part[starts]), *lists], names=["part", "bucket", "handle"]), 1 << 22)

    handles, buckets, rows = [], [], 0
    for handle, bucket in read:
        if not bucket.size:
            continue
        handles.append(handle)
        buckets.append(bucket)
        rows += bucket.size
        if rows >= DEALT_AT_ONCE:
            yield from made()
            handles, buckets, rows = [], [], 0
    if rows:
        yield from made()


def _shared(read: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """bucket, handle and leader (one of the handles) of the sets of buckets that hold several; rows come in any order.

    Of earlier batches, each bucket and its leader are remembered, however many sets it holds.
    """
    known = leaders = np.zeros(0, np.int64)
    told = np.zeros(0, bool)  # of a known bucket, that it holds several
    for batch in read:
        if not batch.num_rows:
            continue
        old = len(known)
        bucket = np.concatenate([known, batch.column("bucket").to_numpy()])
        handle = np.concatenate([leaders, batch.column("handle").to_numpy()])
        fresh = np.concatenate([~told, np.ones(batch.num_rows, bool)])
        order = np.argsort(bucket, kind="stable" if old else None)  # what is known comes first
        bucket, handle, fresh = bucket[order], handle[order], fresh[order]
        starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        sizes = np.diff(np.append(starts, len(bucket)))
        known, leaders = bucket[starts], np.where(order[starts] < old, handle[starts], np.minimum.reduceat(handle, starts))
        told = ~fresh[starts] | (sizes > 1)
        keep = fresh & np.repeat(sizes > 1, sizes)
        if keep.any():
            columns = [bucket[keep], handle[keep], np.repeat(leaders, sizes)[keep]]
            yield pa.record_batch([pa.array(c) for c in columns], names=["bucket", "handle", "leader"])


def _crowded(read: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``_shared`` of what comes in lists, in the order of parts."""

    def pieces() -> Iterator[tuple[int, pa.RecordBatch]]:
        for batch in batches(read):
            part = batch.column("part").to_numpy()
            cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
            for a, b in itertools.pairwise(cuts):
                if a < b:
                    rows = batch.slice(a, b - a)
                    yield int(part[a]), pa.record_batch([rows.column(c).flatten() for c in ("bucket", "handle")], names=["bucket", "handle"])

    def joined(of_part: Iterator[tuple[int, pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for _, piece in of_part:
            held.append(piece)
            rows += piece.num_rows
            if rows >= DEALT_AT_ONCE:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, rows = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    for _, of_part in itertools.groupby(pieces(), operator.itemgetter(0)):
        yield from _shared(joined(of_part))


def _agreeing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many bytes of each row of ``x`` are those of ``y``."""
    same = x == y
    if same.shape[1] % 8 or not 0 < same.shape[1] < 256:
        return same.sum(1)
    # eight counts of at most 255 in one number, whose sum ends up in the first byte
    return ((same.view(np.uint64).sum(1) * np.uint64(0x0101010101010101)) >> np.uint64(56)).astype(np.int64)


def similar(banded: DataFrame, fetch: Callable[[DataFrame], DataFrame], data: str, unpack: Sets, percent: int = 80) -> DataFrame:
    """id, root of the sets that are linked to others, directly or through others.

    ``banded``: the bands of all sets as ``dealt`` gives them, by handle (long, a hash of a set's id). ``fetch`` gives, for a table of handles, handle, id (binary, distinct), n (size of the set), bands (its buckets), sketch (binary,
    the last byte of each coordinate of the signature; all are of one length) and ``data``; ``unpack`` turns a column of ``data``
    into sorted arrays of distinct values.
    """
    parted = banded.repartition("part").sortWithinPartitions("part")
    crowded = settle(parted.mapInArrow(_crowded, "bucket long, handle long, leader long"))
    stars = crowded.filter("handle <> leader").select(F.col("handle").alias("a"), F.col("leader").alias("b")).distinct()
    sets = settle(fetch(settle(crowded.select("handle").distinct())))
    links = settle(_confirmed(stars, sets, data, unpack, percent))

    # sets that are linked with one leader need no comparing with each other
    leaders = links.groupBy(F.col("id_a").alias("id")).agg(F.min("id_b").alias("root"))
    named = sets.select("handle", "id").join(leaders, "id", "left").select("handle", F.xxhash64(F.coalesce("root", "id")).alias("root"))
    members = crowded.select("bucket", "handle").join(named, "handle")
    mixed = _mixed(members.select("bucket", "root"), "bucket")
    apart = settle(members.join(mixed, "bucket").withColumn("meeting", F.col("bucket")))
    many = F.ceil(F.col("others") / BLOCK) + F.ceil(F.col("top") / BLOCK) > COPIES
    meetings = apart.select("bucket", "handle", "root", "meeting", "main", "top", "others")
    large = apart.filter(many)
    if not large.isEmpty():
        rare = settle(_by_rare_elements(large, sets, data, unpack, percent))
        # the copies that cells take either way
        cost = _copies(rare).groupBy("bucket").agg(F.sum("copies").alias("cost"))
        whole = _copies(large).groupBy("bucket").agg(F.sum("copies").alias("whole"))
        # a bucket of which no elements meet in sets with different roots has no links left to find
        dealt_anew = settle(whole.join(cost, "bucket", "left").filter(F.coalesce("cost", F.lit(0)) < F.col("whole")).select("bucket"))
        meetings = meetings.join(dealt_anew, "bucket", "left_anti").unionByName(rare.join(dealt_anew, "bucket", "left_semi"))
    found = settle(_compared(meetings, sets, data, unpack, percent))
    return components(links.unionByName(found))


def _mixed(members: DataFrame, meeting: str) -> DataFrame:
    """For each meeting of several roots: main (its most frequent root), top (the rows of that) and others (the rest)."""
    roots = members.groupBy(meeting, "root").agg(F.count("*").alias("rows"))
    sizes = roots.groupBy(meeting).agg(F.max_by("root", "rows").alias("main"), F.max("rows").alias("top"), F.sum("rows").alias("all"))
    return sizes.filter("top < all").select(meeting, "main", "top", (F.col("all") - F.col("top")).alias("others"))


def _blocks(rows: DataFrame) -> DataFrame:
    """With is_main and the number of blocks of either kind of root."""
    blocks = {f"{c}_blocks": F.ceil(F.col(c) / BLOCK).cast("int") for c in ("top", "others")}
    return rows.withColumns({"is_main": F.col("root") == F.col("main"), **blocks})


def _copies(rows: DataFrame) -> DataFrame:
    copies = F.col("others_blocks") + F.when(F.col("is_main"), 0).otherwise(F.col("top_blocks"))
    return _blocks(rows).select("bucket", copies.alias("copies"))


def _by_rare_elements(large: DataFrame, sets: DataFrame, data: str, unpack: Sets, percent: int) -> DataFrame:
    """bucket, handle, root, meeting, main, top, others: where the sets of large buckets meet.

    In the order of their frequency in the bucket, linked sets of n elements share one among the first
    n - ceil(percent * n / 100) + 1 of each.
    """

    def spread(read: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(read, 1 << 20):
            values = [x.view(np.int64) for x in unpack(batch.column(data))]
            sizes = [len(x) for x in values]
            at = pa.array(np.repeat(np.arange(len(values)), sizes))
            columns = [pa.array(np.concatenate(values)) if values else pa.array([], pa.int64()), *(batch.column(c).take(at) for c in ("bucket", "handle", "root"))]
            yield pa.record_batch([*columns, pa.array(np.repeat(np.array(sizes, np.int64), sizes))], names=["element", "bucket", "handle", "root", "n"])

    filled = large.select("bucket", "handle", "root").join(sets.select("handle", data), "handle")
    elements = settle(filled.mapInArrow(spread, "element long, bucket long, handle long, root long, n long"))
    often = elements.groupBy("bucket", "element").agg(F.count("*").alias("often"))
    order = Window.partitionBy("bucket", "handle").orderBy("often", "element")
    ranked = elements.join(often, ["bucket", "element"]).withColumn("place", F.row_number().over(order))
    first = ranked.filter(F.col("place") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)
    met = settle(first.select("bucket", "handle", "root", F.xxhash64("bucket", "element").alias("meeting")))
    return met.join(_mixed(met.select("meeting", "root"), "meeting"), "meeting").select(
        "bucket", "handle", "root", "meeting", "main", "top", "others"
    )


def _compared(meetings: DataFrame, sets: DataFrame, data: str, unpack: Sets, percent: int) -> DataFrame:
    """id_a, id_b: links between sets that meet and have different roots, enough of them to connect what is linked."""
    # blocks of other roots meet each other, themselves included, and those of the main root, in one cell each;
    # the latter have numbers below zero
    blocked = _blocks(meetings)
    own = F.when(F.col("is_main"), F.col("top_blocks")).otherwise(F.col("others_blocks"))
    place = F.pmod(F.xxhash64("handle", "meeting"), own).cast("int")
    side = F.when(F.col("is_main"), -1 - place).otherwise(place).alias("side")
    last = F.col("others_blocks") - 1
    met = F.when(F.col("is_main"), F.sequence(F.lit(0), last)).otherwise(F.sequence(-F.col("top_blocks"), last))
    each = blocked.select("handle", "bucket", "root", "meeting", side, F.explode(met).alias("met"))
    cell = F.xxhash64("meeting", F.least("side", "met"), F.greatest("side", "met")).alias("cell")
    cells = each.select("handle", "bucket", "root", "side", cell)
    dealt = cells.join(sets, "handle").repartition("cell").sortWithinPartitions("cell")

    def compare(ids: pa.Array, at: int, values: Callable[[int], np.ndarray], label: np.ndarray, n: np.ndarray, side: np.ndarray, bucket: int, bands: np.ndarray, sketch: np.ndarray) -> Iterator[tuple[bytes, bytes]]:
        rows, size = sketch.shape
        p = percent / 100
        least = size * (p - 4 * np.sqrt(p * (1 - p) / max(size, 1)))  # a pair at the similarity falls short once in 30,000 times
        single = (side == side[0]).all()
        step = max(1, AT_ONCE // rows)
        for start in range(0, rows, step):
            mine = np.arange(start, min(start + step, rows))
            fit = (label[mine, None] != label[None, :]) & (100 * n[mine, None] >= percent * n[None, :]) & (100 * n[None, :] >= percent * n[mine, None])
            fit &= mine[:, None] < np.arange(rows)[None, :]
            if not single:
                fit &= side[mine, None] != side[None, :]
            i, j = np.nonzero(fit)
            i = mine[i]
            same = _agreeing(sketch[i], sketch[j])
            likely = np.flatnonzero(same >= least)
            likely = likely[np.argsort(-same[likely], kind="stable")]
            i, j = i[likely], j[likely]
            # the first bucket that two sets share is where they are compared
            agree = bands[i] == bands[j]
            here = bands[i, agree.argmax(1)] == bucket if len(i) else np.zeros(0, bool)
            for a, b in zip(i[here].tolist(), j[here].tolist(), strict=True):
                if label[a] != label[b] and _linked(values(at + a), values(at + b), percent):
                    label[label == label[b]] = label[a]
                    yield ids[at + a].as_py(), ids[at + b].as_py()

    def compare_small(column: dict[str, pa.Array], starts: np.ndarray, ends: np.ndarray, label: np.ndarray, n: np.ndarray, side: np.ndarray, bucket: np.ndarray, bands: np.ndarray, sketch: np.ndarray) -> Iterator[tuple[bytes, bytes]]:
        """As ``compare``, for many small cells at once; label: all of them, changed as sets are linked."""
        p, size = percent / 100, sketch.shape[1]
        least = size * (p - 4 * np.sqrt(p * (1 - p) / max(size, 1)))
        sizes = ends - starts
        cell = np.repeat(np.arange(len(starts)), sizes)
        row = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(len(cell))
        single = np.minimum.reduceat(side[row], np.cumsum(sizes) - sizes) == np.maximum.reduceat(side[row], np.cumsum(sizes) - sizes)
        later = ends[cell] - row - 1  # the sets of its cell that a set is held against
        cuts = np.flatnonzero(np.diff(np.cumsum(later) // TOGETHER)) + 1
        for own in np.split(np.arange(len(row)), cuts):
            many = later[own]
            i = np.repeat(row[own], many)
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many)
            fit = (label[i] != label[j]) & (100 * n[i] >= percent * n[j]) & (100 * n[j] >= percent * n[i])
            of = np.repeat(cell[own], many)
            fit &= single[of] | (side[i] != side[j])
            i, j, of = i[fit], j[fit], of[fit]
            same = _agreeing(sketch[i], sketch[j])
            likely = np.flatnonzero(same >= least)
            agree = bands[i[likely]] == bands[j[likely]]
            likely = likely[bands[i[likely], agree.argmax(1)] == bucket[i[likely]]] if len(likely) else likely
            likely = likely[np.argsort(-same[likely], kind="stable")]
            if not len(likely):
                continue
            i, j, of = i[likely], j[likely], of[likely]
            needed, at = np.unique(np.concatenate([i, j]), return_inverse=True)
            values = unpack(column[data].take(pa.array(needed)))
            for a, b, x, y, c in zip(i.tolist(), j.tolist(), at[: len(i)].tolist(), at[len(i) :].tolist(), of.tolist(), strict=True):
                if label[a] != label[b] and _linked(values[x], values[y], percent):
                    mates = label[starts[c] : ends[c]]
                    mates[mates == label[b]] = label[a]
                    yield column["id"][a].as_py(), column["id"][b].as_py()

    def run(read: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def said(rows: pa.Table, last: bool) -> tuple[pa.RecordBatch, int]:
            """Links of the whole cells of ``rows``, and where the last one, which may go on, begins."""
            rows = rows.combine_chunks()
            column = {c: rows.column(c).chunk(0) for c in rows.column_names}
            cell, label, n, side, bucket = (column[c].to_numpy(zero_copy_only=False) for c in ("cell", "root", "n", "side", "bucket"))
            starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
            ends = np.append(starts[1:], len(cell))
            if not last:
                starts, ends = starts[:-1], ends[:-1]
            sketch = np.frombuffer(b"".join(column["sketch"].to_pylist()), np.uint8).reshape(len(cell), -1)
            bands = column["bands"].flatten().to_numpy().reshape(len(cell), -1)
            found: list[tuple[bytes, bytes]] = []
            label = label.copy()
            unpacked: list[Sequence[np.ndarray]] = []

            def values(k: int) -> np.ndarray:
                if not unpacked:
                    unpacked.append(unpack(column[data]))
                return unpacked[0][k]

            upto = int(ends[-1]) if len(ends) else 0
            if len(starts):
                mixed = np.minimum.reduceat(label[:upto], starts) != np.maximum.reduceat(label[:upto], starts)
                small = mixed & (ends - starts <= SMALL)
                if small.any():
                    found.extend(compare_small(column, starts[small], ends[small], label, n, side, bucket, bands, sketch))
                starts, ends = starts[mixed & ~small], ends[mixed & ~small]
            for x, y in zip(starts.tolist(), ends.tolist(), strict=True):
                found.extend(compare(column["id"], x, values, label[x:y], n[x:y], side[x:y], bucket[x], bands[x:y], sketch[x:y]))
            made = [pa.array([pair[k] for pair in found], pa.binary()) for k in (0, 1)]
            return pa.record_batch(made, names=["id_a", "id_b"]), upto

        held: pa.Table | None = None
        for batch in batches(read, 2 << 20):
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([held, rows]) if held is not None else rows
            if not rows.num_rows:
                continue
            links, upto = said(rows, False)
            if links.num_rows:
                yield links
            held = rows.slice(upto)
        if held is not None and held.num_rows:
            yield said(held, True)[0]

    return dealt.mapInArrow(run, "id_a binary, id_b binary")
