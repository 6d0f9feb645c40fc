"""Embedding near-duplicates: random-hyperplane sign hashing, exact cosines, connected components.

The signs of a vector's products with random hyperplanes make its key in each of several tables. The number of planes
grows with the logarithm of the rows, so that buckets stay about equally large, and the number of tables follows from
it, so that the chance to miss a pair at the threshold stays the same. Buckets are cut into blocks of bounded size; a
cell holds one block, or two, and compares their vectors exactly. A pair counts in the first table that brings it
together only, so no pairs are written: a cell gives each vector's number of links and what it is connected to.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardloom.llm.common import batches, settle
from wardloom.llm.components import components

#: Vectors of a bucket that random data would have; vectors of a block; chance to miss a pair at the threshold.
BUCKET, BLOCK, MISS = 256, 512, 0.0005


def plan(rows: int, threshold: float, bucket: int = BUCKET, miss: float = MISS) -> tuple[int, int]:
    """Planes of a table and tables."""
    planes = max(4, math.ceil(math.log2(max(2, rows / bucket))))
    together = (1 - math.acos(threshold) / math.pi) ** planes
    return planes, math.ceil(math.log(miss) / math.log1p(-together))


def hyperplanes(size: int, planes: int, tables: int, seed: int = 20) -> np.ndarray:
    return np.random.default_rng([seed, size, planes]).standard_normal((size, planes * tables))


def bucket_keys(vectors: np.ndarray, planes: int, tables: int) -> np.ndarray:
    """A row of table keys for each vector."""
    signs = (vectors @ hyperplanes(vectors.shape[1], planes, tables) >= 0).reshape(len(vectors), tables, planes)
    return signs @ (1 << np.arange(planes, dtype=np.int64))


def unit(values: list | None) -> np.ndarray | None:
    """The vector at length one in double precision; None if it is null, empty or zero or holds nulls or non-finite values."""
    if not values or any(v is None for v in values):
        return None
    x = np.array(values, np.float64)
    top = np.abs(x).max()
    if not np.isfinite(top) or top == 0:
        return None
    x = x / top
    return x / np.sqrt(x @ x)


def _cell(ids: list[bytes], counts: np.ndarray, sides: np.ndarray, x: np.ndarray, table_no: int, diagonal: bool, threshold: float, planes: int, tables: int):
    """links (rows linked, in this table first) and root (index of the least id connected here) of each vector."""
    near = x @ x.T >= threshold
    if not diagonal:
        near &= sides[:, None] != sides[None, :]
    np.fill_diagonal(near, False)
    links = np.zeros(len(ids), np.int64)
    order = np.argsort(np.array(ids, object), kind="stable")
    label = np.empty(len(ids), np.int64)
    label[order] = np.arange(len(ids))
    some = np.flatnonzero(near.any(1))
    if len(some):
        near = near[np.ix_(some, some)]
        keys = bucket_keys(x[some], planes, tables)[:, :table_no]
        before = np.zeros_like(near)
        for t in range(keys.shape[1]):
            before |= keys[:, t, None] == keys[None, :, t]
        links[some] = (near & ~before) @ counts[some]
        part = label[some]
        while True:
            least = np.minimum(part, np.where(near, part[None, :], len(ids)).min(1))
            if (least == part).all():
                break
            part = least
        label[some] = part
    return links, order[label]


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.9) -> DataFrame:
    """key, n_links and component_id of every row.

    A link is a pair of rows with a cosine of at least ``threshold`` in double precision; n_links counts the other rows
    that a row is linked with, equal ones and those with a repeated key too. Vectors that are null, empty or zero or hold
    null or non-finite components, and vectors of different lengths, are linked with nothing. ``component_id`` is the
    smallest key that links lead to, nulls aside. Other columns are not read.
    """
    rows = vectors.select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    kind = rows.schema["key"].dataType.simpleString()

    def named(read: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(read):
            units = [unit(v) for v in batch.column("vector").to_pylist()]
            data = [None if u is None else u.tobytes() for u in units]
            ids = [None if d is None else hashlib.blake2b(d, digest_size=16).digest() for d in data]
            yield pa.record_batch([batch.column("key"), pa.array(ids, pa.binary()), pa.array(data, pa.binary())], names=["key", "id", "data"])

    units = settle(rows.mapInArrow(named, f"key {kind}, id binary, data binary"))
    classes = units.filter("id IS NOT NULL").groupBy("id").agg(F.count("*").alias("n"), F.min("key").alias("least"), F.first("data").alias("data"))
    classes = settle(classes)
    planes, tables = plan(classes.count(), threshold)

    def keyed(read: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(read, 1 << 20):
            data = batch.column("data").to_pylist()
            sizes = np.array([len(d) // 8 for d in data])
            keys = np.empty((len(data), tables), np.int64)
            for size in set(sizes.tolist()):
                mine = np.flatnonzero(sizes == size)
                x = np.frombuffer(b"".join(data[k] for k in mine), np.float64).reshape(len(mine), size)
                keys[mine] = bucket_keys(x, planes, tables)
            lists = pa.ListArray.from_arrays(np.arange(0, (len(data) + 1) * tables, tables, dtype=np.int32), keys.ravel())
            yield pa.record_batch([batch.column("id"), batch.column("n"), pa.array(sizes.astype(np.int32)), lists], names=["id", "n", "size", "keys"])

    hashed = classes.select("id", "n", "data").mapInArrow(keyed, "id binary, n long, size int, keys array<long>")
    placed = settle(hashed.select("id", "size", F.posexplode("keys").alias("table", "bucket")))
    place = ["table", "size", "bucket"]
    crowds = placed.groupBy(*place).agg(F.count("*").alias("crowd")).filter("crowd > 1")
    blocks = F.ceil(F.col("crowd") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("id", "table"), F.col("blocks")).cast("int").alias("side")
    inside = placed.join(crowds.withColumn("blocks", blocks), place).select("id", *place, "blocks", own)
    # a block meets every block of its bucket, itself included, in one cell each
    met = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    cells = inside.select("id", *place, "side", met.alias("met")).select("id", *place, "side", F.least("side", "met").alias("i"), F.greatest("side", "met").alias("j"))
    filled = cells.join(classes.select("id", "n", "data"), "id")

    def compare(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_pylist()
        x = np.frombuffer(b"".join(table.column("data").to_pylist()), np.float64).reshape(len(ids), -1)
        number, i, j = (table.column(c)[0].as_py() for c in ("table", "i", "j"))
        counts, sides = table.column("n").to_numpy(), table.column("side").to_numpy()
        links, root = _cell(ids, counts, sides, x, number, i == j, threshold, planes, tables)
        roots = [ids[k] for k in root]
        said = np.array([bool(n) or a != b for n, a, b in zip(links, ids, roots, strict=True)], bool)
        return pa.table({"id": pa.array(ids, pa.binary()), "links": pa.array(links), "root": pa.array(roots, pa.binary())}).filter(pa.array(said))

    said = settle(filled.groupBy(*place, "i", "j").applyInArrow(compare, "id binary, links long, root binary"))
    roots = components(said.select("id", "root"))
    linked = said.groupBy("id").agg(F.sum("links").alias("links"))
    known = classes.select("id", "n", "least").join(linked, "id", "left").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    least = known.groupBy("root").agg(F.min("least").alias("component"))
    found = settle(known.join(least, "root").select("id", "component", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links")))
    return units.join(found, "id", "left").select(
        F.col("key").alias(key),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("id").isNull(), F.col("key")).otherwise(F.col("component")).alias("component_id"),
    )
