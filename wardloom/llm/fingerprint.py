"""Document fingerprints: the bottom-k sketch of a document's word shingles.

A sketch is the ``k`` smallest distinct hashes of the shingles (all of them, if there are fewer). Sketches of the parts
of a set merge into the sketch of the set. The k smallest hashes of two sketches' union are a uniform sample of the
union of the sets, which gives resemblance, containment and counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardloom.llm.common import batches, shingle_hashes, utf8, word_hashes
from wardloom.llm.neighbours import map_with_next

SIZE, WIDTH = 128, 5
SPACE = 2.0**64


def sketches(texts: pa.Array, size: int = SIZE, width: int = WIDTH) -> list[np.ndarray]:
    """The sketch of each text, ascending; none for texts without words and nulls."""
    hashes, first = shingle_hashes(*word_hashes(*utf8(texts)), width)
    return [np.unique(hashes[a:b])[:size] for a, b in zip(first, first[1:], strict=False)]


def merge(parts: Sequence[np.ndarray], size: int = SIZE) -> np.ndarray:
    return np.unique(np.concatenate(parts))[:size] if parts else np.zeros(0, np.uint64)


def distinct(sketch: np.ndarray, size: int = SIZE) -> float:
    """How many distinct shingles there are: exact below ``size``."""
    return float(len(sketch)) if len(sketch) < size else (size - 1) * SPACE / float(sketch[-1])


def resemblance(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """Estimated share of the union that is common; of two empty sets 1, of one empty set 0."""
    union = merge([a, b], size)
    if not len(union):
        return 1.0
    return len(np.intersect1d(np.intersect1d(union, a, True), b, True)) / len(union)


def containment(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """Estimated share of ``a`` that is in ``b``; an empty ``a`` is contained."""
    if not len(a):
        return 1.0
    common = resemblance(a, b, size) * distinct(merge([a, b], size), size)
    return min(1.0, common / distinct(a, size))


def to_text(sketch: np.ndarray) -> str:
    return sketch.astype(">u8").tobytes().hex()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), ">u8").astype(np.uint64)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, width: int = WIDTH) -> DataFrame:
    """key, fingerprint (hexadecimal) and n_distinct of every row's whole text.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case. Texts of fewer than ``width`` words have one shingle; null
    and empty texts, and those without words, have an empty fingerprint. Other columns are not read.
    """

    def run(read: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(read):
            made = sketches(batch.column("text"), size, width)
            columns = [batch.column("key"), pa.array(map(to_text, made), pa.string()), pa.array([distinct(s, size) for s in made], pa.float64())]
            yield pa.record_batch(columns, names=["key", "fingerprint", "n_distinct"])

    rows = docs.selectExpr(f"`{key}` AS key", f"`{text}` AS text")
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, fingerprint string, n_distinct double").withColumnRenamed("key", key)


def merged(prints: DataFrame, by: str, fingerprint: str = "fingerprint", size: int = SIZE) -> DataFrame:
    """by, fingerprint: the sketch of all documents of each group.

    Hashes are made distinct and cut to the smallest before the shuffle as well as after it, so groups may be large.
    """
    hashes = F.explode(F.regexp_extract_all(F.col(fingerprint), F.lit("([0-9a-f]{16})")))
    rows = prints.select(F.col(by).alias("by"), hashes.alias("hash")).distinct()
    least = rows.withColumn("n", F.row_number().over(Window.partitionBy("by").orderBy("hash"))).filter(F.col("n") <= size)
    return least.groupBy(F.col("by").alias(by)).agg(F.array_join(F.array_sort(F.collect_list("hash")), "").alias(fingerprint))


def edited_likeness(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, width: int = WIDTH) -> DataFrame:
    """Each document held against an edited version of itself and against the next document, by fingerprints.

    The edited text has the first characters of the next document in place of the last third. Returns key, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_distinct, contained (of the document in its
    edited text). Null texts are empty; see ``map_with_next`` for the order and for repeated and null keys.
    """

    def make(keys: pa.Array, texts: list[str], after: str) -> list[pa.Array]:
        following = [*texts[1:], after]
        thirds = [len(t) // 3 for t in texts]
        edited = [t[: len(t) - n] + f[:n] for t, f, n in zip(texts, following, thirds, strict=True)]
        own, new = sketches(pa.array([*texts, after], pa.large_string()), size, width), sketches(pa.array(edited, pa.large_string()), size, width)
        return [
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
            pa.array([to_text(s) for s in own[:-1]], pa.string()),
            pa.array([to_text(s) for s in new], pa.string()),
            pa.array([resemblance(a, b, size) for a, b in zip(own[:-1], new, strict=True)], pa.float64()),
            pa.array([resemblance(a, b, size) for a, b in zip(own, own[1:], strict=False)], pa.float64()),
            pa.array([distinct(s, size) for s in own[:-1]], pa.float64()),
            pa.array([containment(a, b, size) for a, b in zip(own[:-1], new, strict=True)], pa.float64()),
        ]

    kinds = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_distinct double, contained double"
    return map_with_next(docs, key, text, make, kinds)
