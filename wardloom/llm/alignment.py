"""Cross-tokenizer alignment by pointer jumping.

The tokens of two tokenizers over the same bytes overlap. Every token points to the farthest-right token that overlaps
it, and doubling the pointers of all tokens of a batch at once leads each of them to the last token of its component:
its group. Pairs of tokens that end together are links, and are counted over the whole corpus.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardloom.llm.common import batches, settle

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Entries of side a that no text is encoded to.
SPECIAL = {"<|endoftext|>"}
#: Characters of a text that are encoded at once, at least, where it can be cut.
SEGMENT = 1 << 16
#: Pairs that hold more than one in so many of all links, fewer than so many of them, are sent to all tasks.
FREQUENT = 1 << 17
#: A space between two other characters: neither tokenizer has a token that reaches over it.
CUT = re.compile(r"(?<=[^\s▁]) (?=[^\s▁])")


def _byte_of() -> dict[str, int]:
    """What byte each character of a byte-level entry stands for: printable ones for themselves, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Tokens:
    """The two tokenizers, and for each of their ids its bytes, its length and its digits."""

    def __init__(self, a: str, b: str) -> None:
        from sentencepiece import SentencePieceProcessor
        from tiktoken import Encoding

        with open(a, encoding="utf-8") as file:
            entries: dict[str, int] = json.load(file)["model"]["vocab"]
        byte_of = _byte_of()
        self.bytes_a = [b""] * (max(entries.values()) + 1)
        ranks = {}
        for entry, k in entries.items():
            if all(c in byte_of for c in entry) and entry not in SPECIAL:
                self.bytes_a[k] = bytes(byte_of[c] for c in entry)
                ranks[self.bytes_a[k]] = k
        # merges are listed in the order of the ids they make, so that the ids are their ranks
        self.a = Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = SentencePieceProcessor(model_file=b)
        self.bytes_b = [_piece(self.b.id_to_piece(k)) for k in range(self.b.get_piece_size())]
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in made], np.int64) for made in (self.bytes_a, self.bytes_b))

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of both; None where the bytes of either differ from a space and the text."""
        a: list[int] = []
        b: list[int] = []
        for part in segments(text):
            a += self.a.encode_ordinary(" " + part)
            b += self.b.encode(part, num_threads=1)
        wanted = b" " + text.encode()
        if not text or self.a.decode_bytes(a) != wanted or b"".join(map(self.bytes_b.__getitem__, b)) != wanted:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)


def _piece(piece: str) -> bytes:
    if m := re.fullmatch("<0x([0-9A-Fa-f]{2})>", piece):
        return bytes([int(m[1], 16)])
    return piece.replace("▁", " ").encode()


def segments(text: str, least: int = SEGMENT) -> Iterator[str]:
    """Parts of a text between single spaces that stand between other characters; each is encoded as a text of its own."""
    start = 0
    while len(text) - start > 2 * least and (m := CUT.search(text, start + least)):
        yield text[start : m.start()]
        start = m.end()
    yield text[start:]


@cache
def tokens(a: str, b: str) -> Tokens:
    return Tokens(a, b)


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token of either tokenizer, the end of the last token of its component.

    ``ends`` are ends of tokens, none of them empty, over the same bytes; the last ones agree. Tokens are numbered a
    first. Each points to the one of the other side that holds its last byte, unless that ends with it: no token of its
    own side overlaps it, and none of the other side reaches farther.
    """
    m = len(ends_a)
    ends = np.concatenate([ends_a, ends_b])
    over_a = np.searchsorted(ends_b, ends_a) + m
    over_b = np.searchsorted(ends_a, ends_b)
    pointer = np.concatenate([over_a, over_b])
    # two tokens that end together: the one of side a is the terminal, and the other one points to it
    stop = np.flatnonzero(ends[over_a] == ends_a)
    pointer[stop] = stop
    while True:
        farther = pointer[pointer]
        if (farther == pointer).all():
            break
        pointer = farther
    last = ends[pointer]
    return last[:m], last[m:]


@cache
def _spelt(size: int, closing: int, inner: int) -> np.ndarray:
    """For each id below ``size``, then for each once more, its decimal digits and a separator; zeros fill the rows."""
    made = [f"{k}{chr(c)}".encode() for c in (inner, closing) for k in range(size)]
    width = max(map(len, made))
    return np.frombuffer(b"".join(x.ljust(width, b"\0") for x in made), np.uint8).reshape(2 * size, width)


def group_text(a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray, size: int) -> bytes:
    """``a1,a2|b1;a3|b2,b3``: ids, all below ``size``, of each group, which go by the ends of their last tokens."""
    closing_a = np.append(last_a[1:] != last_a[:-1], True)
    closing_b = np.append(last_b[1:] != last_b[:-1], True)
    spelt_a, spelt_b = _spelt(size, ord("|"), ord(",")), _spelt(size, ord(";"), ord(","))
    rows = np.empty((len(a) + len(b), spelt_a.shape[1]), np.uint8)
    # a token comes after those of its side and those of the other one in groups before, or up to its own
    rows[np.arange(len(a)) + np.searchsorted(last_b, last_a)] = spelt_a[a + size * closing_a]
    rows[np.arange(len(b)) + np.searchsorted(last_a, last_b, "right")] = spelt_b[b + size * closing_b]
    flat = rows.ravel()
    return flat[flat > 0][:-1].tobytes()


def aligned(docs: DataFrame, key: str, text: str, a_file: str, b_file: str) -> DataFrame:
    """key, row, n_a, n_b, n_groups, groups_sha256, and the pairs of ids linked with the times of each, of every row."""

    def run(read: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokens(a_file, b_file)
        width, most = len(both.bytes_b), max(len(both.bytes_a), len(both.bytes_b))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        names = ["n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"]
        for batch in batches(read, 1 << 20):
            out: list[list] = [[] for _ in names]
            for body in batch.column("body").to_pylist():
                made = both.encode(body or "")
                if made is None:
                    values = (0, 0, 0, "", [], [])
                else:
                    a, b = made
                    ends_a, ends_b = np.cumsum(both.sizes_a[a]), np.cumsum(both.sizes_b[b])
                    last_a, last_b = terminals(ends_a, ends_b)
                    at_a, at_b = np.flatnonzero(ends_a == last_a), np.flatnonzero(ends_b == last_b)
                    pairs, times = np.unique(a[at_a] * width + b[at_b], return_counts=True)
                    digest = hashlib.sha256(group_text(a, b, last_a, last_b, most)).hexdigest()
                    values = (len(a), len(b), len(at_a), digest, pairs, times)
                for column, value in zip(out, values, strict=True):
                    column.append(value)
            arrays = [pa.array(v, t) for v, t in zip(out, kinds, strict=True)]
            yield pa.record_batch([batch.column("key"), batch.column("row"), *arrays], names=["key", "row", *names])

    rows = docs.select(F.col(key).alias("key"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("body"))
    kind = rows.schema["key"].dataType.simpleString()
    made = "n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, times array<long>"
    return rows.mapInArrow(run, f"key {kind}, row long, {made}")


def align(docs: DataFrame, key: str = "doc_id", text: str = "text", a_file: str | None = None, b_file: str | None = None, frequent: int = FREQUENT) -> DataFrame:
    """key, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row.

    Side a encodes a space and the text, side b the text, without special tokens, whose strings are plain text. A group is
    a component of overlapping tokens, a link a pair of tokens that end together. ``count_sum`` adds up, over the links
    of a row, how many links of all rows hold that pair of ids; ``n_best`` counts those whose pair is the most frequent one
    of its b id, ties included. Null and empty texts, and those whose tokens' bytes differ from a space and the text, have
    no tokens: zeros and ''. Repeated rows count each. Texts over 128 K characters are encoded in parts, which changes no
    id. An empty table gives an empty one. Other columns, whatever their names, are not read.
    """
    a_file, b_file = a_file or public_tokenizers.path(A_FILE), b_file or public_tokenizers.path(B_FILE)
    rows = settle(aligned(docs, key, text, a_file, b_file))
    width = len(tokens(a_file, b_file).bytes_b)
    each = rows.select(F.inline(F.arrays_zip("pairs", "times")))
    counts = settle(each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("count")))
    best = counts.groupBy((F.col("pair") % width).alias("b")).agg(F.max("count").alias("top"))
    counts = counts.join(best, F.col("pair") % width == F.col("b")).select("pair", "count", (F.col("count") == F.col("top")).cast("long").alias("best"))
    counts = settle(counts)
    total = counts.agg(F.sum("count")).first()[0] or 0
    table = counts.filter(F.col("count") * frequent > total).orderBy("pair").toArrow()
    known, known_count, known_best = (table.column(c).combine_chunks().to_numpy() for c in ("pair", "count", "best"))

    def looked_up(read: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(read, 1 << 20):
            pairs, times = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("pairs", "times"))
            sizes = batch.column("pairs").value_lengths().to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            at = np.minimum(np.searchsorted(known, pairs), max(len(known) - 1, 0))
            hit = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
            sums = []
            for values in (known_best, known_count):
                held = np.zeros(len(sizes), np.int64)
                np.add.at(held, owner[hit], values[at[hit]] * times[hit])
                sums.append(pa.array(held))
            rest = [np.bincount(owner[~hit], minlength=len(sizes)).cumsum(), pairs[~hit], times[~hit]]
            starts = pa.array(np.concatenate([[0], rest[0]]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(starts, pa.array(v)) for v in rest[1:]]
            yield pa.record_batch([batch.column("row"), *sums, *lists], names=["row", "best", "sum", "pairs", "times"])

    seen = rows.select("row", "pairs", "times").mapInArrow(looked_up, "row long, best long, sum long, pairs array<long>, times array<long>")
    seen = settle(seen)
    rare = seen.select("row", F.inline(F.arrays_zip("pairs", "times"))).join(counts, F.col("pairs") == F.col("pair"))
    added = rare.select("row", (F.col("best") * F.col("times")).alias("best"), (F.col("count") * F.col("times")).alias("sum"))
    sums = seen.select("row", "best", "sum").unionByName(added).groupBy("row").agg(F.sum("best").alias("n_best"), F.sum("sum").alias("count_sum"))
    return rows.drop("pairs", "times").join(sums, "row").select(
        F.col("key").alias(key), "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256"
    )
