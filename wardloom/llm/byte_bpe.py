"""Byte-level BPE by monoid tree reduction.

The encoding of a text is a monoid: two neighbouring texts' encodings join into the encoding of both. An encoding is
valid exactly if each two neighbouring tokens encode, on their own, to those two tokens (every token of the vocabulary
being reachable by merges, which the constructor checks). So a join re-encodes a window around the seam and widens it
on each side where the window's outer token and its neighbour outside are not such a pair; once both are, no token
outside can change. Texts are encoded by halves, down to single bytes; halves and pairs are remembered, as language
repeats them. Decoding joins the bytes of halves in the same way.
"""

from __future__ import annotations

import base64
import functools
import heapq
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame

from wardloom.llm.common import PLAIN_LATIN, batches

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Remembered halves, pairs and chunks of text, at most; then they are forgotten and learned anew.
REMEMBERED = 500_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class TreeEncoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.find = regex.compile(pattern).findall
        letters, numbers = "A-Za-zªµºÀ-ÖØ-öø-ŷ", "0-9²³¹¼-¾"
        # the same pattern with its classes spelt out for plain Latin text, which the faster module then splits
        plain = pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^\s{letters}{numbers}]").replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{numbers}]")
        self.find_plain = re.compile(plain).findall if r"\p" not in plain else self.find
        self.odd = re.compile(f"[^{PLAIN_LATIN}]").search
        self.halves: dict[bytes, tuple[int, ...]] = {}
        self.pairs: dict[tuple[int, int], tuple[int, ...]] = {}
        self.chunks: dict[str, bytes] = {}
        self.loose = re.compile(r" \s|\s |^ | $").search

    def merged(self, piece: bytes) -> tuple[int, ...]:
        """The merges themselves, lowest rank first, of the bytes of a window."""
        if len(piece) > 64:
            return self._merged_long(piece)
        parts = [piece[i : i + 1] for i in range(len(piece))]
        ranks = self.ranks
        while len(parts) > 1:
            found = [ranks.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:], strict=False)]
            least = min(found)
            if least == 1 << 60:
                break
            at = found.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return tuple(ranks[p] for p in parts)

    def _merged_long(self, piece: bytes) -> tuple[int, ...]:
        """The same with a queue, for windows that keep growing, as in long runs of one letter."""
        size, ranks = len(piece), self.ranks
        end, before, there = list(range(1, size + 1)), list(range(-1, size)), [True] * size
        queue = [(ranks[piece[i : i + 2]], i, i + 2) for i in range(size - 1) if piece[i : i + 2] in ranks]
        heapq.heapify(queue)
        while queue:
            _, i, stop = heapq.heappop(queue)
            if not there[i] or (j := end[i]) >= size or end[j] != stop:
                continue
            there[j], end[i], before[stop] = False, stop, i
            h = before[i]
            if h >= 0 and (rank := ranks.get(piece[h:stop])) is not None:
                heapq.heappush(queue, (rank, h, stop))
            if stop < size and (rank := ranks.get(piece[i : end[stop]])) is not None:
                heapq.heappush(queue, (rank, i, end[stop]))
        out, i = [], 0
        while i < size:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return tuple(out)

    def pair(self, left: int, right: int) -> tuple[int, ...]:
        key = (left, right)
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            found = self.pairs[key] = self.merged(self.bytes_of[left] + self.bytes_of[right])
        return found

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """The encoding of two texts in a row from their encodings."""
        if not left or not right:
            return left or right
        window = self.pair(left[-1], right[0])
        if window == (left[-1], right[0]):
            return left + right
        i, j = len(left) - 1, 1
        while True:
            grown = False
            if i and self.pair(left[i - 1], window[0]) != (left[i - 1], window[0]):
                i, grown = max(0, i - max(1, (len(left) - i))), True
            if j < len(right) and self.pair(window[-1], right[j]) != (window[-1], right[j]):
                j, grown = min(len(right), 2 * j), True
            if not grown:
                return left[:i] + window + right[j:]
            window = self.merged(b"".join(map(self.bytes_of.__getitem__, left[i:] + right[:j])))

    def piece(self, piece: bytes) -> tuple[int, ...]:
        """The encoding of one match of the pattern."""
        found = self.halves.get(piece)
        if found is not None:
            return found
        if len(piece) < 2:
            found = (self.ranks[piece],) if piece else ()
        else:
            half = len(piece) // 2
            found = self.join(self.piece(piece[:half]), self.piece(piece[half:]))
        if len(piece) <= 32:
            if len(self.halves) >= REMEMBERED:
                self.halves.clear()
            self.halves[piece] = found
        return found

    def matches(self, text: str) -> list[str]:
        return self.find(text) if self.odd(text) else self.find_plain(text)

    def _ids(self, text: str) -> bytes:
        ids: list[int] = []
        for match in self.matches(text):
            ids += self.piece(match.encode())
        return np.array(ids, np.int32).tobytes()

    def text(self, text: str) -> np.ndarray:
        """The ids of a whole text.

        A space between two characters that are no white space always begins a match, so the stretches between such
        spaces are encoded, and remembered, one by one. Texts with other white space around a space go in one piece.
        """
        if self.loose(text):
            return np.frombuffer(self._ids(text), np.int32)
        first, *stretches = text.split(" ")
        chunks = self.chunks
        out = list(map(chunks.get, stretches))
        for k, found in enumerate(out):
            if found is None:
                stretch = stretches[k]
                out[k] = found = self._ids(" " + stretch)
                if len(stretch) <= 64:
                    if len(chunks) >= REMEMBERED:
                        chunks.clear()
                    chunks[stretch] = found
        return np.frombuffer(self._ids(first) + b"".join(out), np.int32)


class TreeDecoder:
    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values(), default=-1) + 1
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])

    def ids(self, ids: np.ndarray, leaf: int = 1 << 16) -> bytes:
        """The bytes of ``ids``: halves are decoded and concatenated, leaves looked up in one step."""
        if len(ids) > leaf:
            half = len(ids) // 2
            return self.ids(ids[:half], leaf) + self.ids(ids[half:], leaf)
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        if not len(ends):
            return b""
        at = np.repeat(self.starts[ids] - ends + lengths, lengths) + np.arange(ends[-1])
        return self.flat[at].tobytes()


@functools.cache
def encoder(path: str) -> TreeEncoder:
    """One encoder for each worker process, which keeps what it has learned from task to task."""
    made = TreeEncoder(read_ranks(path))
    missing = [b for b in range(256) if bytes([b]) not in made.ranks]
    if missing:
        raise ValueError(f"{path} has no token for the bytes {missing[:8]}")
    return made


def unreachable(ranks: dict[bytes, int]) -> list[bytes]:
    """Tokens that merges never make; the method needs there to be none."""
    made = TreeEncoder(ranks)
    return [token for token, rank in ranks.items() if made.merged(token) != (rank,)]


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """key and ids (array of int) of every row's whole text.

    Null and empty texts give no ids. Rows are encoded one by one, repeated ones too; other columns are not read.
    """
    path = path or public_tokenizers.path(RANKS)

    def run(read: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches(read):
            made = [enc.text(t) if t else np.zeros(0, np.int32) for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("key"), _lists(made, pa.int32())], names=["key", "ids"])

    rows = docs.selectExpr(f"`{key}` AS key", f"`{text}` AS text")
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decode(encoded: DataFrame, key: str = "doc_id", ids: str = "ids", path: str | None = None) -> DataFrame:
    """key and bytes (binary) of every row's ids; null ids give null, no ids empty bytes."""
    path = path or public_tokenizers.path(RANKS)

    def run(read: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _decoder(path)
        for batch in batches(read):
            made = [None if v.as_py() is None else decoder.ids(v.values.to_numpy(zero_copy_only=False)) for v in batch.column("ids")]
            yield pa.record_batch([batch.column("key"), pa.array(made, pa.binary())], names=["key", "bytes"])

    rows = encoded.selectExpr(f"`{key}` AS key", f"`{ids}` AS ids")
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, bytes binary").withColumnRenamed("key", key)


def round_trip(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """key, ids and bytes: every text encoded, and its ids decoded again, in one pass."""
    path = path or public_tokenizers.path(RANKS)

    def run(read: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, decoder = encoder(path), _decoder(path)
        for batch in batches(read):
            ids = [enc.text(t) if t else np.zeros(0, np.int32) for t in batch.column("text").to_pylist()]
            back = pa.array([decoder.ids(x) for x in ids], pa.binary())
            yield pa.record_batch([batch.column("key"), _lists(ids, pa.int32()), back], names=["key", "ids", "bytes"])

    rows = docs.selectExpr(f"`{key}` AS key", f"`{text}` AS text")
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, ids array<int>, bytes binary").withColumnRenamed("key", key)


@functools.cache
def _decoder(path: str) -> TreeDecoder:
    return TreeDecoder(read_ranks(path))


def _lists(arrays: Iterable[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    arrays = list(arrays)
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays) if arrays else [], kind))
