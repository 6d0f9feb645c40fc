"""Packing of documents into training sequences by Karmarkar-Karp multiway differencing.

Documents become ids, and every full window's worth of ids from a document's start is a sequence of its own. The rest
of each document is cut into a few pieces, and the pieces of many documents are partitioned into windows: each piece
starts as a partial partition of which all windows but one are empty; the two partitions of the largest imbalance are
merged, fullest window onto emptiest, until one is left. Windows come out nearly equal, so that as few as the total
allows will do; whenever one exceeds the capacity, the number of windows rises.

Each task packs what it reads, in groups of bounded size. Nothing is shuffled or gathered, a group leaves less than one
window of padding besides what partitioning leaves, and a lost task repeats on its own.
"""

from __future__ import annotations

import functools
import heapq
import re
from collections.abc import Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from wardloom.llm.common import PLAIN_LATIN, batches

TOKENIZER = "word_bpe_49k.json"
REMEMBERED = 500_000


class WordTokenizer:
    """Ids by a tokenizer that drops white space and never joins what stands on its two sides.

    Stretches between white space are encoded, and remembered, one by one: plain Latin ones by the tokenizer's merge
    model for each of their words, others by the whole tokenizer. The strings of special tokens are ordinary text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        letters, numbers = "A-Za-zªµºÀ-ÖØ-öø-ŷ", "0-9²³¹¼-¾"
        self.words = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^\s{letters}{numbers}]+").findall
        self.odd = re.compile(f"[^{PLAIN_LATIN}]").search
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in set(shown)]
        self.shown = {b: b for b in shown} | {b: 256 + k for k, b in enumerate(hidden)}
        self.known_words: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}

    def word(self, word: str) -> bytes:
        found = self.known_words.get(word)
        if found is None:
            if len(self.known_words) >= REMEMBERED:
                self.known_words.clear()
            tokens = self.tokenizer.model.tokenize(word.encode().decode("latin-1").translate(self.shown))
            found = self.known_words[word] = np.array([t.id for t in tokens], "<u4").tobytes()
        return found

    def stretch(self, stretch: str) -> bytes:
        if self.odd(stretch):
            return np.array(self.tokenizer.encode(stretch, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.word, self.words(stretch.lower())))

    def text(self, text: str) -> bytes:
        """The ids of a whole text as little-endian unsigned 32-bit integers."""
        stretches = re.split("[ \t\n\r]+", text) if self.odd(text) else text.lower().split()
        known = self.known
        out = list(map(known.get, stretches))
        for k, found in enumerate(out):
            if found is None:
                out[k] = found = self.stretch(stretches[k])
                if len(stretches[k]) <= 64:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[stretches[k]] = found
        return b"".join(out)


@functools.cache
def tokenizer(path: str) -> WordTokenizer:
    """One tokenizer for each worker process, which keeps what it has learned from task to task."""
    return WordTokenizer(path)


def differencing(sizes: Sequence[int], windows: int) -> list[list[int]]:
    """The items of each of ``windows`` subsets with nearly equal sums, by multiway differencing.

    A partial partition lists its windows that hold anything, largest first, as (sum, items); items are nested pairs
    until the end.
    """
    if windows < 1:
        return []
    heap = [(-size, k, [(size, k)]) for k, size in enumerate(sizes)]
    heapq.heapify(heap)
    made = len(heap)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        over = max(0, len(a) + len(b) - windows)
        keep_a, keep_b = len(a) - over, len(b) - over
        # a's emptiest windows take b's fullest ones of those that find no empty window
        joined = [(x + y, (i, j)) for (x, i), (y, j) in zip(a[keep_a:], reversed(b[keep_b:]), strict=True)]
        merged = sorted(a[:keep_a] + b[:keep_b] + joined, key=lambda w: -w[0])
        least = merged[-1][0] if len(merged) == windows else 0
        heapq.heappush(heap, (least - merged[0][0], made, merged))
        made += 1
    out: list[list[int]] = []
    for _, tree in heap[0][2] if heap else []:
        items, stack = [], [tree]
        while stack:
            top = stack.pop()
            if isinstance(top, tuple):
                stack.extend(top)
            else:
                items.append(top)
        out.append(sorted(items))
    return out


def windows_for(sizes: Sequence[int], capacity: int) -> list[list[int]]:
    """The items of as few windows as differencing finds with no sum over ``capacity``."""
    count = -(-sum(sizes) // capacity)
    while True:
        parts = differencing(sizes, count)
        if all(sum(sizes[i] for i in items) <= capacity for items in parts):
            return parts
        count += 1


def pack(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = 4096,
    end_id: int = 2,
    grain: int = 512,
    group: int = 2048,
    path: str | None = None,
) -> DataFrame:
    """Pieces of the documents with their place: key, start, length, ids, doc_tokens, sequence_id, "offset".

    A document is its text's ids and ``end_id``; a null or empty text is ``end_id`` alone. ``ids`` holds a piece's ids as
    little-endian unsigned 32-bit integers. What a document has beyond full windows is cut into equal pieces of at most
    ``grain`` ids, and ``group`` such pieces at a time are partitioned. Rows are packed one by one, repeated ones and
    those with a null key too; other columns are not read. No rows give no sequences.
    """
    path = path or public_tokenizers.path(TOKENIZER)
    rows = docs.selectExpr(f"`{key}` AS key", f"`{text}` AS text")
    kind = rows.schema["key"].dataType.simpleString()

    def run(read: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = tokenizer(path), np.array([end_id], "<u4").tobytes()
        first = TaskContext.get().partitionId() << 33
        count, waiting, out, size = 0, [], [], 0

        def place(parts: list[tuple]) -> None:
            nonlocal count, size
            at = 0
            for key, start, ids, total in parts:
                out.append((key, start, len(ids) // 4, ids, total, first + count, at))
                at += len(ids) // 4
                size += len(ids)
            count += 1

        def partition() -> None:
            for items in windows_for([len(p[2]) // 4 for p in waiting], capacity):
                place([waiting[i] for i in items])
            waiting.clear()

        def flush() -> pa.RecordBatch:
            nonlocal size
            columns = list(zip(*out, strict=True))
            kinds = [batch_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            made = pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=NAMES)
            out.clear()
            size = 0
            return made

        batch_type = None
        for batch in batches(read):
            batch_type = batch.column("key").type
            for doc, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = (words.text(text) if text else b"") + end
                total = len(ids) // 4
                full = total - total % capacity
                for start in range(0, full, capacity):
                    place([(doc, start, ids[4 * start : 4 * (start + capacity)], total)])
                if rest := total - full:
                    cuts = [full + rest * k // -(-rest // grain) for k in range(-(-rest // grain) + 1)]
                    for a, b in zip(cuts, cuts[1:], strict=False):
                        waiting.append((doc, a, ids[4 * a : 4 * b], total))
                if len(waiting) >= group:
                    partition()
                if size > 4 << 20:
                    yield flush()
        if waiting:
            partition()
        if out:
            yield flush()

    return rows.mapInArrow(run, f"key {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long").withColumnRenamed("key", key)


NAMES = ["key", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
