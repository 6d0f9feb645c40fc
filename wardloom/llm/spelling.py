"""Spelling variants by PartEnum.

Words that differ by one inserted, deleted or replaced letter have letter multisets that, as binary vectors, are at a Hamming
distance of at most two. Letters are dealt into parts; whichever two parts are left out, what remains of a word is a
signature, and words at that distance agree in at least one of them. As only one edit is looked for, the signature keeps the
letters of the remaining parts in their order, which the edit does not change. Words are joined on equal signatures
and verified.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Hashable, Iterable, Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardloom.llm.common import batches, settle

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Parts of the alphabet; of a word each signature leaves out two.
PARTS = 7
#: Words of a signature that one task compares in memory; larger groups are dealt by what is left when a letter goes.
CROWD = 20_000
#: Words up to this length are compared as they are, longer ones by hashes first.
PLAIN = 64
#: Characters of a text that are searched at once; different words that a task counts before it hands them on.
STRETCH, COUNTED = 1 << 20, 200_000


def _stretches(text: str, size: int = STRETCH) -> Iterator[str]:
    """Parts of a text that no run reaches across."""
    start = 0
    while len(text) - start > size:
        run = RUN.match(text, start + size)
        end = run.end() if run else start + size
        yield text[start:end]
        start = end
    yield text[start:]


def words_of(key: object, text: str, every: int) -> Iterator[tuple[str, int]]:
    """The words of one text with their times: runs of letters, A-Z lower-cased.

    Of a run ``w`` with h = crc32("<key>:<w>"), the letter at h % length is left out if ``every`` divides h.
    """
    runs: Counter[str] = Counter()
    for part in _stretches(text):
        runs.update(RUN.findall(part.encode().lower().decode()))  # bytes: A-Z only
    start = zlib.crc32(f"{'' if key is None else key}:".encode())
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), start)
        if h % every == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        yield run, n


def count_words(docs: DataFrame, key: str, text: str, every: int, letters: int, times: int) -> DataFrame:
    """word, n of the words of at least ``letters`` letters that occur ``times`` times or more."""

    def run(read: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()

        def said() -> pa.RecordBatch:
            return pa.record_batch([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])

        for batch in batches(read):
            for k, body in zip(batch.column("key").to_pylist(), batch.column("body").to_pylist(), strict=True):
                for word, n in words_of(k, body or "", every):
                    if len(word) >= letters:
                        found[word] += n
                if len(found) > COUNTED:
                    yield said()
                    found.clear()
        if found:
            yield said()

    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("body"))
    counted = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= times)


def deal_letters(frequency: dict[str, int], parts: int) -> dict[str, int]:
    """The part of each letter, so that all parts hold about as many letters of words."""
    load, part = [0] * parts, {}
    for letter in sorted(frequency, key=lambda c: (-frequency[c], c)):
        part[letter] = load.index(min(load))
        load[part[letter]] += frequency[letter]
    return part


_PRIME, _BASE = (1 << 61) - 1, 1_000_003
_INVERSE = pow(_BASE, -1, _PRIME)


def left_out(word: str, letters: Iterable[str]) -> Iterator[tuple[int, Hashable]]:
    """Places of the given letters in a word, each with what is left without it: the rest, or a hash of it for long words."""
    letters = set(letters)
    if len(word) <= PLAIN:
        for at, c in enumerate(word):
            if c in letters:
                yield at, word[:at] + word[at + 1 :]
        return
    before = 0
    after = 0
    for c in reversed(word[1:]):
        after = (after * _BASE + ord(c)) % _PRIME
    power = 1
    for at, c in enumerate(word):
        if c in letters:
            yield at, (len(word) - 1, (before + after * power) % _PRIME)
        before = (before + ord(c) * power) % _PRIME
        power = power * _BASE % _PRIME
        if at + 1 < len(word):
            # the rest after the next letter, moved by one place
            after = (after - ord(word[at + 1])) * _INVERSE % _PRIME


def whole(word: str) -> Hashable:
    """What ``left_out`` gives for a longer word of which ``word`` is left."""
    if len(word) + 1 <= PLAIN:
        return word
    value = 0
    for c in reversed(word):
        value = (value * _BASE + ord(c)) % _PRIME
    return len(word), value


def one_edit(a: str, b: str) -> bool:
    """Whether two words differ by exactly one inserted, deleted or replaced letter."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


class Partition:
    """The parts of the alphabet and the signatures, each of which leaves out two parts."""

    def __init__(self, part: dict[str, int], parts: int = PARTS) -> None:
        self.part = part
        self.out = list(combinations(range(parts), 2))
        self.letters = ["".join(sorted(c for c in part if part[c] in out)) for out in self.out]
        sets = [frozenset(x) for r in (1, 2) for x in combinations(range(parts), r)]
        #: where a pair counts whose edit touches these parts: the first signature that leaves all of them out
        self.first = {s: next(k for k, out in enumerate(self.out) if s <= set(out)) for s in sets}

    def near(self, words: list[str], number: int) -> Iterator[tuple[int, int]]:
        """Places of the pairs of ``words`` of one signature that one edit makes equal and that count in it.

        In proportion to the words and the pairs: a pair meets under what is left without the letter that differs.
        """
        part, letters, first = self.part, self.letters[number], self.first
        places = {whole(w): k for k, w in enumerate(words)}
        replaced: dict[tuple, list[int]] = {}
        for k, word in enumerate(words):
            shorter = set()
            for at, rest in left_out(word, letters):
                if (other := places.get(rest)) is not None and other not in shorter:
                    shorter.add(other)
                    if first[frozenset((part[word[at]],))] == number and one_edit(word, words[other]):
                        yield other, k
                for other in (met := replaced.setdefault((at, rest), [])):
                    both = frozenset((part[word[at]], part[words[other][at]]))
                    if first[both] == number and one_edit(word, words[other]):
                        yield other, k
                met.append(k)


def _pairs(dealt: DataFrame, partition: Partition, crowd: int | None) -> DataFrame:
    """a, n_a, b, n_b of near pairs from rows in the order of their groups; words of crowded groups come with b null."""

    def run(read: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        group, held, crowded = None, [], False

        def close() -> None:
            if len(held) > 1:
                words = [w for w, _ in held]
                found.extend((group[0], *held[i], *held[j]) for i, j in partition.near(words, group[0]))

        def said() -> pa.RecordBatch:
            columns = zip(*found, strict=True) if found else [[]] * 5
            kinds = [pa.int32(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            made = [pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)]
            found.clear()
            return pa.record_batch(made, names=["number", "a", "n_a", "b", "n_b"])

        for batch in batches(read):
            columns = [batch.column(c).to_pylist() for c in ("number", "signature", "word", "n")]
            for number, signature, word, n in zip(*columns, strict=True):
                if (number, signature) != group:
                    close()
                    group, held, crowded = (number, signature), [], False
                if not crowded and crowd is not None and len(held) == crowd:
                    crowded = True
                    found.extend((number, *x, None, None) for x in held)
                    held = []
                if crowded:
                    found.append((number, word, n, None, None))
                else:
                    held.append((word, n))
                if len(found) > 50_000:
                    yield said()
            if found:
                yield said()
        close()
        if found:
            yield said()

    return dealt.select("number", "signature", "word", "n").mapInArrow(run, "number int, a string, n_a long, b string, n_b long")


def near_words(words: DataFrame, parts: int = PARTS, crowd: int = CROWD) -> DataFrame:
    """a, n_a, b, n_b: each pair of near ``words`` (word, n) once."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").agg(F.count("*").alias("n"))
    partition = Partition(deal_letters({r.letter: r.n for r in letters.collect()}, parts), parts)
    made = [F.xxhash64(F.translate("word", out, "") if out else F.col("word")) for out in partition.letters]
    signed = words.select("word", "n", F.posexplode(F.array(*made)).alias("number", "signature"))
    first = settle(_pairs(signed.repartition("number", "signature").sortWithinPartitions("number", "signature"), partition, crowd))

    def dealt(read: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(read, 1 << 20):
            rows: list[tuple] = []
            for number, word, n in zip(*(batch.column(c).to_pylist() for c in ("number", "a", "n_a")), strict=True):
                rests = {whole(word)} | {rest for _, rest in left_out(word, partition.letters[number])}
                rows += [(number, zlib.crc32(repr(r).encode()), word, n) for r in rests]
                if len(rows) > 50_000:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)

    crowded = first.filter("b IS NULL").mapInArrow(dealt, "number int, signature long, word string, n long")
    again = crowded.distinct().repartition("number", "signature").sortWithinPartitions("number", "signature")
    # a pair may meet under several hashes here
    rest = _pairs(again, partition, None).distinct()
    return first.filter("b IS NOT NULL").unionByName(rest).drop("number")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.string(), pa.int64()]
    columns = [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.record_batch(columns, names=["number", "signature", "word", "n"])


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", every: int = 199, letters: int = 6, times: int = 5, ratio: int = 5, parts: int = PARTS, crowd: int = CROWD) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word of at least ``letters`` letters and ``times`` occurrences.

    Words are runs of ASCII letters and of U+00C0 to U+00FF with A-Z in lower case; see ``words_of`` for the letters left
    out, a null key counting as empty. Two words are near if one edit makes them equal. ``form`` is the near word of largest n,
    of equal ones the first in code-point order, if that n is at least ``ratio`` (2 or more) times the word's; ``root`` is where forms
    lead from the word. Null and empty texts have no words, repeated rows count each, texts and words may be of any
    length, and an empty table gives an empty one. Other columns, whatever their names, are not read.
    """
    words = settle(count_words(docs, key, text, every, letters, times))
    links = settle(near_words(words, parts, crowd))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("n_b").alias("n_a"), F.col("a").alias("b"), F.col("n_a").alias("n_b")))
    best = F.min(F.struct((-F.col("n_b")).alias("less"), "b"))
    near = both.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), best.alias("best"))
    is_form = -F.col("best.less") >= ratio * F.col("n")
    found = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best.b")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")
    )
    found = settle(found)
    # occurrences grow with each step, so the steps that a pointer spans double until none leads on
    steps = settle(found.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        moved = settle(steps.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("moved")))
        steps = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            break
    return found.join(steps, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
