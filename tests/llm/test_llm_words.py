"""Spelling variants, token alignment and exact dedup, against plain versions."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from wardloom.llm import alignment, exact_dedup, spelling
from wardloom.llm.common import join_by_weight, reachable
from wardloom.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
LONG = "lengthyword" * 9


@pytest.fixture(autouse=True)
def workers(spark):
    reachable(spark)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain_variants(data, every=199, letters=6, times=5):
    n = Counter()
    for key, text in data:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    words = {w: k for w, k in n.items() if len(w) >= letters and k >= times}
    near = {w: [] for w in words}
    for a, b in itertools.combinations(words, 2):
        if abs(len(a) - len(b)) < 2 and distance(a, b) == 1:
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 5 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return out


def variant_docs(alphabet, seed=1):
    rng = random.Random(seed)
    base = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(6, 9))) for _ in range(25)] + [LONG, "Straße", "ÉCOLEà"]
    words = []
    for w in base:
        words += [w] * rng.choice([5, 40, 300])
        for _ in range(12):
            k = rng.randrange(len(w))
            other = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice(alphabet) + w[k:], w[:k] + rng.choice(alphabet) + w[k + 1 :]])
            words += [other] * rng.choice([3, 5, 9, 60])
    rng.shuffle(words)
    data = [(k, rng.choice([" ", ", ", "1"]).join(words[k::40])) for k in range(40)]
    return [*data, (None, "Nobody " * 9), (None, "nobody " * 5), (50, None), (51, ""), (52, "tiny x é"), (53, "×÷ÀÿĀ" * 30), (54, data[0][1]), (54, data[0][1])]


@pytest.mark.parametrize("alphabet", ["abcdefghijklmnopqrstuvwxyzéü", "ab"])
@pytest.mark.parametrize("crowd", [spelling.CROWD, 3])
def test_variants_against_brute_force(spark, alphabet, crowd):
    data = variant_docs(alphabet)
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in data], "doc_id long, text string, word string, n int").repartition(5)
    got = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(docs, every=7, crowd=crowd).collect()]
    assert len(got) == len(set(got))
    assert set(got) == plain_variants(data, every=7)
    assert sum(r[4] for r in got) > 100
    assert spelling.variants(docs.limit(0)).count() == 0


def test_roots_follow_forms(spark):
    n = {"abcdef": 5, "abcdeg": 25, "abcdhg": 125, "abcihg": 625, "xbcihg": 124, "xbcihgg": 600}
    docs = spark.createDataFrame([(1, " ".join(" ".join([w] * k) for w, k in n.items()))], "doc_id long, text string")
    got = {r.word: (r.form, r.root) for r in spelling.variants(docs, every=10**9).collect()}
    assert got["abcdef"] == ("abcdeg", "abcihg") and got["abcdhg"] == ("abcihg", "abcihg")
    assert got["xbcihg"] == ("abcihg", "abcihg") and got["xbcihgg"] == (None, "xbcihgg")


def test_long_texts_are_cut_between_runs():
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefgé  ,7") for _ in range(5000))
    parts = list(spelling._stretches(text, 50))
    assert len(parts) > 50 and "".join(parts) == text
    assert [r for p in parts for r in spelling.RUN.findall(p)] == spelling.RUN.findall(text)


@pytest.mark.parametrize("word", ["abcabc", LONG, "x" * 64, "xy" * 32 + "z"])
def test_what_is_left_of_words(word):
    for at, rest in spelling.left_out(word, set(word)):
        assert rest == spelling.whole(word[:at] + word[at + 1 :])
    assert len(list(spelling.left_out(word, set(word)))) == len(word)


def test_spelling_query_against_brute_force(spark):
    folder = SMALL
    data = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in QUERIES["op11_spelling_variants"](spark, folder).collect()}
    assert got == plain_variants(data)


def plain_alignment(data):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    byte_of = alignment._byte_of()
    rows = []
    for key, text in data:
        ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids
        ids_b = b.encode(text or "")
        bytes_a = [bytes(byte_of[c] for c in a.id_to_token(k)) for k in ids_a]
        bytes_b = [re.sub(r"^<0x(..)>$", lambda m: chr(int(m[1], 16)), p).encode("latin-1") if re.match("<0x..>$", p) else p.replace("▁", " ").encode() for p in b.id_to_piece(ids_b)]
        if not text or b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            rows.append((key, [], [], [], ""))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        links = [(ids_a[ends_a.index(e)], ids_b[ends_b.index(e)]) for e in sorted(set(ends_a) & set(ends_b))]
        groups, i, j = [], 0, 0
        for e in sorted(set(ends_a) & set(ends_b)):
            x, y = ends_a.index(e) + 1, ends_b.index(e) + 1
            groups.append(",".join(map(str, ids_a[i:x])) + "|" + ",".join(map(str, ids_b[j:y])))
            i, j = x, y
        rows.append((key, ids_a, ids_b, links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    count = Counter(p for r in rows for p in r[3])
    top = Counter()
    for (_, y), n in count.items():
        top[y] = max(top[y], n)
    return sorted(
        (str(k), len(x), len(y), len(z), len(z), sum(count[p] == top[p[1]] for p in z), sum(count[p] for p in z), s) for k, x, y, z, s in rows
    )


def aligned_rows(df):
    return sorted((str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect())


def odd_texts():
    return [None, "", " ", "a", "two  spaces", " lead", "trail ", "tab\tand\nlines\n\n", "</s> <s> <|endoftext|> <0x41>", "▁ mark", "日本語 テキスト 😀😀", "á é", "\x00\x01", "naïve café", "'s 't we're", "same text", "same text", "x" * 300, "　wide"]


@pytest.mark.parametrize("frequent", [alignment.FREQUENT, 1, 20])
def test_alignment_against_plain_version(spark, frequent):
    data = list(enumerate(odd_texts())) + [(None, "no key here"), (3, "a")]
    docs = spark.createDataFrame([(k, t, 7, [1]) for k, t in data], "doc_id long, text string, row int, pairs array<int>").repartition(3)
    assert aligned_rows(alignment.align(docs, frequent=frequent)) == plain_alignment(data)
    assert alignment.align(docs.limit(0)).count() == 0


def test_alignment_query_against_plain_version(spark):
    data = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    df = QUERIES["op12_alignment"](spark, SMALL)
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert aligned_rows(df) == plain_alignment(data)


def test_segments_change_no_ids():
    rng = random.Random(4)
    both = alignment.tokens(public_tokenizers.path(alignment.A_FILE), public_tokenizers.path(alignment.B_FILE))
    for _ in range(30):
        text = "".join(rng.choice(["a", "the", "ing", " ", " ", " ", "\n", "é", "12", "'s", "▁", "<", ".", "日", "　", "\x1c"]) for _ in range(400))
        parts = list(alignment.segments(text, 20))
        assert " ".join(parts) == text
        assert sum((both.a.encode_ordinary(" " + p) for p in parts), []) == both.a.encode_ordinary(" " + text)
        assert sum((both.b.encode(p) for p in parts), []) == both.b.encode(text)


def test_ids_are_those_of_the_tokenizer_file():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path(alignment.A_FILE))
    whole.encode_special_tokens = True
    own = alignment.tokens(public_tokenizers.path(alignment.A_FILE), public_tokenizers.path(alignment.B_FILE)).a
    rng = random.Random(8)
    texts = [f"a{chr(c)}1 {chr(c)}{chr(c)}" for c in range(0x3000)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xD800), rng.randrange(0x10000, 0x32000)])) for _ in range(60)) for _ in range(500)]
    texts += [t for t in odd_texts() if t]
    for text in texts:
        assert own.encode_ordinary(text) == whole.encode(text, add_special_tokens=False).ids


def test_no_piece_reaches_over_a_space():
    both = alignment.tokens(public_tokenizers.path(alignment.A_FILE), public_tokenizers.path(alignment.B_FILE))
    assert not any(re.search(r"\S \S", x.decode("utf-8", "ignore")) for x in [*both.bytes_a, *both.bytes_b])


def test_pointers_lead_to_the_last_token():
    rng = np.random.default_rng(3)
    for n in (1, 5, 200):
        a, b = (np.append(np.flatnonzero(rng.random(n) < 0.4), n) + 1 for _ in range(2))
        last_a, last_b = alignment.terminals(a, b)
        common = np.intersect1d(a, b)
        for ends, last in ((a, last_a), (b, last_b)):
            assert last.tolist() == common[np.searchsorted(common, ends)].tolist()
    chain = alignment.terminals(np.append(np.arange(1, 4000, 2), 4001), np.append(np.arange(2, 4000, 2), 4001))
    assert all((x == 4001).all() for x in chain)


def copies():
    rng = random.Random(6)
    texts = [f"text {k}" for k in range(300)] + ["copied text"] * 150 + ["a", "A", "a ", " a", "a\n", "a\x00", "é", "é", "", "long " * 50_000, "long " * 50_000]
    data = list(enumerate(texts, 1)) + [(1000 + k, texts[rng.randrange(300)]) for k in range(100)]
    return [*data, (5000, None), (None, None), (None, "only null ids"), (None, "only null ids"), (7, "text 6"), (7, "text 6"), (None, "text 6"), (7, "other")]


@pytest.mark.parametrize("bits", [64, 3, 1])
@pytest.mark.parametrize("capacity", [exact_dedup.CAPACITY, 4])
def test_exact_duplicates_against_plain_version(spark, monkeypatch, bits, capacity):
    monkeypatch.setattr(exact_dedup, "HELD", 20_000)
    data = copies()
    docs = spark.createDataFrame([(k, t, "k", 0) for k, t in data], "doc_id long, text string, key string, n int").repartition(4)
    got = exact_dedup.exact_duplicates(docs, bits=bits, capacity=capacity).collect()
    groups = {}
    for k, t in data:
        groups.setdefault(t or "", []).append(k)
    digest = {t: hashlib.sha256(t.encode()).hexdigest() for t in groups}
    top = {t: max((k for k in ids if k is not None), default=None) for t, ids in groups.items()}
    expected = Counter((k, top[t or ""], len(groups[t or ""]), digest[t or ""]) for k, t in data)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == expected
    kept = Counter((r.doc_id, r.text_sha256) for r in got if r.kept)
    assert kept == Counter((top[t], digest[t]) for t in groups)
    assert exact_dedup.exact_duplicates(docs.limit(0)).count() == 0


def test_directory_splits_overfull_buckets(spark):
    rng = np.random.default_rng(1)
    keys = np.unique(np.concatenate([rng.integers(-(1 << 63), 1 << 63, 3000), (1 << 62) + rng.integers(0, 1 << 50, 500)]))
    places = exact_dedup.directory(spark.createDataFrame([(int(k),) for k in keys], "key long"), capacity=100, buckets=64, doublings=6)
    bits = len(places).bit_length() - 1
    assert len(places) == 1 << bits and (np.diff(places) >= 0).all()
    prefix = ((keys.view(np.uint64) ^ np.uint64(1 << 63)) >> np.uint64(64 - bits)).astype(np.int64)
    load = np.bincount(places[prefix])
    cells = np.bincount(places)
    # a bucket is over its capacity only where no further doubling was to be had
    assert all(n <= 2 * len(keys) // 64 + 2 or cells[k] == 1 for k, n in enumerate(load) if n > 100)
    # buckets are aligned ranges of a power of two
    for k, n in enumerate(cells):
        at = np.flatnonzero(places == k)
        assert n & (n - 1) == 0 and at[0] % n == 0
    assert (np.sort(places[prefix[np.argsort(keys)]]) == places[prefix[np.argsort(keys)]]).all()
    assert len(exact_dedup.directory(spark.createDataFrame([], "key long"))) == 1 << exact_dedup.DOUBLINGS


def test_join_by_weight(spark):
    rows = spark.createDataFrame([(k % 7 if k < 70 else 100, k) for k in range(200)], "a long, k long")
    groups = spark.createDataFrame([(100, 130, "hot"), (3, 10, "three"), (9, 0, "none")], "b long, n long, name string")
    for most in (1, 3, 1000):
        got = {r.k: r.name for r in join_by_weight(rows, groups, rows["a"] == groups["b"], "n", 200, most).collect()}
        assert got == {k: "hot" if k >= 70 else "three" if k % 7 == 3 else None for k in range(200)}
