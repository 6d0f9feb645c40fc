"""The operators that work on single texts, against their definitions and other libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from wardloom.llm import byte_bpe, fingerprint, language_id, line_dedup, minhash, packing, quality, sampling, toxicity, url_filter
from wardloom.llm.common import reachable, shingle_hashes, utf8, word_hashes
from wardloom.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
ALPHABETS = ["abcdefgh ", "aaab", " \n\t\r", "éèß ñ漢字かな", "0123 9", "!?.,'s\"", "the an in er ", "Σσς İı", "\x1c\x85\xa0 x"]


@pytest.fixture(autouse=True)
def workers(spark):
    reachable(spark)


def some_texts(count, seed=1):
    rng = random.Random(seed)
    for _ in range(count):
        letters = rng.choice(ALPHABETS) + rng.choice(ALPHABETS)
        yield "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 3, 20, 200])))


def odd_rows(spark):
    """Nulls in every column, empty and long texts, repeated rows, and a column whose name an operator uses."""
    texts = [None, "", " \n ", "word", "word", "a b c d e f g", "x" * 60_000, "no. 1\n\nno. 2", "1234 !!"]
    data = [(k, t, "en", "s", k) for k, t in enumerate(texts)] + [(None, "lost id", None, None, None), (3, "word", "en", "s", 3)]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, key int")


def no_rows(spark):
    return odd_rows(spark).limit(0)


def test_byte_bpe_is_that_of_the_library():
    ranks = byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.RANKS))
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder, decoder = byte_bpe.TreeEncoder(ranks), byte_bpe.TreeDecoder(ranks)
    assert byte_bpe.unreachable(ranks) == []
    for text in [*some_texts(1500), "ab" * 20_000 + "xyz" * 9_000, "<|endoftext|>"]:
        ids = encoder.text(text)
        assert ids.tolist() == library.encode_ordinary(text)
        assert decoder.ids(ids, leaf=50) == text.encode()


def test_byte_bpe_rows(spark):
    got = byte_bpe.round_trip(odd_rows(spark)).collect()
    assert len(got) == 11 and all((r.ids == []) == (r.bytes == b"") for r in got)
    encoded = byte_bpe.encode(odd_rows(spark))
    back = {r.doc_id: bytes(r.bytes) for r in byte_bpe.decode(encoded).collect()}
    assert back[6] == b"x" * 60_000 and back[None] == b"lost id"
    assert byte_bpe.round_trip(no_rows(spark)).count() == 0


def test_word_tokens_are_those_of_the_library():
    path = public_tokenizers.path(packing.TOKENIZER)
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    words = packing.WordTokenizer(path)
    for text in [*some_texts(1500, 2), "a<|endoftext|>b ||| <|startoftext|>"]:
        assert np.frombuffer(words.text(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_differencing_keeps_items_and_balances():
    rng = random.Random(4)
    sizes = [rng.randint(1, 512) for _ in range(600)]
    parts = packing.differencing(sizes, 40)
    assert sorted(i for p in parts for i in p) == list(range(600))
    sums = [sum(sizes[i] for i in p) for p in parts]
    assert max(sums) - min(sums) < 10
    assert packing.differencing([], 3) == [] and packing.windows_for([], 10) == []
    assert len(packing.windows_for([7, 7, 7], 10)) == 3  # three would fit two windows by their sum


def test_packing_of_rows(spark):
    def check(df, padding):
        library = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
        library.encode_special_tokens = True
        pieces = packing.pack(df).toPandas()
        expected = sorted(
            (-1 if r.doc_id is None else r.doc_id, (library.encode(r.text, add_special_tokens=False).ids if r.text else []) + [2])
            for r in df.collect()
        )
        # copies of a row follow one another by their pieces' starts
        documents = {}
        for p in pieces.sort_values(["doc_id", "sequence_id", "start"]).itertuples():
            documents.setdefault((-1 if np.isnan(p.doc_id) else int(p.doc_id)), []).append((p.start, np.frombuffer(p.ids, "<u4").tolist(), p.doc_tokens))
        for doc, ids in expected:
            held = [x for x in documents[doc] if x[2] == len(ids)]
            firsts = dict((s, t) for s, t, _ in held)
            assert [i for s in sorted(firsts) for i in firsts[s]] == ids
        assert pieces.length.sum() == sum(len(ids) for _, ids in expected)
        windows = pieces.groupby("sequence_id")
        assert windows.length.sum().max() <= 4096
        for _, w in windows:
            w = w.sort_values("offset")
            assert (w.offset.to_numpy() == np.concatenate([[0], w.length.cumsum().to_numpy()[:-1]])).all()
        assert windows.ngroups * 4096 - pieces.length.sum() < padding

    check(odd_rows(spark).coalesce(1), 4096)
    check(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").coalesce(1), 2 * 4096)
    assert packing.pack(no_rows(spark)).count() == 0


def words(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    return [w for w in lowered.split(" ") if w]


def test_words_and_shingles():
    texts = [*some_texts(400, 5), None, "A b", "a B", "a\x0bb", "a\x85b"]
    hashes, first = word_hashes(*utf8(pa.array(texts)))
    known = {}
    for text, a, b in zip(texts, first, first[1:]):
        assert len(words(text)) == b - a
        for w, h in zip(words(text), hashes[a:b]):
            assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known)
    threes, at = shingle_hashes(hashes, first, 3)
    for text, a, b in zip(texts, at, at[1:]):
        w = words(text)
        runs = {tuple(w[k : k + 3]) for k in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} - {()}
        assert len(set(threes[a:b])) == len(runs)


def test_circulant_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 1200).astype(np.uint64)
    a, b = base[:1000], base[200:]
    signed = minhash.signatures(np.concatenate([a, b]), np.array([0, 1000, 2000]), 1024)
    assert abs((signed[0] == signed[1]).mean() - 800 / 1200) < 0.06
    values = np.arange(1 << 16, dtype=np.uint32)
    assert len(np.unique(minhash.permuted(values, np.empty_like(values), np.empty_like(values)))) == 1 << 16


def test_fingerprints(spark):
    rng = random.Random(2)
    vocabulary = [f"w{k}" for k in range(5000)]
    text = [rng.choice(vocabulary) for _ in range(3000)]
    a, b, c = (" ".join(x) for x in (text[:2400], text[600:], text))
    one, two, whole = fingerprint.sketches(pa.array([a, b, c]))
    assert abs(fingerprint.resemblance(one, two) - 0.6) < 0.15
    assert fingerprint.containment(one, whole) > 0.85
    assert abs(fingerprint.distinct(whole) / 2996 - 1) < 0.3
    empty = fingerprint.sketches(pa.array(["", None]))
    assert [fingerprint.resemblance(*empty), fingerprint.resemblance(empty[0], one)] == [1.0, 0.0]
    assert (fingerprint.from_text(fingerprint.to_text(one)) == one).all()
    parts = spark.createDataFrame([("g", " ".join(text[:1504])), ("g", " ".join(text[1500:])), ("e", ""), ("g", None)], "g string, text string")
    prints = fingerprint.fingerprints(parts.withColumnRenamed("g", "doc_id"))
    merged = {r.doc_id: r.fingerprint for r in fingerprint.merged(prints, "doc_id").collect()}
    assert merged == {"g": fingerprint.to_text(whole)}


def test_edited_texts_follow_the_order(spark):
    got = fingerprint.edited_likeness(odd_rows(spark)).collect()
    data = sorted(((-1 if r.doc_id is None else r.doc_id, r.text or "") for r in odd_rows(spark).collect()), key=lambda x: (-x[0], x[1]))
    expected = []
    for k, (doc, text) in enumerate(data):
        third = len(text) // 3
        edited = text[: len(text) - third] + data[(k + 1) % len(data)][1][:third]
        expected.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_chars, r.edited_sha256) for r in got) == sorted(expected)
    assert fingerprint.edited_likeness(no_rows(spark)).count() == 0
    nulls = spark.createDataFrame([(None, "a b"), (None, "c")], "doc_id long, text string")
    assert fingerprint.edited_likeness(nulls).count() == 2


def test_url_rules(spark):
    data = [
        (1, None, "", "", None, "allow"),
        (2, "no scheme", "", "", None, "allow"),
        (3, "HTTP://A.NET", "a.net", "", None, "allow"),
        (4, "x://A.net/?a", "a.net", "/", "net/", "block"),
        (5, "x://a.example.net/en/q#", "a.example.net", "/en/q", "example.net/en/", "allow"),
        (6, "x://anet/", "anet", "/", None, "allow"),
        (7, "a://org/fr/b", "org", "/fr/b", "org/fr/", "allow"),
        (8, "a://example.com/de", "example.com", "/de", None, "allow"),
        (9, "a://www.cheap-pills.example.com/x", "www.cheap-pills.example.com", "/x", None, "block"),
        (9, "a://www.cheap-pills.example.com/x", "www.cheap-pills.example.com", "/x", None, "block"),
        (None, "a://b?c://net/", "b", "", None, "allow"),
    ]
    pages = spark.createDataFrame([(d[0], d[1], "t") for d in data], "page_id int, url string, token string")
    got = url_filter.judge(pages).drop("pattern").collect()
    expected = [(d[0], *d[2:]) for d in data]
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_rules_are_filed_by_their_rarest_token():
    index = url_filter.RuleIndex(url_filter.SITE_RULES, {"net": 50, "example": 90, "en": 3, "com": 9, "de": 10, "org": 1, "fr": 1})
    assert {t: [r.name for r in rs] for t, rs in index.filed.items()} == {
        "net": ["net/"], "en": ["example.net/en/"], "com": ["example.com/de/"], "fr": ["org/fr/"]
    }


def test_where_a_rule_is_filed_follows_the_counts(spark):
    urls = ["x://casino.a.com/", "x://casino.b.com/", "x://win.c.com/", "x://m.casino-win.d.com/", "x://e.com/buy-links/1", "x://e.com/links/", "x://e.com/a/buy-links/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    for word, other in (("win", "casino"), ("casino", "win")):
        more = spark.createDataFrame([(100 + k, f"x://{other}{'.' * (k % 2)}{k % 2}.com/") for k in range(10)], pages.schema)
        counts = url_filter.token_counts(pages.union(more), "url", url_filter.PATTERN_RULES)
        index = url_filter.RuleIndex(url_filter.PATTERN_RULES, counts)
        assert "casino-win." in [r.name for r in index.filed[word]]
    got = {r.page_id: (r.verdict, r.pattern) for r in url_filter.judge(pages).collect()}
    assert got == {0: ("allow", None), 1: ("allow", None), 2: ("allow", None), 3: ("block", "casino-win."), 4: ("block", "/buy-links/"), 5: ("allow", None), 6: ("allow", None)}


def test_samples_are_the_first_by_hash(spark):
    rows = [(k, "a" if k % 3 else "b") for k in range(3000)] + [(k, "c") for k in range(5000, 5020)] + [(None, "a"), (7, None)] + [(5, "b")] * 50
    df = spark.createDataFrame(rows, "id long, label string")
    got = sampling.sample_keys(df.filter("id <> 5 OR label = 'b'"), "id", "label", 5, 0, 100)
    hashes = {r.id: r.h for r in df.selectExpr("id", "xxhash64(id) h").collect()}
    for label, most in (("a", 100), ("b", 100), ("c", 100)):
        usable = {k for k, x in rows if k is not None and x == label and zlib.crc32(str(k).encode()) % 5 and (k != 5 or label == "b")}
        assert [k for k, x in got.items() if x == label] == sorted(usable, key=lambda k: hashes[k])[:most] or {k for k, x in got.items() if x == label} == set(sorted(usable, key=lambda k: hashes[k])[:most])
    assert sampling.sample_keys(df.limit(0), "id", "label", 5, 0, 10) == {}


@pytest.fixture(scope="module")
def labelled(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return docs, spark.read.parquet("/root/testdata/sf0.01/labels.parquet")


def test_language_held_out(spark, labelled):
    docs, _ = labelled
    network = language_id.fit(docs)
    got = language_id.predict(docs, network).join(docs, "doc_id").filter("held_out")
    assert got.filter("lang_pred = lang").count() / got.count() > 0.95
    rows = language_id.predict(odd_rows(spark), network).collect()
    assert len(rows) == 11 and {r.doc_id for r in rows if r.lang_pred == "und"} == {0, 1, 2, 8}
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert language_id.fit(no_rows(spark)) is None
    assert {r.lang_pred for r in language_id.predict(odd_rows(spark), None).collect()} == {"und"}


def test_table_reader_agrees_with_the_network():
    rng = np.random.default_rng(0)
    windows = rng.integers(0, 256, (20, language_id.WINDOW)).astype(np.uint8)
    net = language_id.train(windows, rng.integers(0, 2, 20), ["a", "b"], epochs=1)
    pooled = []
    for w in language_id.WIDTHS:
        seen = net.embedding[windows]
        n = windows.shape[1] - w + 1
        pooled.append((sum(seen[:, j : j + n] @ net.filters[w][j] for j in range(w)) + net.biases[w]).max(1))
    x = np.exp(np.tanh(np.concatenate(pooled, 1)) @ net.dense + net.offset)
    assert np.allclose(language_id.Reader(net).windows(windows), x / x.sum(1, keepdims=True), atol=1e-4)


def test_quality_held_out(spark, labelled):
    docs, labels = labelled
    model = quality.fit(docs, labels)
    assert 0.5 < model.prior < 0.98
    got = quality.score(docs, model).join(labels, "doc_id").filter("held_out")
    assert got.filter("predicted = quality").count() / got.count() > 0.9
    assert quality.score(odd_rows(spark), model).count() == 11
    assert quality.fit(no_rows(spark), labels) is None and quality.fit(docs, labels.limit(0)) is None
    assert {r.score for r in quality.score(odd_rows(spark), None).collect()} == {0.5}


def test_toxicity_held_out(spark, labelled):
    docs, labels = labelled
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model).join(labels, "doc_id").filter("held_out")
    assert got.filter("predicted = 1 AND toxic = 0").count() <= 0.02 * got.count()
    insults = spark.createDataFrame([(1, "You stupid idiot, what trash."), (2, "A fine day in town.")], "doc_id long, text string")
    assert {r.doc_id: r.predicted for r in toxicity.score(insults, model).collect()} == {1: 1, 2: 0}
    assert toxicity.score(odd_rows(spark), model).count() == 11
    assert toxicity.fit(no_rows(spark), labels) is None
    assert {r.score for r in toxicity.score(odd_rows(spark), None).collect()} == {0.0}


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(3)
    truth = rng.random(6000) < 0.2
    fires = np.array([[0.02, 0.01, 0.05, 0.05], [0.6, 0.4, 0.5, 0.5]])
    votes = (rng.random((6000, 4)) < fires[truth.astype(int)]).astype(np.float32)
    votes[:, 3] = votes[:, 2]  # an echo
    votes = np.concatenate([votes, (votes.max(1, keepdims=True) == 0)], 1).astype(np.float32)
    model = toxicity.label_model(votes, np.array([False] * 4 + [True]), 0.2)
    assert np.abs(model.fires[1, :2] - fires[1, :2]).max() < 0.2
    assert model.correlation[2, 3] > 0.9 and model.voice[2] < 0.7
    assert ((model.posterior(votes) > 0.5) == truth).mean() > 0.9


def test_line_shingles_are_whole_when_short():
    hashes, first = line_dedup.shingles(pa.array(["abcdefgh", "abc", "abc", "", None, "abd"]))
    assert np.diff(first).tolist() == [2, 1, 1, 0, 0, 1]
    assert hashes[2] == hashes[3] != hashes[4]


def test_queries_keep_their_columns(spark):
    expected = {
        "op1_language_id": {"doc_id", "held_out", "lang_pred", "score"},
        "op2_packing": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
        "op4_byte_bpe": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
        "op5_quality": {"doc_id", "held_out", "score", "predicted"},
        "op6_toxicity": {"doc_id", "held_out", "score", "predicted"},
        "op7_url_filter": {"page_id", "host", "path", "rule", "verdict"},
        "op10_fingerprint": {"doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"},
    }
    for name, columns in expected.items():
        df = QUERIES[name](spark, SMALL)
        assert columns <= set(df.columns), name
        table = "pages" if "url" in name else "documents"
        rows = spark.read.parquet(f"{SMALL}/{table}.parquet").count()
        assert df.count() >= rows if name == "op2_packing" else df.count() == rows


def test_toxicity_collects_one_kind_of_texts_at_a_time(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame as Classic

    from wardloom.llm import toxicity

    docs = spark.range(600).selectExpr("id as doc_id", "concat('some words of text number ', id, if(id % 3 = 0, ' idiot', ' fine')) as text")
    labels = spark.range(600).selectExpr("id as doc_id", "int(id % 3 = 0) as toxic")
    collected, real = [], Classic.toArrow
    monkeypatch.setattr(Classic, "toArrow", lambda self: collected.append(real(self)) or collected[-1])
    assert toxicity.fit(docs, labels, sample=100, labelled=60) is not None
    sizes = [t.num_rows for t in collected]
    assert sorted(sizes) == [100, 120]
