"""Near-duplicate operators, components and the pipeline, against plain versions."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from wardloom.llm import embedding_dedup, line_dedup, lsh, minhash
from wardloom.llm.common import reachable
from wardloom.llm.components import UnionFind, components
from wardloom.llm.queries import QUERIES


@pytest.fixture(autouse=True)
def workers(spark):
    reachable(spark)


def least_reachable(ids, linked):
    sets = UnionFind()
    for a, b in itertools.combinations(ids, 2):
        if linked(a, b):
            sets.union(a, b)
    return {i: sets.root(i) for i in ids}


def similar(a, b, percent=80):
    return bool(a and b) and 100 * len(a & b) >= percent * len(a | b)


def variants(rng, base, count, edits):
    """Copies of a list of words in which some words are changed."""
    for _ in range(count):
        words = list(base)
        for _ in range(edits):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        yield words


def test_components_against_union_find(spark):
    rng = random.Random(1)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)]
    links += [(k, k + 1) for k in range(1000, 1300)]  # a long chain
    links += [(2000, k) for k in range(2001, 2400)] + [(5, 5)]  # a hub, a loop
    sets = UnionFind()
    for a, b in links:
        sets.union(a, b)
    got = {r.id: r.root for r in components(spark.createDataFrame(links, "a long, b long").repartition(7)).collect()}
    assert got == {x: sets.root(x) for pair in links for x in pair if pair[0] != pair[1]}
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


def near_texts():
    rng = random.Random(7)
    texts = [" ".join(f"w{rng.randrange(3000)}" for _ in range(rng.choice([2, 9, 60, 200]))) for _ in range(150)]
    for edits in (1, 3, 6, 12):
        texts += [" ".join(w) for w in variants(rng, [f"b{k}" for k in range(120)], 25, edits)]
    texts += [texts[0]] * 40 + [texts[3].upper()] + ["", " \t", "one", "One", "one\x0btwo", "one two"]
    return texts


def shingles(text, width):
    words = "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in (text or "")).split(" ")
    words = [w.lower() for w in words if w]
    return {tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} - {()}


@pytest.mark.parametrize("width", [2, 5])
@pytest.mark.parametrize("block", [512, 8])
def test_minhash_against_brute_force(spark, monkeypatch, width, block):
    monkeypatch.setattr(lsh, "BLOCK", block)
    if block < 512:
        monkeypatch.setattr(lsh, "COPIES", 0)  # the way of very large buckets
    data = [(k, t, k) for k, t in enumerate(near_texts())] + [(999, None, 0)]
    docs = spark.createDataFrame(data, "doc_id long, text string, handle int")
    got = minhash.near_duplicates(docs, width=width).collect()
    sets = {k: shingles(t, width) for k, t, _ in data}
    expected = least_reachable(list(sets), lambda a, b: similar(sets[a], sets[b]))
    assert {r.doc_id: r.n_shingles for r in got} == {k: len(s) for k, s in sets.items()}
    assert {r.doc_id: r.component_id for r in got} == expected


def test_minhash_odd_rows(spark):
    schema = "doc_id long, text string"
    text = " ".join(f"t{k}" for k in range(30))
    docs = spark.createDataFrame([(None, text), (5, text), (5, text), (7, "other words here"), (5, "third thing"), (None, "alone now")], schema)
    got = sorted(((r.doc_id or 0, r.component_id or 0) for r in minhash.near_duplicates(docs).collect()))
    assert got == [(0, 0), (0, 5), (5, 5), (5, 5), (5, 5), (7, 7)]
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_embeddings_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    rng = np.random.default_rng(5)
    base = rng.standard_normal((60, 24))
    near = [base[0] + rng.normal(0, s, 24) for s in (0.05, 0.2, 0.4) for _ in range(40)]
    vectors = [*base.tolist(), *(v.tolist() for v in near), base[1].tolist(), base[1].tolist(), (3 * base[1]).tolist()]
    good = len(vectors)
    vectors += [None, [], [0.0] * 24, [float("nan")] * 24, [None] * 24, [float("inf")] + [1.0] * 23, [1.0, 2.0], [1.0, 2.0]]
    df = spark.createDataFrame([(k, v, k) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>, n int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(df).collect()}
    x = np.array(vectors[:good])
    x /= np.linalg.norm(x, axis=1)[:, None]
    linked = x @ x.T >= 0.9
    roots = least_reachable(range(good), lambda a, b: linked[a, b])
    expected = {k: (int(linked[k].sum()) - 1, roots[k]) for k in range(good)}
    expected |= {k: (0, k) for k in range(good, len(vectors))} | {len(vectors) - k: (1, len(vectors) - 2) for k in (1, 2)}
    assert got == expected
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.1])], "vec_id long, embedding array<double>")
    assert sorted((r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(twice).collect()) == [(2, 1)] * 3


def test_miss_rate_stays_the_same():
    for rows in (100, 10**4, 10**6, 10**9):
        planes, tables = embedding_dedup.plan(rows, 0.9)
        together = (1 - np.arccos(0.9) / np.pi) ** planes
        assert (1 - together) ** tables <= embedding_dedup.MISS


def lined_docs():
    rng = random.Random(3)
    base = "the quick brown fox jumps over the lazy dog and runs into the deep dark forest at night".split()
    lines = [" ".join(f"w{rng.randrange(900)}" for _ in range(12)) for _ in range(60)]
    lines += [" ".join(w) for w in variants(rng, base, 30, 1)] + ["short", "", "tiny line"]
    docs = [(k, "\n".join(rng.choice(lines) for _ in range(rng.randrange(1, 7)))) for k in range(80)]
    return [*docs, (80, None), (81, ""), (82, lines[0] * 400)]


def kept_lines(docs):
    places = [(k, n, line) for k, t in docs if t is not None for n, line in enumerate(t.split("\n"))]
    sets = {x: {x[j : j + 7] for j in range(len(x) - 6)} for *_, x in places if len(x.strip(" ")) >= line_dedup.LEAST}
    roots = least_reachable(sorted(sets), lambda a, b: similar(sets[a], sets[b]))
    first = {}
    return {(k, n): first.setdefault(roots[x], (k, n)) if x in roots else (k, n) for k, n, x in sorted(places)}


def test_lines_against_brute_force(spark):
    data = lined_docs()
    docs = spark.createDataFrame([(k, t, "h") for k, t in data], "doc_id long, text string, line string")
    expected = kept_lines(data)
    report = line_dedup.line_report(docs).collect()
    assert {(r.doc_id, r.line_no): (r.kept_key, r.kept_line) for r in report} == expected
    assert all(r.kept == (expected[r.doc_id, r.line_no] == (r.doc_id, r.line_no)) for r in report)
    got = {r.doc_id: (r.text, r._lines_removed) for r in line_dedup.deduplicated(docs).collect()}
    for k, text in data:
        lines = (text or "").split("\n")
        left = [x for n, x in enumerate(lines) if expected.get((k, n), (k, n)) == (k, n)]
        assert got[k] == (None if text is None else "\n".join(left), len(lines) - len(left))
    assert line_dedup.deduplicated(docs.limit(0)).count() == 0 == line_dedup.line_report(docs.limit(0)).count()


@pytest.mark.parametrize("copies", [0, 16])
def test_lines_of_one_template(spark, monkeypatch, copies):
    """Lines that differ in a number have no links; a bucket that holds them all is not compared pair by pair."""
    monkeypatch.setattr(lsh, "BLOCK", 8)
    monkeypatch.setattr(lsh, "COPIES", copies)
    rng = random.Random(11)
    lines = [f"Your parcel {rng.randrange(10**12):012d} has been handed to the carrier" for _ in range(250)]
    lines += [x + "s" for x in lines[:20]] + [x.replace("Your", "A") for x in lines[30:40]]
    docs = [(k, "\n".join(lines[k::20])) for k in range(20)]
    report = line_dedup.line_report(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.line_no): (r.kept_key, r.kept_line) for r in report} == kept_lines(docs)
    assert 15 < sum(not r.kept for r in report) < 60


def test_template_lines_meet_in_proportion(spark, monkeypatch):
    """The rows that cells get grow with the lines, not with their square."""
    monkeypatch.setattr(lsh, "BLOCK", 8)
    monkeypatch.setattr(lsh, "COPIES", 0)
    sizes = []
    compared = lsh._compared

    def counted(meetings, *rest):
        sizes.append(lsh._copies(meetings).agg({"copies": "sum"}).first()[0] or 0)
        return compared(meetings, *rest)

    monkeypatch.setattr(lsh, "_compared", counted)
    rng = random.Random(12)
    for n in (200, 800):
        lines = [f"Your parcel {rng.randrange(10**12):012d} has been handed to the carrier" for _ in range(n)]
        line_dedup.removals(spark.createDataFrame([(k, x) for k, x in enumerate(lines)], "doc_id long, text string")).count()
    assert sizes[1] <= 6 * max(sizes[0], 100)


def test_shared_buckets_across_batches():
    rng = np.random.default_rng(2)
    for step in (1, 2, 3, 50):
        bucket = np.sort(rng.integers(0, 12, 40))
        handle = np.concatenate([np.sort(rng.choice(1000, n, False)) for n in np.unique(bucket, return_counts=True)[1]])
        table = pa.table({"bucket": bucket, "handle": handle})
        got = [tuple(r.values()) for b in lsh._shared(table.to_batches(step)) for r in b.to_pylist()]
        expected = []
        for k in set(bucket.tolist()):
            members = handle[bucket == k].tolist()
            expected += [(k, h, members[0]) for h in members] if len(members) > 1 else []
        assert sorted(got) == sorted(expected)


@pytest.mark.parametrize(("words", "changed", "least"), [(94, 2, 0.995), (134, 2, 0.995)])
def test_recall_of_documents_near_the_threshold(spark, words, changed, least):
    """Pairs at similarities of exactly 0.8 and of 0.857, many of them."""
    rng = random.Random(13)
    data = []
    for k in range(400):
        base = [f"w{k}x{j}" for j in range(words)]
        other = list(base)
        for at in rng.sample(range(5, words - 5, 12), changed):
            other[at] = "changed"
        data += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(other))]
    pairs = [(shingles(a[1], 5), shingles(b[1], 5)) for a, b in zip(data[::2], data[1::2], strict=True)]
    near = {2 * k + 1 for k, (a, b) in enumerate(pairs) if similar(a, b)}
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert len(near) == 400 and all(len(a & b) / len(a | b) < 0.9 for a, b in pairs)
    assert sum(got[k] == k - 1 for k in near) >= least * len(near)


def test_columns_of_any_name_stay(spark):
    line = "a line that is long enough to be compared with others"
    names = ["_key", "_version", "_gone", "_own", "_place", "_row", "own", "doc", "body", "removed", "key", "kept", "a.b"]
    data = [(1, f"{line}\nfirst", *range(len(names))), (2, f"{line}\nsecond and quite another one", *range(len(names)))]
    docs = spark.createDataFrame(data, "doc_id long, text string, " + ", ".join(f"`{c}` int" for c in names))
    left = line_dedup.deduplicated(docs)
    assert left.columns == [*docs.columns, "_lines_removed"]
    assert sorted(map(tuple, left.collect())) == [(*data[0], 0), (2, "second and quite another one", *range(len(names)), 1)]
    for stage in (corpus_pipeline.without_repeated_lines, corpus_pipeline.without_near_copies):
        kept = stage(spark, docs, "")
        assert kept.columns == docs.columns and sorted(tuple(r)[2:] for r in kept.collect()) == [tuple(range(len(names)))] * 2


def test_choice_among_rows_of_one_id_is_stable(spark):
    text = " ".join(f"t{k}" for k in range(60))
    data = [(1, text, lang, source) for lang in "abc" for source in "xy"] * 2
    schema = "doc_id long, text string, lang string, source string"
    left = [corpus_pipeline.without_near_copies(spark, spark.createDataFrame(rows, schema).repartition(n), "").collect() for rows, n in ((data, 1), (data[::-1], 3))]
    assert len(left[0]) == 1 and left[0] == left[1]


def test_repeated_rows_keep_their_lines(spark):
    line = "a line that is long enough to be compared with others"
    docs = spark.createDataFrame([(1, line), (1, line), (None, line), (2, line + "!")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.text) for r in line_dedup.deduplicated(docs).collect())
    assert got == [(0, ""), (1, line), (1, line), (2, "")]


def test_rows_that_share_a_key_are_rows_of_their_own(spark):
    line, others = "a line that is long enough to be compared with others", ["first other text", "second, quite unlike it"]
    data = [(k, f"{line}\n{x}{k}") for k in (None, 4) for x in others] + [(None, None)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = [r.text for r in line_dedup.deduplicated(docs).collect() if r.text]
    assert sum(t.split("\n").count(line) for t in got) == 1
    report = line_dedup.line_report(docs).collect()
    assert len(report) == 8 and sum(r.kept for r in report) == sum(len(t.split("\n")) for t in got)


def test_short_lines_are_compared(spark):
    texts = ["All rights reserved.\n\n}\n \t\n}", "}\nAll rights reserved.\n\n \t\n短い行です。", "短い行です。\n\u3000\nAll rights reserved!\n{"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.deduplicated(docs).collect()}
    assert got == {0: "All rights reserved.\n\n}\n \t", 1: "\n \t\n短い行です。", 2: "\u3000\n{"}


def test_near_copies_of_the_pipeline(spark):
    text = " ".join(f"t{k}" for k in range(60))
    data = [(3, text), (2, text + " end"), (2, text + " end"), (9, None), (9, None), (8, ""), (None, text), (None, "other words")]
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in data], "doc_id long, text string, lang string, source string, n_chars int")
    left = corpus_pipeline.without_near_copies(spark, docs, "")
    assert left.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in left.collect()) == [(0, "other words"), (2, text + " end"), (8, ""), (9, "")]


def test_emptied_documents_go_and_counts_follow(spark):
    line, other = "a line that is long enough to be compared", "quite another line, of about the same length"
    data = [(1, line), (2, line), (3, f"{other}\n{line}"), (4, ""), (5, None)]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in data], "doc_id long, text string, lang string, source string, n_chars int")
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.without_repeated_lines(spark, docs, "").collect()}
    assert got == {1: (line, len(line)), 3: (other, len(other)), 4: ("", 0), 5: (None, 0)}


def test_copies_leave_no_remnants(spark):
    text = "Notes\n\na line that is long enough to be compared\n \t\n- item\n\nEnd"
    data = [(1, text), (2, text), (3, "End\r\n\n\nNotes\nonly here"), (4, "\n\n"), (5, "\n\u3000\nNotes\n\n")]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in data], "doc_id long, text string, lang string, source string, n_chars int")
    got = {r.doc_id: r.text for r in corpus_pipeline.without_repeated_lines(spark, docs, "").collect()}
    assert got == {1: text, 3: "End\r\n\n\nonly here", 4: "\n\n"}


def test_pipeline_stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, docs.count()
    from wardloom.llm.common import settle

    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = settle(stage(spark, docs, folder))
        assert docs.columns == columns, name
        assert 0.6 * before < docs.count() <= before, name
    pieces = settle(corpus_pipeline.packed(spark, docs, folder))
    assert pieces.select("doc_id").distinct().count() == docs.count()
    empty = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0


def test_queries_give_every_row(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").count()
    nine = QUERIES["op9_minhash"](spark, folder)
    assert nine.columns == ["doc_id", "n_shingles", "component_id", "kept"] and nine.count() == rows
    eight = QUERIES["op8_embedding_dedup"](spark, folder)
    assert eight.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert QUERIES["op3_line_dedup"](spark, folder).columns == ["doc_id", "line_no", "kept", "kept_doc_id", "kept_line_no"]


def test_line_sets_are_made_without_a_call_for_each_line(monkeypatch):
    """np.unique of each line took most of the time of signing and comparing lines."""
    rng = np.random.default_rng(3)
    lines = ["".join(rng.choice(list("ab é😀x"), n)) for n in rng.integers(0, 60, 400)] + ["", None, "abc", "a" * 50]
    hashes, first = line_dedup.shingles(pa.array(lines))
    expected = [np.unique(hashes[a:b]).tolist() for a, b in zip(first, first[1:], strict=False)]
    monkeypatch.setattr(np, "unique", None)
    found = line_dedup._Sets(pa.array(lines))
    assert [x.tolist() for x in found] == expected
    some = [x for x in lines if x]
    batch = pa.record_batch({"handle": list(range(len(some))), "id": [x.encode() for x in some], "line": some})
    signed = pa.Table.from_batches(line_dedup._signed(iter([batch])))
    assert signed.column("n").to_pylist() == [len(x) for x in expected if x]


def test_bands_are_dealt_in_few_rows(spark, monkeypatch):
    """A row for each band of each line, through Spark and back, took most of the time of finding crowded buckets."""
    dealt = []
    similar_sets = lsh.similar

    def counted(banded, *rest):
        dealt.append(banded.count())
        return similar_sets(banded, *rest)

    monkeypatch.setattr(line_dedup, "similar", counted)
    rng = random.Random(14)
    lines = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(8)) for _ in range(400)]
    docs = [(k, "\n".join([*lines[k::8], lines[0] + "!"])) for k in range(8)]
    report = line_dedup.line_report(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sum(not r.kept for r in report) == 8
    assert dealt[0] < 400


@pytest.mark.parametrize("at_once", [1, 40, 1 << 19])
def test_crowded_buckets_of_dealt_bands(monkeypatch, at_once):
    monkeypatch.setattr(lsh, "DEALT_AT_ONCE", at_once)
    rng = np.random.default_rng(5)
    read = [(rng.integers(0, 1 << 62, n), lsh.bucket_numbers(rng.integers(0, 30, (n, 12)))) for n in (0, 5, 300, 40)]
    members = {}
    for handles, buckets in read:
        for handle, own in zip(handles.tolist(), buckets.tolist(), strict=True):
            for bucket in own:
                members.setdefault(bucket, set()).add(handle)
    assert lsh.parts_of(0) == 1 and lsh.parts_of(40 * lsh.PART) == 64
    for parts in (1, 16, 1 << 17):
        rows = pa.Table.from_batches(list(lsh.dealt(iter(read), parts))).sort_by("part")
        assert rows.num_rows <= (4 if at_once > 1000 else 400) * parts
        for step in (1, 7, 1000):
            got = [r for b in lsh._crowded(iter(rows.to_batches(step))) for r in b.to_pylist()]
            assert sorted((r["bucket"], r["handle"]) for r in got) == sorted((k, h) for k, m in members.items() if len(m) > 1 for h in m)
            leaders = {(r["bucket"], r["leader"]) for r in got}
            assert len(leaders) == len({b for b, _ in leaders}) and all(x in members[b] for b, x in leaders)


def test_equal_bytes_are_counted():
    rng = np.random.default_rng(6)
    for size in (7, 8, 48, 160, 256, 400):
        x, y = rng.integers(0, 2, (2, 50, size)).astype(np.uint8)
        assert lsh._agreeing(x, y).tolist() == (x == y).sum(1).tolist()
        assert len(lsh._agreeing(x[:0], y[:0])) == 0
    full = np.full((2, 248), 9, np.uint8)
    assert lsh._agreeing(full, full).tolist() == [248, 248]
