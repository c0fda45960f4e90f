"""Similar documents against all pairs."""

import random

import cases
import numpy as np
import pyarrow as pa
import pytest

from clickstrata.llm import jaccard


def shingles(text):
    words = cases.non_space(text)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def expected(rows):
    """(doc_id, set size, smallest id reachable) per row, by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                group[root(i)] = root(j)
    ids = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            ids[root(k)] = min(doc, ids.get(root(k), doc))
    return [(doc, len(sets[k]), ids.get(root(k))) for k, (doc, _) in enumerate(rows)]


def corpus(seed, n=260):
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = r.choices(vocabulary, k=40)
    rows = []
    for k in range(n):
        if rows and r.random() < 0.6:
            words = r.choice(rows[-40:])[1].split(" ")
            for _ in range(r.choice([0, 0, 1, 1, 2, 3])):
                at = r.randrange(len(words) + 1)
                words[at : at + r.choice([0, 1])] = r.choices(vocabulary, k=r.choice([0, 1]))
            words = words or ["a"]
        else:
            words = r.choices(vocabulary, k=r.choice([1, 3, 5, 6, 9, 12, 15, 20, 30, 60, 120]))
            if r.random() < 0.3:
                words = words + passage
        rows.append((k + 1, " ".join(words)))
    return rows


def same(spark, rows):
    found = jaccard.similar_documents(cases.documents(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, found), key=cases.key) == sorted(expected(rows), key=cases.key)


def test_edge_cases(spark):
    same(spark, [*cases.TEXTS, (None, ""), (9, "a row without an id"), (12, "ONE")])


@pytest.mark.parametrize("boundary", [None, 0, 20])
def test_equals_all_pairs(spark, monkeypatch, boundary):
    if boundary is not None:
        monkeypatch.setattr(jaccard, "_boundary", lambda *_: boundary)
    same(spark, corpus(3))


def test_frequent_shingles_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "LONG_LIST", 2)
    same(spark, corpus(4))


def test_empty_table(spark):
    assert jaccard.similar_documents(cases.documents(spark, [])).collect() == []
    assert jaccard.keep_one(cases.documents(spark, [])).collect() == []


def test_one_row_of_each_component_stays(spark):
    rows = [*cases.TEXTS, *((k + 100, text) for k, text in corpus(5, 60))]
    documents = cases.documents(spark, rows)
    kept = jaccard.keep_one(documents)
    assert kept.columns == documents.columns
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    want = expected(rows)
    empty = [row for row, (_, n, _) in zip(rows, want, strict=True) if not n]
    assert sorted((row for row in got if not shingles(row[1])), key=cases.key) == sorted(empty, key=cases.key)
    assert all(row in rows for row in got)
    left = [doc for doc, text in got if shingles(text)]
    named = {c for _, n, c in want if n and c is not None}
    assert sorted(d for d in left if d is not None) == sorted(named)
    assert sum(d is None for d in left) == len({t for (d, t), (_, n, c) in zip(rows, want, strict=True) if n and c is None})


def test_members_of_a_bucket_are_spread():
    buckets = np.array([5, 7, 5, 5, 9, 7], np.uint64)
    keys = np.stack([np.arange(6), np.zeros(6)], 1).astype(np.uint64)
    slots = np.array(jaccard._slots(buckets, keys))
    assert slots.tolist() == [1, 1, 2 + 2, 2 + 3, 0, 2 + 5]
    assert np.array(jaccard._slots(buckets[:0], keys[:0])).tolist() == []


def test_only_entries_that_meet_are_kept(spark):
    rows = [(1, b"a", 0), (1, b"b", 0), (2, b"a", 0), (2, b"a", 0), (3, b"c", 1), (3, b"d", 9), (4, b"e", 0)]
    entries = spark.createDataFrame([(bucket, key, 6, 1, 0, slot) for bucket, key, slot in rows], "bucket long, key binary, size int, place int, least int, slot int")
    kept = jaccard._met(entries).select("bucket", "key").collect()
    assert sorted((r["bucket"], bytes(r["key"])) for r in kept) == [(1, b"a"), (1, b"b"), (3, b"c"), (3, b"d")]


def test_small_slices_change_nothing(spark, monkeypatch):
    rows = corpus(6, 120)
    monkeypatch.setattr(jaccard, "SLOTS", 2)
    found = jaccard.similar_documents(cases.documents(spark, rows).repartition(7)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, found), key=cases.key) == sorted(expected(rows), key=cases.key)


def test_sketches_rule_out_no_link():
    texts = [t for _, t in corpus(8, 200)] + ["", " ".join(f"v{k}" for k in range(3000))]
    own = jaccard.Sets(pa.array(texts))
    numbers = np.array(own.sketches().to_pylist(), np.int64).view(np.uint64)
    assert numbers.shape == (len(texts), jaccard.SKETCH)
    for i in range(len(texts)):
        for j in range(i):
            a, b = (set(own.hashes[own.first[k] : own.first[k + 1]].tolist()) for k in (i, j))
            assert int(np.bitwise_count(numbers[i] ^ numbers[j]).sum()) <= len(a ^ b)


def test_a_shared_passage_makes_few_pairs(spark):
    r = random.Random(9)
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(k, " ".join(f"a{r.randrange(10**9)}" for _ in range(120)) + f" {passage}") for k in range(300)]
    documents = cases.documents(spark, rows)
    keyed = jaccard._sets(documents, "doc_id", "text")
    every = keyed.select(keyed["key"].alias("a")).crossJoin(keyed.select(keyed["key"].alias("b"))).where("a < b")
    assert every.count() == 300 * 299 // 2
    assert jaccard._close(every, keyed).count() == 0
    same(spark, rows)


def _texts_in_part_alike(r, n, shared):
    """Two texts of ``n`` words each, ``shared`` of them a common beginning."""
    passage = [f"p{r.randrange(10**9)}" for _ in range(shared)]
    return [" ".join(passage + [f"q{r.randrange(10**9)}" for _ in range(n - shared)]) for _ in range(2)]


def test_wide_sketches_rule_out_no_link():
    r = random.Random(12)
    texts = [t for n in (200, 256, 270, 300, 600, 1100, 1300) for shared in (n // 2, n * 9 // 10) for t in _texts_in_part_alike(r, n, shared)]
    own = jaccard.Sets(pa.array([*texts, "", "one"]))
    numbers = [np.array(row, np.int64).view(np.uint64) for row in own.wide_sketches().to_pylist()]
    assert [len(row) for row in numbers] == jaccard.sketch_width(own.sizes).tolist()
    assert all(64 * len(row) >= 2 * n for row, n in zip(numbers, own.sizes.tolist(), strict=True))
    for i in range(len(numbers)):
        for j in range(i):
            x, y = sorted((numbers[i], numbers[j]), key=len)
            while len(y) > len(x):
                y = y[: len(y) // 2] ^ y[len(y) // 2 :]
            a, b = (set(own.hashes[own.first[k] : own.first[k + 1]].tolist()) for k in (i, j))
            assert int(np.bitwise_count(x ^ y).sum()) <= len(a ^ b)


def test_long_texts_in_part_alike_make_no_pairs(spark):
    """Sketches of a fixed width look alike for long texts, whose whole sets then went through a shuffle by pair."""
    r = random.Random(13)
    rows = [(k, t) for k, t in enumerate(t for n in (1500, 2000, 2080, 4000) for _ in range(3) for t in _texts_in_part_alike(r, n, n // 2))]
    rows += [(100 + k, t) for k, t in enumerate(t for n in (1500, 2060, 4000) for t in _texts_in_part_alike(r, n, n * 19 // 20))]
    documents = cases.documents(spark, rows)
    keyed = jaccard._sets(documents, "doc_id", "text")
    every = keyed.select(keyed["key"].alias("a")).crossJoin(keyed.select(keyed["key"].alias("b"))).where("a < b")
    assert jaccard._close(every, keyed).count() == 3
    same(spark, rows)
