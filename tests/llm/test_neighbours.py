"""Nearest vectors against all distances."""

import math

import numpy as np
import pytest

from clickstrata.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, score double, shard int"


def table(spark, rows):
    return spark.createDataFrame([(k, v, 0.5, 7) for k, v in rows], SCHEMA)


def usable(v):
    return v is not None and any(x != 0 for x in v if x is not None) and all(x is not None and math.isfinite(x) for x in v)


def expected(rows, asked, k):
    out = []
    for q, a in asked:
        if q is None or not usable(a):
            continue
        near = [(float(np.sqrt(((np.float32(a).astype(float) - np.float32(b).astype(float)) ** 2).sum())), i) for i, b in rows if i is not None and i != q and usable(b) and len(b) == len(a)]
        out += [(q, rank, i, d) for rank, (d, i) in enumerate(sorted(near)[:k], 1)]
    return out


def corpus(n=3000, dim=8):
    r = np.random.default_rng(5)
    centres = r.normal(size=(20, dim))
    rows = [(k, (centres[k % 20] + 0.3 * r.normal(size=dim)).tolist()) for k in range(n)]
    rows += [(n + k, rows[100][1]) for k in range(400)]  # copies
    one = rows[0][1]
    odd = [None, [], [0.0] * dim, [float("nan"), *one[1:]], [None, *one[1:]], [float("inf"), *one[1:]], [1.0, 2.0]]
    return rows + [(n + 1000 + k, v) for k, v in enumerate(odd)] + [(None, one), (200, rows[200][1])]


@pytest.mark.parametrize("options", [{}, {"shard_rows": 500, "leaf": 16}])
def test_equals_all_distances(spark, options):
    rows = corpus()
    asked = [(k, v) for k, v in rows if k is not None and k % 100 == 0]
    found = neighbours.nearest(table(spark, rows), table(spark, asked), **options).collect()
    want = expected(rows, {k: (k, v) for k, v in asked}.values(), 10)
    assert [tuple(r)[:3] for r in sorted(found)] == [w[:3] for w in sorted(want)]
    assert np.allclose([r["score"] for r in sorted(found)], [w[3] for w in sorted(want)], rtol=1e-12, atol=1e-12)


def test_larger_factor_finds_most(spark):
    rows = corpus(2000)[:2000]
    asked = rows[::50]
    found = neighbours.nearest(table(spark, rows), table(spark, asked), factor=1.5, leaf=16).collect()
    want = {w[:1] + w[2:3] for w in expected(rows, asked, 10)}
    assert len(want & {(r["query_id"], r["vec_id"]) for r in found}) >= 0.9 * len(want)


def test_few_candidates_and_empty_tables(spark):
    few = table(spark, [(0, [1.0, 2.0]), (100, [2.0, 2.0])])
    assert sorted(tuple(r)[:3] for r in neighbours.nearest(few, few).collect()) == [(0, 1, 100), (100, 1, 0)]
    empty = table(spark, [])
    assert neighbours.nearest(empty, empty).collect() == []
    assert neighbours.nearest(few, empty).collect() == []


def test_ties_make_no_deep_tree():
    n = 3000
    for vectors in (np.eye(n, 64) + np.eye(n, 64, -64), np.eye(1500), np.ones((n, 3)), np.repeat(np.eye(3), 700, 0)):
        ids = np.arange(len(vectors))
        tree = neighbours.Tree(ids, vectors, leaf=4)
        best, place = tree.search(ids[::500], vectors[::500], 10, 1.0)
        for q, d, found in zip(ids[::500], best, place, strict=True):
            every = np.sqrt(((vectors - vectors[q]) ** 2).sum(1))
            every[q] = np.inf
            order = np.lexsort((ids, every))[:10]
            assert found.tolist() == order.tolist()
            assert np.allclose(d, every[order], rtol=1e-15)


def test_far_from_the_origin():
    # Squares of large numbers lose what distinguishes the vectors, their differences do not.
    vectors = 1e9 + np.random.default_rng(1).normal(size=(500, 6))
    best, place = neighbours.Tree(np.arange(500), vectors, leaf=16).search(np.arange(20), vectors[:20], 10, 1.0)
    for q in range(20):
        every = np.sqrt(((vectors - vectors[q]) ** 2).sum(1))
        every[q] = np.inf
        assert place[q].tolist() == np.lexsort((np.arange(500), every))[:10].tolist()
