"""Neighbours by all words of a seed, and words told apart by their whole hash."""

import numpy as np
import pyarrow as pa

from clickstrata.llm import packing


def index_of(spark, texts):
    stats = packing.statistics(spark.createDataFrame([(t,) for t in texts], "text string"))
    return packing.Index(packing._terms(pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])), stats, stats.idf())


def test_long_seed_is_queried_by_all_words(spark):
    rare = [f"rare{k}" for k in range(40)]
    texts = [" ".join([*rare, "shared", "other"]), "shared other a b", "c d e f", "shared g h i", *[f"shared other filler{k}" for k in range(5)], *[f"{w} j{k}" for k, w in enumerate(rare)]]
    used = np.zeros(len(texts), bool)
    used[0] = True
    found = index_of(spark, texts).neighbours(0, used).tolist()
    assert sorted(found) == [k for k in range(1, len(texts)) if k != 2]


def test_words_do_not_share_frequencies(spark):
    words = [f"w{k}" for k in range(30_000)]
    stats = packing.statistics(spark.createDataFrame([(" ".join(words),), ("w1 w2",), ("w1",)], "text string"))
    assert len(stats.kinds) == 30_000 and sorted(stats.frequency.tolist())[-3:] == [1, 2, 3]
    assert stats.n_docs == 3 and stats.mean_words == 30_003 / 3


def test_frequencies_are_those_of_all_shards(spark):
    rows = spark.createDataFrame([(k, f"common own{k}") for k in range(8)], "doc_id long, text string").coalesce(1)
    sharded = packing.assign_shards(rows, 30)
    assert sharded.select("shard").distinct().count() == 4
    found = packing.frequencies(sharded).collect()
    assert sorted(r["n"] for r in found) == [1] * 8 + [8] * 4
    pieces = packing.pack(rows, shard_tokens=8).collect()
    assert sorted({r["doc_id"] for r in pieces}) == list(range(8))
