import itertools
import math
import zlib

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from clickstrata.llm import language

PIECES = ["▁", "▁a", "a", "b", "ab", "▁ab", "ba", "é"]


def brute(word, p, unknown=language.UNKNOWN):
    marked, total = "▁" + word, 0.0
    for cuts in itertools.product([0, 1], repeat=len(marked) - 1):
        parts, at = [], 0
        for k, cut in enumerate(cuts, 1):
            if cut:
                parts.append(marked[at:k])
                at = k
        parts.append(marked[at:])
        total += math.prod(p.get(x, unknown if len(x) == 1 else 0.0) for x in parts)
    return total


def test_forward_sums_all_segmentations():
    p = {piece: 0.05 + 0.01 * k for k, piece in enumerate(PIECES)}
    table = np.array([[*p.values(), language.UNKNOWN, 0.0], [0.1] * len(PIECES) + [language.UNKNOWN, 0.0]]).T
    words = ["a", "ab", "abba", "éab", "xab", "bbbb", "aabab"]
    got = language.Pieces(PIECES).log_likelihood(words, table)
    assert np.allclose(got[:, 0], [math.log(brute(w, p)) for w in words])
    assert np.allclose(got[:, 1], [math.log(brute(w, dict.fromkeys(PIECES, 0.1))) for w in words])


def test_expected_counts_match_the_derivative():
    """d log Z / d log p of a piece is its expected count."""
    p = np.array([0.05 + 0.01 * k for k in range(len(PIECES))] + [language.UNKNOWN, 0.0])[:, None]
    pieces, words = language.Pieces(PIECES), ["ab", "abba", "éabx"]
    counts = pieces.expected(words, np.ones(3), np.zeros(3, int), p)
    for k in range(len(PIECES)):
        up, down = p.copy(), p.copy()
        up[k] *= 1 + 1e-5
        down[k] *= 1 - 1e-5
        slope = (pieces.log_likelihood(words, up).sum() - pieces.log_likelihood(words, down).sum()) / 2e-5
        assert counts[k, 0] == pytest.approx(slope, abs=1e-4)


def test_held_out(spark):
    ids = [0, 1, 17, 100, -3, None]
    got = spark.createDataFrame([(k,) for k in ids], "k long").select(language.held_out(F.col("k")).alias("h")).collect()
    assert [r["h"] for r in got] == [k is not None and zlib.crc32(str(k).encode()) % 5 == 0 for k in ids]


def test_edge_cases(spark):
    texts = [*cases.TEXTS, (8, "12 34 ½ ... ²"), (9, "x" * 5000)]
    rows = cases.documents(spark, texts).unionByName(cases.documents(spark, [(20, "zwei drei vier die der"), (21, "und der die")], lang="de"))
    out = language.identify(rows, carry=["doc_id", "n_chars"]).select("carried.*", "text", "lang_pred", "score").collect()
    assert len(out) == len(texts) + 2
    for r in out:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1
        assert letters or r["score"] == 0
    assert next(r for r in out if r["doc_id"] == 21)["lang_pred"] == "de"


def test_nothing_to_learn_from(spark):
    rows = cases.documents(spark, lang=None)
    assert {r["lang_pred"] for r in language.identify(rows).collect()} == {"und"}
    assert language.identify(cases.documents(spark, [])).collect() == []


def test_one_language(spark):
    out = language.identify(cases.documents(spark)).select("carried.doc_id", "lang_pred", "score").collect()
    assert {(r["lang_pred"], r["score"]) for r in out} == {("en", 1.0), ("und", 0.0)}


def test_accuracy_on_held_out_rows(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = language.identify(documents, carry=["doc_id", "lang"]).select("carried.*", "lang_pred").where(language.held_out(F.col("doc_id"))).collect()
    assert len(out) > 20
    assert sum(r["lang"] == r["lang_pred"] for r in out) / len(out) >= 0.95


def test_labels_of_held_out_rows_are_not_learned(spark):
    texts = [(k, "alpha beta") for k in range(40)]
    rows = cases.documents(spark, texts).withColumn("lang", F.when(language.held_out(F.col("doc_id")), "xx").otherwise("en"))
    assert {r["lang_pred"] for r in language.identify(rows).collect()} == {"en"}
