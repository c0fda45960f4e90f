import zlib

import cases
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickstrata.llm import packing


@pytest.fixture(scope="module")
def encoder():
    return packing.encoder(packing.vocabulary_path())


def whole(encoder, text):
    return encoder.whole.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*"aAbZ1'sté É.!_ \n\x1c\x85²ªİſ☃Σσé<|>", "<|endoftext|>"]), max_size=20).map("".join), max_size=4))
def test_ids_equal_the_tokenizers(texts):
    encoder = packing.encoder(packing.vocabulary_path())
    assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)] == [whole(encoder, t) for t in texts]


def check(rows, encoder, documents, window=4096):
    """Every token of every document row once, in sequences without gaps."""
    left = sorted((d, t) for d, t in ((k if k is not None else -1, tuple([*whole(encoder, t), 2])) for k, t in documents))
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append(r)
        by_doc.setdefault(r["doc_id"] if r["doc_id"] is not None else -1, []).append(r)
    padding = 0
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in pieces] == [sum(q["length"] for q in pieces[:k]) for k in range(len(pieces))]
        size = sum(r["length"] for r in pieces)
        assert size <= window
        padding += window - size if size & (size - 1) else 0
    for doc, pieces in by_doc.items():
        own = [t for d, t in left if d == doc]
        assert {r["doc_tokens"] for r in pieces} == {len(t) for t in own}
        for t in set(own):
            n = own.count(t)
            mine = sorted((r["start"], r["length"], r["ids_crc32"]) for r in pieces if r["doc_tokens"] == len(t))
            assert sum(x[1] for x in mine) == n * len(t)
            for start, length, crc in mine:
                assert zlib.crc32(np.array(t[start : start + length], "<u4").tobytes()) == crc
    assert sorted(by_doc) == sorted({d for d, _ in left})
    return padding


def test_edge_cases(spark, encoder):
    table = cases.documents(spark)
    assert check(packing.pack(table).collect(), encoder, cases.TEXTS) == 0
    assert check(packing.pack(table, window=64, shard_tokens=500).collect(), encoder, cases.TEXTS, 64) == 0
    assert packing.pack(cases.documents(spark, [])).collect() == []
    rows = packing.pack(table.where("doc_id = 4"), with_ids=True).collect()
    assert [r["ids"] for r in rows] == [[*whole(encoder, "one"), 2]]


def test_supplied_table(spark, sf_dir, encoder):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert check(packing.pack(documents).collect(), encoder, rows) == 0


def brute_neighbours(texts, seed, used):
    """BM25 of all documents for the seed's best words, without an index."""
    docs = [[hash_ for hash_ in _kinds(t)] for t in texts]
    n, mean = len(docs), sum(map(len, docs)) / len(docs)
    frequency = {}
    for d in docs:
        for k in set(d):
            frequency[k] = frequency.get(k, 0) + 1

    def weight(d, k):
        tf = d.count(k)
        return np.log1p((n - frequency[k] + 0.5) / (frequency[k] + 0.5)) * tf * (packing.K1 + 1) / (tf + packing.K1 * (1 - packing.B + packing.B * len(d) / mean))

    query = set(docs[seed])
    assert len(query) <= packing.QUERY_TERMS
    scores = [(-sum(weight(d, k) for k in query if k in d), j) for j, d in enumerate(docs) if j not in used]
    return [j for s, j in sorted((round(s, 9), j) for s, j in scores) if s < 0]


def _kinds(text):
    import pyarrow as pa

    from clickstrata.llm import words as W

    return (W.words_of(pa.array([text]), W.ALPHANUMERIC).hashes & np.uint64(packing.TERMS - 1)).tolist()


def test_neighbours_against_plain_bm25(spark):
    import pyarrow as pa

    texts = ["red green blue", "red red red", "blue sky over the hill", "a green hill", "nothing here", "red green blue sky"]
    stats = packing.statistics(spark.createDataFrame([(t,) for t in texts], "text string"))
    assert stats.n_docs == 6 and stats.frequency.sum() == sum(len(set(t.split())) for t in texts)
    index = packing.Index(packing._terms(pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])), stats, stats.idf())
    for seed in range(len(texts)):
        used = np.zeros(len(texts), bool)
        used[seed] = True
        assert index.neighbours(seed, used).tolist() == brute_neighbours(texts, seed, {seed})


def test_related_documents_share_a_window(spark):
    topics = ["apple pear plum cherry", "bolt screw nut washer"]
    rows = [(k, " ".join(topics[k % 2].split() * 20)) for k in range(12)]
    out = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), window=200).collect()
    first = {r["doc_id"] % 2 for r in out if r["sequence_id"] == min(x["sequence_id"] for x in out)}
    assert len(first) == 1
