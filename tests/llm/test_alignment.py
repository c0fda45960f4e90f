import hashlib
from collections import Counter

import numpy as np
import pytest
from cases import TEXTS, documents
from test_tokens import MIXED
from tokenizers import Tokenizer

from clickstrata.llm import alignment, tokens


@pytest.fixture(scope="module")
def vocabularies():
    a, b = alignment.vocabulary_paths()
    return tokens.ByteTokenizer(a), tokens.PieceTokenizer(b)


def aligned(text, a, b):
    """(ids of A, ids of B, links, groups as text) of one whole text."""
    tokenizer = a.tokenizer
    ids_a = tokenizer.encode(" " + text, add_special_tokens=False).ids if text else []
    ids_b = b.model.encode(text) if text else []
    wanted = (" " + (text or "")).encode()
    if not text or b"".join(a.bytes[k] for k in ids_a) != wanted or b"".join(b.bytes[k] for k in ids_b) != wanted:
        return [], [], [], ""
    ends_a = np.cumsum([len(a.bytes[k]) for k in ids_a]).tolist()
    ends_b = np.cumsum([len(b.bytes[k]) for k in ids_b]).tolist()
    links = [(x, y) for x, e in zip(ids_a, ends_a) for y in ([ids_b[ends_b.index(e)]] if e in set(ends_b) else [])] if len(ids_a) < 500 else None
    both = sorted(set(ends_a) & set(ends_b))
    place_a, place_b = {e: k for k, e in enumerate(ends_a)}, {e: k for k, e in enumerate(ends_b)}
    groups, at_a, at_b = [], 0, 0
    for e in both:
        groups.append("|".join(",".join(map(str, ids)) for ids in (ids_a[at_a : place_a[e] + 1], ids_b[at_b : place_b[e] + 1])))
        at_a, at_b = place_a[e] + 1, place_b[e] + 1
    found = [(ids_a[place_a[e]], ids_b[place_b[e]]) for e in both]
    assert links is None or links == found
    return ids_a, ids_b, found, ";".join(groups)


def expected(rows, a, b):
    own = [(doc_id, *aligned(text, a, b)) for doc_id, text in rows]
    counts = Counter(link for *_, links, _ in own for link in links)
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    out = []
    for doc_id, ids_a, ids_b, links, groups in own:
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        out.append((doc_id, len(ids_a), len(ids_b), len(links), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), digest, groups))
    return out, counts


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is None, x) for x in r))


ROWS = TEXTS + [(1000 + k, text) for k, text in enumerate(MIXED[:400])] + [(5000, "a lone ▁ mark"), (5001, "x")] * 2


def test_equals_whole_text_alignment(spark, vocabularies):
    found = alignment.align_corpus(documents(spark, ROWS), with_groups=True).collect()
    rows, _ = expected(ROWS, *vocabularies)
    assert ordered(found) == ordered(rows)
    assert any(r.n_a == 0 and r.doc_id == 5000 for r in found)


def test_small_batches_and_forgetting(spark, vocabularies, monkeypatch):
    rows, counts = expected(ROWS, *vocabularies)
    paths = alignment.vocabulary_paths()
    import pyarrow as pa

    monkeypatch.setattr(alignment, "BATCH_CHARACTERS", 500)
    monkeypatch.setattr(alignment, "HELD_BYTES", 20_000)
    monkeypatch.setattr(tokens, "SEGMENT", 300)
    own, forgotten, seen = alignment.Aligner(*paths), [], []
    for batch in alignment._aligned(own, pa.array([t for _, t in ROWS], pa.string()), lambda: forgotten.append(1)):
        whole = batch.sums(~own.good) == 0
        seen += (batch.sums(own.n_a) * whole).tolist()
    assert seen == [r[1] for r in rows] and len(forgotten) > 3


def test_pair_table(spark, vocabularies):
    _, counts = expected(ROWS, *vocabularies)
    table = alignment.count_pairs(documents(spark, ROWS))
    rows = table.rows(documents(spark)).collect()
    assert {(r.a_id, r.b_id): r.n for r in rows} == counts
    assert len(rows) <= alignment.pair_bound(*vocabularies)
    values, best = table.lookup(np.array([(50_000 << 32) | 3]))
    assert values.tolist() == [0] and not best[0]


def test_another_corpus_is_an_error(spark):
    table = alignment.count_pairs(documents(spark, [(1, "one two")]))
    with pytest.raises(Exception, match="first pass"):
        alignment.align_documents(documents(spark, [(1, "three")]), table).collect()


@pytest.mark.parametrize("rows", [[], [(1, None), (2, ""), (3, "▁")]])
def test_without_tokens(spark, rows):
    found = alignment.align_corpus(documents(spark, rows)).collect()
    assert ordered(found) == [(k, 0, 0, 0, 0, 0, 0, "") for k, _ in rows]


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 1000, 100_000])
def test_perfect_hash(n):
    keys = np.random.default_rng(n).integers(-(2**62), 2**62, n)
    table = alignment.PerfectHash(keys)
    assert sorted(table(keys).tolist()) == list(range(len(set(keys.tolist()))))
    assert (table(keys) == table(keys)).all() and (table.keys[table(keys)] == keys).all()
    others = np.setdiff1d(np.arange(1000), keys)
    assert (table(others) == -1).all()
    assert len(table.words) * 64 <= 8 * n + 64 * len(table.levels)


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_tree_sum(spark, parts):
    vectors = [np.arange(50, dtype=np.int64) * k for k in range(97)]
    frame = spark.createDataFrame([(v.tobytes(),) for v in vectors], "vector binary").repartition(parts)
    assert (alignment.tree_sum(frame, parts, 50) == sum(vectors)).all()
