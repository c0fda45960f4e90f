import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from cases import LONG, documents

from clickstrata.llm import filter_audit as audit


def failed(rows):
    """The filters that each (doc_id, text, source) fails, one by one."""
    first = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    out = []
    for doc_id, text, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        checks = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": doc_id is not None and first[text] < doc_id,
        }
        out.append({f for f, bad in checks.items() if bad})
    return out


def brute(rows, labels):
    """The chain applied to every document, order by order."""
    good = {k for k, q, _ in labels if q == 1}
    toxic = {k for k, _, t in labels if t == 1}
    sets, out, shapley = failed(rows), {}, Counter()
    for part in {source or "" for *_, source in rows}:
        own = [(k, bad) for (k, _, source), bad in zip(rows, sets) if (source or "") == part]
        for order in map("".join, permutations("ABCDE")):
            alive = own
            for step, f in enumerate(order, 1):
                gone = [x for x in alive if f in x[1]]
                alive = [x for x in alive if f not in x[1]]
                failing = [x for x in own if f in x[1]]
                out[part, order, step] = [
                    len(alive), len(gone), len(failing) - len(gone), sum(x[1] == {f} for x in own),
                    sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone),
                ]
                shapley[part, f] += len(gone)
    return {(part, order, step): (*counts, shapley[part, order[step - 1]]) for (part, order, step), counts in out.items()}


PROSE = " ".join(f"word{k}" for k in range(260))
ROWS = [
    (1, PROSE, "a"), (2, PROSE, "a"), (3, PROSE, None), (3, PROSE, None), (None, PROSE, "a"), (None, PROSE, "b"),
    (4, None, "a"), (5, "", "b"), (6, " \t ", "b"), (7, "same " * 250, "a"), (8, PROSE.upper(), "a"), (9, PROSE + " #", "b"),
    (10, LONG, "b"), (11, "Short & loud", ""), (12, "x y " * 300, "a"), (2, PROSE, "a"), (13, PROSE + " É", "a"),
]
LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, None), (3, None, 1), (7, 1, 1), (9, 0, 0), (10, 1, 0), (None, 1, 1), (99, 1, 1)]


def tables(spark, rows=ROWS, labels=LABELS):
    docs = documents(spark, [(k, t) for k, t, _ in rows]).drop("source")
    sources = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumnRenamed("doc_id", "mask")
    return sources.withColumnRenamed("mask", "doc_id").withColumns({"mask": sources.text, "n": sources.text, "part": sources.text, "id": sources.text}), spark.createDataFrame(
        labels, "doc_id long, quality int, toxic int"
    ), docs


def result(spark, rows=ROWS, labels=LABELS):
    docs, marks, _ = tables(spark, rows, labels)
    found = audit.audit(audit.document_masks(docs, marks)).collect()
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in found}, len(found)


def test_equals_the_chain_applied_in_every_order(spark):
    found, n = result(spark)
    expected = brute(ROWS, LABELS)
    assert n == len(expected) == 3 * 120 * 5
    assert found == expected


def test_many_copies_of_one_text(spark):
    rows = [(k, "copied text " * 150, "hot") for k in range(400)] + [(None, "no id", "hot")] * 50
    found, _ = result(spark, rows, [(k, 1, 0) for k in range(0, 400, 2)])
    assert found == brute(rows, [(k, 1, 0) for k in range(0, 400, 2)])


def test_empty_tables(spark):
    assert result(spark, [], LABELS) == ({}, 0)
    found, _ = result(spark, ROWS, [])
    assert all(row[4] == row[5] == 0 for row in found.values())


def test_removal_is_a_min_plus_product():
    orders = np.array(list(permutations(range(4))))
    places = audit.places_of(orders)
    assert all((order[place - 1] == np.arange(4)).all() for order, place in zip(orders, places))
    masks = (np.arange(16)[:, None] >> np.arange(4) & 1).astype(bool)
    steps = audit.removal_steps(masks, places)
    for m, mask in enumerate(masks):
        for o, order in enumerate(orders):
            assert steps[m, o] == next((k for k, f in enumerate(order, 1) if mask[f]), 5)


@pytest.mark.parametrize("filters", ["XY", "PQR"])
def test_other_chains(spark, filters):
    masks = spark.createDataFrame([("p", m, m + 1, m, 1) for m in range(2 ** len(filters))], "part string, mask int, n long, good long, toxic long")
    found = audit.audit(masks, filters).collect()
    assert {r.filter_order for r in found} == set(map("".join, permutations(filters)))
    total = sum(m + 1 for m in range(2 ** len(filters)))
    last = [r for r in found if r.step == len(filters)]
    assert {r.kept for r in last} == {1} and all(r.kept + sum(x.removed for x in found if x.filter_order == r.filter_order) == total for r in last)
