"""Repeated benchmark rows do not add to what a block collects."""

import cases

from clickstrata.llm import decontaminate


def test_repeats_are_collected_once(spark, monkeypatch):
    sizes, block = [], decontaminate._block

    def seen(rows, window):
        sizes.append(len(rows))
        return block(rows, window)

    monkeypatch.setattr(decontaminate, "_block", seen)
    passage = "one two three four five six seven eight nine ten"
    rows = [("a", passage)] * 300 + [(f"i{k}", f"item{k} {passage}") for k in range(5)]
    benchmark = spark.createDataFrame(rows, "item_id string, text string")
    out = decontaminate.find_passages(cases.documents(spark, [(1, f"x {passage} y")]), benchmark, block_bytes=100).first()
    assert sum(sizes) == 6 and len(sizes) <= 5
    assert out["items"] == ["a", *(f"i{k}" for k in range(5))] and [tuple(h) for h in out["hits"]] == [(1, 11)]
