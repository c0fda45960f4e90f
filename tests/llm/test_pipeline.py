"""Every stage on its own input, on a table with planted cases, against brute force."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import cases
import corpus_pipeline as pipeline
from test_jaccard import expected, shingles

PROSE = "the quick brown fox number {k} jumps over lazy dogs while item {j} watches from the garden wall near house {i}"
ITEM = "zebra yonder xylophone winter velvet under table sugar river quiet people orange"


def corpus():
    rows = [(k, " . ".join(PROSE.format(k=k * m, j=k + m, i=m) for m in range(1, 6))) for k in range(1, 30)]
    rows += [(101, rows[0][1]), (102, rows[1][1] + " end"), (103, "12 34 56"), (104, None), (105, "")]
    rows += [(106, f"some words before it {ITEM} and after"), (107, "my password = abcdefgh12345678 is written here")]
    return rows


def test_stages(spark, tmp_path):
    docs = cases.documents(spark, corpus())
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([("a", ITEM)], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    folder, kept = str(tmp_path), {}
    for name, function in pipeline.STAGES[:-1]:
        out = function(spark, docs, folder)
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert docs.count() == len(kept[name])
        if name == "ngram_jaccard_join":
            rows = [(r["doc_id"], r["text"]) for r in before.collect()]
            assert set(kept[name]) == {c for _, _, c in expected(rows)} and all(shingles(t) for t in kept[name].values())
    assert not {103, 104, 105} & set(kept["language_id"]) and {1, 29, 101, 106, 107} <= set(kept["language_id"])
    assert not {101, 102} & set(kept["ngram_jaccard_join"]) and {1, 2} <= set(kept["ngram_jaccard_join"])
    assert set(kept["decontamination"]) == set(kept["ngram_jaccard_join"]) - {106}
    assert set(kept["secret_scan"]) == set(kept["decontamination"])
    assert "abcdefgh12345678" not in kept["secret_scan"][107] and kept["secret_scan"][1] == corpus()[0][1]
    pieces = pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r["doc_id"] for r in pieces} == set(kept["secret_scan"])
    whole = pipeline.run(spark, folder).collect()
    assert {(r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in whole if r["start"] == 0 and r["length"] == r["doc_tokens"]}
    assert {(r["doc_id"], r["doc_tokens"]) for r in whole} == {(r["doc_id"], r["doc_tokens"]) for r in pieces}


def test_empty_table(spark, tmp_path):
    cases.documents(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert pipeline.run(spark, str(tmp_path)).collect() == []
