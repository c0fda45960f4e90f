import hashlib
import random

import cases

from clickstrata.llm import decontaminate


def brute(documents, items, window=10):
    wins = {}
    for item, text in items:
        words = cases.alphanumeric(text)
        for k in range(max(1, len(words) - window + 1) if words else 0):
            wins.setdefault(tuple(words[k : k + window]), set()).add("" if item is None else str(item))
    lengths = {len(w) for w in wins}
    out = []
    for doc, text in documents:
        words, hit, found = cases.alphanumeric(text), set(), set()
        for n in lengths:
            for k in range(len(words) - n + 1):
                if (w := tuple(words[k : k + n])) in wins:
                    hit |= set(range(k, k + n))
                    found |= wins[w]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(words), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=cases.key)


def ask(documents, benchmark, **options):
    return sorted((tuple(r) for r in decontaminate.summarise(decontaminate.find_passages(documents, benchmark, **options)).collect()), key=cases.key)


ITEMS = [
    (1, "four five six seven eight nine ten eleven twelve"),
    (2, "Three four five six seven eight nine ten eleven twelve"),
    (2, "w5 sépar5 w6"),
    (10, "one"),
    (11, None),
    (12, " .. "),
    (None, "日本語 x"),
    (3, "w1 sépar1 w2 sépar2 w3 sépar3 w4 sépar4 w5 sépar5 w6 sépar6"),
]


def test_edge_cases(spark):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    expected = brute(cases.TEXTS, ITEMS)
    assert ask(cases.documents(spark), benchmark) == expected
    assert any(row[3] > 1 for row in expected)
    # several blocks of the benchmark give the same
    assert ask(cases.documents(spark), benchmark, block_bytes=60) == expected


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert ask(cases.documents(spark), none) == brute(cases.TEXTS, [])
    assert ask(cases.documents(spark, []), spark.createDataFrame(ITEMS, "item_id long, text string")) == []


def test_random_texts_of_few_words(spark):
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice("abcd") for _ in range(n))
    documents = [(k, text(rng.randrange(60))) for k in range(200)]
    items = [(k, text(rng.randrange(1, 14))) for k in range(40)]
    assert ask(cases.documents(spark, documents), spark.createDataFrame(items, "item_id long, text string"), window=6) == brute(documents, items, 6)


def test_supplied_tables(spark, sf_dir):
    documents, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    rows, items = documents.select("doc_id", "text").collect(), benchmark.select("item_id", "text").collect()
    expected = brute(rows, items)
    assert ask(documents, benchmark) == expected
    assert sum(row[5] for row in expected) > 0
