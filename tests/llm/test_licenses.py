import math
import re

import cases

from clickstrata.llm import licenses


def brute(documents, threshold=licenses.THRESHOLD):
    out = []
    for doc, text in documents:
        words = cases.alphanumeric(text)
        places, base = [], set()
        for phrase, label in licenses.PHRASES:
            p = phrase.split()
            at = [k for k in range(len(words)) if words[k : k + len(p)] == p]
            places += at
            base |= {label} if at else set()
        labels, score, matches = set(base), 1.0 if places else 0.0, []
        for n, line in enumerate((text or "").split("\n")):
            own = cases.alphanumeric(line)
            for label, template in licenses.TEMPLATES:
                t = set(cases.alphanumeric(template))
                shared = len(t & set(own))
                if shared >= max(1, math.ceil(round(threshold * len(t), 6))):
                    labels.add(label)
                    score = max(score, shared / len(t))
                    matches.append((label, n, shared / len(t)))
        out.append(
            (doc, len(words), len(places), min(places, default=None), max(places, default=None))
            + (",".join(sorted(base)), ",".join(sorted(labels)), score, sorted(matches))
        )
    return sorted(out, key=cases.key)


def ask(documents, **options):
    rows = licenses.scan_licenses(documents, **options).collect()
    return sorted((tuple(r)[:-1] + (sorted(tuple(m) for m in r["matches"]),) for r in rows), key=cases.key)


NOTICES = [
    (20, "a\nReleased under the MIT License.\n\nMIT\nLicense mit license MIT LICENSE"),
    (21, "x the general\npublic license and the Apache  License"),
    (22, licenses.TEMPLATES[8][1].upper() + "\nfoo"),
    (23, "# " + " ".join(licenses.TEMPLATES[1][1].split()[:18])),
    (24, "# " + " ".join(licenses.TEMPLATES[1][1].split()[:9])),
    (25, "mit-license; License mit"),
    (26, "This work is licensed under the GNU Lesser General Public License"),
]


def test_edge_cases(spark):
    texts = cases.TEXTS + NOTICES
    expected = brute(texts)
    assert ask(cases.documents(spark, texts)) == expected
    assert {row[6] for row in expected} >= {"mit", "apache,gpl", "bsd"}
    assert ask(cases.documents(spark, [])) == []


def test_lower_threshold(spark, monkeypatch):
    assert ask(cases.documents(spark, NOTICES), threshold=0.45) == brute(NOTICES, 0.45)


def test_supplied_table(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    expected = brute(documents.select("doc_id", "text").collect())
    assert ask(documents) == expected
    assert sum(row[2] for row in expected) == sum(len(re.findall(r"(?i)mit license|apache license|general public license", r["text"])) for r in documents.collect())
