"""Notices that are wrapped over lines, and long lines that only hold a template's words somewhere."""

import textwrap

import cases

from clickstrata.llm import licenses

MIT, BSD, ISC = (licenses.TEMPLATES[k][1] for k in (1, 8, 12))
FILLER = " ".join(f"filler{k}" for k in range(40))


def brute(text, threshold=licenses.THRESHOLD):
    """Labels of all lines of at most ``span`` words and of all windows of ``span`` words, one by one."""
    words, out = cases.alphanumeric(text), set()
    for label, template in licenses.TEMPLATES:
        own = cases.alphanumeric(template)
        span = max(len(own), -(-len(own) * 1000 // round(threshold * 1000)))
        blocks = [words[k : k + span] for k in range(len(words))]
        blocks += [b for b in map(cases.alphanumeric, text.split("\n")) if len(b) <= span]
        if any(len(set(b) & set(own)) * 1000 >= round(threshold * 1000) * len(set(own)) for b in blocks):
            out.add(label)
    return out


def ask(spark, texts):
    rows = licenses.scan_licenses(cases.documents(spark, list(enumerate(texts)))).collect()
    return [r for _, r in sorted((r["doc_id"], r) for r in rows)]


def test_wrapped_notices(spark):
    texts = ["/*\n" + "\n".join(f" * {x}" for x in textwrap.wrap(notice, width)) + "\n */\n" + FILLER for notice in (MIT, BSD, ISC) for width in (20, 40, 72)]
    for text, row in zip(texts, ask(spark, texts), strict=True):
        assert {m["label"] for m in row["matches"]} == brute(text) != set()
        assert row["score"] == 1.0 and row["matches"][0]["line"] == 1


def test_words_spread_over_a_long_line(spark):
    spread = f"released {FILLER} under {FILLER} the {FILLER} license"
    inside = f"{FILLER} released under the MIT license {FILLER}"
    found = ask(spark, [spread, inside, f"x\n{inside}", f"released {FILLER}\nunder the MIT license {FILLER}"])
    assert [r["labels"] for r in found] == ["", "mit", "mit", "mit"]
    assert [[tuple(m) for m in r["matches"]] for r in found] == [[], [("mit", 0, 1.0)], [("mit", 1, 1.0)], [("mit", 1, 0.8)]]


def test_windows_stay_within_a_text(spark):
    assert [r["matches"] for r in ask(spark, ["released under", "the license"])] == [[], []]


def test_every_notice_counts_once(spark):
    wrapped = "\n".join(textwrap.wrap(BSD, 50))
    row = ask(spark, [f"{wrapped}\n{FILLER}\n{BSD}\n{FILLER}\n{wrapped}"])[0]
    assert [m["label"] for m in row["matches"]] == ["bsd"] * 3
