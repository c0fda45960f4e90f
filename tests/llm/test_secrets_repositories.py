"""Candidates judged by owners and repositories together."""

from collections import defaultdict

from clickstrata.llm import secrets

HOT = "Qa7-Wz8_Ex9Rc1Tv2Yb3Un4Im5"
FEW = "Mk3-Jn4_Hb5Gv6Fc7Dx8Sz9Aq1"
LOST = "Pl0-Ok9_Ij8Uh7Yg6Tf5Rd4Es3"
ROWS = (
    [(k, f"x {HOT} y", "one") for k in range(secrets.COPIED_REPOS)]
    + [(100 + k % secrets.MAX_REPOS, f"x {FEW} y", "two") for k in range(20)]
    + [(200 + k, f"x {LOST} y", None) for k in range(secrets.COPIED_OWNERS)]
    + [(300, f"{HOT} password=abcdefabcdefg", "one")]
)


def brute(rows):
    owners, repos = defaultdict(set), defaultdict(set)
    for doc, text, owner in rows:
        for *_, digest in secrets.find_spans(text):
            who = ("owner", owner) if owner is not None else ("repo", doc)
            owners[digest].add(who)
            repos[digest].add((who, doc))
    live = {d for d in owners if len(owners[d]) <= secrets.MAX_OWNERS and len(repos[d]) <= secrets.MAX_REPOS}
    copied = {d for d in owners if len(owners[d]) >= secrets.COPIED_OWNERS or len(repos[d]) >= secrets.COPIED_REPOS}
    found = [(doc, [s[3] for s in secrets.find_spans(text)]) for doc, text, _ in rows]
    return sorted((doc, sum(d in live for d in own), sum(d in copied for d in own)) for doc, own in found)


def table(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, source string")


def test_both_counts_decide(spark):
    got = secrets.scan_secrets(table(spark)).collect()
    assert sorted((r["doc_id"], r["n_live"], r["n_copied"]) for r in got) == brute(ROWS)
    by_id = {r["doc_id"]: r for r in got}
    assert "unique" not in by_id[0]["spans"] and by_id[0]["n_copied"] == 1
    assert "unique" in by_id[100]["spans"] and by_id[100]["n_live"] == 1
    assert "unique" not in by_id[200]["spans"] and by_id[200]["n_copied"] == 1


def test_copied_in_one_source_is_not_cut_out(spark):
    texts = {r["doc_id"]: r["text"] for r in secrets.redact_secrets(table(spark)).collect()}
    assert texts[0] == f"x {HOT} y" and texts[100] == "x [SECRET] y" and texts[200] == f"x {LOST} y"
    assert texts[300] == f"{HOT} [SECRET]"
