import cases
import numpy as np

from clickstrata.llm import urls
from clickstrata.llm.queries import URL_RULES


def split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = cases.lower(rest[:cut]), rest[cut:]
    return host, rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]


def fitting(host, path, rules):
    fits = [(-len(h + p), v != "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (min(fits)[2], min(fits)[3]) if fits else (None, None)


PAGES = [
    (1, "https://WWW.Example.com/en/x?y#z", ""),
    (2, "http://m.example.com/en/", ""),
    (3, "http://example.com", ""),
    (4, "https://a.net/fr/1", '<a href="https://Friend.org/x">1</a> <A class=x HREF=//cdn.org>2</a>'),
    (5, "https://a.net/de/1?q=://x", '<a href="/local">1</a><a href="mailto:x@y">2</a>'),
    (6, "https://friend.org/", "<a href='http://a.net/'>x</a><a href='http://a.net/2'>x</a>"),
    (7, "https://helper.org/", '<a href="https://a.net/fr/9">x</a>'),
    (8, "no scheme", "<a href=http://a.net/>x</a>"),
    (9, None, None),
    (9, None, None),
    (None, "ftp://x.y.com:80/en/", None),
    (11, "http://://odd", "<a href="),
    (12, "https://deep.www.example.com/en/9#://", ""),
    (13, "https://good.com/", '<a href="https://helper.org/">x</a>'),
]


def table(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "p", "q", "w") for r in rows], "page_id long, url string, html string, host string, rule string, verdict string")


def test_rules_and_parts(spark):
    got = sorted((tuple(r)[:4] for r in urls.judge_urls(table(spark), urls.rules_table(spark, URL_RULES)).collect()), key=cases.key)
    expected = sorted(((k, *split(u), fitting(*split(u), URL_RULES)[0]) for k, u, _ in PAGES), key=cases.key)
    assert got == expected


def test_ranks_against_plain_iteration(spark):
    rules = [("good.com", "/", "allow"), ("a.net", "/fr/", "block")]
    got = {r["page_id"]: r for r in urls.judge_urls(table(spark), urls.rules_table(spark, rules), threshold=0.5).collect()}
    hosts = ["a.net", "friend.org", "cdn.org", "helper.org", "good.com"]
    links = np.zeros((5, 5))
    for a, b, n in (("a.net", "friend.org", 1), ("a.net", "cdn.org", 1), ("friend.org", "a.net", 2), ("helper.org", "a.net", 1), ("good.com", "helper.org", 1)):
        links[hosts.index(a), hosts.index(b)] = n

    def received(m, seed):
        out = m.sum(1)
        step = np.divide(m, out[:, None], out=np.zeros_like(m), where=out[:, None] > 0)
        share = np.eye(5)[hosts.index(seed)]
        rank = share.copy()
        for _ in range(urls.ROUNDS):  # the scaled form: what is lost at hosts without links goes back to the seed at the end
            moved = urls.DAMPING * rank @ step
            rank = moved + share
        return moved / rank.sum() * 5

    trust, distrust = received(links, "good.com"), received(links.T, "a.net")
    for page, host in ((5, "a.net"), (6, "friend.org"), (7, "helper.org")):
        assert np.isclose(got[page]["trust"], trust[hosts.index(host)]) and np.isclose(got[page]["distrust"], distrust[hosts.index(host)])
    assert got[6]["verdict"] == "block" and got[7]["verdict"] == ("block" if distrust[3] > max(trust[3], 0.5) else "allow")
    assert got[3]["verdict"] == "allow" and got[9]["verdict"] == "allow"


def test_empty_tables(spark):
    rules = urls.rules_table(spark, URL_RULES)
    assert urls.judge_urls(table(spark, []), rules).collect() == []
    assert {r["verdict"] for r in urls.judge_urls(table(spark), rules.limit(0)).collect()} == {"allow"}


def test_supplied_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = [(r["page_id"], r["url"]) for r in pages.collect()]
    got = sorted((tuple(r)[:5] for r in urls.judge_urls(pages, urls.rules_table(spark, URL_RULES)).collect()), key=cases.key)
    expected = [(k, *split(u), *fitting(*split(u), URL_RULES)) for k, u in rows]
    assert got == sorted(((*e[:4], e[4] or "allow") for e in expected), key=cases.key)
