"""URL verdicts: rules first, then trust and distrust along the links between hosts.

A rule is (host, path, verdict). It fits its host and all subdomains where the
url's path starts with the rule's path. The longest fitting rule wins (length
of host and path together; equally long: blocking, then the smaller text).

Other urls are judged by their host. Links of the pages give weighted edges
between hosts. Trust is personalised PageRank from the hosts of allowed pages
along the links; distrust the same from the hosts of blocked pages against the
links, since who links to blocked hosts is suspect. What a host has received
(its rank without its own restart share) is compared, in multiples of the mean
rank: it is blocked if its distrust is at least ``threshold`` and more than
its trust. A host without links receives nothing and is allowed.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
path: from there up to ``?``, ``#`` or the end. A null url, or one without
``://``, has both empty: no rule fits and no link leads there, so it is allowed.
Each page row gives one row; repeated or null ids too.

Edges and hosts are summed before anything is joined, rules are looked up once
per host, and ranks are written to the shared folder every few rounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import clear_scratch, scratch_path, stage

ALLOW, BLOCK = "allow", "block"
DAMPING = 0.85
ROUNDS = 20
WRITE_EVERY = 5
THRESHOLD = 1.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# What a link names: a scheme and two slashes, or two slashes alone, in an anchor's href.
LINK = r"""(?is)<a\s[^>]*?\bhref\s*=\s*["']?\s*((?:https?:)?//[^"'\s>]+)"""
RULE = "host string, path string, verdict string"


def _after(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_after(url), r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rules_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), RULE)


def _rules_of_hosts(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rules): the rules of each host and of the domains above it, best first."""
    labels = F.split("host", r"\.", -1)
    above = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    own = hosts.where("host <> ''").select("host", F.explode(above).alias("domain"))
    text = F.concat("rule_host", "path")
    order = F.struct((-F.length(text)).alias("length"), F.when(F.col("verdict") == BLOCK, 0).otherwise(1).alias("kind"), text.alias("rule"), "path", "verdict")
    named = rules.select(F.translate("host", UPPER, LOWER).alias("rule_host"), "path", "verdict").distinct()
    return own.join(named, own["domain"] == named["rule_host"]).groupBy("host").agg(F.array_sort(F.collect_list(order)).alias("rules"))


def host_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst, n): links from pages of one host to another host."""
    link = F.explode(F.regexp_extract_all(F.col(html_col), F.lit(LINK), 1))
    dst = host_of(F.when(F.startswith("link", F.lit("//")), F.concat(F.lit("http:"), "link")).otherwise(F.col("link")))
    found = pages.select(host_of(F.col(url_col)).alias("src"), link.alias("link")).select("src", dst.alias("dst"))
    return found.where("src <> '' AND dst <> '' AND src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))


def personalised_rank(edges: DataFrame, seeds: DataFrame, *, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(host, rank, received) from the restart hosts in ``seeds``; edges are (src, dst, n).

    A rank leaves a host along its edges in proportion to ``n``; from hosts
    without edges it goes back to the seeds, which scales all ranks alike, so it
    is done once at the end: ranks sum to 1.
    """
    spark = edges.sparkSession
    restart = seeds.select("host").distinct()
    n_seeds = restart.count()
    if not n_seeds:
        return restart.select("host", F.lit(0.0).alias("rank"), F.lit(0.0).alias("received"))
    restart = restart.select("host", F.lit(1.0 / n_seeds).alias("share"))
    out = edges.groupBy("src").agg(F.sum("n").alias("total"))
    steps = stage(edges.join(out, "src").select("src", "dst", (F.col("n") / F.col("total")).alias("weight")), "links")
    zero = F.lit(0.0)
    ranks, written = restart.select("host", F.col("share").alias("rank"), zero.alias("received")), None
    for k in range(rounds):
        moved = ranks.join(steps, ranks["host"] == steps["src"]).groupBy("dst").agg(F.sum(F.col("rank") * F.col("weight") * damping).alias("got"))
        both = moved.select(F.col("dst").alias("host"), "got").join(restart, "host", "full")
        got, share = F.coalesce("got", zero), F.coalesce("share", zero)
        ranks = both.select("host", (got + share).alias("rank"), got.alias("received"))
        if (k + 1) % WRITE_EVERY == 0 or k == rounds - 1:
            path = scratch_path(spark, "ranks")
            ranks.write.parquet(path)
            ranks = spark.read.parquet(path)
            if written:
                clear_scratch(spark, written)
            written = path
    total = ranks.agg(F.sum("rank")).first()[0]
    return ranks.select("host", (F.col("rank") / total).alias("rank"), (F.col("received") / total).alias("received"))


def host_scores(pages: DataFrame, judged: DataFrame, *, damping: float = DAMPING, rounds: int = ROUNDS, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, trust, distrust) of hosts that the links reach, in multiples of the mean rank.

    ``judged`` has the hosts and verdicts (null: none) of the pages that rules decide.
    """
    edges = stage(host_links(pages, url_col, html_col), "edges")
    seeds = stage(judged.where("verdict IS NOT NULL").groupBy("host").agg(F.max(F.col("verdict") == BLOCK).alias("blocked"), F.max(F.col("verdict") == ALLOW).alias("allowed")), "seeds")
    if edges.isEmpty():
        return edges.sparkSession.createDataFrame([], "host string, trust double, distrust double")
    nodes = edges.select(F.explode(F.array("src", "dst")).alias("host")).unionByName(seeds.select("host")).distinct()
    n = nodes.count()
    trust = personalised_rank(edges, seeds.where("allowed AND NOT blocked"), damping=damping, rounds=rounds)
    against = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    distrust = personalised_rank(against, seeds.where("blocked"), damping=damping, rounds=rounds)
    return trust.select("host", (F.col("received") * n).alias("trust")).join(distrust.select("host", (F.col("received") * n).alias("distrust")), "host", "full").na.fill(0.0)


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    *,
    threshold: float = THRESHOLD,
    damping: float = DAMPING,
    rounds: int = ROUNDS,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) per page row."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    # Written first, so that the join below stands on two plain shuffles and adaptive execution can split a hot host.
    known = stage(_rules_of_hosts(rows.select("host").distinct(), rules), "host_rules")
    best = F.filter("rules", lambda r: F.startswith(F.col("path"), r["path"]))
    fitted = rows.join(known, "host", "left").select("page_id", "host", "path", F.try_element_at(best, F.lit(1)).alias("best"))
    fitted = stage(fitted.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict")), "ruled")
    scores = host_scores(pages, fitted, damping=damping, rounds=rounds, url_col=url_col, html_col=html_col)
    scored = fitted.join(scores, "host", "left").na.fill(0.0, ["trust", "distrust"])
    bad = (F.col("distrust") >= threshold) & (F.col("distrust") > F.col("trust"))
    method = F.when(bad, BLOCK).otherwise(ALLOW)
    return scored.select("page_id", "host", "path", "rule", F.coalesce("verdict", method).alias("verdict"), "trust", "distrust")
