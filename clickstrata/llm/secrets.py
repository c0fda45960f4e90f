"""Secrets in documents, judged by who else has them.

Patterns find candidate strings in every text. Each candidate's digest is then
counted over the corpus: in how many repositories and by how many owners it
occurs. A string that many owners or many repositories have is a copied example; one that
a single owner has in a few repositories looks live. The fixed patterns are reported whatever their
count. A long mixed string outside of them is added (kind ``unique``) only if it looks live.

Positions are code points, ends exclusive. A null or empty text has no spans. Each
document row gives one row; repeated rows and null ids keep theirs. Without an
owner, each repository is an owner of its own; rows without a repository share one.

Counting goes from (digest, owner, repository) to (digest, owner) to digest,
each with partial sums before its shuffle, so a string that a third of all rows
share is never gathered. Texts are not shuffled: what moves are the candidates.
The time for a text grows with its length and, by sorting, its number of spans.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import stage
from .words import slices

# The kinds in their order, and what their patterns ask for.
KINDS = ("assign", "access", "hex", "unique")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
MIN_ASSIGNED = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")

MIXED = re.compile(r"[A-Za-z0-9+/_=-]{24,}")
MIN_BITS = 3.5  # of entropy per character
MAX_OWNERS = 1
COPIED_OWNERS = 3
MAX_REPOS = 9  # a live string may stand in some repositories of its owner
COPIED_REPOS = 10

_SPAN = pa.struct([("kind", pa.string()), ("first", pa.int64()), ("stop", pa.int64()), ("digest", pa.string())])
_SPANS = pa.list_(_SPAN)
SPANS = "array<struct<kind:string,first:long,stop:long,digest:string>>"


def _digest(secret: str) -> str:
    return hashlib.blake2b(secret.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def _looks_random(text: str) -> bool:
    if not (any(c.isdigit() for c in text) and any(c.isalpha() for c in text)):
        return False
    n = len(text)
    return -sum(k / n * math.log2(k / n) for k in Counter(text).values()) >= MIN_BITS


def find_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, digest of the secret part) of the patterns' matches in a text, by kind."""
    found: list[tuple[str, int, int, str]] = []
    low = text.encode("utf-8", "surrogatepass").lower()
    if any(word in low for word in ASSIGN_WORDS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= MIN_ASSIGNED:
                found.append(("assign", *m.span(), _digest(m[2])))
    if "AKIA" in text:
        found += [("access", *m.span(), _digest(m[0])) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span(), _digest(m[0])) for m in HEX.finditer(text)]
    taken = sorted((a, b) for _, a, b, _ in found)
    starts, ends = [a for a, _ in taken], [0, *accumulate((b for _, b in taken), max)]
    for m in MIXED.finditer(text):
        # Of the spans that begin before its end, the one that ends last tells whether any overlaps it.
        if ends[bisect_left(starts, m.end())] <= m.start() and _looks_random(m[0]):
            found.append(("unique", *m.span(), _digest(m[0])))
    return found


def _row_key(doc_id, text: str) -> int:
    """Rows with the same id and text have the same spans and share a key."""
    raw = hashlib.blake2b(f"{doc_id}\n{text}".encode("utf-8", "surrogatepass"), digest_size=8).digest()
    return int.from_bytes(raw, "little", signed=True)


def candidates(documents: DataFrame, *, carry: Sequence[str] = (), id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str = "doc_id") -> DataFrame:
    """(doc_id, owner, repo, row_key, spans) per document row, in one pass over the texts; ``carry`` adds ``carried`` and ``text``."""
    rows = documents.select(
        F.struct(*(carry or [F.lit(None).cast("string").alias("none")])).alias("carried"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        F.col(owner_col).cast("string").alias("owner"),
        F.col(repo_col).cast("string").alias("repo"),
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            ids, spans, keys = part.column("doc_id").to_pylist(), [], []
            for doc_id, text in zip(ids, part.column("text").to_pylist(), strict=True):
                found = find_spans(text or "")
                spans.append([dict(zip(("kind", "first", "stop", "digest"), s, strict=True)) for s in found])
                keys.append(_row_key(doc_id, text or ""))
            columns = [part.column(c) for c in ("carried", "doc_id", "text", "owner", "repo")] if carry else [part.column(c) for c in ("doc_id", "owner", "repo")]
            names = ["carried", "doc_id", "text", "owner", "repo"] if carry else ["doc_id", "owner", "repo"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(keys, pa.int64()), pa.array(spans, _SPANS)], [*names, "row_key", "spans"])

    carried = f"carried {rows.schema['carried'].dataType.simpleString()}, doc_id long, text string" if carry else "doc_id long"
    return (rows if carry else rows.drop("carried")).mapInArrow(scan, f"{carried}, owner string, repo string, row_key long, spans {SPANS}")


def ownership(found: DataFrame) -> DataFrame:
    """(digest, n_owners, n_repos): distinct owners and repositories of every candidate string."""
    repo = F.coalesce("repo", F.lit(""))
    owner = F.coalesce(F.concat(F.lit("owner:"), "owner"), F.concat(F.lit("repo:"), repo))
    each = found.select(F.explode("spans.digest").alias("digest"), owner.alias("owner"), repo.alias("repo"))
    by_owner = each.groupBy("digest", "owner", "repo").agg(F.lit(1).alias("one")).groupBy("digest", "owner").agg(F.count("*").alias("repos"))
    return by_owner.groupBy("digest").agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos"))


def row_owners(found: DataFrame) -> DataFrame:
    """(row_key, owners): for each row with candidates, whether it looks ``live`` or ``copied``, by digest."""
    each = found.where(F.size("spans") > 0).select("row_key", F.explode(F.array_distinct("spans.digest")).alias("digest")).distinct()
    live = (F.col("n_owners") <= MAX_OWNERS) & (F.col("n_repos") <= MAX_REPOS)
    copied = (F.col("n_owners") >= COPIED_OWNERS) | (F.col("n_repos") >= COPIED_REPOS)
    judged = ownership(found).select("digest", F.struct(live.alias("live"), copied.alias("copied")).alias("is"))
    return each.join(judged, "digest").groupBy("row_key").agg(F.map_from_entries(F.collect_list(F.struct("digest", "is"))).alias("owners"))


def _added(span: Column, owners: Column) -> Column:
    return (span["kind"] == "unique") & owners[span["digest"]]["live"]


def _listed(spans: Column) -> Column:
    """kind:start:end by start, then kind in the order of ``KINDS``, comma-joined."""
    rank = F.create_map(*[x for k, kind in enumerate(KINDS) for x in (F.lit(kind), F.lit(k))])
    keyed = F.transform(spans, lambda s: F.struct(s["first"].alias("first"), rank[s["kind"]].alias("rank"), s["stop"].alias("stop"), s["kind"].alias("kind")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", s["kind"], s["first"].cast("string"), s["stop"].cast("string"))), ",")


def scan_secrets(documents: DataFrame, **columns: str) -> DataFrame:
    """Counts and spans per document row, with the number of its candidates that look live and that are copied examples."""
    found = stage(candidates(documents, **columns), "secrets")
    rows = found.drop("owner", "repo").join(row_owners(found), "row_key", "left")
    base = F.filter("spans", lambda s: s["kind"] != "unique")
    owners, many = F.col("owners"), lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    kept = F.filter("spans", lambda s: (s["kind"] != "unique") | _added(s, owners))
    return rows.select(
        "doc_id",
        many("assign").alias("n_assign"),
        many("access").alias("n_access"),
        many("hex").alias("n_hex"),
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(kept).alias("spans"),
        F.size(F.filter("spans", lambda s: owners[s["digest"]]["live"])).cast("long").alias("n_live"),
        F.size(F.filter("spans", lambda s: owners[s["digest"]]["copied"])).cast("long").alias("n_copied"),
    )


def _without(text: str, spans: list[tuple[int, int]], mark: str) -> str:
    """The text with each run of overlapping spans replaced by ``mark``."""
    out, at = [], 0
    for first, stop in sorted(spans):
        if first >= at:
            out += [text[at:first], mark]
        at = max(at, stop)
    return "".join([*out, text[at:]])


def redact_secrets(documents: DataFrame, *, mark: str = "[SECRET]", text_col: str = "text", id_col: str = "doc_id", **columns: str) -> DataFrame:
    """All rows and columns of the documents, with every reported span replaced by ``mark``; a null text stays null.

    Rows without ``unique`` candidates are decided from their own text and are not shuffled.
    """
    names = documents.columns
    needed = stage(candidates(documents, text_col=text_col, id_col=id_col, **columns), "secrets")
    known = row_owners(needed)
    scanned = candidates(documents, carry=[c for c in names if c != text_col], text_col=text_col, id_col=id_col, **columns)
    undecided = F.exists("spans", lambda s: s["kind"] == "unique")
    shape = ["carried", "text", "spans"]
    plain = scanned.where(~undecided).select(*shape)
    kept = F.filter("spans", lambda s: (s["kind"] != "unique") | _added(s, F.col("owners")))
    judged = scanned.where(undecided).join(known, "row_key", "left").select("carried", "text", kept.alias("spans"))
    rows = plain.unionByName(judged)

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = part.column("text").to_pylist()
            for k, spans in enumerate(part.column("spans").to_pylist()):
                if spans:
                    texts[k] = _without(texts[k], [(s["first"], s["stop"]) for s in spans], mark)
            yield pa.RecordBatch.from_arrays([part.column("carried"), pa.array(texts, pa.string())], ["carried", "text"])

    out = rows.mapInArrow(replace, f"carried {rows.schema['carried'].dataType.simpleString()}, text string")
    return out.select(*[F.col("text").alias(c) if c == text_col else F.col("carried")[c].alias(c) for c in names])
