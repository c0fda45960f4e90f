"""Benchmark passages in documents, by a prefix-filtered join and exact verification.

A benchmark item is cut into windows of ``window`` consecutive words (a shorter
item is one window). A document contains a window when it has all of the
window's shingles in place, so one shingle of each window is a necessary
prefix: its rarest one, by the number of times it occurs in all documents.
Documents are joined with these prefix shingles only; a match at place ``p`` of
a shingle at place ``k`` of its window fixes where the window would have to
begin, which the bounds of position (not before the text) and length (not past
its end) test before the words themselves are compared.

The benchmark's different rows are dealt by hash to blocks of ``block_bytes`` of
text in the mean (a block holds one item's text at least), whatever its size; there is one pass over the documents per block, and
the rows carry what earlier blocks found.

Words: A-Z lower-cased, ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``, compared by 64-bit hashes.
Null or empty texts have no words. Items without words are no windows; items
with the same id count once; a null item id counts as the empty string. Every
document row gives one row, repeated or null ids too.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import stage
from . import words as W

WINDOW = 10
SHINGLE = 3
BLOCK_BYTES = 4 << 20
_FILTER_BITS = 20


@dataclass
class Block:
    """Windows of some items. ``words`` holds all windows end to end."""

    item_ids: list[str]
    items: np.ndarray  # item of each window
    words: np.ndarray
    first: np.ndarray  # where a window's words begin; one more than there are windows
    shingles: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # size: hash, window, place of each shingle


@dataclass
class Prefixes:
    """Prefix shingles of one size, sorted by hash, with the windows they stand for."""

    size: int
    hashes: np.ndarray
    windows: np.ndarray
    places: np.ndarray
    seen: np.ndarray  # by the low bits of a hash: whether any prefix shingle has them


def _block(rows: list[tuple[str, str]], window: int) -> Block:
    found = W.words_of(pa.array([text for _, text in rows], pa.string()), W.ALPHANUMERIC)
    ids = sorted({item for item, _ in rows})
    number = {item: k for k, item in enumerate(ids)}
    items, parts = [], []
    shingles: dict[int, list[tuple[np.ndarray, int]]] = {}
    known: set[tuple[int, bytes]] = set()
    for k, (item, _) in enumerate(rows):
        own = found.hashes[found.first[k] : found.first[k + 1]]
        for at in range(max(1, len(own) - window + 1) if len(own) else 0):
            part = own[at : at + window]
            if (number[item], part.tobytes()) not in known:
                known.add((number[item], part.tobytes()))
                parts.append(part)
                items.append(number[item])
    for k, part in enumerate(parts):
        size = min(SHINGLE, len(part))
        shingles.setdefault(size, []).append((W.Words(part, np.zeros(len(part)), None, None).shingles(size), k))
    first = np.cumsum([0, *map(len, parts)])
    table = {
        size: (
            np.concatenate([h for h, _ in rows_of]),
            np.concatenate([np.full(len(h), k) for h, k in rows_of]),
            np.concatenate([np.arange(len(h)) for h, _ in rows_of]),
        )
        for size, rows_of in shingles.items()
    }
    words = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    return Block(ids, np.array(items, np.int64), words, first, table)


def _seen(hashes: np.ndarray) -> np.ndarray:
    table = np.zeros(1 << _FILTER_BITS, bool)
    table[hashes & np.uint64((1 << _FILTER_BITS) - 1)] = True
    return table


def _places_of(stream: np.ndarray, hashes: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the stream of values that are in the sorted ``hashes``, and which of these they are first at."""
    at = np.flatnonzero(seen[stream & np.uint64((1 << _FILTER_BITS) - 1)])
    where = np.searchsorted(hashes, stream[at])
    hit = hashes[np.minimum(where, len(hashes) - 1)] == stream[at]
    return at[hit], where[hit]


def _occurrences(documents: DataFrame, block: Block) -> dict[int, np.ndarray]:
    """How often each shingle of the block occurs in the documents, by size."""
    tables = {size: np.unique(h) for size, (h, _, _) in block.shingles.items()}
    sent = documents.sparkSession.sparkContext.broadcast(tables)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = sent.value
        totals = {size: np.zeros(len(h), np.int64) for size, h in tables.items()}
        filters = {size: _seen(h) for size, h in tables.items()}
        for part in W.slices(batches):
            found = W.words_of(part.column("text"), W.ALPHANUMERIC)
            for size, hashes in tables.items():
                at, where = _places_of(found.shingles(size), hashes, filters[size])
                where = where[found.whole(size)[at]]
                totals[size] += np.bincount(where, minlength=len(hashes))
        for size, total in totals.items():
            k = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), size)), pa.array(k), pa.array(total[k])], ["size", "k", "n"])

    counted = documents.select("text").mapInArrow(count, "size long, k long, n long").groupBy("size", "k").agg(F.sum("n").alias("n"))
    out = {size: np.zeros(len(h), np.int64) for size, h in tables.items()}
    for row in counted.collect():  # at most one row per shingle of the block
        out[row["size"]][row["k"]] = row["n"]
    return {size: out[size][np.searchsorted(tables[size], h)] for size, (h, _, _) in block.shingles.items()}


def _prefixes(block: Block, occurrences: dict[int, np.ndarray]) -> list[Prefixes]:
    """The rarest shingle of each window; of equally rare ones that with the smallest hash."""
    out = []
    for size, (hashes, windows, places) in block.shingles.items():
        order = np.lexsort((places, hashes, occurrences[size], windows))
        _, first = np.unique(windows[order], return_index=True)
        chosen = order[first]
        chosen = chosen[occurrences[size][chosen] > 0]
        chosen = chosen[np.argsort(hashes[chosen], kind="stable")]
        out.append(Prefixes(size, hashes[chosen], windows[chosen], places[chosen], _seen(hashes[chosen])))
    return [p for p in out if len(p.hashes)]


def _matches(found: W.Words, block: Block, prefixes: list[Prefixes]) -> tuple[np.ndarray, np.ndarray]:
    """First word and window of every occurrence of a window in the texts."""
    starts, windows = [], []
    for prefix in prefixes:
        at, low = _places_of(found.shingles(prefix.size), prefix.hashes, prefix.seen)
        if not len(at):
            continue
        many = np.searchsorted(prefix.hashes, prefix.hashes[low], side="right") - low
        at = np.repeat(at, many)
        k = np.repeat(low, many) + np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
        window = prefix.windows[k]
        begin, text = at - prefix.places[k], found.texts[at]
        length = np.diff(block.first)[window]
        inside = (begin >= found.first[text]) & (begin + length <= found.first[text + 1])
        begin, window, length = begin[inside], window[inside], length[inside]
        same = np.ones(len(begin), bool)
        for offset in range(int(length.max(initial=0))):
            open_ = np.flatnonzero(same & (length > offset))
            same[open_] = found.hashes[begin[open_] + offset] == block.words[block.first[window[open_]] + offset]
        starts.append(begin[same])
        windows.append(window[same])
    if not starts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(starts), np.concatenate(windows)


FOUND = "n_words long, hits array<struct<first:long,stop:long>>, items array<string>"
_HITS = pa.list_(pa.struct([("first", pa.int64()), ("stop", pa.int64())]))


def _runs(start: np.ndarray, stop: np.ndarray) -> list[tuple[int, int]]:
    """Disjoint word ranges that cover the same words, in order."""
    runs: list[list[int]] = []
    for a, b in sorted(zip(start.tolist(), stop.tolist(), strict=True)):
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b)
        else:
            runs.append([a, b])
    return [tuple(run) for run in runs]


def _scan(documents: DataFrame, block: Block) -> DataFrame:
    """Adds to each document's ``hits`` and ``items`` what it has of the block; ``carried`` passes unchanged."""
    prefixes = _prefixes(block, _occurrences(documents, block))
    sent = documents.sparkSession.sparkContext.broadcast((block, prefixes))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, prefixes = sent.value
        for part in W.slices(batches):
            found = W.words_of(part.column("text"), W.ALPHANUMERIC)
            start, window = _matches(found, block, prefixes)
            order = np.argsort(found.texts[start], kind="stable") if len(start) else start
            start, window = start[order], window[order]
            texts, cuts = np.unique(found.texts[start], return_index=True) if len(start) else ([], [])
            hits, items = part.column("hits").to_pylist(), part.column("items").to_pylist()
            cuts = [*cuts, len(start)]
            for text, low, high in zip(texts, cuts[:-1], cuts[1:], strict=True):
                begin = start[low:high] - found.first[text]
                runs = _runs(begin, begin + np.diff(block.first)[window[low:high]])
                old = [(h["first"], h["stop"]) for h in hits[text]]
                hits[text] = [{"first": a, "stop": b} for a, b in (_runs(*np.array(old + runs).T) if old else runs)]
                items[text] = sorted({*items[text], *(block.item_ids[k] for k in np.unique(block.items[window[low:high]]))})
            added = [pa.array(found.counts(), pa.int64()), pa.array(hits, _HITS), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([part.column("carried"), part.column("text"), *added], ["carried", "text", "n_words", "hits", "items"])

    return documents.mapInArrow(scan, f"carried {documents.schema['carried'].dataType.simpleString()}, text string, {FOUND}")


def find_passages(
    documents: DataFrame,
    benchmark: DataFrame,
    *,
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    carry: Sequence[str] = ("doc_id",),
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(carried, text, n_words, hits, items) per document row.

    ``carried`` holds the columns named in ``carry``, so that a decision needs no
    join back to the documents. ``hits`` are the disjoint ranges of word numbers
    inside any occurrence of a window, ``items`` the sorted ids (as strings) of
    the items that have one.
    """
    items = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
        F.coalesce(F.col(item_text_col), F.lit("")).alias("text"),
    )
    items = stage(items.distinct(), "benchmark")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-size // block_bytes))
    rows = documents.select(
        F.struct(*carry).alias("carried"),
        F.col(text_col).alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<struct<first:long,stop:long>>").alias("hits"),
        F.array().cast("array<string>").alias("items"),
    )
    for k in range(n_blocks):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == k) if n_blocks > 1 else items
        rows = _scan(rows, _block([tuple(row) for row in part.sort("item", "text").collect()], window))
        if k < n_blocks - 1:
            rows = stage(rows, "passages")
    return rows


def summarise(found: DataFrame) -> DataFrame:
    """Counts per document, and the digest of the item ids (sorted as strings, comma-joined)."""
    return found.select(
        "carried.*",
        "n_words",
        n_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (n_hit() > 0).alias("contaminated"),
    )


def n_hit() -> Column:
    """Number of words inside the ranges of ``hits``."""
    return F.aggregate("hits", F.lit(0).cast("long"), lambda total, run: total + run["stop"] - run["first"])
