"""Documents whose word n-gram sets are similar, by a size-aware heavy-light join.

A document's set holds its distinct shingles of ``SIZE`` words. Sets ``A`` and
``B`` link at a Jaccard similarity of 80 %, which for sizes ``s`` and ``t`` means
``c(s, t) = ceil(4 (s + t) / 9)`` common shingles.

* Small sets are joined by enumeration: each emits, for every partner size, the
  hashes of its subsets of ``c(s, t)`` shingles. Linked sets, and no others, share one.
* Large sets scan inverted lists. By pigeonhole it is enough to list a set's first
  ``s - ceil(0.8 s) + 1`` shingles in one global order, in which shingles with long lists
  come last. Partners must pass the bounds of size and position.
* The boundary between the two is where the summed cost of both is least: subsets
  emitted against list entries met, from the sizes and lists of the data.

Candidates are first compared by sketches: a shingle flips one of the bits
of its set's sketch, so two sketches differ in no more bits than the sets do in shingles, and a
pair with more differing bits than linked sets can have is none. A sketch has twice as
many bits as the set has shingles, at least, so that those of long texts do not all look alike. Every other
candidate is verified on the whole sets. Equal sets are one node of the link
graph, whatever the number of copies. In a bucket (subset or list) the members
are first compared with one pivot; what that links is put into components.
Only members of different components are then compared with each other, so a
group of near copies costs a multiple of its size, not the square, and no link
between components is lost. Long lists are split by adaptive joins and counted with partial sums.

Words: A-Z lower-cased, ``[^\\x20\\x09-\\x0D]+``, compared by 64-bit hashes. Fewer
words than ``SIZE`` are one shingle; without words (null or empty text) the set
is empty and linked with nothing. Every row gives one row. A null id counts
as larger than all others: a component's id is its smallest id that is not null.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources import stage
from . import words as W

SIZE = 5
LONGEST_SMALL = 40  # largest boundary considered
MOST_SUBSETS = 5_000  # subsets of one set for one partner size, at the most
MOST_FREQUENT = 1 << 16  # bound on the shingles of long lists
LONG_LIST = 32
_SEEN = 1_000_000
SKETCH = 8  # 64-bit numbers of a sketch, at the least
WIDEST = 1 << 10  # and at the most
SLOTS = 256  # tasks that the members of one bucket are spread over, at the most
ENTRY_COLUMNS = ("bucket", "key", "size", "place", "least", "slot")
_U = np.uint64


def needed(s: int, t: int) -> int:
    """Common shingles of linked sets of these sizes."""
    return -(-4 * (s + t) // 9)


def partners(s: int) -> range:
    """Sizes of sets that a set of ``s`` shingles can be linked with."""
    return range(-(-4 * s // 5), 5 * s // 4 + 1)


def prefix(s: np.ndarray) -> np.ndarray:
    """How many shingles of a set are listed."""
    return s - -(-4 * s // 5) + 1


def subsets(s: int) -> int:
    """How many subsets a set of ``s`` shingles emits."""
    return sum(comb(s, needed(s, t)) for t in partners(s))


def enumerable(s: int) -> bool:
    return s <= LONGEST_SMALL and all(comb(s, needed(s, t)) <= MOST_SUBSETS for t in partners(s))


def sketch_width(s: np.ndarray) -> np.ndarray:
    """Numbers of the sketches of sets of these sizes: a power of two, for linked sets the same or twice as many."""
    width = np.full(len(s), SKETCH)
    while (short := (32 * width < s) & (width < WIDEST)).any():
        width[short] *= 2
    return width


class Sets:
    """Shingle sets of a slice of texts, end to end: sorted by text, then by the order of shingles."""

    def __init__(self, texts: pa.Array, frequent: np.ndarray | None = None) -> None:
        found = W.words_of(texts, W.NON_SPACE)
        n_words = found.counts()
        inside = found.whole(SIZE)
        hashes, owners = [found.shingles(SIZE)[inside]], [found.texts[: len(inside)][inside]]
        short = np.flatnonzero((n_words > 0) & (n_words < SIZE))
        for n in np.unique(n_words[short]):
            own = short[n_words[short] == n]
            hashes.append(found.shingles(int(n))[found.first[own]])
            owners.append(own)
        h, owner = np.concatenate(hashes), np.concatenate(owners)
        late = np.zeros(len(h), bool)
        if frequent is not None and len(frequent):
            late = frequent[np.minimum(np.searchsorted(frequent, h), len(frequent) - 1)] == h
        # Sorted by shingle first, then stably by text and lateness in small integers, which numpy sorts by digits.
        order = np.argsort(h)
        group = owner * 2 + late
        group = group.astype(np.uint16) if 2 * len(texts) <= 1 << 16 else group
        order = order[np.argsort(group[order], kind="stable")]
        h, owner = h[order], owner[order]
        fresh = np.ones(len(h), bool)
        fresh[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
        self.hashes, self.owners = h[fresh], owner[fresh]
        self.sizes = np.bincount(self.owners, minlength=len(texts))
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])

    def keys(self) -> np.ndarray:
        """Two 64-bit sums per set, independent of order."""
        sums = [np.concatenate([np.zeros(1, _U), np.cumsum(W.mix(self.hashes ^ _U(salt)))]) for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
        return np.stack([W.mix(s[self.first[1:]] - s[self.first[:-1]] + self.sizes.astype(_U)) for s in sums], 1)

    def sketches(self) -> pa.Array:
        """Per set, ``SKETCH`` numbers whose bits are flipped by its shingles."""
        bit = W.mix(self.hashes ^ _U(0x9FB21C651E98DF25)) % _U(64 * SKETCH)
        out = np.zeros(len(self.sizes) * SKETCH, np.uint64)
        np.bitwise_xor.at(out, self.owners * SKETCH + (bit >> _U(6)).astype(np.int64), _U(1) << (bit & _U(63)))
        return pa.ListArray.from_arrays(pa.array(np.arange(0, len(out) + 1, SKETCH, dtype=np.int32)), _signed(out))

    def wide_sketches(self) -> pa.Array:
        """The same with :func:`sketch_width` numbers; the first half of a sketch xor the second is the sketch of half the width."""
        width = sketch_width(self.sizes)
        ends = np.concatenate([[0], np.cumsum(width)])
        bit = W.mix(self.hashes ^ _U(0x9FB21C651E98DF25)) & (64 * width - 1).astype(np.uint64)[self.owners]
        out = np.zeros(ends[-1], np.uint64)
        np.bitwise_xor.at(out, ends[self.owners] + (bit >> _U(6)).astype(np.int64), _U(1) << (bit & _U(63)))
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), _signed(out))


def _binary(keys: np.ndarray) -> pa.Array:
    raw = pa.py_buffer(np.ascontiguousarray(keys).tobytes())
    return pa.Array.from_buffers(pa.binary(16), len(keys), [None, raw]).cast(pa.binary())


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


class _First:
    """Whether a key is seen for the first time; forgets now and then, as repeats only cost time."""

    def __init__(self) -> None:
        self.seen: set[bytes] = set()

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        if len(self.seen) > _SEEN:
            self.seen.clear()
        out = np.zeros(len(keys), bool)
        for k, key in enumerate(map(bytes, keys)):
            if key not in self.seen:
                self.seen.add(key)
                out[k] = True
        return out


def _keyed(documents: DataFrame, carry: Sequence[str], text_col: str, sketched: bool = False) -> DataFrame:
    """(carried, key, n) per row, and ``sketch`` if it is asked for."""
    rows = documents.select(F.struct(*carry).alias("carried"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches):
            sets = Sets(part.column("text"))
            columns = [part.column("carried"), _binary(sets.keys()), pa.array(sets.sizes, pa.int64()), *([sets.wide_sketches()] if sketched else [])]
            yield pa.RecordBatch.from_arrays(columns, ["carried", "key", "n", "sketch"][: len(columns)])

    shape = f"carried {rows.schema['carried'].dataType.simpleString()}, key binary, n long"
    return rows.mapInArrow(run, f"{shape}, sketch array<long>" if sketched else shape)


def _sets(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, key, n, sketch) per row, stored."""
    keyed = _keyed(documents, [id_col], text_col, sketched=True)
    return stage(keyed.select(F.col(f"carried.{id_col}").cast("long").alias("doc_id"), "key", "n", "sketch"), "sets")


def _slots(buckets: np.ndarray, keys: np.ndarray) -> pa.Array:
    """Per entry: 0 if it is alone in its bucket here, 1 if it is the first of several, and by its key, from 2, if it is another of them."""
    _, first, inverse, many = np.unique(buckets, return_index=True, return_inverse=True, return_counts=True)
    slots = np.where(many[inverse] > 1, 2 + (keys[:, 0] % _U(SLOTS)).astype(np.int32), 0)
    slots[first[many > 1]] = 1
    return pa.array(slots.astype(np.int32))


def _places(sets: Sets, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of each shingle in its set, and whether it is listed."""
    place = np.arange(len(sets.hashes)) - sets.first[sets.owners]
    return place, own[sets.owners] & (place < prefix(sets.sizes)[sets.owners])


def _listed(sets: Sets, keys: np.ndarray, own: np.ndarray) -> pa.RecordBatch:
    """(bucket, key, size, place, least, slot) of the listed shingles of the sets ``own``; ``least`` is 0."""
    place, kept = _places(sets, own)
    owner, hashes = sets.owners[kept], sets.hashes[kept]
    numbers = [pa.array(n.astype(np.int32)) for n in (sets.sizes[owner], place[kept], np.zeros(len(owner)))]
    return pa.RecordBatch.from_arrays([_signed(hashes), _binary(keys[owner]), *numbers, _slots(hashes, keys[owner])], ENTRY_COLUMNS)


def _enumerated(sets: Sets, keys: np.ndarray, small: np.ndarray, boundary: int) -> Iterator[pa.RecordBatch]:
    """The same of the subsets of the sets ``small``; ``least`` is the smaller of the two sizes meant."""
    for s in np.unique(sets.sizes[small]).tolist():
        own = np.flatnonzero(small & (sets.sizes == s))
        values = W.mix(sets.hashes[sets.first[own][:, None] + np.arange(s)] ^ _U(0x2545F4914F6CDD1D))
        total = values.sum(1)
        for t in partners(s):
            if not 0 < t <= boundary:
                continue
            left_out = np.array(list(combinations(range(s), s - needed(s, t))), np.int64).reshape(comb(s, needed(s, t)), -1)
            rows = max(1, 200_000 // len(left_out))
            for at in range(0, len(own), rows):
                v = values[at : at + rows]
                h = W.mix(total[at : at + rows, None] - v[:, left_out].sum(2) + _U(min(s, t) * 1000 + max(s, t)))
                numbers = [pa.array(np.full(h.size, n, np.int32)) for n in (s, 0, min(s, t))]
                owned = np.repeat(keys[own[at : at + rows]], len(left_out), 0)
                yield pa.RecordBatch.from_arrays([_signed(h.ravel()), _binary(owned), *numbers, _slots(h.ravel(), owned)], ENTRY_COLUMNS)


def _entries(texts: DataFrame, frequent: np.ndarray, boundary: int) -> DataFrame:
    """List entries of the sets that a set above the boundary can be linked with, and the subsets of the sets up to it."""
    sent = texts.sparkSession.sparkContext.broadcast(frequent)
    least = max(1, partners(boundary + 1).start)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = _First()
        for part in W.slices(batches):
            sets = Sets(part.column("text"), sent.value)
            keys = sets.keys()
            fresh = (sets.sizes > 0) & first(keys)
            yield _listed(sets, keys, fresh & (sets.sizes >= least))
            yield from _enumerated(sets, keys, fresh & (sets.sizes <= boundary), boundary)

    return texts.mapInArrow(run, "bucket long, key binary, size int, place int, least int, slot int")


def _met(entries: DataFrame) -> DataFrame:
    """The entries of buckets with several members, from one shuffle of all entries.

    Of the members that one slice of texts has in a bucket, only the first goes to the
    bucket's common task; the others, which are not alone, are spread by their keys. So that task gets
    one row per slice at the most, and is told by slot 1 that there are more.
    """
    entries = entries.withColumn("spread", F.when(F.col("slot") > 1, F.col("slot")).otherwise(0))
    bucket = Window.partitionBy("least", "bucket", "spread")
    several = (F.max("slot").over(bucket) > 0) | (F.min("key").over(bucket) != F.max("key").over(bucket))
    # Copies in different slices give equal entries.
    return entries.withColumn("several", several).where("several").select("bucket", "key", "size", "place", "least").distinct()


def _list_lengths(texts: DataFrame) -> DataFrame:
    """(bucket, entries) of the lists of all sets, summed per slice before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = _First()
        for part in W.slices(batches):
            sets = Sets(part.column("text"))
            listed, many = np.unique(sets.hashes[_places(sets, (sets.sizes > 0) & first(sets.keys()))[1]], return_counts=True)
            yield pa.RecordBatch.from_arrays([_signed(listed), pa.array(many.astype(np.int64))], ["bucket", "entries"])

    return texts.mapInArrow(run, "bucket long, entries long").groupBy("bucket").agg(F.sum("entries").alias("entries"))


def _boundary(sizes: DataFrame, mean_list: float) -> int:
    """The size up to which enumeration is cheaper in sum; ``sizes`` has (n, sets)."""
    many = {row["n"]: row["sets"] for row in sizes.where(F.col("n") <= LONGEST_SMALL).collect()}  # at most LONGEST_SMALL rows
    best, least, total = 0, 0.0, 0.0
    for s in range(1, LONGEST_SMALL + 1):
        if not enumerable(s):
            break
        total += many.get(s, 0) * (subsets(s) - int(prefix(np.array(s))) * (1 + mean_list))
        if total < least:
            best, least = s, total
    return best


def _frequent(texts: DataFrame) -> tuple[np.ndarray, float]:
    """Shingles with the longest lists (at most ``MOST_FREQUENT``), and how many entries a shingle of any other list meets."""
    counted = stage(_list_lengths(texts).where("entries > 1"), "lists")
    long = max(LONG_LIST, (counted.agg(F.sum("entries")).first()[0] or 0) // MOST_FREQUENT)
    total, squares = counted.where(F.col("entries") <= long).agg(F.sum("entries"), F.sum(F.col("entries").cast("double") ** 2)).first()
    rows = counted.where(F.col("entries") > long).select("bucket").toLocalIterator()
    known = np.fromiter((row[0] for row in rows), np.int64).view(_U)
    return np.sort(known), squares / total if total else 1.0


def _pair(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _fits(s: str, t: str):
    """Bound of size."""
    return (F.col(s) * 5 >= F.col(t) * 4) & (F.col(t) * 5 >= F.col(s) * 4)


def _reaches(s: str, i: str, t: str, j: str):
    """Bound of position: what can still be common from these places on is enough."""
    return F.least(F.col(s) - F.col(i), F.col(t) - F.col(j)) * 9 >= (F.col(s) + F.col(t)) * 4


def _with_pivots(entries: DataFrame, keep, by: Sequence[str]) -> DataFrame:
    """Pairs of each bucket's members with its smallest one."""
    pivots = entries.groupBy(*by).agg(F.min(F.struct("size", "key", "place")).alias("pivot"), F.count("*").alias("members")).where("members > 1")
    met = entries.join(pivots.select(*by, *[F.col(f"pivot.{c}").alias(f"pivot_{c}") for c in ("size", "key", "place")]), list(by))
    return met.where((F.col("key") != F.col("pivot_key")) & keep).select(*_pair("key", "pivot_key")).distinct()


def _across(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs of members of a list that are in different components."""
    own = entries.join(labels, "key", "left").withColumn("root", F.coalesce("root", "key"))
    per_root = own.groupBy("bucket", "root").agg(F.count("*").alias("members"))
    mixed = per_root.groupBy("bucket").agg(F.max_by("root", F.struct("members", "root")).alias("major"), F.count("*").alias("roots")).where("roots > 1").drop("roots")
    own = stage(own.join(mixed, "bucket"), "mixed")
    minor = own.where("root != major").select("bucket", *[F.col(c).alias(f"{c}_") for c in ("key", "size", "place", "root")])
    ordered = (F.col("root") == F.col("major")) | (F.col("key") < F.col("key_"))
    met = minor.join(own, (minor["bucket"] == own["bucket"]) & (F.col("root") != F.col("root_")) & ordered & _fits("size", "size_") & _reaches("size", "place", "size_", "place_"))
    return met.select(*_pair("key", "key_")).distinct()


def _close(pairs: DataFrame, keyed: DataFrame) -> DataFrame:
    """The pairs whose sketches do not rule out a link: linked sets of ``s`` and ``t`` shingles differ in at most ``(s + t) / 9``."""
    sets = keyed.where("n > 0").groupBy("key").agg(F.first(F.struct("n", "sketch")).alias("set"))  # copies have the same
    met = pairs.join(sets.select(F.col("key").alias("a"), F.col("set").alias("x")), "a").join(sets.select(F.col("key").alias("b"), F.col("set").alias("y")), "b")
    width = F.least(F.size("x.sketch"), F.size("y.sketch"))
    x, y = (F.when(F.size(c) > width, F.zip_with(F.slice(c, 1, width), F.slice(c, width + 1, width), lambda p, q: p.bitwiseXOR(q))).otherwise(F.col(c)) for c in ("x.sketch", "y.sketch"))
    differ = F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda total, bits: total + bits)
    return met.where(differ * 9 <= F.col("x.n") + F.col("y.n")).select("a", "b")


def _links(pairs: DataFrame, keyed: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose whole sets are similar enough."""
    pairs = stage(_close(pairs, keyed), "pairs")
    wanted = stage(pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "key"), "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = _First()
        for part in W.slices(batches):
            sets = Sets(part.column("text"))
            keys = sets.keys()
            own = np.flatnonzero((sets.sizes > 0) & first(keys))
            offsets = np.concatenate([[0], np.cumsum(sets.sizes[own])]).astype(np.int32)
            kept = np.zeros(len(sets.sizes), bool)
            kept[own] = True
            yield pa.RecordBatch.from_arrays(
                [_binary(keys[own]), pa.ListArray.from_arrays(pa.array(offsets), _signed(sets.hashes[kept[sets.owners]]))], ["key", "shingles"]
            )

    # Copies have the same shingles, so whichever comes first is right. Grouped by key, they are shuffled once for both joins.
    sets = texts.mapInArrow(run, "key binary, shingles array<long>").join(wanted, "key", "left_semi").groupBy("key").agg(F.first("shingles").alias("shingles"))
    left = sets.select(F.col("key").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("key").alias("b"), F.col("shingles").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    met = pairs.join(left, "a").join(right, "b")
    return stage(met.where(common * 9 >= (F.size("x") + F.size("y")) * 4).select("a", "b"), "links")


def components(links: DataFrame) -> DataFrame:
    """(key, root): the smallest key reachable by the links (a, b), for every key that has a link and is not the root.

    Alternates two steps: each node hands its larger neighbours, then its smaller
    ones, to the smallest of them, until the links are stars. Rounds grow
    with the logarithm of the longest chain.
    """
    edges, before = stage(links.where("a != b").select(*_pair("a", "b")).distinct(), "edges"), None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").distinct()
        lower = large.groupBy("b").agg(F.min("a").alias("m"))
        moved = large.join(lower, "b").where("a != m").select(F.col("m").alias("a"), F.col("a").alias("b"))
        edges = stage(moved.union(lower.select("m", "b")).distinct(), "edges")
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before or not state[0]:
            return edges.select(F.col("b").alias("key"), F.col("a").alias("root"))
        before = state


def _roots(documents: DataFrame, keyed: DataFrame, text_col: str) -> DataFrame:
    """(key, root) of all sets that have a link and are not the root."""
    texts = documents.select(F.col(text_col).alias("text"))
    frequent, mean_list = _frequent(texts)
    boundary = _boundary(keyed.where("n > 0").select("key", "n").distinct().groupBy("n").agg(F.count("*").alias("sets")), mean_list)
    entries = stage(_met(_entries(texts, frequent, boundary)), "met")
    lists, small = entries.where("least = 0"), entries.where("least > 0")
    # In a list, sets of about one size have a pivot; any other links are found across components.
    bands = lists.withColumn("band", F.floor(F.log("size") / F.log(F.lit(1.25))))
    near = _with_pivots(bands, _fits("size", "pivot_size") & _reaches("size", "place", "pivot_size", "pivot_place"), ("bucket", "band"))
    if boundary:
        # All members of a subset's bucket are linked with one of the smaller size, if there is one.
        near = near.union(_with_pivots(small, F.col("pivot_size") == F.col("least"), ("bucket", "least"))).distinct()
    links = _links(near, keyed, texts)
    across = _links(_across(lists, components(links)), keyed, texts)
    return components(links.union(across))


def _members(keyed: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, root, component_id) of every set that is not empty."""
    sets = keyed.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("least")).join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    named = sets.groupBy("root").agg(F.min("least").alias("component_id"))
    return sets.join(named, "root").select("key", "root", "least", "component_id")


def similar_documents(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) per document row."""
    keyed = _sets(documents, id_col, text_col)
    members = _members(keyed, _roots(documents, keyed, text_col)).select("key", "component_id")
    full = keyed.where("n > 0").join(members, "key").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    empty = keyed.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.unionByName(empty)


def keep_one(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component with all columns: that of the smallest id; documents without words all stay.

    Texts are moved at most once, for a join with the sets that stay; of equal
    rows, or several texts with the smallest id, one stays.
    """
    keyed = _sets(documents, id_col, text_col)
    members = _members(keyed, _roots(documents, keyed, text_col))
    first = members.where(F.col("least").eqNullSafe(F.col("component_id"))).groupBy("root").agg(F.min("key").alias("key"), F.first("component_id").alias("component_id"))
    copies = keyed.groupBy("key", "doc_id").agg(F.count("*").alias("copies"))
    chosen = first.join(copies, (first["key"] == copies["key"]) & first["component_id"].eqNullSafe(copies["doc_id"]))
    chosen = stage(chosen.select(first["key"].alias("key"), "doc_id", "copies"), "chosen")
    rows = _keyed(documents, documents.columns, text_col)
    own = F.col(f"carried.{id_col}").cast("long")
    met = rows.where("n > 0").join(chosen, (rows["key"] == chosen["key"]) & own.eqNullSafe(chosen["doc_id"])).select(rows["key"].alias("key"), "carried", "copies")
    single = met.where("copies = 1").select("carried")
    repeated = met.where("copies > 1").groupBy("key").agg(F.first("carried").alias("carried")).select("carried")
    return rows.where("n = 0").select("carried").union(single).union(repeated).select("carried.*")
