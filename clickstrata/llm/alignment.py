"""Which tokens of two tokenizers stand for the same text, counted over a corpus.

A text, with a space in front, is encoded by a byte-level vocabulary (A) and a piece
model (B). Places where tokens of both end cut it into groups; the two tokens that end
there are linked. The first pass counts how often each pair of ids is linked. Its
distinct pairs come to the driver, where a minimal perfect hash is built over them, so
that counts are plain vectors: each task turns its share of the counts into one, and
the vectors are added up in a tree. The second pass aligns the documents again and
looks the counts up by hash; the pair kept at a place is compared, so a pair that is
not in the table is an error and never another pair's count.

Of two linked tokens one's bytes end with the other's, so the vocabularies bound the
pairs (:func:`pair_bound`); what is collected and broadcast is checked against that.

Both passes align each different chunk of text once (``tokens``); a chunk's groups do
not depend on what is around it. Rows: null and empty texts have no tokens, nor
do texts that B does not give back as they were (such as ones with its mark for spaces);
their counts are 0 and their digest is ''. Repeated rows count each time. Rows keep
null ids. Of equal counts each is best. Long texts are taken in parts. Other columns
are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import clear_scratch, scratch_path
from .tokens import ByteTokenizer, PieceTokenizer, chunks, segments
from .words import mix

BYTE_VOCABULARY = "byte_bpe_50k.json"
PIECE_MODEL = "piece_bpe_32k.model"
HELD_BYTES = 320 << 20  # of chunks and what is known of them, by estimate; a Python worker forgets them beyond that
BATCH_CHARACTERS = 1 << 20  # of text whose new chunks are aligned together
FAN = 16  # vectors that are added up by one task
GAMMA = 2.0
_LOW = np.int64(0xFFFFFFFF)


def vocabulary_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(BYTE_VOCABULARY), public_tokenizers.path(PIECE_MODEL)


# ---- minimal perfect hashing ------------------------------------------------


@dataclass
class PerfectHash:
    """Gives ``n`` distinct 64-bit keys the numbers from 0 to n - 1.

    At each level the keys left are hashed to GAMMA times as many bits; a key alone on its bit
    is placed there, the others go on to the next level. A key's number is how many bits are
    set before its own over all levels. ``keys`` holds the keys by number, to tell others apart.
    """

    keys: np.ndarray
    words: np.ndarray = field(init=False)  # the bits of all levels
    before: np.ndarray = field(init=False)  # bits set before each word
    levels: list[tuple[int, int]] = field(init=False)  # first bit and size

    def __post_init__(self) -> None:
        left, bits, self.levels, first = np.unique(self.keys.astype(np.int64)), [], [], 0
        while len(left):
            size = -(-max(64, math.ceil(GAMMA * len(left))) // 64) * 64
            at = self._hashed(left, len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            bits.append(alone)
            self.levels.append((first, size))
            first += size
            left = left[~alone[at]]
        flat = np.concatenate(bits) if bits else np.zeros(0, bool)
        self.words = np.packbits(flat, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        own = np.unique(self.keys.astype(np.int64))
        self.keys = np.empty(len(own), np.int64)
        self.keys[self._numbers(own)] = own

    @staticmethod
    def _hashed(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys.view(np.uint64) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)) % np.uint64(size)).astype(np.int64)

    def _numbers(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (first, size) in enumerate(self.levels):
            at = first + self._hashed(keys[left], level, size)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit & np.uint64(1)).astype(bool)
            lower = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[left[hit]] = (self.before[at >> 6] + lower)[hit]
            left = left[~hit]
        return out

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for one that is not among the keys."""
        keys = np.asarray(keys, np.int64)
        found = self._numbers(keys)
        if not len(self.keys):
            return found
        return np.where((found >= 0) & (self.keys[found] == keys), found, -1)


def pair_bound(a: ByteTokenizer, b: PieceTokenizer) -> int:
    """How many pairs of ids there are of which one's bytes end with the other's."""
    own, other = Counter(x for x in a.bytes if x), Counter(x for x in b.bytes if x)
    ends = sum(n * other[x[k:]] for x, n in own.items() for k in range(len(x)))
    return ends + sum(n * own[x[k:]] for x, n in other.items() for k in range(1, len(x)))


# ---- aligning chunks --------------------------------------------------------


class Aligner:
    """Chunks by number, and what is known of each: tokens of A and B, links, their pairs, the groups as text."""

    def __init__(self, byte_path: str, piece_path: str) -> None:
        self.a, self.b = ByteTokenizer(byte_path), PieceTokenizer(piece_path)
        self.names_a = _names(self.a.size, b",", b"|")
        self.names_b = _names(self.b.size, b",", b";")
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.texts: list[bytes] = []
        self.good = np.empty(0, bool)
        self.n_a, self.n_b = np.empty(0, np.int64), np.empty(0, np.int64)
        self.first = np.zeros(1, np.int64)  # of each chunk its first pair, and the end of the last
        self.pairs = np.empty(0, np.int64)  # a << 32 | b
        self.held = 0

    def numbers(self, own: list[str]) -> np.ndarray:
        """The number of each chunk, new ones being aligned."""
        new = list({chunk for chunk in own if chunk not in self.known})
        if new:
            self.learn(new)
        return np.fromiter(map(self.known.__getitem__, own), np.int32, len(own))

    def learn(self, new: list[str]) -> None:
        # Chunks that B does not give back have no tokens of either.
        ids_b, stops_b, good = self.b.encode_chunks(new)
        ids_a, stops_a = self.a.encode_chunks(new)
        n_a, n_b = np.diff(stops_a, prepend=0), np.diff(stops_b, prepend=0)
        ids_a, n_a = ids_a[np.repeat(good, n_a)], n_a * good
        ends_a, ends_b = np.cumsum(self.a.lengths[ids_a]), np.cumsum(self.b.lengths[ids_b])
        both = np.intersect1d(ends_a, ends_b, assume_unique=True)
        last_a, last_b = np.searchsorted(ends_a, both), np.searchsorted(ends_b, both)
        pairs = ids_a[last_a] << 32 | ids_b[last_b]
        # A chunk's tokens end where the next one's begin, so its last tokens are linked.
        links = np.searchsorted(last_a, np.cumsum(n_a))
        n_links = np.diff(links, prepend=0)

        names = self._group_names(ids_a, ids_b, last_a, last_b)
        ends = np.cumsum(n_a + n_b).tolist()
        self.texts += [b"".join(names[low:high]) for low, high in zip([0, *ends[:-1]], ends, strict=True)]
        at = len(self.known)
        self.known.update(zip(new, range(at, at + len(new)), strict=True))
        self.good = np.append(self.good, good)
        self.n_a, self.n_b = np.append(self.n_a, n_a), np.append(self.n_b, n_b)
        self.first = np.append(self.first, self.first[-1] + np.cumsum(n_links))
        self.pairs = np.append(self.pairs, pairs)
        self.held += 300 * len(new) + sum(map(len, new)) + sum(map(len, self.texts[at:]))

    def _group_names(self, ids_a: np.ndarray, ids_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> list[bytes]:
        """Every token's id and what follows it, in the order in which groups are written: their tokens of A, then those of B."""
        closes_a, closes_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
        closes_a[last_a] = 1
        closes_b[last_b] = 1
        group_a, group_b = np.cumsum(closes_a) - closes_a, np.cumsum(closes_b) - closes_b
        out = np.empty(len(ids_a) + len(ids_b), object)
        out[np.arange(len(ids_a)) + np.append(0, last_b + 1)[group_a]] = self.names_a[2 * ids_a + closes_a]
        out[np.arange(len(ids_b)) + (last_a + 1)[group_b]] = self.names_b[2 * ids_b + closes_b]
        return out.tolist()

    def full(self) -> bool:
        return self.held > HELD_BYTES


def _names(size: int, inside: bytes, last: bytes) -> np.ndarray:
    """At 2 * id its decimal text with ``inside`` behind it, and next to it the one with ``last``."""
    out = np.empty(2 * size, object)
    out[:] = [b"%d%s" % (k, after) for k in range(size) for after in (inside, last)]
    return out


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(paths: tuple[str, str]) -> Aligner:
    """One per Python worker."""
    if paths not in _aligners:
        _aligners[paths] = Aligner(*paths)
    return _aligners[paths]


@dataclass
class Batch:
    """Documents of a record batch: rows ``low`` to ``high``, the chunks of all, and of each document where its chunks begin."""

    low: int
    high: int
    numbers: np.ndarray
    offsets: np.ndarray

    def sums(self, by_chunk: np.ndarray) -> np.ndarray:
        """The sum over each document's chunks."""
        return np.diff(np.append(0, np.cumsum(by_chunk[self.numbers]))[self.offsets])


def _aligned(own: Aligner, texts: pa.Array, forget) -> Iterator[Batch]:
    """The documents in batches of about :data:`BATCH_CHARACTERS`, one at least. ``forget`` is called when chunks are to be forgotten."""
    low, ends, size = 0, [0], 0
    numbers: list[np.ndarray] = [np.empty(0, np.int32)]
    waiting: list[str] = []  # chunks that have no number yet; a long document's do not wait together
    for k, text in enumerate(texts):
        if size >= BATCH_CHARACTERS:
            yield Batch(low, k, np.concatenate([*numbers, own.numbers(waiting)]), np.array(ends))
            low, ends, size, numbers, waiting = k, [0], 0, numbers[:1], []
            if own.full():
                forget()
                own.forget()
        n = 0
        for part in segments(" " + value) if (value := text.as_py()) else ():
            found = chunks(part)
            waiting += found
            n += len(found)
            size += len(part)
            if size >= BATCH_CHARACTERS:
                numbers.append(own.numbers(waiting))
                waiting = []
        ends.append(ends[-1] + n)
    yield Batch(low, len(texts), np.concatenate([*numbers, own.numbers(waiting)]), np.array(ends))


# ---- first pass -------------------------------------------------------------


def partial_counts(documents: DataFrame, paths: tuple[str, str], text_col: str = "text") -> DataFrame:
    """(pair, n): how often each task saw each pair of ids linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(paths)
        used = np.zeros(0, np.int64)  # how often each chunk occurred
        pairs, counts = np.empty(0, np.int64), np.empty(0, np.int64)

        def gather() -> None:
            nonlocal used, pairs, counts
            here = np.repeat(used, np.diff(own.first[: len(used) + 1]))
            all_pairs = np.append(pairs, own.pairs[: len(here)][here > 0])
            all_counts = np.append(counts, here[here > 0])
            pairs, place = np.unique(all_pairs, return_inverse=True)
            counts = np.zeros(len(pairs), np.int64)
            np.add.at(counts, place, all_counts)
            used = np.zeros(0, np.int64)

        for batch in batches:
            for part in _aligned(own, batch.column("text"), gather):
                whole = part.sums(~own.good) == 0
                kept = part.numbers[np.repeat(whole, np.diff(part.offsets))]
                seen = np.bincount(kept, minlength=len(own.known))
                seen[: len(used)] += used
                used = seen
        gather()
        for low in range(0, len(pairs), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(pairs[low : low + (1 << 16)]), pa.array(counts[low : low + (1 << 16)])], ["pair", "n"])

    return documents.select(F.col(text_col).alias("text")).mapInArrow(run, "pair long, n long")


def tree_sum(vectors: DataFrame, parts: int, length: int) -> np.ndarray:
    """The sum of all rows' vectors (64-bit numbers as bytes), :data:`FAN` tasks' worth at a time."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length, np.int64)
        for batch in batches:
            for vector in batch.column("vector"):
                total += np.frombuffer(vector.as_buffer(), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["vector"])

    while True:
        parts = max(1, math.ceil(parts / FAN))
        vectors = vectors.repartition(parts).mapInArrow(add, "vector binary")
        if parts == 1:
            return np.frombuffer(vectors.first()["vector"], np.int64)


@dataclass
class PairTable:
    """Counts of linked pairs by the hash of the pair, and the highest count of each id of B."""

    places: PerfectHash
    counts: np.ndarray
    best: np.ndarray

    def lookup(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each pair its count (0 if it is not in the table), and whether that is its B id's highest."""
        found = self.places(pairs)
        if not len(self.counts):
            return np.zeros(len(pairs), np.int64), np.zeros(len(pairs), bool)
        counts = np.where(found >= 0, self.counts[found], 0)
        return counts, counts == self.best[pairs & _LOW]

    def rows(self, like: DataFrame) -> DataFrame:
        """(a_id, b_id, n) as a DataFrame of the session of ``like``."""
        table = pa.table({"a_id": self.places.keys >> 32, "b_id": self.places.keys & _LOW, "n": self.counts})
        return like.sparkSession.createDataFrame(table)


def count_pairs(documents: DataFrame, paths: tuple[str, str] | None = None, text_col: str = "text") -> PairTable:
    """The first pass over all documents."""
    spark, paths = documents.sparkSession, paths or vocabulary_paths()
    a, b = ByteTokenizer(paths[0]), PieceTokenizer(paths[1])
    path = scratch_path(spark, "pairs")
    partial_counts(documents, paths, text_col).write.parquet(path)
    partial = spark.read.schema("pair long, n long").parquet(path)
    keys = partial.select("pair").distinct().toArrow().column("pair").to_numpy()
    if len(keys) > pair_bound(a, b):
        raise ValueError("more pairs than the vocabularies allow")
    places = PerfectHash(keys)
    shared = spark.sparkContext.broadcast(places)

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = np.zeros(len(shared.value.keys), np.int64)
        for batch in batches:
            np.add.at(vector, shared.value(batch.column("pair").to_numpy()), batch.column("n").to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array([vector.tobytes()], pa.binary())], ["vector"])

    counts = np.zeros(0, np.int64)
    if len(keys):
        counts = tree_sum(partial.mapInArrow(dense, "vector binary"), partial.rdd.getNumPartitions(), len(keys))
    shared.destroy()
    clear_scratch(spark, path)
    best = np.zeros(b.size, np.int64)
    np.maximum.at(best, places.keys & _LOW, counts)
    return PairTable(places, counts, best)


# ---- second pass ------------------------------------------------------------

ALIGNED = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_JOINED = 1 << 16


def align_documents(
    documents: DataFrame,
    table: PairTable,
    paths: tuple[str, str] | None = None,
    *,
    with_groups: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Of each document: doc_id, its tokens of A and of B, groups, links, links whose count is the highest of their B id,
    the sum of the links' counts, the digest of its groups written as ``a1,a2|b1;a3|b2,b3``; ``with_groups`` adds that text.
    """
    paths = paths or vocabulary_paths()
    shared = documents.sparkSession.sparkContext.broadcast(table)
    schema = f"doc_id long, {ALIGNED}" + (", groups string" if with_groups else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(paths)
        found = np.zeros((3, 0), np.int64)  # of each chunk, as far as looked up: the sum of its counts, best links, unknown pairs

        def gather() -> None:
            nonlocal found
            found = np.zeros((3, 0), np.int64)

        for batch in batches:
            for part in _aligned(own, batch.column("text"), gather):
                if found.shape[1] < len(own.known):
                    first = own.first[found.shape[1] :]
                    counts, best = shared.value.lookup(own.pairs[first[0] :])
                    running = np.zeros((3, len(counts) + 1), np.int64)
                    np.cumsum([counts, best, counts == 0], axis=1, out=running[:, 1:])
                    found = np.append(found, np.diff(running[:, first - first[0]]), 1)
                ids = batch.column("doc_id").slice(part.low, part.high - part.low)
                yield _rows(own, part, ids, found, with_groups)

    return documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def _rows(own: Aligner, part: Batch, ids: pa.Array, found: np.ndarray, with_groups: bool) -> pa.RecordBatch:
    whole = part.sums(~own.good) == 0
    sums, bests, unknown = found
    if (part.sums(unknown) * whole).any():
        raise KeyError("a pair that the first pass has not seen")
    links = np.diff(own.first)
    columns = [part.sums(x) * whole for x in (own.n_a, own.n_b, links, links, bests, sums)]
    digests, groups = [], []
    for low, high, good in zip(part.offsets[:-1].tolist(), part.offsets[1:].tolist(), whole.tolist(), strict=True):
        digest, written = hashlib.sha256(), []
        if good and high > low:
            for at in range(low, high, _JOINED):
                text = b"".join(map(own.texts.__getitem__, part.numbers[at : min(at + _JOINED, high)].tolist()))
                text = text if at + _JOINED < high else text[:-1]  # nothing behind the last group
                digest.update(text)
                if with_groups:
                    written.append(text)
        digests.append(digest.hexdigest() if good and high > low else "")
        groups.append(b"".join(written).decode())
    names = [f.split()[0] for f in ("doc_id long, " + ALIGNED).split(", ")]
    arrays = [ids, *(pa.array(c, pa.int64()) for c in columns), pa.array(digests, pa.string())]
    return pa.RecordBatch.from_arrays(arrays + [pa.array(groups, pa.string())] * with_groups, names + ["groups"] * with_groups)


def align_corpus(documents: DataFrame, **settings) -> DataFrame:
    """Both passes."""
    return align_documents(documents, count_pairs(documents), **settings)
