"""Token sequences of related documents without padding, by lexical retrieval.

Documents are packed in shards. A shard has an inverted index over the words
of its documents. A window begins with the first unused document (the seed)
and asks the index for the BM25 neighbours of that seed; unused ones fill the
window, best first. The document that does not fit is cut: its rest begins the
next window and becomes the seed there. When the neighbours are used up, the
next unused document takes over as seed in the same window.

Document frequencies and the average length are counted over all documents.
Words are told apart by their whole 64-bit hash. Their frequencies stay in Spark:
each shard is given those of its own words. A seed is queried by all of its words.

A document is its token ids and the end id. A shard's last window, if not full,
is cut into sequences whose lengths are powers of two, which take no padding.
Shards are consecutive rows of a partition, of at most ``BYTES_A_TOKEN * shard_tokens``
bytes of text (a longer document is a shard of its own). They are stored with the
texts, so that a lost task is done again alike and every row, repeated or with a
null id, is packed once; then texts and frequencies are brought together by shard.
A null or empty text is its end id alone. Equal scores: the earlier document.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import stage
from . import words as W

VOCABULARY = "word_bpe_49k.json"
WINDOW = 4096
END_ID = 2
SHARD_TOKENS = 1_000_000  # texts, ids, terms and index of a shard are held by one Python worker
BYTES_A_TOKEN = 4  # about, in English
TERMS = 1 << 64  # all hashes
QUERY_TERMS = math.inf  # all words
K1, B = 1.2, 0.75
_CACHE = 500_000
_LONGEST_KEPT = 32
_SEGMENT = 1 << 20

# How the vocabulary's own file splits normalised text into words,
# restricted to characters for which Python and the file agree on case, form and class.
_WORD = re.compile(r"'(?:[stmd]|re|ve|ll)|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
_PLAIN = re.compile(r"[\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-įı-ſ]*\Z")
_SPACE = re.compile(r"[\t\n\r ]")
_WORD_END = "</w>"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


class Encoder:
    """Token ids of texts as little-endian 32-bit bytes, equal to the tokenizer's, by encoding each different word once."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.whole = Tokenizer.from_file(path)
        self.special = [t["content"] for t in spec["added_tokens"]]
        # The same vocabulary and merges for words that are already lower-cased and apart.
        spec |= {"normalizer": None, "added_tokens": []}
        spec["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
        self.words = Tokenizer.from_str(json.dumps(spec))
        vocabulary = self.words.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[k for piece, k in vocabulary.items() if piece.endswith(_WORD_END)]] = True
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        found = [self._split(text) if text else [] for text in texts]
        if len(self.known) > _CACHE:
            self.known = {}
        every = set().union(*(own for own in found if isinstance(own, list)))
        self._learn({word for word in every if word not in self.known})
        return [own if isinstance(own, bytes) else b"".join(map(self.known.__getitem__, own)) for own in found]

    def _split(self, text: str) -> list[str] | bytes:
        if _PLAIN.match(text) and not any(s in text for s in self.special):
            return _WORD.findall(text.lower())
        ids, at = [], 0
        while at < len(text):  # long texts in pieces that end at a space
            cut = _SPACE.search(text, at + _SEGMENT)
            stop = cut.start() if cut else len(text)
            ids.append(np.array(self.whole.encode(text[at:stop], add_special_tokens=False).ids, "<u4").tobytes())
            at = stop
        return b"".join(ids)

    def _learn(self, new: set[str]) -> None:
        words = list(new)
        if not words:
            return
        texts = [" ".join(words[k : k + 5000]) for k in range(0, len(words), 5000)]
        ids = np.concatenate([np.array(e.ids, "<u4") for e in self.words.encode_batch_fast(texts, add_special_tokens=False)])
        stops = (np.flatnonzero(self.ends[ids]) + 1).tolist()
        if len(stops) != len(words):
            raise ValueError("the tokenizer split a word in two")
        raw, at = ids.tobytes(), 0
        for word, stop in zip(words, stops, strict=True):
            self.known[word] = raw[4 * at : 4 * stop]
            at = stop


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per Python worker, so that words learned in a task serve the next."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _terms(part: pa.RecordBatch) -> list[tuple[np.ndarray, np.ndarray]]:
    """(word hash, count) of each text."""
    found = W.words_of(part.column("text"), W.ALPHANUMERIC)
    kinds = found.hashes.view(np.int64)
    return [np.unique(kinds[a:b], return_counts=True) for a, b in zip(found.first[:-1], found.first[1:], strict=True)]


@dataclass
class Statistics:
    """Over all documents: number, average words, and documents per word, of the words given."""

    n_docs: int
    mean_words: float
    kinds: np.ndarray  # sorted
    frequency: np.ndarray

    def idf(self) -> np.ndarray:
        return np.log1p((self.n_docs - self.frequency + 0.5) / (self.frequency + 0.5))


def assign_shards(documents: DataFrame, shard_bytes: int) -> DataFrame:
    """(shard, place, doc_id, text, n_words) per row of (doc_id, text).

    A shard's number is the partition's and then a bound on the sequences of the
    partition's shards before, so that sequences can be numbered from it on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = following = TaskContext.get().partitionId() << 40
        size, place = 0, 0
        for part in W.slices(batches):
            shards = []
            for length in np.diff(W.text_bytes(part.column("text"))[1]).tolist():
                own = length + BYTES_A_TOKEN  # with the end id
                if size and size + own > shard_bytes:
                    shard, size = following, 0
                size += own
                following += 4 * length + 64
                shards.append(shard)
            places = pa.array(np.arange(place, place + part.num_rows))
            place += part.num_rows
            counts = pa.array(W.words_of(part.column("text"), W.ALPHANUMERIC).counts(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int64()), places, part.column("doc_id"), part.column("text"), counts], ["shard", "place", "doc_id", "text", "n_words"])

    return documents.select("doc_id", "text").mapInArrow(run, "shard long, place long, doc_id long, text string, n_words long")


def frequencies(sharded: DataFrame) -> DataFrame:
    """(shard, kind, n): of every word of a shard, the number of documents in all shards that have it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, own = None, []
        for part in W.slices(batches):
            for shard, (kinds, _) in zip(part.column("shard").to_pylist(), _terms(part), strict=True):
                if shard != current and own:
                    yield _counted(current, own)
                    own = []
                current = shard
                own.append(kinds)
        if own:
            yield _counted(current, own)

    counted = sharded.select("shard", "text").mapInArrow(count, "shard long, kind long, n long")
    # A word has a row for each shard, or a few where tasks share a shard.
    by_kind = counted.groupBy("kind").agg(F.sum("n").alias("n"), F.collect_set("shard").alias("shards"))
    return by_kind.select(F.explode("shards").alias("shard"), "kind", "n")


def _counted(shard: int, own: list[np.ndarray]) -> pa.RecordBatch:
    kinds, n = np.unique(np.concatenate(own), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(kinds), shard)), pa.array(kinds), pa.array(n)], ["shard", "kind", "n"])


def totals(sharded: DataFrame) -> tuple[int, float]:
    """(documents, average words)."""
    n, words = sharded.agg(F.count("*"), F.sum("n_words")).first()
    return n, words / n if n else 0.0


def statistics(documents: DataFrame) -> Statistics:
    """Those of all words, on the driver: for small tables. :func:`pack` gives each shard its own."""
    sharded = assign_shards(documents.select(F.lit(0).cast("long").alias("doc_id"), "text"), BYTES_A_TOKEN * SHARD_TOKENS)
    found = frequencies(sharded).select("kind", "n").distinct().sort("kind").collect()
    return Statistics(*totals(sharded), *(np.array([row[c] for row in found], np.int64) for c in ("kind", "n")))


class Index:
    """Inverted index of a shard: for each word its documents and their BM25 weights."""

    def __init__(self, terms: list[tuple[np.ndarray, np.ndarray]], stats: Statistics, idf: np.ndarray) -> None:
        sizes = np.array([len(k) for k, _ in terms])
        docs = np.repeat(np.arange(len(terms)), sizes)
        kinds = np.concatenate([k for k, _ in terms])
        counts = np.concatenate([n for _, n in terms]).astype(np.float64)
        length = np.bincount(docs, counts, len(terms))
        weight = idf[np.searchsorted(stats.kinds, kinds)] * counts * (K1 + 1) / (counts + K1 * (1 - B + B * length[docs] / max(stats.mean_words, 1e-9)))
        self.first_of_doc = np.concatenate([[0], np.cumsum(sizes)])
        self.n = len(terms)
        order = np.argsort(kinds, kind="stable")
        self.docs, self.posted = docs[order], weight[order]
        present, begins = np.unique(kinds[order], return_index=True)
        place = np.searchsorted(present, kinds)
        ends = np.append(begins[1:], len(kinds))
        self.low, self.high = begins[place], ends[place]  # of each (document, word) its postings

    def neighbours(self, seed: int, used: np.ndarray) -> np.ndarray:
        """Unused documents that share a word with the seed, best first."""
        own = slice(self.first_of_doc[seed], self.first_of_doc[seed + 1])
        score = np.zeros(self.n)
        for low, high in zip(self.low[own].tolist(), self.high[own].tolist(), strict=True):
            score[self.docs[low:high]] += self.posted[low:high]
        score[used] = 0
        found = np.flatnonzero(score)
        return found[np.argsort(-score[found], kind="stable")]


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _pack(lengths: list[int], index: Index, window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Windows as lists of (document, first token, tokens); all are full but the last."""
    used = np.zeros(len(lengths), bool)
    following, filled, pieces = 0, 0, []
    queue: Iterator[int] = iter(())
    while True:
        doc = next((d for d in queue if not used[d]), None)
        if doc is None:
            while following < len(lengths) and used[following]:
                following += 1
            if following == len(lengths):
                break
            doc = following
            used[doc] = True
            queue = iter(index.neighbours(doc, used).tolist())
        used[doc] = True
        at, crossed = 0, False
        while at < lengths[doc]:
            take = min(lengths[doc] - at, window - filled)
            pieces.append((doc, at, take))
            at, filled = at + take, filled + take
            if filled == window:
                yield pieces
                pieces, filled, crossed = [], 0, True
        if crossed:  # its rest has begun a window and is the seed there
            queue = iter(index.neighbours(doc, used).tolist())
    if pieces:
        yield pieces


def _powers(pieces: list[tuple[int, int, int]], size: int) -> Iterator[list[tuple[int, int, int]]]:
    """A window of ``size`` tokens cut into ones whose sizes are powers of two."""
    rest = list(reversed(pieces))
    for bit in range(size.bit_length() - 1, -1, -1):
        room, out = size & (1 << bit), []
        while room:
            doc, at, n = rest.pop()
            take = min(n, room)
            out.append((doc, at, take))
            room -= take
            if take < n:
                rest.append((doc, at + take, n - take))
        if out:
            yield out


def pack(
    documents: DataFrame,
    *,
    window: int = WINDOW,
    end_id: int = END_ID,
    shard_tokens: int = SHARD_TOKENS,
    vocabulary: str | None = None,
    with_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of the packed sequences, one row each; ``with_ids`` adds the token ids themselves.

    Pieces of a sequence follow each other without gaps; in document order a
    document's pieces make up all of its tokens.
    """
    path = vocabulary or vocabulary_path()
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sharded = stage(assign_shards(rows, BYTES_A_TOKEN * shard_tokens), "packing")
    n_docs, mean_words = totals(sharded)

    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        encode, end = encoder(path).encode, np.array([end_id], "<u4").tobytes()
        kinds, n = (found.column(c).to_numpy() for c in ("kind", "n"))
        order = np.argsort(kinds)
        stats = Statistics(n_docs, mean_words, kinds[order], n[order])
        docs = docs.sort_by("place")
        tokens, terms = [], []
        for part in W.slices(docs.select(["text"]).to_batches()):
            tokens += [own + end for own in encode(part.column("text").to_pylist())]
            terms += _terms(part)
        shard = docs.column("shard")[0].as_py()
        return pa.Table.from_batches([_shard(docs.column("doc_id").to_pylist(), tokens, terms, stats, stats.idf(), window, shard, with_ids)[0]])

    texts = sharded.select("shard", "place", "doc_id", "text").groupBy("shard")
    return texts.cogroup(frequencies(sharded).groupBy("shard")).applyInArrow(run, PIECES + (", ids array<int>" if with_ids else ""))


def _shard(ids: list, tokens: list[bytes], terms: list, stats: Statistics, idf: np.ndarray, window: int, sequence: int, with_ids: bool) -> tuple[pa.RecordBatch, int]:
    lengths = [len(t) // 4 for t in tokens]
    columns: list[list] = [[] for _ in range(8)]
    for filled in _pack(lengths, Index(terms, stats, idf), window):
        size = sum(n for *_, n in filled)
        for pieces in [filled] if size == window else _powers(filled, size):
            offset = 0
            for doc, at, n in pieces:
                raw = tokens[doc][4 * at : 4 * (at + n)]
                for column, value in zip(columns, (ids[doc], at, n, zlib.crc32(raw), lengths[doc], sequence, offset, np.frombuffer(raw, "<i4") if with_ids else None), strict=True):
                    column.append(value)
                offset += n
            sequence += 1
    arrays = [pa.array(c, pa.int64()) for c in columns[:7]] + ([pa.array(columns[7], pa.list_(pa.int32()))] if with_ids else [])
    names = [c.split()[0] for c in PIECES.split(", ")] + (["ids"] if with_ids else [])
    return pa.RecordBatch.from_arrays(arrays, names), sequence
