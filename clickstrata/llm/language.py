"""Language of a text: unigram pieces of each language, summed over all segmentations.

A word (a run of letters, lower-cased, with the vocabulary's word mark before
it) can be cut into pieces of a fixed public vocabulary in many ways. With a
probability for each piece in each language, a word's probability is the sum
over all of its segmentations, which a forward pass adds up from left to right.
A text's log-likelihood is the sum over its words; languages are equally likely
beforehand, and ``score`` is the posterior of the best one.

Piece probabilities are learned by expectation-maximisation from all labelled
training rows, without a sample: words are counted per language in Spark, each
round computes expected piece counts from the word table in parallel, and what
reaches the driver is one number per language and piece of the vocabulary.

A letter outside of the vocabulary is a piece of its own with a fixed small
probability. Runs of over ``MAX_RUN`` letters are cut there. A text that is null or
has no letter is ``und`` with score 0, and so is every text if nothing was
learned. Equally likely languages: the first in alphabetical order. Each
document row gives one row; repeated rows and null ids (never held out, never
learned from) too.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import stage
from .words import mix, slices

UNDETERMINED = "und"
VOCABULARY = "piece_bpe_32k.model"
MAX_RUN = 32
ROUNDS = 3
SMOOTHING = 0.1
UNKNOWN = 1e-7
TINY = 1e-280  # a word's sum below this is taken in logarithms: single paths may have become 0
_FLUSH = 200_000
_GROUP = 4_000
_CACHE = 300_000
_LETTERS = re.compile(r"[^\W\d_]+")
_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def read_pieces(path: str) -> list[str]:
    """The lower-case letter pieces of a SentencePiece vocabulary, which are all that words can be cut into."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(k) for k in range(model.get_piece_size())}
    return sorted(p for p in pieces if (letters := p.removeprefix("▁")) == letters.lower() and (not letters or letters.isalpha()) and p)


def words(text: str | None) -> list[str]:
    found = _LETTERS.findall((text or "").lower())
    if any(len(w) > MAX_RUN for w in found):
        found = [w[k : k + MAX_RUN] for w in found for k in range(0, len(w), MAX_RUN)]
    return found


def has_letter(found: list[str]) -> bool:
    return any(any(c.isalpha() for c in w) for w in found)


@dataclass
class Lattice:
    """For words of one length: which piece stands from each place on for each number of characters."""

    length: int
    arcs: list[np.ndarray]  # arcs[n - 1]: words x places; piece number, or that of "none"

    def of(self, rows: np.ndarray) -> Lattice:
        return Lattice(self.length, [ids[rows] for ids in self.arcs])


class Pieces:
    """The vocabulary as hashes of character strings."""

    def __init__(self, pieces: list[str]) -> None:
        sizes = np.array([len(p) for p in pieces])
        hashes = np.empty(len(pieces), np.uint64)
        for n in np.unique(sizes):
            own = np.flatnonzero(sizes == n)
            points = np.frombuffer("".join(pieces[k] for k in own).encode("utf-32-le"), np.uint32).reshape(len(own), n)
            hashes[own] = self._hash(points.astype(np.uint64))
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.seen = np.zeros(1 << 20, bool)
        self.seen[self.hashes & _U(0xFFFFF)] = True
        self.longest = max(map(len, pieces), default=1)
        self.unknown, self.none = len(pieces), len(pieces) + 1

    @staticmethod
    def _hash(points: np.ndarray) -> np.ndarray:
        h = np.zeros(len(points), np.uint64)
        for k in range(points.shape[1]):
            h = h * _STEP + mix(points[:, k] + _U(1))
        return h

    def lattice(self, group: list[str]) -> Lattice:
        marked = [f"▁{w}" for w in group]
        length = len(marked[0])
        points = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(group), length)
        mixed = mix(points.astype(np.uint64) + _U(1))
        h = np.zeros_like(mixed)
        arcs = []
        for n in range(1, min(length, self.longest) + 1):
            h = h[:, : length - n + 1] * _STEP + mixed[:, n - 1 :]
            ids = np.full(h.shape, self.none if n > 1 else self.unknown, np.int32)
            maybe = np.nonzero(self.seen[h & _U(0xFFFFF)])
            values = h[maybe]
            at = np.minimum(np.searchsorted(self.hashes, values), len(self.hashes) - 1)
            hit = self.hashes[at] == values
            ids[maybe[0][hit], maybe[1][hit]] = self.order[at[hit]]
            arcs.append(ids)
        return Lattice(length, arcs)

    def groups(self, found: Sequence[str]) -> Iterator[tuple[np.ndarray, Lattice]]:
        """Lattices of the words, in groups of equal length, with the words' numbers."""
        by_length = defaultdict(list)
        for k, word in enumerate(found):
            by_length[len(word)].append(k)
        for numbers in by_length.values():
            for at in range(0, len(numbers), _GROUP):
                part = numbers[at : at + _GROUP]
                yield np.array(part), self.lattice([found[k] for k in part])

    def log_likelihood(self, found: Sequence[str], table: np.ndarray) -> np.ndarray:
        """Words x languages: log of the sum over all segmentations; ``table`` is pieces x languages."""
        out = np.empty((len(found), table.shape[1]))
        logs = _log(table)
        for numbers, lattice in self.groups(found):
            sums = forward(lattice, lambda ids: table[ids])[-1]
            out[numbers] = _log(sums)
            small = np.flatnonzero((sums < TINY).any(1))
            if len(small):
                out[numbers[small]] = log_forward(lattice.of(small), lambda ids: logs[ids])[-1]
        return out

    def expected(self, found: Sequence[str], counts: np.ndarray, languages: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Pieces x languages: how often each piece is used, over all segmentations of the words by their weight."""
        total = np.zeros_like(table)
        logs = _log(table)
        for numbers, lattice in self.groups(found):
            own = languages[numbers]
            p = lambda ids, own=own: table[ids, own]
            ahead = forward(lattice, p)
            small = ahead[-1] < TINY
            if small.any():
                self._expected_logs(lattice.of(small), counts[numbers[small]], own[small], logs, total)
                if small.all():
                    continue
                lattice, numbers, own, ahead = lattice.of(~small), numbers[~small], own[~small], [x[~small] for x in ahead]
                p = lambda ids, own=own: table[ids, own]
            behind = backward(lattice, p)
            weight = counts[numbers] / ahead[-1]
            for n, ids in enumerate(lattice.arcs, 1):
                for at in range(ids.shape[1]):
                    used = np.flatnonzero(ids[:, at] < self.none)
                    share = weight[used] * ahead[at][used] * table[ids[used, at], own[used]] * behind[at + n][used]
                    np.add.at(total, (ids[used, at], own[used]), share)
        return total

    def _expected_logs(self, lattice: Lattice, counts: np.ndarray, own: np.ndarray, logs: np.ndarray, total: np.ndarray) -> None:
        """Adds to ``total`` what ``expected`` counts, for words whose probability is hardly more than 0."""
        p = lambda ids: logs[ids, own]
        ahead, behind = log_forward(lattice, p), log_backward(lattice, p)
        possible = np.isfinite(ahead[-1])
        for n, ids in enumerate(lattice.arcs, 1):
            for at in range(ids.shape[1]):
                used = np.flatnonzero((ids[:, at] < self.none) & possible)
                share = np.exp(ahead[at][used] + logs[ids[used, at], own[used]] + behind[at + n][used] - ahead[-1][used])
                np.add.at(total, (ids[used, at], own[used]), counts[used] * share)


def forward(lattice: Lattice, p) -> list[np.ndarray]:
    """Probability of all ways to reach each place."""
    sums: list = [1.0 + 0 * p(lattice.arcs[0][:, 0])] + [0.0] * lattice.length
    for at in range(lattice.length):
        for n, ids in enumerate(lattice.arcs, 1):
            if at + n <= lattice.length:
                sums[at + n] = sums[at + n] + sums[at] * p(ids[:, at])
    return sums


def backward(lattice: Lattice, p) -> list[np.ndarray]:
    """Probability of all ways from each place to the end."""
    sums: list = [0.0] * lattice.length + [1.0 + 0 * p(lattice.arcs[0][:, 0])]
    for at in range(lattice.length - 1, -1, -1):
        for n, ids in enumerate(lattice.arcs, 1):
            if at + n <= lattice.length:
                sums[at] = sums[at] + sums[at + n] * p(ids[:, at])
    return sums


def _log(values: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log(values)


def log_forward(lattice: Lattice, log_p) -> list[np.ndarray]:
    """Logarithms of what :func:`forward` gives, which do not underflow."""
    none = np.full_like(log_p(lattice.arcs[0][:, 0]), -np.inf)
    sums = [np.zeros_like(none)] + [none] * lattice.length
    for at in range(lattice.length):
        for n, ids in enumerate(lattice.arcs, 1):
            if at + n <= lattice.length:
                sums[at + n] = np.logaddexp(sums[at + n], sums[at] + log_p(ids[:, at]))
    return sums


def log_backward(lattice: Lattice, log_p) -> list[np.ndarray]:
    """Logarithms of what :func:`backward` gives, which do not underflow."""
    none = np.full_like(log_p(lattice.arcs[0][:, 0]), -np.inf)
    sums = [none] * lattice.length + [np.zeros_like(none)]
    for at in range(lattice.length - 1, -1, -1):
        for n, ids in enumerate(lattice.arcs, 1):
            if at + n <= lattice.length:
                sums[at] = np.logaddexp(sums[at], sums[at + n] + log_p(ids[:, at]))
    return sums


@dataclass
class Model:
    languages: list[str]
    pieces: list[str]
    table: np.ndarray  # (pieces, unknown, none) x languages


def held_out(doc_id: Column) -> Column:
    """Whether the row is kept out of training."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def word_table(labelled: DataFrame) -> DataFrame:
    """(lang, word, n) over rows of (lang, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for part in slices(batches):
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
                for word, n in Counter(words(text)).items():
                    counts[lang, word] += n
            if len(counts) > _FLUSH:
                yield _counted(counts)
                counts.clear()
        yield _counted(counts)

    return labelled.select("lang", "text").mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _counted(counts: Counter) -> pa.RecordBatch:
    langs, found = zip(*counts, strict=True) if counts else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(found, pa.string()), pa.array(list(counts.values()), pa.int64())], ["lang", "word", "n"])


def fit(labelled: DataFrame, *, vocabulary: str | None = None, rounds: int = ROUNDS, smoothing: float = SMOOTHING) -> Model:
    """Piece probabilities per language from all rows of (lang, text) with a language and a text."""
    spark = labelled.sparkSession
    names = read_pieces(vocabulary or vocabulary_path())
    table = stage(word_table(labelled.where("lang IS NOT NULL AND text IS NOT NULL")), "words")
    languages = sorted(row[0] for row in table.select("lang").distinct().collect())
    size = len(names)
    model = np.zeros((size + 2, len(languages)))
    model[:size] = 1 / max(size, 1)
    model[size] = UNKNOWN
    for _ in range(rounds if languages else 0):
        sent = spark.sparkContext.broadcast((names, languages, model))

        def expect(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            names, languages, model = sent.value
            pieces, total = Pieces(names), np.zeros_like(model)
            for part in batches:
                langs = np.searchsorted(languages, part.column("lang").to_pylist()) if part.num_rows else np.empty(0, int)
                total += pieces.expected(part.column("word").to_pylist(), part.column("n").to_numpy(), langs, model)
            piece, lang = np.nonzero(total[: len(names)])
            yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(lang), pa.array(total[piece, lang])], ["piece", "lang", "n"])

        counted = table.mapInArrow(expect, "piece long, lang long, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n"))
        counts = np.zeros((size, len(languages)))
        for row in counted.toLocalIterator():  # at most pieces x languages
            counts[row["piece"], row["lang"]] = row["n"]
        model = model.copy()
        model[:size] = (counts + smoothing) / (counts + smoothing).sum(0)
    return Model(languages, names, model)


def predict(documents: DataFrame, model: Model, *, carry: Sequence[str] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """(carried, text, lang_pred, score) per row; ``carried`` holds the columns named in ``carry``."""
    rows = documents.select(F.struct(*carry).alias("carried"), F.col(text_col).alias("text"))
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def guess(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        pieces, known, scores = Pieces(model.pieces), {}, np.empty((0, len(model.languages)))
        for part in slices(batches):
            found = [words(text) for text in part.column("text").to_pylist()]
            if len(known) > _CACHE:
                known, scores = {}, scores[:0]
            new = sorted(set().union(*found) - known.keys())
            scores = np.concatenate([scores, pieces.log_likelihood(new, model.table)])
            known.update(zip(new, range(len(known), len(scores)), strict=True))
            names, posteriors = [], []
            for own in found:
                if not model.languages or not has_letter(own):
                    names.append(UNDETERMINED)
                    posteriors.append(0.0)
                    continue
                total = scores[[known[w] for w in own]].sum(0)
                best = int(total.argmax())
                names.append(model.languages[best])
                posteriors.append(float(1 / np.exp(np.maximum(total - total[best], -700)).sum()))
            yield pa.RecordBatch.from_arrays([part.column("carried"), part.column("text"), pa.array(names, pa.string()), pa.array(posteriors, pa.float64())], ["carried", "text", "lang_pred", "score"])

    return rows.mapInArrow(guess, f"carried {rows.schema['carried'].dataType.simpleString()}, text string, lang_pred string, score double")


def identify(documents: DataFrame, *, carry: Sequence[str] = ("doc_id",), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """Learns from the labelled rows that are not held out and predicts for all rows; see :func:`predict`."""
    training = documents.where(F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    model = fit(training.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")), **options)
    return predict(documents, model, carry=carry, text_col=text_col)
