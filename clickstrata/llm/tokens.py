"""Token ids of many texts: cut where a tokenizer cuts anyway, and each different chunk encoded once.

A chunk begins at a space or line feed after a character that is not white space,
or at the start of a text. No token of the vocabularies here spans such a place, and
what stands on one side does not change the tokens on the other, so the ids of a
text are those of its chunks in order. Both encoders check their vocabulary for that.
"""

from __future__ import annotations

import itertools
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np

SEGMENT = 1 << 20  # characters of a text that are split at a time
KEPT = 900_000  # chunks at most that a Python worker remembers, each of at most
LONGEST_KEPT = 64  # characters
LAST_LATIN = "\u024f"  # up to here all libraries agree on what is a letter
JOINED = 1 << 15  # characters that are given to a tokenizer at a time

_TOUCHING = re.compile(r"\s[ \n]")
_CHUNK = re.compile(r"(?s:.)[^ \n]*(?:(?<=\s)[ \n][^ \n]*)*")
_FIRST = re.compile(r"[^ \n]*")
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_CUT = re.compile(r"(?<=\S)[ \n]")


def chunks(text: str) -> list[str]:
    """The chunks of ``text``, which joined give it back."""
    if _TOUCHING.search(text):
        return _CHUNK.findall(text)
    words = text.replace("\n", " \n").split(" ")
    return words[: words[0] != ""] + [w if w[:1] == "\n" else " " + w for w in words[1:]]


def plain_words(text: str) -> list[str] | None:
    """The chunks of a text that begins with a space or line feed, with the space left out; None if its white space touches."""
    return None if _TOUCHING.search(text) else text.replace("\n", " \n").split(" ")[1:]


def whole_chunk(word: str) -> str:
    """The chunk that :func:`plain_words` gives as ``word``."""
    return word if word[:1] == "\n" else " " + word


def segments(text: str) -> Iterator[str]:
    """Consecutive parts of ``text`` of about :data:`SEGMENT` characters, cut between chunks."""
    at = 0
    while at < len(text):
        cut = _CUT.search(text, at + SEGMENT) if len(text) - at > SEGMENT else None
        stop = cut.start() if cut else len(text)
        yield text[at:stop]
        at = stop


def batches(own: list[str]) -> Iterator[list[str]]:
    """``own`` in runs of about :data:`JOINED` characters, one chunk at least, that joined are cut again at the same places."""
    run, size = [], 0
    for chunk in own:
        if run and (size + len(chunk) > JOINED or chunk[0] not in " \n" or run[-1][-1].isspace()):
            yield run
            run, size = [], 0
        run.append(chunk)
        size += len(chunk)
    if run:
        yield run


def _byte_alphabet() -> dict[str, int]:
    """Which character stands for which byte in a byte-level vocabulary: printable ones for themselves, the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + k): b for k, b in enumerate(others)}


class ByteTokenizer:
    """A byte-level BPE file of the tokenizers library. Strings of added tokens inside texts are plain text for ``encode_chunks``."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        before = spec["pre_tokenizer"] or {}
        alphabet, vocabulary = _byte_alphabet(), spec["model"]["vocab"]
        if spec["normalizer"] or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
            raise ValueError("not a plain byte-level vocabulary")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]) or not alphabet.keys() <= vocabulary.keys():
            raise ValueError("added tokens must be plain strings, and each byte must have a token")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self._characters = {b: c for c, b in alphabet.items()}
        self._space = self._characters[0x20]
        self._short: dict[str, list[int]] = {}  # of chunks of one or two characters
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.bytes: list[bytes] = [b""] * self.size
        for piece, k in vocabulary.items():
            if k not in self.added.values():
                self.bytes[k] = bytes(map(alphabet.__getitem__, piece))
        self.lengths = np.array([len(b) for b in self.bytes])
        longest = sorted(self.added, key=len, reverse=True)
        self._added = re.compile("|".join(map(re.escape, longest))) if longest else None

    def around_added(self, text: str) -> Iterator[str | int]:
        """The parts of a text between added tokens, and the ids of these."""
        at = 0
        for found in self._added.finditer(text) if self._added else ():
            yield text[at : found.start()]
            yield self.added[found[0]]
            at = found.end()
        yield text[at:]

    def encode_one(self, chunk: str) -> list[int]:
        """The ids of a chunk. Letters after a space or nothing are one word of the model, which takes less time alone."""
        word = chunk[1:] if chunk[0] == " " else chunk
        if not word.isalpha() or max(word) > LAST_LATIN:
            return self.tokenizer.encode(chunk, add_special_tokens=False).ids
        if not word.isascii():
            word = "".join(map(self._characters.__getitem__, word.encode()))
        return [t.id for t in self.tokenizer.model.tokenize(self._space + word if chunk[0] == " " else word)]

    def ids_of(self, chunk: str) -> list[int]:
        """The ids of a chunk, from those of its parts where a token never spans two: after a line feed, and between a
        letter or digit and the punctuation behind it."""
        if chunk[0] == "\n" and chunk[1:2].strip():
            return self.ids_of("\n") + self.ids_of(chunk[1:])
        if chunk in self._short:
            return self._short[chunk]
        core = chunk.rstrip(PUNCTUATION)
        if core != chunk and core[-1:].isalnum():
            return self.encode_one(core) + self.ids_of(chunk[len(core) :])
        ids = self.encode_one(chunk)
        if len(chunk) <= 2:
            self._short[chunk] = ids
        return ids

    def encode_chunks(self, own: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all chunks one after the other, how many ids there are up to each chunk's end)."""
        found = list(map(self.ids_of, own))
        stops = np.cumsum(list(map(len, found)), dtype=np.int64)
        return np.fromiter(itertools.chain.from_iterable(found), np.int64, int(stops[-1]) if found else 0), stops


def chunk_stops(lengths: np.ndarray, run: list[str]) -> np.ndarray:
    """How many tokens end up to each chunk's end, by the tokens' bytes; an error if one spans two chunks."""
    ends = np.cumsum(lengths)
    wanted = np.cumsum([len(chunk.encode()) for chunk in run])
    stops = np.searchsorted(ends, wanted)
    if not len(ends) or stops[-1] >= len(ends) or (ends[stops] != wanted).any() or ends[-1] != wanted[-1]:
        raise ValueError("a token spans two chunks")
    return stops + 1


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


class PieceTokenizer:
    """A sentencepiece BPE model with byte fallback that adds a space in front; ids of chunks of text."""

    SPACE = "▁"

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.get_piece_size()
        self.bytes: list[bytes] = [self._bytes(k) for k in range(self.size)]
        self.lengths = np.array([len(b) for b in self.bytes])
        inner = re.compile(rf"[^{self.SPACE}][{self.SPACE}\n]")
        if any(inner.search(self.model.id_to_piece(k)) for k in range(self.size)):
            raise ValueError("a piece spans two chunks")

    def _bytes(self, k: int) -> bytes:
        if self.model.is_control(k) or self.model.is_unknown(k):
            return b""
        piece = self.model.id_to_piece(k)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(k) else piece.replace(self.SPACE, " ").encode()

    def encode_chunks(self, own: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As :meth:`ByteTokenizer.encode_chunks`, and of each chunk whether its pieces' bytes are its own. A chunk where they differ has no ids."""
        ids, stops, good, before = [], [], [], 0
        for run in batches(own):
            for part in self._encode(run):
                ids.append(part[0])
                stops.append(before + part[1])
                good.append(part[2])
                before += len(part[0])
        return _joined(ids), _joined(stops), _joined(good).astype(bool)

    def _encode(self, run: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        # Behind a chunk of one token, as the space that the model puts in front is not the text's.
        text = "".join(run)
        found = self.model.encode("a" + text)[1:]
        if self.SPACE not in text and b"".join(map(self.bytes.__getitem__, found)) == text.encode():
            ids = np.array(found, np.int64)
            yield ids, chunk_stops(self.lengths[ids], run), np.ones(len(run), bool)
        elif len(run) > 1:
            for chunk in run:
                yield from self._encode([chunk])
        else:
            yield np.empty(0, np.int64), np.zeros(1, np.int64), np.zeros(1, bool)


class _Learned(dict):
    """Ids of chunks, each encoded when it is first asked for. Keys lack the chunk's leading space if ``spaced``."""

    def __init__(self, tokenizer: ByteTokenizer, spaced: bool, tails: _Learned | None = None) -> None:
        self.tokenizer, self.spaced, self.tails, self.held = tokenizer, spaced, self if tails is None else tails, 0

    def __missing__(self, chunk: str) -> bytes:
        if self.spaced and chunk[:1] == "\n" and chunk[1:2].strip():
            ids = self.tails["\n"] + self.tails[chunk[1:]]
        elif (core := chunk.rstrip(PUNCTUATION)) != chunk and core[-1:].isalnum():
            # Letters and digits never share a token with punctuation after them.
            ids = self[core] + self.tails[chunk[len(core) :]]
        else:
            ids = array("I", self.tokenizer.encode_one(whole_chunk(chunk) if self.spaced else chunk)).tobytes()
        if len(chunk) <= LONGEST_KEPT:
            self[chunk] = ids
            self.held += 1
        return ids


class IdCache:
    """Ids of texts as unsigned 32-bit numbers in bytes, by encoding each different chunk once."""

    def __init__(self, path: str) -> None:
        self.tokenizer = ByteTokenizer(path)
        self._forget()

    def _forget(self) -> None:
        self.exact = _Learned(self.tokenizer, False)
        self.spaced = _Learned(self.tokenizer, True, self.exact)

    def encode(self, text: str | None) -> bytes:
        """The ids of a text, as the tokenizer gives them for the whole text; null and empty: none."""
        if not text:
            return b""
        if self.exact.held + self.spaced.held > KEPT:
            self._forget()
        ids = []
        for part in self.tokenizer.around_added(text):
            if isinstance(part, int):
                ids.append(array("I", [part]).tobytes())
            else:
                ids += map(self._plain, segments(part))
        return ids[0] if len(ids) == 1 else b"".join(ids)

    def _plain(self, text: str) -> bytes:
        first = _FIRST.match(text)[0]  # up to the first space or line feed
        words = plain_words(text[len(first) :]) if not first[-1:].isspace() else None
        if words is None:
            return b"".join(map(self.exact.__getitem__, chunks(text)))
        return (self.exact[first] if first else b"") + b"".join(map(self.spaced.__getitem__, words))


_caches: dict[str, IdCache] = {}


def id_cache(path: str) -> IdCache:
    """One per Python worker, so that chunks learned in a task serve the next."""
    if path not in _caches:
        _caches[path] = IdCache(path)
    return _caches[path]
