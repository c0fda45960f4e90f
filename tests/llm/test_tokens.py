import random

import numpy as np
import pytest
from cases import LONG, TEXTS
from tokenizers import Tokenizer

from clickstrata.llm import alignment, token_files, tokens

PARTS = [" ", "  ", "\n", "\t", "\r\n", "\x1c", "\x85", " ", "a", "b!", "'s", "9", "日本", "é", "́", "😀", "<|endoftext|>", "▁", "​", "\x00", "_-", "the", "WORD", "foo."]
MIXED = ["".join(random.Random(k).choices(PARTS, k=k % 31)) for k in range(1500)]
ALL = [text for _, text in TEXTS if text] + MIXED


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(token_files.vocabulary_path())


def test_chunks_join_to_the_text():
    for text in ALL:
        assert "".join(tokens.chunks(text)) == text if text else True
        assert "".join(tokens.segments(text)) == text


def test_long_texts_are_cut_between_chunks(monkeypatch):
    monkeypatch.setattr(tokens, "SEGMENT", 50)
    parts = list(tokens.segments(LONG))
    assert len(parts) > 1000 and "".join(parts) == LONG
    assert [c for part in parts for c in tokens.chunks(part)] == tokens.chunks(LONG)


@pytest.mark.parametrize("segment", [40, 1 << 20])
def test_ids_are_those_of_the_whole_text(monkeypatch, whole, segment):
    monkeypatch.setattr(tokens, "SEGMENT", segment)
    cache = tokens.IdCache(token_files.vocabulary_path())
    for text in ALL:
        expected = whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(cache.encode(text), "<u4").tolist() == expected, text[:100]
    assert cache.encode(None) == cache.encode("") == b""


def test_forgetting_changes_nothing(monkeypatch, whole):
    monkeypatch.setattr(tokens, "KEPT", 3)
    cache = tokens.IdCache(token_files.vocabulary_path())
    for text in ALL[:200]:
        assert np.frombuffer(cache.encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_pieces_are_those_of_the_whole_text():
    pieces = tokens.PieceTokenizer(alignment.vocabulary_paths()[1])
    for text in filter(None, ALL):
        expected = pieces.model.encode(text)
        same = b"".join(pieces.bytes[k] for k in expected) == (" " + text).encode()
        ids, stops, good = pieces.encode_chunks(tokens.chunks(" " + text))
        assert good.all() == same, text[:100]
        assert stops[-1] == len(ids)
        if same:
            assert ids.tolist() == expected
