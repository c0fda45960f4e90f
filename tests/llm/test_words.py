import cases
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickstrata.llm import words as W


def _check(texts, pattern, plain):
    found = W.words_of(pa.array(texts, pa.string()), pattern)
    expected = [plain(t) for t in texts]
    assert found.counts().tolist() == [len(x) for x in expected]
    names = {}
    for word, h in zip((w for x in expected for w in x), found.hashes.tolist(), strict=True):
        assert names.setdefault(word, h) == h
    assert len(set(names.values())) == len(names)


@pytest.mark.parametrize(("pattern", "plain"), [(W.NON_SPACE, cases.non_space), (W.ALPHANUMERIC, cases.alphanumeric)])
def test_same_words_as_the_patterns(pattern, plain):
    _check([t for _, t in cases.TEXTS], pattern, plain)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("aAbB1 \t\n\x0b.-_é☃[`{"), max_size=30)), min_size=1, max_size=6))
def test_any_text(texts):
    _check(texts, W.NON_SPACE, cases.non_space)
    _check(texts, W.ALPHANUMERIC, cases.alphanumeric)


def test_hash_does_not_depend_on_the_place():
    text = "alpha " + "x" * (W.WINDOW_BYTES + 10) + " alpha" + " beta" * 100_000 + " alpha"
    found = W.words_of(pa.array(["pad alpha", text]), W.NON_SPACE)
    assert len({int(found.hashes[k]) for k in (1, 2, 4, len(found.hashes) - 1)}) == 1


def test_slices_keep_all_rows_in_order():
    batch = pa.RecordBatch.from_arrays([pa.array(["ab", None, "c" * 50, "d"]), pa.array([0, 1, 2, 3])], ["text", "k"])
    parts = list(W.slices([batch], size=3))
    assert np.concatenate([p.column("k").to_numpy() for p in parts]).tolist() == [0, 1, 2, 3]
    assert len(parts) == 3
