"""Words whose probability is below the least float."""

import math

import numpy as np

from clickstrata.llm import language

PIECES = ["▁", "a", "b", "ab", "い"]
FLOOR = 1e-30


def test_long_foreign_run_stays_finite():
    table = np.array([[0.3, 0.3, 0.2, 0.2, FLOOR, language.UNKNOWN, 0.0], [FLOOR] * 4 + [0.9, language.UNKNOWN, 0.0]]).T
    words = ["い" * 32, "ab" * 16, "ab"]
    got = language.Pieces(PIECES).log_likelihood(words, table)
    assert np.isfinite(got).all()
    assert np.allclose(got[0], [math.log(0.3) + 32 * math.log(FLOOR), math.log(FLOOR) + 32 * math.log(0.9)])
    total = got[[0] + [1] * 200].sum(0)
    assert total.argmax() == 0


def test_expected_counts_of_a_foreign_run():
    table = np.array([[0.3, 0.3, 0.2, 0.2, FLOOR, language.UNKNOWN, 0.0]]).T
    pieces, words = language.Pieces(PIECES), ["い" * 32, "い" * 31 + "a"]
    got = pieces.expected(words, np.array([2, 3]), np.zeros(2, int), table)[:, 0]
    assert np.allclose(got, [5, 3, 0, 0, 2 * 32 + 3 * 31, 0, 0])


def test_logarithms_agree_with_plain_sums(monkeypatch):
    table = np.array([[0.05 + 0.01 * k for k in range(len(PIECES))] + [language.UNKNOWN, 0.0]]).T
    pieces, words, counts = language.Pieces(PIECES), ["ab", "abba", "xabい", "bbab"], np.arange(1, 5)
    plain = pieces.log_likelihood(words, table), pieces.expected(words, counts, np.zeros(4, int), table)
    monkeypatch.setattr(language, "TINY", 1e-5)
    mixed = pieces.log_likelihood(words, table), pieces.expected(words, counts, np.zeros(4, int), table)
    assert np.allclose(plain[0], mixed[0]) and np.allclose(plain[1], mixed[1])
