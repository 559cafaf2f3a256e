"""Texts that the CRF scan skips are those that Viterbi leaves untagged."""

import numpy as np

from gridspark.llm import secrets


def test_first_words_and_negative_transitions():
    crf = secrets.Crf()
    crf.move[:] = -5.0
    crf.move[0, 0] = 0.0
    crf.unary[-1, 1], crf.unary[0, 1] = -3.0, 4.0
    may, table = crf.may_tag(crf.table()), crf.table()
    assert crf.viterbi(table[[1]]).tolist() == [1] and may[1]
    rng = np.random.default_rng(2)
    for _ in range(40):
        crf.unary, crf.move = rng.normal(0, 1, crf.unary.shape), rng.normal(-2, 2, (3, 3))
        may, table = crf.may_tag(crf.table()), crf.table()
        for _ in range(20):
            code = rng.integers(0, len(table), rng.integers(1, 4))
            assert may[code].any() or not crf.viterbi(table[code]).any()
