"""The model's vocabulary: grows with the corpus, and other words keep ids and shares of their own."""

import zlib

import numpy as np
import pytest

from tabforge.llm import gru_lm as lm
from tabforge.llm import lm_scoring as ls


def test_short_list_grows_with_words():
    short = [lm.Shape.of(v, 32).short for v in (4_000, 24_000, 79_000, 374_000, 10**9)]
    assert short[0] >= 4_000 and short[0] < short[1] < short[2] < short[3] < short[4] <= 1.01 * lm.MOST_WORDS
    for v, n in zip((24_000, 79_000, 374_000), short[1:]):
        assert n >= 60 * v ** 0.5


def vocabulary():
    """20,000 words; the head has the 15,000 most frequent."""
    words = [(b"w%d" % i, 1 + 40_000 // (i + 1)) for i in range(20_000)]
    crc = {}
    for w, n in words:
        k = zlib.crc32(w) % ls.HASHED
        a, b = crc.get(k, (0, 0))
        crc[k] = (a + n, b + 1)
    return words, ls.Vocabulary(words[:15_000], sum(n for _, n in words), len(words), crc)


def test_ids_and_shares_of_all_words():
    words, v = vocabulary()
    lookup, size = v.lookup(), len(v.words)
    texts = [w for w, _ in words]
    ids = v.ids(texts, np.array([lookup.get(w, size) for w in texts]))
    own = ids < v.shape.short
    assert len(set(ids[own])) == own.sum() >= 9_000 and len(set(ids[~own])) > 8
    assert ids.max() < v.shape.start and (ids[15_000:] >= v.hashed).all()
    rest = np.bincount(ids[~own] - v.shape.short, [words[i][1] for i in np.flatnonzero(~own)], v.shape.rest)
    assert (rest == v.rest_tokens).all()
    # probabilities of all trained words and one unseen word in each hashed class are one
    p = v.first()
    p.flat[:] += np.random.default_rng(1).normal(0, 0.1, p.flat.shape).astype(np.float32)
    inputs = np.arange(v.shape.start)
    got = 10.0 ** (lm.score([np.array([3, i]) for i in inputs], p) - lm.score([np.array([3])], p)[0])
    assert got.sum() == pytest.approx(1, rel=1e-3)
    logs = np.log10(np.array([n for _, n in words])[~own] + 1.0)
    share = np.bincount(ids[~own] - v.shape.short, 10 ** (logs - v.rest_log[ids[~own] - v.shape.short]), v.shape.rest)
    share[ls.OCTAVES:] += 10 ** -v.rest_log[ls.OCTAVES:]
    assert share[share > 0] == pytest.approx(1)


def test_order_of_words_beyond_1024_is_learnt():
    """Words ranked 3,000 to 3,049 follow each other; another order is less likely."""
    shape = lm.Shape.of(5_000, 32)
    r = np.random.default_rng(7)
    make = lambda n, step: [3_000 + (s + step * np.arange(40)) % 50 for s in r.integers(0, 50, n)]
    counts = np.ones(shape.short, int)
    counts[3_000:3_050] = 100
    p, adam = lm.Params.first(counts, 1, shape=shape), lm.Adam()
    before = lm.score(make(40, 1), p).sum()
    for _ in range(15):
        lm.train(make(64, 1), p, adam, lanes=16)
    assert lm.score(make(40, 1), p).sum() > 0.6 * before
    assert lm.score(make(40, 1), p).sum() > lm.score(make(40, 7), p).sum()


def test_carried_state_differs_by_rare_words():
    """Two rare words in front give the words after them different scores."""
    words, v = vocabulary()
    lookup, size = v.lookup(), len(v.words)
    p = v.first()
    p.cls[:] = np.random.default_rng(1).normal(0, 0.3, p.cls.shape)
    at = lambda ws: v.ids(ws, np.array([lookup.get(w, size) for w in ws]))
    a, b = (lm.score([at([w, b"w0", b"w1"])], p)[0] - lm.score([at([w])], p)[0] for w in (b"w2500", b"w14500"))
    assert a != b
