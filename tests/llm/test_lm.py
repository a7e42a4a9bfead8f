"""Language model: gradients, exact base score, proper probabilities, held-out gain."""

import math
import zlib
from collections import Counter

from llm_cases import nasty, empty, small  # noqa: F401
import numpy as np
import pytest

from tabforge.llm import gru_lm as lm
from tabforge.llm import lm_scoring as ls


def brute(docs):
    tok = lambda t: [*(t or "").encode().lower().split(), b""]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    c = Counter(w for i, t in docs if not held(i) for w in tok(t))
    n, v = sum(c.values()), len(c)
    return Counter((i, held(i), len(tok(t)), sum(c[w] > 0 for w in tok(t)), n,
                    round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tok(t)), 6)) for i, t in docs)


def check(df, **kw):
    docs = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    rows = ls.score_documents(df, **kw).collect()
    got = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows)
    assert got == brute(docs)
    assert all(r.score < 0 and math.isfinite(r.score) for r in rows if r.train_tokens)
    return rows


def test_small_beats_unigram(small):
    rows = check(small, rounds=1)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_join_of_rare_words(small):
    """A tiny head vocabulary sends nearly all words through the join."""
    check(small.limit(60), head=10, rounds=1)


def test_nasty_and_empty(nasty, empty):
    check(nasty)
    assert ls.score_documents(empty).collect() == []


def numbers(seed, n=30):
    r = np.random.default_rng(seed)
    return [r.integers(0, lm.SHORT + 1, r.integers(1, 90)) for _ in range(n)]


def test_gradients_match_differences():
    docs = numbers(1, 6)
    p = lm.Params.first(np.arange(lm.SHORT)[::-1] + 1, 50)
    p.flat[:] += np.random.default_rng(2).normal(0, 0.1, p.flat.shape)
    w, number = next(lm.windows(docs, p, 4, 200))
    grads = lm.Params()
    flat, _, dh = w.losses(p, number >= 0, grads)
    w.backward(p, flat, dh, grads)

    def loss(q):
        w, number = next(lm.windows(docs, q, 4, 200))
        return -float(w.losses(q, number >= 0, None)[1].astype(np.float64).sum())

    r = np.random.default_rng(3)
    for name in lm.Params.SHAPES:
        for _ in range(4):
            g = getattr(grads, name)
            at = np.unravel_index(np.argsort(-np.abs(g).ravel())[r.integers(0, 12)], g.shape)
            a, b = lm.Params(p.flat.copy()), lm.Params(p.flat.copy())
            getattr(a, name)[at] += 1e-2
            getattr(b, name)[at] -= 1e-2
            assert g[at] == pytest.approx((loss(a) - loss(b)) / 2e-2, rel=0.03, abs=0.02)


def test_windows_do_not_change_scores():
    docs = numbers(4)
    p = lm.Params.first(np.ones(lm.SHORT, int), 9)
    p.flat[:] += np.random.default_rng(5).normal(0, 0.2, p.flat.shape)
    a, b, c = lm.score(docs, p, 8, 5), lm.score(docs, p, 3, 64), lm.score(docs, p)
    assert np.allclose(a, b, atol=1e-3) and np.allclose(a, c, atol=1e-3)
    alone = np.array([lm.score([d], p, 1, 7)[0] for d in docs])
    assert np.allclose(a, alone, atol=1e-3)


def test_probabilities_sum_to_one():
    p = lm.Params.first(np.arange(lm.SHORT) + 1, 100)
    p.flat[:] += np.random.default_rng(6).normal(0, 0.3, p.flat.shape)
    total = 10.0 ** lm.score([np.array([7, i]) for i in range(lm.SHORT + 1)], p)
    assert total.sum() == pytest.approx(10.0 ** lm.score([np.array([7])], p)[0], rel=1e-4)


def test_training_learns_order():
    r = np.random.default_rng(7)
    make = lambda n: [np.array([(s + j) % 50 for j in range(60)]) for s in r.integers(0, 50, n)]
    p, adam = lm.Params.first(np.r_[np.full(50, 100), np.zeros(lm.SHORT - 50, int)], 1), lm.Adam()
    before = lm.score(make(40), p).sum()
    for _ in range(15):
        lm.train(make(64), p, adam, lanes=16)
    assert lm.score(make(40), p).sum() > 0.6 * before
