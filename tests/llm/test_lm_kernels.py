"""The model's arithmetic against plain formulas, and windows that stay full beside long documents."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from tabforge.llm import gru_lm as lm
from tabforge.llm import lm_scoring as ls


def test_a_long_document_is_scored_in_few_windows(monkeypatch):
    """Its end is taken in windows of a quarter, not one for every ``steps`` tokens; scores stay."""
    r = np.random.default_rng(1)
    docs = [r.integers(0, lm.SHORT, 40) for _ in range(200)] + [r.integers(0, lm.SHORT, 20_000)]
    p = lm.Params.first(np.ones(lm.SHORT, int), 9)
    p.flat[:] += r.normal(0, 0.2, p.flat.shape).astype(np.float32)
    alone, cells, window = lm.score(docs[-1:], p, 1, 1000), [], lm.Window

    def counted(p, ids, *more):
        cells.append(ids.size)
        return window(p, ids, *more)

    monkeypatch.setattr(lm, "Window", counted)
    got = lm.score(docs, p, 64, 16)
    assert got[-1] == pytest.approx(alone[0], rel=1e-4)
    assert sum(cells) >= 28_000 and len(cells) <= 2 + 4 * 28_000 / (64 * 16)
    assert max(cells) <= 64 * 16


def test_chunks_go_into_lanes_together():
    class Part:
        def __init__(self, n):
            self.ids = np.zeros(n, np.int32)

    got = [[len(x.ids) for x in g] for g in ls._laned(map(Part, (4, 4, 1, 30, 5, 5)), 10)]
    assert got == [[4, 4, 1], [30], [5, 5]]


def plain(ids, p):
    """Log-probability of one document, token by token in float64."""
    s, h, state, last, total = p.shape, lm.HIDDEN, np.zeros(lm.HIDDEN), p.shape.start, 0.0
    log_softmax = lambda x: x - x.max() - np.log(np.exp(x - x.max()).sum())
    for i in ids:
        x, u = p.inp[last].astype(float), state @ p.rec.astype(float)
        z, r = (1 / (1 + np.exp(-(x[k * h:(k + 1) * h] + u[k * h:(k + 1) * h]))) for k in (0, 1))
        n = np.tanh(x[2 * h:] + r * u[2 * h:])
        state = n + z * (state - n)
        c = i // s.per_class if i < s.short else i - s.short + s.classes
        total += log_softmax(state @ p.cls.astype(float) + p.cls_b)[c]
        if i < s.short:
            total += log_softmax(state @ p.word[c].astype(float) + p.word_b[c])[i % s.per_class]
        last = i
    return total / np.log(10)


@pytest.mark.parametrize("spread", [0.3, 60.0])  # the second: exponentials that overflow without a shift
def test_scores_are_those_of_the_plain_formulas(spread):
    shape, r = lm.Shape(5, 7, 4), np.random.default_rng(2)
    p = lm.Params.first(r.integers(0, 50, shape.short), 6, shape=shape)
    p.flat[:] += r.normal(0, 0.3, p.flat.shape).astype(np.float32)
    p.word_out[:] *= spread / 0.3
    p.cls_out[:] *= spread / 0.3
    docs = [r.integers(0, shape.start, n) for n in (1, 3, 200, 17, 900)]
    with np.errstate(over="raise"):
        got = lm.score(docs, p, 3, 8)
    assert got == pytest.approx([plain(d, p) for d in docs], rel=1e-4)


def test_a_step_is_adams():
    """Touched rows and classes move by the textbook step of the clipped gradient, others stay."""
    shape, r = lm.Shape(40, 6, 3), np.random.default_rng(3)
    docs = [r.integers(0, shape.start, n) for n in (30, 50, 9)]
    p = lm.Params.first(r.integers(1, 9, shape.short), 4, shape=shape)
    adam, m, v = lm.Adam(), np.zeros(p.flat.shape), np.zeros(p.flat.shape)
    for t in (1, 2, 3):
        grads, before = lm.Params(shape=shape), p.flat.astype(float)
        w, number = next(lm.windows(docs[:t], p, 3, 60))
        flat, _, dh = w.losses(p, number >= 0, grads)
        w.backward(p, flat, dh, grads)
        moves = lm.Params(shape=shape)
        moves.rec[:], moves.cls_out[:], moves.inp[w.rows], moves.word_out[w.classes] = 1, 1, 1, 1
        on = moves.flat > 0
        assert not grads.flat[~on].any() and (~on).any()
        g = grads.flat.astype(float) / len(flat)
        g *= min(1, 1 / np.sqrt((g * g).sum()))
        m[on], v[on] = 0.9 * m[on] + 0.1 * g[on], 0.99 * v[on] + 0.01 * g[on] ** 2
        adam.step(p, grads, w.rows, w.classes, len(flat), 0.5)
        step = 0.5 * 0.01 * m / (1 - 0.9 ** t) / (np.sqrt(v / (1 - 0.99 ** t)) + lm.Adam.EPS)
        assert p.flat == pytest.approx(np.where(on, before - step, before), abs=2e-6)


def test_sums_of_parts():
    r = np.random.default_rng(4)
    for counts in ([1], [1, 1, 1], [8, 9, 1, 64, 65, 700, 2], r.integers(1, 30, 200)):
        rows, ends = r.integers(0, 50, sum(counts)), np.cumsum(counts)
        x = r.normal(size=(50, 3))
        want = np.add.reduceat(x[rows], np.r_[0, ends[:-1]], axis=0)
        assert np.allclose(lm._sums(x, rows, ends), want)


def test_words_ids_and_misses_of_texts():
    r = np.random.default_rng(5)
    texts = [None, b"", b" \x0b\xff A b\x0c", *(bytes(r.choice(list(b"abAB \t\n\x0b\x0c\r\x1c\x85\xa0\xe9"), n)) for n in r.integers(0, 90, 60)),
             b"x" * 500 + b" b"]
    head = [(b"b", 9), (b"", 5), (b"a", 3)]
    for known in (head, head[:1]):  # the second: the end is outside the head too
        v = ls.Vocabulary(known, 30, 9, {})
        x = ls.Numbered(texts, v, pa.array(v.words, pa.binary()))
        for t, ids, misses in zip(texts, x.docs(), x.misses().to_pylist()):
            words = [*(t or b"").lower().split(), b""]
            rank = [v.lookup().get(w, len(known)) for w in words]
            assert ids.tolist() == v.ids(words, np.array(rank)).tolist()
            lost = [w for w, k in zip(words, rank) if k == len(known)]
            assert {m["word"]: m["n"] for m in misses} == {w: lost.count(w) for w in lost}


def test_crc32s():
    r = np.random.default_rng(6)
    words = [r.bytes(n) for n in (0, 1, 3, 63, 64, 65, 500, *r.integers(0, 70, 50))]
    for some in (words, []):
        a = pa.array([b"front", *some], pa.binary())[1:]
        assert ls.crc32s(a).tolist() == [zlib.crc32(w) for w in some]
