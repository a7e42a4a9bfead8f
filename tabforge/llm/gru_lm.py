"""A small gated recurrent language model in numpy.

Documents lie one after another in parallel lanes; a window covers some steps
of all lanes, and a lane's state passes from window to window, so a document
of any length is scored as a whole and trained by truncated backpropagation.
The output is class-factored: a softmax over word classes, then one over the
words of the class. Words outside the short list are in classes of their own
(``Shape.rest``), each with an input id; inside one of these, words have their
add-one unigram shares.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np

HIDDEN = 16
LANES, STEPS = 512, 32
ROWS, PART = 512, 128  # rows of logits in the cache together, rows of a matrix product
PIECE = 8             # rows of a piece of a sum
MOST, LEAST = 60, 1e-30  # bounds of logits and of sums of their exponentials that need no shift
MOST_WORDS = 1 << 17  # bound of the short list: about 34 MB of weights a copy
GROWTH = 64           # short list words per square root of the distinct training words


@dataclass(frozen=True)
class Shape:
    """Ids: the short list by class, then the ``rest`` classes of other words, then START."""

    classes: int = 32
    per_class: int = 32
    rest: int = 1

    @classmethod
    def of(cls, distinct: int, rest: int, most: int = MOST_WORDS) -> Shape:
        """Square shape for V distinct words: about min(V, GROWTH * sqrt(V), most, MOST_WORDS) of them."""
        side = math.ceil(math.sqrt(min(distinct, GROWTH * math.sqrt(distinct), most, MOST_WORDS)))
        return cls(max(1, side), max(1, side), rest)

    @property
    def short(self) -> int:
        return self.classes * self.per_class

    @property
    def start(self) -> int:  # input of a document's first step
        return self.short + self.rest

    def sizes(self) -> dict[str, tuple[int, ...]]:
        """Shapes of the weights; the last of the HIDDEN + 1 inputs of a softmax is its bias."""
        h, out = HIDDEN, self.classes + self.rest
        return {"inp": (self.start + 1, 3 * h), "rec": (h, 3 * h), "cls_out": (1, h + 1, out),
                "word_out": (self.classes, h + 1, self.per_class)}


SMALL = Shape()
SHORT = SMALL.short


class Params:
    """Weights as views of one flat float32 vector, so they add and average."""

    SHAPES = SMALL.sizes()

    def __init__(self, flat: np.ndarray | None = None, shape: Shape = SMALL):
        sizes = shape.sizes()
        self.shape = shape
        self.flat = np.zeros(sum(math.prod(x) for x in sizes.values()), np.float32) if flat is None else flat
        at = 0
        for name, size in sizes.items():
            n = math.prod(size)
            setattr(self, name, self.flat[at:at + n].reshape(size))
            at += n
        self.cls, self.cls_b = self.cls_out[0, :HIDDEN], self.cls_out[0, HIDDEN]
        self.word, self.word_b = self.word_out[:, :HIDDEN], self.word_out[:, HIDDEN]

    @classmethod
    def first(cls, counts: np.ndarray, rest: int | np.ndarray, seed: int = 5, shape: Shape = SMALL) -> Params:
        """Start at the unigram model of the short list counts and the counts of the rest classes."""
        p, rng = cls(shape=shape), np.random.default_rng(seed)
        p.inp[:] = rng.normal(0, 0.1, p.inp.shape)
        p.rec[:] = rng.normal(0, HIDDEN ** -0.5, p.rec.shape)
        by_class = counts.astype(np.float64).reshape(shape.classes, shape.per_class) + 1e-3
        p.word_b[:] = np.log(by_class / by_class.sum(1, keepdims=True))
        by_class = np.r_[by_class.sum(1), np.broadcast_to(rest, shape.rest) + 1.0]
        p.cls_b[:] = np.log(by_class / by_class.sum())
        return p


def lanes_of(docs: list[np.ndarray], lanes: int = LANES) -> list[np.ndarray]:
    """Documents (their numbers, in order) dealt to lanes, longest first.

    Lanes are sorted by length, so the active ones are always the first.
    """
    order = sorted(range(len(docs)), key=lambda i: -len(docs[i]))
    heap = [(0, k) for k in range(min(lanes, len(docs)))]
    own: list[list[int]] = [[] for _ in heap]
    for i in order:
        n, k = heapq.heappop(heap)
        own[k].append(i)
        heapq.heappush(heap, (n + len(docs[i]), k))
    own.sort(key=lambda x: -sum(len(docs[i]) for i in x))
    return [np.array(x, np.int64) for x in own]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place, by exp(-x): 1 / (1 + inf) is 0."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _thirds(rec: np.ndarray) -> list[np.ndarray]:
    return [np.ascontiguousarray(rec[:, k:k + HIDDEN]) for k in range(0, 3 * HIDDEN, HIDDEN)]


def _softmaxes(h: np.ndarray, target: np.ndarray, ends: np.ndarray, weights: np.ndarray,
               grads: np.ndarray | None) -> tuple[np.ndarray, np.ndarray | None]:
    """Log-probabilities of the targets, and with ``grads`` the gradient of their negative sum by ``h``.

    Rows up to ``ends[c]`` (and from ``ends[c - 1]``) go through ``weights[c]``; their last input is 1. The
    gradient by the weights is written to ``grads`` for each ``c`` with rows. The logits lie in blocks of some
    rows, which stay in the cache.
    """
    rows, width = len(h), weights.shape[2]
    got = np.empty(rows, np.float32)
    dh = None if grads is None else np.empty((rows, HIDDEN), np.float32)
    room, ones, line = np.empty((min(ROWS, rows), width), np.float32), np.ones(width, np.float32), np.arange(ROWS) * width
    last, c = ends.tolist(), 0
    for at in range(0, rows, ROWS):
        to = min(at + ROWS, rows)
        x, cells = room[:to - at], line[:to - at] + target[at:to]
        parts, a = [], at
        while a < to:
            while last[c] <= a:
                c += 1
            b = min(last[c], to, a + PART)
            parts.append((c, a, b, x[a - at:b - at]))
            a = b
        for shift in (False, True):
            for k, a, b, part in parts:
                np.dot(h[a:b], weights[k], out=part)
            if shift:
                x -= x.max(1, keepdims=True)
            elif not -MOST < x.max() < MOST:
                continue
            hit = x.reshape(-1)[cells]
            np.exp(x, out=x)
            total = x @ ones
            if total.min() > LEAST:
                break
        got[at:to] = hit - np.log(total)
        if grads is None:
            continue
        x.reshape(-1)[cells] -= total
        over = (1 / total)[:, None]
        scaled = h[at:to] * over
        for k, a, b, part in parts:
            np.dot(part, weights[k, :HIDDEN].T, out=dh[a:b])
            if a == (last[k - 1] if k else 0):
                np.dot(scaled[a - at:b - at].T, part, out=grads[k])
            else:
                grads[k] += scaled[a - at:b - at].T @ part
        dh[at:to] *= over
    return got, dh


def _sums(x: np.ndarray, rows: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of ``x[rows]`` over parts, up to each of ``ends`` (no part is empty).

    Parts are cut into pieces of up to PIECE rows; the k-th rows of all pieces are added at once.
    """
    count = np.diff(ends, prepend=0)
    pieces = (count + PIECE - 1) // PIECE
    to = np.cumsum(pieces)
    first = np.repeat(ends - count - PIECE * (to - pieces), pieces) + PIECE * np.arange(to[-1])
    left = (first + PIECE - np.repeat(ends, pieces)).clip(0).astype(np.int8)  # rows that a piece lacks
    by = np.argsort(left, kind="stable")
    first, lacks = first[by], np.bincount(left, minlength=PIECE)
    out = x.take(rows[first], 0)
    for k in range(1, PIECE):
        more = int(lacks[:PIECE - k].sum())
        out[:more] += x.take(rows[first[:more] + k], 0)
    place = np.empty(len(by), np.int64)
    place[by] = np.arange(len(by))
    done, many = out.take(place[to - pieces], 0), pieces > 1
    if many.any():
        done[many] = _sums(out, place[np.repeat(many, pieces)], np.cumsum(pieces[many]))
    return done


class Window:
    """Forward pass over some steps of the active lanes (arrays: steps x lanes x HIDDEN, each in one piece)."""

    def __init__(self, p: Params, ids: np.ndarray, start: np.ndarray, before: np.ndarray, state: np.ndarray):
        steps, lanes = ids.shape
        h = HIDDEN
        self.ids, self.start = ids, start
        self.inputs = np.where(start, p.shape.start, np.vstack((before[None], ids[:-1])))
        x = p.inp.take(self.inputs.ravel(), 0).reshape(steps, lanes, 3, h)
        self.z, self.r, self.n = (np.ascontiguousarray(x[:, :, k]) for k in range(3))  # of the inputs; gates below
        self.q, self.prev, self.out = np.empty_like(self.n), np.empty_like(self.n), np.empty_like(self.n)
        rec = _thirds(p.rec)
        u, fresh = np.empty((lanes, h), np.float32), start.any(1).tolist()
        for t in range(steps):
            prev, z, r, n, q, out = self.prev[t], self.z[t], self.r[t], self.n[t], self.q[t], self.out[t]
            prev[:] = state
            if fresh[t]:
                prev[start[t]] = 0
            z += np.dot(prev, rec[0], out=u)
            _sigmoid(z)
            r += np.dot(prev, rec[1], out=u)
            _sigmoid(r)
            np.dot(prev, rec[2], out=q)
            n += np.multiply(r, q, out=u)
            np.tanh(n, out=n)
            np.subtract(prev, n, out=out)
            out *= z
            out += n
            state = out
        self.state = state

    def losses(self, p: Params, valid: np.ndarray, grads: Params | None):
        """Natural log-probabilities of the targets (tail words: of their class),
        and with ``grads`` the gradient of their negative sum by state."""
        shape = p.shape
        flat = np.flatnonzero(valid.ravel())
        ids = self.ids.ravel()[flat]
        cls = np.where(ids < shape.short, ids // shape.per_class, ids - shape.short + shape.classes)
        # rows by class; a stable sort of small numbers is a radix sort
        order = np.argsort(cls.astype(np.uint16), kind="stable")
        flat, ids, cls = flat[order], ids[order], cls[order]
        h = np.ones((len(flat), HIDDEN + 1), np.float32)
        h[:, :HIDDEN] = self.out.reshape(-1, HIDDEN).take(flat, 0)
        got, dh = _softmaxes(h, cls, np.array([len(h)]), p.cls_out, grads and grads.cls_out)
        ends = np.searchsorted(cls, np.arange(shape.classes), "right")
        self.classes = np.flatnonzero(np.diff(ends, prepend=0))
        own = int(ends[-1])
        lp, d = _softmaxes(h[:own], ids[:own] % shape.per_class, ends, p.word_out, grads and grads.word_out)
        got[:own] += lp
        if grads:
            dh[:own] += d
        return flat, got, dh

    def backward(self, p: Params, flat: np.ndarray, dh: np.ndarray, grads: Params) -> None:
        """Gradients of the recurrent and the input weights (overwrites the window)."""
        steps, lanes = self.ids.shape
        h = HIDDEN
        out = np.zeros((steps * lanes, h), np.float32)
        out[flat] = dh
        out = out.reshape(steps, lanes, h)
        z, r, n = self.z, self.r, self.n
        # what each step's gradient is multiplied by, then the gradients of the gates
        dz = 1 - z
        dn = n * n
        np.subtract(1, dn, out=dn)
        dn *= dz
        dz *= z
        dz *= self.prev - n
        dr = 1 - r
        dr *= r
        dr *= self.q
        dq = r
        back, fresh = [x.T for x in _thirds(p.rec)], self.start.any(1).tolist()
        carry, u = np.zeros((lanes, h), np.float32), np.empty((lanes, h), np.float32)
        for t in range(steps - 1, -1, -1):
            g = out[t]
            g += carry
            dn[t] *= g
            dz[t] *= g
            dr[t] *= dn[t]
            dq[t] *= dn[t]
            np.multiply(g, z[t], out=carry)
            for d, x in zip((dz, dr, dq), back):
                carry += np.dot(d[t], x, out=u)
            if fresh[t]:
                carry[self.start[t]] = 0
        prev = self.prev.reshape(-1, h).T
        for k, d in enumerate((dz, dr, dq)):
            grads.rec[:, k * h:(k + 1) * h] = prev @ d.reshape(-1, h)
        ids = self.inputs.ravel()
        order = np.argsort(ids)
        ids = ids[order]
        ends = np.flatnonzero(np.r_[ids[1:] != ids[:-1], True]) + 1
        self.rows = ids[ends - 1]
        dx = np.empty((len(ids), 3, h), np.float32)
        for k, d in enumerate((dz, dr, dn)):
            dx[:, k] = d.reshape(-1, h)
        grads.inp[self.rows] = _sums(dx.reshape(-1, 3 * h), order, ends)


class Adam:
    """Adam whose input rows and word classes move only when a window touches them.

    ``EPS`` is above the mean gradients of rare words, which so move in
    proportion to them and keep their frequencies.
    """

    EPS = 1e-5
    GROUP, ROWS = 8, 1024  # word classes, input rows that move together: their numbers stay in the cache

    def __init__(self, rate: float = 0.01):
        self.rate, self.t = rate, 0
        self.m = self.v = None

    def step(self, p: Params, grads: Params, inputs: np.ndarray, classes: np.ndarray, n: int, part: float) -> None:
        """A ``part`` of a step against ``grads / n``, clipped to norm 1 (the touched ``grads`` are overwritten)."""
        if self.m is None:
            self.m, self.v = Params(shape=p.shape), Params(shape=p.shape)
        cuts = np.flatnonzero(np.diff(classes) > 1) + 1
        runs = [(int(a), min(int(a) + self.GROUP, to)) for r in np.split(classes, cuts) if len(r)
                for to in (int(r[-1]) + 1,) for a in range(int(r[0]), to, self.GROUP)]
        touched = [("rec", slice(None)), ("cls_out", slice(None)), *(("word_out", slice(*r)) for r in runs)]
        rows = [inputs[i:i + self.ROWS] for i in range(0, len(inputs), self.ROWS)]
        moved = [grads.inp.take(at, 0) for at in rows]
        g = [getattr(grads, k)[at] for k, at in touched]
        norm = math.sqrt(sum(float(np.dot(x.ravel(), x.ravel())) for x in (*moved, *g))) / n
        self.t += 1
        a, b = 1 - 0.9 ** self.t, 1 - 0.99 ** self.t
        # m / (sqrt(v / b) + EPS) = sqrt(b) * m / (sqrt(v) + EPS * sqrt(b))
        clip, eps = np.float32(0.1 / n * min(1.0, 1.0 / max(norm, 1e-9))), np.float32(self.EPS * math.sqrt(b))
        rate = np.float32(self.rate * part / a * math.sqrt(b))

        def move(x: np.ndarray, m: np.ndarray, v: np.ndarray) -> np.ndarray:
            """Updates m and v, and turns x into the step."""
            x *= clip
            m *= np.float32(0.9)
            m += x
            x *= x  # (0.1 of the gradient) squared: 0.01 of its square
            v *= np.float32(0.99)
            v += x
            np.sqrt(v, out=x)
            x += eps
            np.divide(m, x, out=x)
            x *= rate
            return x

        for (k, at), x in zip(touched, g):
            weights = getattr(p, k)[at]
            weights -= move(x, getattr(self.m, k)[at], getattr(self.v, k)[at])
        for at, x in zip(rows, moved):
            m, v = self.m.inp.take(at, 0), self.v.inp.take(at, 0)
            p.inp[at] = p.inp.take(at, 0) - move(x, m, v)
            self.m.inp[at], self.v.inp[at] = m, v


def windows(docs: list[np.ndarray], p: Params, lanes: int, steps: int, wide: bool = False):
    """Windows over the documents in order, with the lanes' states carried on.

    A window is taken from its lanes' tokens, so beside the tokens there are
    only lanes x steps cells, however long a document is.
    """
    own = lanes_of(docs, lanes)
    if not own:
        return
    order = np.concatenate(own)
    sizes = np.array([len(docs[i]) for i in order], np.int64)
    tokens = np.concatenate([docs[i] for i in order], dtype=np.int32, casting="same_kind")
    of = np.repeat(order.astype(np.int32), sizes)
    first = np.zeros(len(tokens) + 1, bool)
    first[np.cumsum(sizes) - sizes] = True
    lengths = np.array([sum(len(docs[i]) for i in mine) for mine in own], np.int64)
    begin = np.cumsum(lengths) - lengths
    state = np.zeros((len(own), HIDDEN), np.float32)
    before = np.full(len(own), p.shape.start, np.int32)
    t, longest = 0, int(lengths[0])
    while t < longest:
        live = int((lengths > t).sum())
        # with ``wide``, few lanes (the ends of long documents) go on for more steps, to a quarter of a window
        width = max(steps, lanes * steps // (4 * live)) if wide else steps
        at = np.arange(t, min(t + width, longest))[:, None]
        valid = at < lengths[:live]
        cells = np.where(valid, begin[:live] + at, len(tokens) - 1)
        ids = np.where(valid, tokens[cells], 0)
        w = Window(p, ids, first[cells] & valid, before[:live], state[:live])
        state, before = w.state, ids[-1]
        yield w, np.where(valid, of[cells], -1)
        t += len(at)


def train(docs: list[np.ndarray], p: Params, adam: Adam, lanes: int = LANES, steps: int = STEPS) -> int:
    """One pass of truncated backpropagation over the documents; tokens seen."""
    seen, grads = 0, Params(shape=p.shape)  # a window overwrites what it touches
    for w, number in windows(docs, p, lanes, steps):
        flat, _, dh = w.losses(p, number >= 0, grads)
        w.backward(p, flat, dh, grads)
        # windows of under a quarter (the ends of long documents) move the weights by their share
        part = min(1.0, 4 * len(flat) / (lanes * steps))
        adam.step(p, grads, w.rows, w.classes, max(1, len(flat)), part)
        seen += len(flat)
    return seen


def score(docs: list[np.ndarray], p: Params, lanes: int = LANES, steps: int = STEPS) -> np.ndarray:
    """Log10 probability of each whole document (tail words: of their class)."""
    out = np.zeros(len(docs))
    for w, number in windows(docs, p, lanes, steps, wide=True):
        flat, got, _ = w.losses(p, number >= 0, None)
        out += np.bincount(number.ravel()[flat], got.astype(np.float64), len(docs))
    return out / np.log(10)
