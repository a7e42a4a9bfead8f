"""Hard negatives: brute force in plain Python, bounds against exact scores."""

import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabforge.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, x string, block int"


def brute(rows):
    """``rows``: (vec_id, embedding, label, ...)."""
    use = []
    for i, (v, e, y, *_) in enumerate(rows):
        if y is None or e is None or any(c is None or not math.isfinite(c) for c in e):
            continue
        y = int(math.fmod(y + 1, 10)) if v is not None and v % 7 == 0 else y
        use.append((i, v, y, [math.floor(256 * float(np.float32(c))) for c in e]))
    out = Counter()
    for i, v, y, x in use:
        if v is None or v % 100:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(x, o[3])), o[1] is None, o[1] or 0, o[0], o) for o in use if o[0] != i),
                        key=lambda t: t[:4])
        for p in [s for s in scored if s[4][2] == y][:5]:
            rank = 0
            for s in scored:
                if rank < 10 and s[4][2] != y and 30 * -p[0] <= 100 * -s[0] <= 90 * -p[0]:
                    rank += 1
                    out[(v, p[4][1], rank, s[4][1], -p[0], -s[0])] += 1
    return out


def odd_rows(seed, n=700, dims=6):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(5, dims))
    rows = []
    for i in range(n):
        e = (centres[i % 5] * (1 + (i % 3)) + r.normal(0, 0.3, dims)).astype(np.float32).tolist()
        if i % 4 == 0:
            e = centres[0].astype(np.float32).tolist()  # a large group of copies
        vec = None if i % 61 == 5 else (0 if i % 97 == 3 else i)
        rows.append((vec, e, int(i % 11) - 1, "x", i))
    rows += [(800, None, 1, None, None), (900, [1.0] * dims, None, None, None), (1000, [None] * dims, 1, None, None),
             (1100, [float("nan")] * dims, 1, None, None), (1200, [float("inf")] * dims, 1, None, None),
             (1300, [], 1, None, None), (1400, [0.0] * dims, 2, None, None), (1500, [0.5, -0.5], 2, None, None),
             (1600, [3.4e5] * dims, 3, None, None), (1601, [3.4e5] * dims, 3, None, None), (200, rows[200][1], rows[200][2], "y", 1)]
    return rows


@pytest.mark.parametrize("block_rows,group", [(None, 2048), (90, 3)])
def test_equals_brute_force(spark, block_rows, group):
    rows = odd_rows(1)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = Counter(tuple(r) for r in hn.mine(df, block_rows=block_rows, group_anchors=group).collect())
    assert got == brute(rows) and sum(got.values()) > 100


def test_small_table_and_empty(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    assert Counter(tuple(r) for r in hn.mine(df).collect()) == brute([tuple(r) for r in df.collect()])
    assert hn.mine(df.where("false")).collect() == []


def test_references_do_not_change_the_result(spark):
    rows = odd_rows(2, 300)
    df = spark.createDataFrame(rows, SCHEMA)
    none = hn.mine(df, choose=lambda v: (np.zeros((0, 6)), 6), block_rows=64)
    assert Counter(map(tuple, none.collect())) == Counter(map(tuple, hn.mine(df, block_rows=64).collect()))


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 10**9), st.integers(1, 8), st.sampled_from([1, 50, 10**6]))
def test_bounds_hold(seed, dims, size):
    r = np.random.default_rng(seed)
    x = r.integers(-size, size + 1, (40, dims))
    x[:10] = x[0] * r.integers(-2, 3, (10, 1))
    refs = hn.farthest_first(hn.directions(x[20:]), 5)
    angles, norm = hn.angles_to(x, refs), np.linalg.norm(x.astype(float), axis=1)
    starts = np.arange(0, 40, 8)
    lo, hi = (f.reduceat(angles, starts, axis=0) for f in (np.minimum, np.maximum))
    n_lo, n_hi = (f.reduceat(norm, starts) for f in (np.minimum, np.maximum))
    below, above = hn.score_bounds(angles, norm, lo, hi, n_lo, n_hi)
    s = hn.exact_scores(x, x).reshape(40, 5, 8)
    assert (s.min(axis=2) >= below).all() and (s.max(axis=2) <= above).all()


def test_filter_leaves_out_far_tiles(monkeypatch):
    """On grouped vectors most tiles are never scored."""
    import pyarrow as pa

    r = np.random.default_rng(3)
    centres = np.eye(16)[:8] * 500
    x = np.sort(np.arange(8 * hn.TILE) % 8, kind="stable")
    v = (centres[x] + r.normal(0, 5, (len(x), 16))).astype(np.int64)
    angles = hn.angles_to(v, np.eye(16)[:8])
    norm = np.linalg.norm(v.astype(float), axis=1)
    t = pa.table({"vec_id": np.arange(len(x)), "label": np.zeros(len(x), int), "row_no": np.arange(len(x)), "norm": norm,
                  "x": pa.array([q.astype("<i4").tobytes() for q in v], pa.binary()),
                  "angles": pa.array([q.astype("<f4").tobytes() for q in angles], pa.binary())})
    scored = []
    plain = hn.exact_scores
    monkeypatch.setattr(hn, "exact_scores", lambda a, b: scored.append(len(a) * len(b)) or plain(a, b))
    got = hn.cell(t.slice(0, 20), t, 16, 5, True)
    assert got.num_rows == 100 and sum(scored) == 20 * hn.TILE  # one of eight tiles


def test_wide_integers():
    a = np.array([[1 << 40, 3], [-(1 << 20), 1 << 30]])
    b = np.array([[1 << 12, 5], [7, -(1 << 24)]])
    want = [[sum(int(p) * int(q) for p, q in zip(u, w)) for w in b] for u in a]
    assert hn.exact_scores(a, b).tolist() == want
    with pytest.raises(ValueError, match="56 bits"):
        hn.exact_scores(a, a)
