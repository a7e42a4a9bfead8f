"""One very long document among others: memory of the windows, and its scores."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tabforge.llm import gru_lm as lm
from tabforge.llm import lm_scoring as ls


def test_windows_need_no_lanes_times_longest():
    r = np.random.default_rng(1)
    docs = [r.integers(0, lm.SHORT, 20) for _ in range(400)] + [r.integers(0, lm.SHORT, 60_000)]
    p = lm.Params.first(np.ones(lm.SHORT, int), 9)
    p.flat[:] += r.normal(0, 0.2, p.flat.shape).astype(np.float32)
    tracemalloc.start()
    got = lm.score(docs, p)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6  # dense lanes: 401 x 60,000 x 13 bytes = 313 MB
    assert got[-1] == pytest.approx(lm.score(docs[-1:], p)[0], rel=1e-4)
    assert got[:3] == pytest.approx([lm.score([d], p)[0] for d in docs[:3]], rel=1e-4)


def test_a_long_row_goes_alone():
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3, 4]), pa.array([b"a b", b"c", b"word " * 900, None])],
                                       names=["doc_id", "text"])
    assert [[r[0] for r in c] for c in ls._chunks(iter([batch]), 500)] == [[1, 2], [3], [4]]
