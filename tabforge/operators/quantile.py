"""Exact quantiles by radix selection, without sorting or gathering a column.

``F.median`` / ``percentile`` keep a value->count map that is merged in ONE
final task, so its memory grows with the number of distinct values. Here a
double's 64 bits are read as an integer that orders like the double, and the
value at a rank is found digit by digit from the most significant end: each
round every task counts the next ``DIGIT_BITS`` bits of the values that share
a still wanted prefix in fixed-size histograms, Spark adds the histograms up,
and the digit that holds the rank extends the prefix. All columns and all
ranks share a round. There are at most ``64 / DIGIT_BITS`` rounds at any size
and for any values; a round ends early for a prefix whose smallest and largest
value are the same. What reaches the driver is at most 2 ** DIGIT_BITS
counters per wanted prefix.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.operators.clean import require_columns

DIGIT_BITS = 12
_COUNTS = "col int, prefix long, digit int, n long, lo long, hi long"
_SIGN = np.uint64(1 << 63)


def ordered_bits(values: np.ndarray) -> np.ndarray:
    """Signed integers that order like the doubles (-0.0 counts as 0.0)."""
    bits = (values + 0.0).view(np.int64)
    return np.where(bits >= 0, bits, bits ^ np.int64(0x7FFFFFFFFFFFFFFF))


def from_ordered_bits(image: int) -> float:
    bits = image if image >= 0 else image ^ 0x7FFFFFFFFFFFFFFF
    return float(np.array([bits], np.int64).view(np.float64)[0])


class _Histogram:
    """Counts of one column's next digit below one prefix, in one task."""

    def __init__(self, prefix: int, done: int, width: int):
        self.prefix, self.done, self.width = prefix, done, width
        size = 1 << width
        self.n = np.zeros(size, np.int64)
        self.lo = np.full(size, np.iinfo(np.int64).max)
        self.hi = np.full(size, np.iinfo(np.int64).min)

    def add(self, image: np.ndarray) -> None:
        u = image.view(np.uint64) ^ _SIGN
        if self.done:
            inside = u >> np.uint64(64 - self.done) == np.uint64(self.prefix)
            image, u = image[inside], u[inside]
        digit = (u >> np.uint64(64 - self.done - self.width) & np.uint64((1 << self.width) - 1)).astype(np.int64)
        self.n += np.bincount(digit, minlength=len(self.n))
        np.minimum.at(self.lo, digit, image)
        np.maximum.at(self.hi, digit, image)


def _digit_counts(df: DataFrame, cols: Sequence[str], wanted: Mapping[int, Sequence[int]], done: int,
                  width: int) -> DataFrame:
    """Per column, prefix and digit: count, smallest and largest image (one aggregate)."""
    data = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hists = [(i, _Histogram(p, done, width)) for i, ps in wanted.items() for p in ps]
        for b in batches:
            images = {}
            for i in wanted:
                v = b.column(f"c{i}").to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
                images[i] = ordered_bits(v[~np.isnan(v)])
            for i, h in hists:
                h.add(images[i])
        for i, h in hists:
            at = np.flatnonzero(h.n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), i, np.int32)), pa.array(np.full(len(at), h.prefix, np.int64)),
                 pa.array(at.astype(np.int32)), pa.array(h.n[at]), pa.array(h.lo[at]), pa.array(h.hi[at])],
                names=["col", "prefix", "digit", "n", "lo", "hi"])

    return data.mapInArrow(run, _COUNTS).groupBy("col", "prefix", "digit").agg(
        F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def exact_quantiles(df: DataFrame, wanted: Mapping[str, Sequence[float]]) -> dict[str, list[float | None]]:
    """Interpolated quantiles (as ``percentile``/``median``) of several columns.

    ``wanted`` maps a column to quantiles within [0, 1]; the result has their
    values in the same order. NULL and NaN are ignored, infinities are
    ordinary values; an empty column gives ``None``.
    """
    require_columns(df, wanted)
    for c, qs in wanted.items():
        if not all(0.0 <= q <= 1.0 for q in qs):
            raise ValueError(f"quantiles of {c!r} must be within [0, 1]")
    cols = [c for c in wanted if len(wanted[c])]
    found: list[dict[int, float]] = [{} for _ in cols]
    # rank -> (prefix, rows before the prefix); known after the first round
    open_ranks: list[dict[int, tuple[int, int]]] | None = None
    sizes = [0] * len(cols)
    done = 0
    prefixes: dict[int, list[int]] = {i: [0] for i in range(len(cols))}
    while prefixes:
        width = min(DIGIT_BITS, 64 - done)
        rows = _digit_counts(df, cols, prefixes, done, width).collect()
        hists: dict[tuple[int, int], list] = {}
        for r in sorted(rows, key=lambda r: r["digit"]):
            hists.setdefault((r["col"], r["prefix"]), []).append((r["digit"], r["n"], r["lo"], r["hi"]))
        if open_ranks is None:
            open_ranks = []
            for i, c in enumerate(cols):
                sizes[i] = sum(h[1] for h in hists.get((i, 0), []))
                ranks = {f(q * (sizes[i] - 1)) for q in wanted[c] for f in (math.floor, math.ceil)} if sizes[i] else ()
                open_ranks.append({r: (0, 0) for r in ranks})
        prefixes = {}
        for i, ranks in enumerate(open_ranks):
            for rank, (prefix, before) in list(ranks.items()):
                for digit, n, lo, hi in hists[i, prefix]:
                    if rank < before + n:
                        break
                    before += n
                if lo == hi:
                    found[i][rank] = from_ordered_bits(lo)
                    del ranks[rank]
                else:
                    ranks[rank] = (prefix << width | digit, before)
            if ranks:
                prefixes[i] = sorted({p for p, _ in ranks.values()})
        done += width

    def value(i: int, q: float) -> float | None:
        if not sizes[i]:
            return None
        pos = q * (sizes[i] - 1)
        lo, hi = math.floor(pos), math.ceil(pos)
        a, b = found[i][lo], found[i][hi]
        return a if lo == hi or a == b else (hi - pos) * a + (pos - lo) * b

    out: dict[str, list[float | None]] = {c: [] for c in wanted}
    for i, c in enumerate(cols):
        out[c] = [value(i, q) for q in wanted[c]]
    return out


def exact_quantile(df: DataFrame, col: str, q: float = 0.5) -> float | None:
    return exact_quantiles(df, {col: [q]})[col][0]


def exact_median(df: DataFrame, col: str) -> float | None:
    return exact_quantile(df, col, 0.5)
