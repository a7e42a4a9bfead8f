"""Hard-negative mining with angular triangle filtering.

Every vector stores its norm and its angles to a few reference directions.
By the triangle inequality of angles, an anchor at angle a and a vector at
angle b to the same reference lie between |a - b| and a + b apart; that
cosine interval times both norms bounds their score from both sides. Rows are
kept in an order in which neighbours have like angles, so a tile of rows
shares one interval per anchor, and only tiles whose bounds overlap an
anchor's window are scored, in exact integer arithmetic.

All anchors meet all rows in cells of a grid (anchor groups x row blocks) of
bounded size; a cell returns its best few rows per window, and these are
merged per anchor. The references only steer the filter: any choice of them
gives the same result.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.llm.common import prepare
from tabforge.session import cut_lineage

SCALE = 256
REFERENCES = 16
# Rows (smallest hash of their id) from which the reference directions are chosen.
SAMPLE = 1024
BLOCK_ROWS, LEAST_BLOCK = 16_384, 1024
GROUP_ANCHORS = 2048
TILE = 128
CHUNK = 1024
# Angles are stored as float32 (error under 2.4e-7 rad) of float64 arc cosines.
ANGLE_ERROR = 1e-6
# Windows multiply scores by up to 90 in 64 bits.
MOST_SCORE = 1 << 56

PREPARED = "vec_id long, label long, x binary, norm double, angles binary, near int, near_angle double"
HITS = "anchor_row long, p long, score long, row_no long, vec_id long"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


# ---------------------------------------------------------------- geometry
def integers(rows: list, dims: int) -> np.ndarray:
    """floor(SCALE * c) of each component; shorter vectors end in zeros."""
    out = np.zeros((len(rows), dims), np.int64)
    for i, r in enumerate(rows):
        v = np.floor(SCALE * np.asarray(r, np.float64))
        if len(v) and np.abs(v).max() >= 2.0**62:
            raise ValueError("a vector component is too large for integer scores")
        out[i, :len(v)] = v.astype(np.int64)
    return out


def directions(x: np.ndarray) -> np.ndarray:
    """Unit vectors; zero vectors stay zero."""
    n = np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    return np.divide(x, n, out=np.zeros(x.shape), where=n > 0)


def farthest_first(units: np.ndarray, k: int) -> np.ndarray:
    """Up to ``k`` reference directions, each the one least like those before."""
    units = units[np.abs(units).sum(axis=1) > 0]
    if not len(units):
        return np.zeros((0, units.shape[1]))
    chosen, like = [0], units @ units[0]
    while len(chosen) < min(k, len(units)):
        i = int(np.argmin(like))
        if like[i] > 1 - 1e-9:
            break
        chosen.append(i)
        like = np.maximum(like, units @ units[i])
    return units[chosen]


def angles_to(x: np.ndarray, refs: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(directions(x) @ refs.T, -1.0, 1.0)).astype(np.float32)


def score_bounds(a_angles: np.ndarray, a_norm: np.ndarray, lo: np.ndarray, hi: np.ndarray, n_lo: np.ndarray,
                 n_hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bound of the integer scores of each anchor with each tile.

    ``lo``/``hi``: smallest and largest angle of a tile to each reference,
    ``n_lo``/``n_hi``: smallest and largest norm. Bounds are widened by the
    stored angles' error and by the rounding of norms and products.
    """
    least = np.zeros((len(a_angles), len(lo)))
    most = np.full_like(least, math.pi)
    for r in range(a_angles.shape[1]):
        a = a_angles[:, r, None].astype(np.float64)
        l, h = lo[None, :, r].astype(np.float64), hi[None, :, r].astype(np.float64)
        np.maximum(least, np.maximum(a - h, l - a), out=least)
        np.minimum(most, np.minimum(a + h, 2 * math.pi - a - l), out=most)
    up = np.cos(np.clip(least - 2 * ANGLE_ERROR, 0, math.pi))
    down = np.cos(np.clip(most + 2 * ANGLE_ERROR, 0, math.pi))
    slack = 1e-9 * a_norm[:, None] * n_hi[None, :] + 0.5
    return (a_norm[:, None] * down * np.where(down > 0, n_lo, n_hi) - slack,
            a_norm[:, None] * up * np.where(up > 0, n_hi, n_lo) + slack)


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products: float64 products where all sums stay under 2**53."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if most < MOST_SCORE:
        return a @ b.T
    got = a.astype(object) @ b.T.astype(object)
    if got.size and max(abs(v) for v in got.flat) >= MOST_SCORE:
        raise ValueError("integer scores leave the range of 56 bits")
    return got.astype(np.int64)


class Best:
    """The first ``k`` hits of each query: higher score, then smaller id (NULL last)."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.floor = np.full(n, np.iinfo(np.int64).min)
        self.last = np.full(n, -1)  # id rank of the k-th hit: of equal scores only smaller ones enter
        self.q = self.score = self.rank = np.zeros(0, np.int64)

    def wants(self, q: np.ndarray, scores: np.ndarray, ranks: np.ndarray) -> np.ndarray:
        floor = self.floor[q][:, None]
        return (scores > floor) | ((scores == floor) & (ranks[None, :] < self.last[q][:, None]))

    def add(self, q: np.ndarray, score: np.ndarray, rank: np.ndarray) -> None:
        q, score, rank = np.r_[self.q, q], np.r_[self.score, score], np.r_[self.rank, rank]
        order = np.lexsort((rank, -score, q))
        q, score, rank = q[order], score[order], rank[order]
        first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.zeros(0, int)
        place = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
        full = place == self.k - 1
        self.floor[q[full]], self.last[q[full]] = score[full], rank[full]
        keep = place < self.k
        self.q, self.score, self.rank = q[keep], score[keep], rank[keep]


# -------------------------------------------------------------------- cells
def _columns(t: pa.Table, dims: int) -> dict:
    get = lambda c: t.column(c).to_numpy(zero_copy_only=False)
    n = t.num_rows
    x = np.empty((n, dims), np.int64)
    for i, v in enumerate(t.column("x").to_pylist()):
        x[i] = np.frombuffer(v, "<i4" if len(v) == 4 * dims else "<i8")
    angles = np.array([np.frombuffer(v, "<f4") for v in t.column("angles").to_pylist()], np.float32).reshape(n, -1)
    ids = t.column("vec_id").to_pylist()
    return {"x": x, "angles": angles, "norm": get("norm"), "label": get("label"), "row_no": get("row_no"), "ids": ids}


def cell(anchors: pa.Table, rows: pa.Table, dims: int, k: int, positives: bool) -> pa.Table:
    """Best ``k`` rows of one block for each window of one anchor group.

    ``positives``: one window per anchor, rows of its label but itself, any
    score. Else one window [0.3 p, 0.9 p] for each of the anchor's positive
    scores p, rows of other labels.
    """
    schema = pa.schema([(c.split()[0], pa.int64()) for c in HITS.split(", ")])
    if not anchors.num_rows or not rows.num_rows:
        return schema.empty_table()
    r = _columns(rows, dims)
    # tiles of like angles; within the block, ids are compared by their rank
    rank = np.empty(rows.num_rows, np.int64)
    order = sorted(range(rows.num_rows), key=lambda i: (r["ids"][i] is None, r["ids"][i] or 0, r["row_no"][i]))
    rank[order] = np.arange(rows.num_rows)
    starts = np.arange(0, rows.num_rows, TILE)
    lo, hi = (f.reduceat(r["angles"], starts, axis=0) for f in (np.minimum, np.maximum))
    n_lo, n_hi = (f.reduceat(r["norm"], starts) for f in (np.minimum, np.maximum))
    out = []
    for at in range(0, anchors.num_rows, CHUNK):
        part = anchors.slice(at, CHUNK)
        a = _columns(part, dims)
        if positives:
            owner = np.arange(part.num_rows)
            p = np.zeros(part.num_rows, np.int64)
            low, high = np.full(len(p), -MOST_SCORE), np.full(len(p), MOST_SCORE)
        else:
            lists = part.column("scores").to_pylist()
            owner = np.repeat(np.arange(part.num_rows), [len(s) for s in lists])
            p = np.array([s for ls in lists for s in ls], np.int64)
            low, high = -((-30 * p) // 100), (90 * p) // 100
        best = Best(len(owner), k)
        below, above = score_bounds(a["angles"], a["norm"], lo, hi, n_lo, n_hi)
        # tiles with the highest scores first, so that floors rise early
        for t in np.argsort(-above.max(axis=0), kind="stable"):
            q = np.flatnonzero((above[owner, t] >= np.maximum(low, best.floor)) & (below[owner, t] <= high))
            if not len(q):
                continue
            rs = slice(starts[t], starts[t] + TILE)
            who, back = np.unique(owner[q], return_inverse=True)
            scores = exact_scores(a["x"][who], r["x"][rs])
            if np.abs(scores).max(initial=0) >= MOST_SCORE:
                raise ValueError("integer scores leave the range of 56 bits")
            same = a["label"][who][:, None] == r["label"][rs][None, :]
            if positives:
                fits = same & (a["row_no"][who][:, None] != r["row_no"][rs][None, :])
            else:
                fits = ~same
            s = scores[back]
            hit = fits[back] & (s >= low[q][:, None]) & (s <= high[q][:, None]) & best.wants(q, s, rank[rs])
            i, j = np.nonzero(hit)
            if len(i):
                best.add(q[i], s[i, j], rank[rs][j])
        row = np.asarray(order)[best.rank]
        out.append(pa.Table.from_arrays([
            pa.array(a["row_no"][owner[best.q]]), pa.array(p[best.q]), pa.array(best.score),
            pa.array(r["row_no"][row]), pa.array([r["ids"][i] for i in row], pa.int64())], schema=schema))
    return pa.concat_tables(out)


# -------------------------------------------------------------------- Spark
def usable(rows: DataFrame) -> DataFrame:
    """vec_id, label (moved on for ids divisible by 7), embedding of the rows that take part."""
    label = rows["label"].cast("long")
    bad = F.exists(rows["embedding"], lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(label.isNotNull() & rows["embedding"].isNotNull() & ~bad).select(
        rows["vec_id"].cast("long").alias("vec_id"),
        F.when(rows["vec_id"] % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        rows["embedding"].cast("array<double>").alias("embedding"))


def references(vectors: DataFrame, k: int = REFERENCES, sample: int = SAMPLE) -> tuple[np.ndarray, int]:
    """Reference directions from ``sample`` rows, and the longest vector's length."""
    dims = vectors.agg(F.max(F.size("embedding"))).first()[0] or 0
    few = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()  # at most `sample` rows
    return farthest_first(directions(integers([r["embedding"] for r in few], dims)), k), dims


def prepared(vectors: DataFrame, refs: np.ndarray, dims: int, blocks: int) -> DataFrame:
    """Integer vectors with norm, angles, row_no and block, written in like-angle order.

    Blocks are ranges of (nearest reference, angle to it, hash): a hot
    direction's rows are many ranges, never one block.
    """
    def run(batches):
        for b in batches:
            x = integers(b.column("embedding").to_pylist(), dims)
            angles = angles_to(x, refs)
            near = angles.argmin(axis=1) if len(refs) else np.zeros(len(x), int)
            small = np.abs(x).max(axis=1, initial=0) < 1 << 31
            yield pa.RecordBatch.from_arrays([
                b.column("vec_id"), b.column("label"),
                pa.array([v.astype("<i4" if s else "<i8").tobytes() for v, s in zip(x, small)], pa.binary()),
                pa.array(np.linalg.norm(x.astype(np.float64), axis=1)),
                pa.array([v.astype("<f4").tobytes() for v in angles], pa.binary()), pa.array(near.astype(np.int32)),
                pa.array((angles[np.arange(len(x)), near] if len(refs) else np.zeros(len(x))).astype(np.float64))],
                names=[c.split()[0] for c in PREPARED.split(", ")])

    keys = ["near", "near_angle", "spread"]
    rows = vectors.mapInArrow(run, PREPARED).withColumn("spread", F.xxhash64("vec_id", "x"))
    return cut_lineage(
        rows.repartitionByRange(blocks, *keys).sortWithinPartitions(*keys).drop(*keys)
        .select("*", F.spark_partition_id().alias("block"), F.monotonically_increasing_id().alias("row_no")),
        "mining-vectors")


def _grid(anchors: DataFrame, rows: DataFrame, blocks: int, groups: int, dims: int, k: int,
          positives: bool) -> DataFrame:
    """Hits of every anchor group with every row block, cell by cell."""
    a = anchors.withColumn("group", F.floor(F.col("block") * F.lit(groups) / F.lit(blocks)).cast("int")).drop("block")
    a = a.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    # columns of their own: both sides come from the same table
    r = rows.select(*[F.col(c).alias(c) for c in rows.columns],
                    F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return cell(left, right, dims, k, positives)

    return a.groupBy("block", "group").cogroup(r.groupBy("block", "group")).applyInArrow(run, HITS)


def _first(hits: DataFrame, keys: list[str], k: int) -> DataFrame:
    order: list[Column] = [F.col("score").desc(), F.col("vec_id").asc_nulls_last(), F.col("row_no").asc()]
    return hits.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)


def mine(rows: DataFrame, positives: int = 5, negatives: int = 10, anchor_every: int = 100,
         block_rows: int | None = None, group_anchors: int = GROUP_ANCHORS,
         choose: Callable[[DataFrame], tuple[np.ndarray, int]] = references) -> DataFrame:
    """Hard negatives of every anchor (vec_id divisible by ``anchor_every``).

    Result: see ``RESULT``. Rows with a NULL label or vector, or any NULL,
    NaN or infinite component, take no part. Scores are inner products of
    floor(256 * component). An anchor's positives are its first ``positives``
    other rows of its label (higher score, then smaller vec_id, NULL ids
    last); for each positive with score p the first ``negatives`` rows of
    other labels with 30 p <= 100 score <= 90 p are ranked from 1.

    Vectors shorter than the longest end in zeros. Repeated rows are rows of
    their own: a repeated anchor mines twice, a repeat of an anchor can be
    its positive, equal negatives hold a rank each. NULL ids are no anchors. An empty table gives an
    empty result; further columns are ignored. Components of 2**62 and more
    (scaled) or scores of 2**56 and more raise ``ValueError``.
    """
    prepare(rows.sparkSession)
    vectors = usable(rows)
    refs, dims = choose(vectors)
    total = rows.count()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    size = block_rows or min(BLOCK_ROWS, max(LEAST_BLOCK, math.ceil(total / (2 * cores))))
    ready = prepared(vectors, refs, dims, max(1, math.ceil(total / size)))
    blocks = (ready.agg(F.max("block")).first()[0] or 0) + 1
    anchors = ready.where(F.col("vec_id") % anchor_every == 0)
    groups = max(1, math.ceil(anchors.count() / group_anchors))
    hits = _grid(anchors, ready, blocks, groups, dims, positives, True)
    found = cut_lineage(_first(hits, ["anchor_row"], positives).select(
        "anchor_row", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "mining-positives")
    windows = found.groupBy(F.col("anchor_row").alias("row_no")).agg(F.collect_set("positive_score").alias("scores"))
    hits = _grid(anchors.join(windows, "row_no"), ready, blocks, groups, dims, negatives, False)
    best = _first(hits, ["anchor_row", "p"], negatives).select(
        "anchor_row", F.col("p").alias("positive_score"), F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    ids = anchors.select(F.col("row_no").alias("anchor_row"), F.col("vec_id").alias("anchor_id"))
    return found.join(best, ["anchor_row", "positive_score"]).join(ids, "anchor_row").select(
        *[c.split()[0] for c in RESULT.split(", ")])
