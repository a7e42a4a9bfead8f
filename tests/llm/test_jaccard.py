"""Jaccard join against brute force."""

import os
import random
from collections import Counter

from llm_cases import NASTY, nasty, empty, small  # noqa: F401
import numpy as np
import pytest

from tabforge.llm import jaccard_join as jj
from tabforge.llm.components import components


def brute(docs):
    """(doc_id, n_shingles, component) by comparing all pairs of distinct sets."""
    sets = {}
    for i, t in docs:
        w = (t or "").encode().lower().split()
        s = {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        sets.setdefault(i, frozenset(s))
    ids = sorted(i for i in sets if i is not None)
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    of = {}
    for i in ids:
        if sets[i]:
            of.setdefault(sets[i], []).append(i)
    groups = sorted(of.items(), key=lambda x: len(x[0]))
    for g, members in groups:
        for m in members:
            a, b = sorted((root(members[0]), root(m)))
            up[b] = a
    for x in range(len(groups)):
        for y in range(x + 1, len(groups)):
            if 100 * len(groups[x][0]) < 75 * len(groups[y][0]):
                break
            common = len(groups[x][0] & groups[y][0])
            if 100 * common >= 75 * (len(groups[x][0]) + len(groups[y][0]) - common):
                a, b = sorted((root(groups[x][1][0]), root(groups[y][1][0])))
                up[b] = a
    return Counter((i, len(sets[i]), root(i) if i is not None else None) for i, _ in docs)


def check(df, **kw):
    docs = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    got = Counter(tuple(r) for r in jj.jaccard_components(df, **{"cells": 1 << 14, **kw}).collect())
    assert got == brute(docs)


def test_small(small):
    check(small)


def test_nasty_and_empty(nasty, empty):
    check(nasty)
    assert jj.jaccard_components(empty).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_near_copies(spark, seed, monkeypatch):
    """Chains of edits, a common passage, a crowd of near copies, tiny salted tiles."""
    monkeypatch.setattr(jj, "TILE", 0)
    r = random.Random(seed)
    word = lambda: f"v{r.randint(0, 3000)}"
    passage = [word() for _ in range(60)]
    base = [word() for _ in range(120)]
    docs = []
    for i in range(400):
        kind = i % 4
        if kind == 0:
            w = base[:]
            for _ in range(r.randint(0, 5)):
                w[r.randrange(len(w))] = word()
        elif kind == 1:
            w = [word() for _ in range(r.randint(20, 90))] + passage
        elif kind == 2 and docs:
            w = docs[r.randrange(len(docs))][1].split()
            for _ in range(r.randint(0, max(1, len(w) // 25))):
                w[r.randrange(len(w))] = word()
        else:
            w = [word() for _ in range(r.randint(1, 200))]
        docs.append((i * 7 % 401, " ".join(w)))
    check(spark.createDataFrame(docs, "doc_id long, text string"), cells=64 if seed == 1 else 1 << 16)


def test_keep_one(spark, nasty):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "A b c d e f"), (3, None), (4, ""), (5, "x y z"), (5, "x y z")],
                                 "doc_id long, text string").withColumn("twice_id", jj.F.lit(1))
    assert sorted(r.doc_id for r in jj.keep_one(docs).collect()) == [1, 3, 4, 5]
    kept = jj.keep_one(nasty)
    assert kept.columns == nasty.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[5] == 1 and ids[6] == 0 and len(NASTY) - sum(ids.values()) == 2


def test_keep_one_joins_marked_rows_only(spark):
    ids = np.arange(30000)
    cells = jj._cell(ids)
    order = np.argsort(cells, kind="stable")
    at = np.flatnonzero(np.diff(cells[order]) == 0)[0]
    y, x = sorted(map(int, ids[order][at:at + 2]))  # two ids with one mark: x is lost, y is not
    docs = spark.createDataFrame([(x, "a b c d e f"), (-1, "a b c d e f"), (y, "u v w x y z"), (7, "x y z"), (7, "x y z"),
                                  (40000, "other words than these"), (None, "a b c d e f")], "doc_id long, text string")
    kept = jj.keep_one(docs)
    assert sorted((r.doc_id if r.doc_id is not None else -9) for r in kept.collect()) == sorted([-9, -1, y, 7, 40000])
    # most texts leave by a branch that joins nothing, so they are not shuffled
    assert "Join" not in kept._jdf.queryExecution().optimizedPlan().children().head().toString()


def test_prefix_law():
    for n in range(1, 400):
        take = jj.prefix_length(n, 75)
        assert n - take + 1 == -(-75 * n // 100)  # the rest alone is too small for a link


def test_sets_match_words():
    texts = [b"A b\tc d e f", b"", None, b"one two", b"x " * 50, b"a b c d e"]
    got = [len(s) for s in jj.shingle_sets(texts)]
    assert got == [2, 0, 0, 1, 1, 1]
    assert next(jj.shingle_sets([b"a B c d e"]))[0] == next(jj.shingle_sets([b" A b c D e\n"]))[0]
    assert np.all(np.diff(next(jj.shingle_sets([b" ".join(b"%d" % i for i in range(99))])).astype(object)) > 0)


def test_components_of_a_path(spark):
    n = 300
    edges = spark.range(n - 1).selectExpr("id + 1 AS u", "id AS v")
    assert {tuple(r) for r in components(edges).collect()} == {(i, 0) for i in range(n)}
    assert components(edges.where("false")).collect() == []


def test_pairs_meet_once(spark):
    """A pair in many tiles is looked at in the largest of them, whatever the size bands."""
    tiles = [(k, 0, i, 100, i) for k in range(20) for i in range(6) if k < 10 or i < 4]
    rows = spark.createDataFrame(tiles, "key long, salt int, node long, n long, component long")
    sizes = spark.createDataFrame([(i, 100, [0] * jj.WORDS) for i in range(6)], "node long, n long, bits array<long>")
    plan = jj._cross_pairs(rows, sizes, jj._largest(rows), 75)
    assert sorted(map(tuple, plan.collect())) == [(a, b) for a in range(6) for b in range(a + 1, 6)]
    met = jj._cross_pairs(rows, sizes, jj._largest(rows), 75, distinct=False)
    assert met.count() == 15  # 15 pairs, in 260 places


@pytest.mark.parametrize("seed", [3, 4])
def test_pairs_of_overlapping_tiles(spark, seed, monkeypatch):
    """Every pair of a tile is met, with few named tiles and with bands in all of them."""
    monkeypatch.setattr(jj, "BANDED", 4 * (seed - 3))
    r = random.Random(seed)
    tiles = {(k, i) for k in range(30) for i in range(40) if r.random() < 0.3}
    size = {i: r.randint(50, 120) for i in range(40)}
    rows = spark.createDataFrame([(k, 0, i, size[i], i // 2) for k, i in tiles],
                                 "key long, salt int, node long, n long, component long")
    sizes = spark.createDataFrame([(i, n, [0] * jj.WORDS) for i, n in size.items()], "node long, n long, bits array<long>")
    want = {(a, b) for k, a in tiles for l, b in tiles if k == l and a < b and a // 2 != b // 2
            and 100 * min(size[a], size[b]) >= 75 * max(size[a], size[b])}
    got = jj._cross_pairs(rows, sizes, jj._largest(rows, seed - 2), 75).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def clique(spark, m, words=200):
    """(texts, sizes, sets, all pairs) of m texts that differ in their last word."""
    body = " ".join(f"w{i}" for i in range(words))
    texts = [(10 + i, f"{body} end{i}".encode()) for i in range(m)]
    sets = [(i, [int(x) for x in s.view(np.int64)]) for (i, _), s in zip(texts, jj.shingle_sets([t for _, t in texts]))]
    sizes = spark.createDataFrame([(i, len(s)) for i, s in sets], "node long, n long")
    pairs = [(a, b) for a, _ in texts for b, _ in texts if a < b]
    return sizes, spark.createDataFrame(sets, "node long, items array<long>"), spark.createDataFrame(pairs, "a long, b long")


@pytest.mark.parametrize("small", [0, 1000])
def test_a_set_is_sent_once_for_all_its_pairs(spark, small):
    sizes, sets, pairs = clique(spark, 12)
    dealt = jj._dealt(pairs, sizes, small > 0, jj.GROUP).collect()
    assert len(dealt) == 66 and len({r.cell for r in dealt}) == 1  # 12 sets, not 66 + 11
    # a component over the bound is cut into blocks, and no pair is lost
    cut = jj._dealt(pairs, sizes, small > 0, 600).collect()
    assert {(r.a, r.b) for r in cut} == {(r.a, r.b) for r in dealt} and 1 < len({r.cell for r in cut}) <= 10
    for group in (jj.GROUP, 600, 1):
        got = jj.exact_links(pairs, sizes, sets.unionByName(sets), 75, small, group).collect()
        assert sorted(map(tuple, got)) == sorted((r.a, r.b) for r in dealt)
    assert jj.exact_links(pairs, sizes, sets, 100, small).collect() == []


@pytest.mark.parametrize("small", [0, 1000])
def test_links_of_texts_are_those_of_their_arrays(spark, small):
    sizes, sets, pairs = clique(spark, 6)
    body = " ".join(f"w{i}" for i in range(200))
    texts = spark.createDataFrame([(10 + i, f"{body} end{i}".encode()) for i in range(6)] + [(10, b"")],
                                  "node long, items binary")
    want = sorted(map(tuple, jj.exact_links(pairs, sizes, sets, 75, small).collect()))
    assert sorted(map(tuple, jj.exact_links(pairs, sizes, texts, 75, small).collect())) == want and len(want) == 15
    assert jj.exact_links(pairs, sizes, texts, 100, small).collect() == []


def test_asked_texts_and_released_scratch(spark):
    docs = spark.createDataFrame([(1, b"A b"), (2, b"c"), (1, None), (None, b"d")], "doc_id long, text binary")
    got = jj.asked_texts(docs, spark.createDataFrame([(1,)], "node long")).collect()
    assert sorted((r.node, bytes(r["items"])) for r in got) == [(1, b""), (1, b"A b")]
    base = jj.scratch_path(spark, "x").rsplit("/", 1)[0].removeprefix("file:")
    before = set(os.listdir(base))
    kept = jj.keep_one(spark.createDataFrame([(1, "a b c d e f"), (2, "A b c d e f"), (3, "x")], "doc_id long, text string"))
    left = {x.rsplit("-", 1)[0] for x in set(os.listdir(base)) - before}
    assert left == {"jaccard-result", "jaccard-fates"}  # what the join itself staged is gone
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_tiles_of_repeated_ids(spark):
    """Each class has its tiles once, also where its doc_id has repeated rows, other texts, or other classes' texts."""
    body = " ".join(f"v{i}" for i in range(60))
    docs = [(1, body), (1, body), (2, body), (1, body + " x"), (3, body + " y"), (3, body + " y"), (2, "q r s t u v"),
            (None, body), (4, None), (5, "  "), (6, body.upper()), (6, body + " z")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.n_shingles): r.component_id for r in jj.jaccard_components(df, cells=1 << 14).collect()}
    assert got == {(1, 56): 1, (2, 56): 1, (1, 57): 1, (3, 57): 1, (2, 2): 2, (None, 56): None, (4, 0): 4, (5, 0): 5,
                   (6, 56): 1, (6, 57): 1}
    texts = df.select("doc_id", df["text"].cast("binary").alias("text"))
    classes = spark.createDataFrame(
        [(r.doc_id, r.s1, r.s2, r.n_shingles) for r in jj.signatures(texts, 5).where("doc_id IN (1, 2, 3)").collect()],
        "node long, s1 long, s2 long, n_shingles long").groupBy("s1", "s2", "n_shingles").agg({"node": "min"}).withColumnRenamed("min(node)", "node")
    repeats = spark.createDataFrame([(1,), (2,), (3,), (6,)], "doc_id long")
    sketch, crowds = jj.count_sketches(texts, 5, [(1 << 10, "u1"), (1 << 8, "u4")])
    tiles = jj._class_tiles(texts.where("doc_id < 4"), classes, repeats, sketch, crowds, 5, 75).collect()
    assert sorted((r.node, r.n) for r in tiles) == [(1, 56), (1, 57), (2, 2), (3, 57)]
    assert all(len(r["keys"]) == len(r.salts) == jj.prefix_length(r.n, 75) for r in tiles)
