"""Sharding and mixing against plain Python."""

import zlib
from collections import Counter, defaultdict

from llm_cases import NASTY, key, nasty, empty, small  # noqa: F401
import pytest

from tabforge.llm import mixing, shards


def check_shards(rows, docs):
    assert Counter(r.doc_id for r in rows) == Counter(d[0] for d in docs)
    want = Counter((d[0], len((d[1] or "").encode()) + 1, zlib.crc32((d[1] or "").encode())) for d in docs)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    assert {r.law for r in rows} <= {"bytes"} and all(r.grown_shard is None for r in rows)


def test_shards_small(small):
    docs = [(r.doc_id, r.text) for r in small.collect()]
    rows = shards.shard_documents(small).collect()
    check_shards(rows, docs)
    load, grown, homes = Counter(), Counter(), {}
    for r in rows:
        load[r.shard] += r["size"]
    assert shards.near_equal([load[s] for s in range(8)], 0.03)
    # the edited map: nine near equal shards, few records moved, whole virtual slots at a time
    for r in rows:
        grown[r.next_shard] += r["size"]
        homes.setdefault(r.virtual_slot, set()).add((r.shard, r.next_shard))
    assert shards.near_equal([grown[s] for s in range(9)], 0.03) and len(grown) == 9
    assert all(len(h) == 1 for h in homes.values())
    assert sum(r["size"] for r in rows if r.next_shard != r.shard) <= 0.15 * sum(load.values())
    again = shards.shard_documents(small.repartition(3)).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in rows} == {(r.doc_id, r.shard, r.slot) for r in again}


def test_shards_nasty_and_empty(nasty, empty):
    check_shards(shards.shard_documents(nasty).collect(), NASTY)
    assert shards.shard_documents(empty).collect() == []


def test_hot_key_is_spread(spark):
    docs = spark.range(30_000).selectExpr("CASE WHEN id < 20000 THEN 1 ELSE id END AS doc_id", "'x' AS text")
    rows = shards.shard_documents(docs).collect()
    assert len(rows) == 30_000
    load = Counter(r.shard for r in rows)
    assert max(load.values()) <= 1.05 * 30_000 / 8


def test_heavy_texts_without_an_id_are_spread(spark):
    """Few rows of many bytes in one slot go to further slots too."""
    docs = spark.range(2000).selectExpr("CASE WHEN id < 400 THEN NULL ELSE id END AS doc_id",
                                        "repeat('x', CASE WHEN id < 400 THEN 20000 ELSE 10 END) AS text")
    rows = shards.shard_documents(docs).collect()
    check_shards(rows, [(r.doc_id, r.text) for r in docs.collect()])
    load = Counter()
    for r in rows:
        load[r.shard] += r["size"]
    assert shards.near_equal([load[s] for s in range(8)], 0.05)


def test_map_versions_are_kept(spark):
    sizes = [(i, 50 + i % 5, 1 + i % 3) for i in range(64)]
    stored = shards.write_map(spark, shards.map_rows(shards.assign(sizes, 4), sizes, 1))
    grown = shards.edit_map(stored, 5)
    assert shards.read_map(grown, 1) == shards.read_map(stored, 1)
    mapping, same = shards.read_map(grown, 2)
    assert same == sizes and mapping == shards.rebalance(shards.assign(sizes, 4), sizes, 5)
    recs = spark.range(64).selectExpr("id AS doc_id", "id AS size", "id AS text_crc32",
                                      "CAST(id AS INT) AS virtual_slot", "id AS row_no")
    for version in (1, 2):
        placed = shards.place(recs, grown, version).collect()
        assert {r.virtual_slot: r.shard for r in placed} == shards.read_map(grown, version)[0]


def test_rebalance_moves_little():
    sizes = [(i, 100 + i % 7, 1) for i in range(512)]
    first = shards.assign(sizes, 8)
    grown = shards.rebalance(first, sizes, 9)
    moved = [s for s in grown if grown[s] != first[s]]
    assert {grown[s] for s in moved} == {8}
    load = Counter()
    for s, b, _ in sizes:
        load[grown[s]] += b
    assert shards.near_equal([load[k] for k in range(9)], 0.03)
    assert shards.rebalance(grown, sizes, 9) == grown
    fewer = shards.rebalance(first, sizes, 7)
    assert set(fewer.values()) == set(range(7))


def targets(docs):
    size = Counter()
    for _, text, source in docs:
        size[source] += len((text or "").encode().split())
    names = sorted((s for s in size if s is not None), key=lambda s: [ord(c) for c in s])
    names += [None] if None in size else []
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(size.values()), set()
    while True:  # reshare the excess until no source is above its cap
        free = [s for s in names if s not in capped]
        left = total - sum(3 * size[s] for s in capped)
        t = {s: 3 * size[s] if s in capped else left * weight[s] / sum(weight[x] for x in free) for s in names}
        over = {s for s in free if t[s] > 3 * size[s]}
        if not over:
            return size, t
        capped |= over


def check_mix(rows, docs, slack):
    size, want = targets(docs)
    assert Counter((r.doc_id, r["size"]) for r in rows) == Counter(
        (d[0], len((d[1] or "").encode().split())) for d in docs)
    taken = Counter()
    for r in rows:
        assert r.source_size == size[r.source]
        assert r.target == pytest.approx(want[r.source], rel=1e-9)
        assert r.taken % max(1, r["size"]) == 0 and 0 <= r.taken <= 3 * r["size"]
        share = want[r.source] / size[r.source] if size[r.source] else 0
        if r["size"]:
            assert int(share + 1e-9) <= r.copies <= int(share + 1e-9) + 1
        taken[r.source] += r.taken
    for s in size:
        assert abs(taken[s] - want[s]) <= slack(s)


def test_mix_small(small):
    docs = [(r.doc_id, r.text, r.source) for r in small.collect()]
    rows = mixing.mix(small).collect()
    most = defaultdict(int)
    for _, t, s in docs:
        most[s] = max(most[s], len(t.split()))
    check_mix(rows, docs, lambda s: most[s])  # one document is rounded by chance, all others by pairs
    again = mixing.mix(small.repartition(5)).collect()
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_mix_levels(spark, monkeypatch):
    """Several reduction levels keep the sum and every row."""
    monkeypatch.setattr(mixing, "BUCKET", 8)
    docs = spark.range(3000).selectExpr("id AS doc_id", "repeat('w ', CAST(1 + id % 17 AS INT)) AS text",
                                        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('s', id % 5) END AS source")
    check_mix(mixing.mix(docs).collect(), [(r.doc_id, r.text, r.source) for r in docs.collect()], lambda s: 17)


def test_mix_nasty_and_empty(nasty, empty):
    check_mix(mixing.mix(nasty).collect(), [(d[0], d[1], d[3]) for d in NASTY], lambda s: 30_000)
    assert mixing.mix(empty).collect() == []


def test_mix_repeated_rows(spark):
    docs = spark.range(4000).selectExpr("1 AS doc_id", "'a b c' AS text", "concat('s', id % 2) AS source")
    check_mix(mixing.mix(docs).collect(), [(r.doc_id, r.text, r.source) for r in docs.collect()], lambda s: 3)


def test_mix_rows_without_ids_stay_in_bounded_groups(spark, monkeypatch):
    """Equal rows without a doc_id, or of one, do not meet in one group."""
    seen = []
    real = mixing.cut_lineage
    def watched(df, name):
        out = real(df, name)
        if name.startswith("mix-level"):
            seen.append(out.selectExpr("max(size(f.done))").first()[0])
        return out
    monkeypatch.setattr(mixing, "cut_lineage", watched)
    docs = spark.range(24_000).selectExpr("CASE WHEN id < 16000 THEN NULL WHEN id < 20000 THEN 5 ELSE id END AS doc_id",
                                          "'a b c' AS text", "concat('s', id % 2) AS source")
    check_mix(mixing.mix(docs).collect(), [(r.doc_id, r.text, r.source) for r in docs.collect()], lambda s: 3)
    assert max(seen) <= 640
