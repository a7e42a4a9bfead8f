"""Quality ledger and fingerprints against plain Python."""

import hashlib
import random
import re
from collections import Counter

import xxhash

from llm_cases import NASTY, key, nasty, empty, small  # noqa: F401
from pyspark.sql import functions as F

from tabforge.llm import fingerprints as fp
from tabforge.llm import quality_rules as q


def measured(text):
    text = text or ""
    words = [w.decode() for w in text.encode().split()]
    n = len(words)
    grams = Counter(tuple(words[i:i + 8]) for i in range(n - 7))
    inside = set()
    for i in range(n - 7):
        if grams[tuple(words[i:i + 8])] > 1:
            inside.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if x.encode().strip()]
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))


def check_quality(rows, docs):
    want = Counter()
    for doc_id, text in docs:
        m = measured(text)
        want[(doc_id, *m, m[0] < 20 or 100 * m[4] > 30 * m[0])] += 1
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                  for r in rows)
    assert got == want
    assert all(not r.kept for r in rows if r.base_failed)
    assert all(r.kept == (r.fail_bits == 0) for r in rows)


def test_quality_small(small):
    check_quality(q.quality(small).collect(), [(r.doc_id, r.text) for r in small.collect()])


def test_quality_nasty_and_empty(nasty, empty):
    check_quality(q.quality(nasty).collect(), [(d[0], d[1]) for d in NASTY])
    assert q.quality(empty).collect() == []
    kept = q.keep_good(nasty)
    assert kept.columns == nasty.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in q.quality(nasty).where("kept").collect()}


def test_policies_and_ablation(small):
    rows = q.ledger(small)
    bits = [r.fail_bits for r in rows.collect()]
    lenient = q.Policy(2, ("few_words", "symbols"))
    kept = q.apply_policy(rows, lenient).where("kept").count()
    assert kept == sum(1 for b in bits if not b & lenient.mask)
    for r in q.ablation(rows).collect():
        bit = 1 << list(q.RULES).index(r.rule)
        assert r.rejected == sum(1 for b in bits if b & bit)
        assert r.only == sum(1 for b in bits if b == bit)
        assert r.kept_without == sum(1 for b in bits if not b & ~bit)


def check_edits(rows, docs):
    docs = sorted(((i, t or "") for i, t in docs), key=lambda d: (d[0] is None, d[0] or 0, d[1].encode()))
    want = Counter()
    for k, (i, t) in enumerate(docs):
        nxt = docs[(k + 1) % len(docs)][1]
        cut = len(t) // 4
        want[(i, len(t), hashlib.sha256((t[:len(t) - cut] + nxt[:cut]).encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == want
    prints = {}
    for r in rows:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        prints.setdefault(r.doc_id, set()).add(r.fingerprint)
    return prints


def test_edits_small(small):
    docs = [(r.doc_id, r.text) for r in small.collect()]
    rows = fp.edited_fingerprints(small).collect()
    prints = check_edits(rows, docs)
    text = dict(docs)
    same = {}
    for i, p in prints.items():
        same.setdefault(text[i], set()).update(p)
    assert all(len(p) == 1 for p in same.values())
    better = sum(r.near_edited > r.near_next for r in rows)
    assert better >= 0.95 * len(rows)


def test_edits_nasty_and_empty(nasty, empty):
    rows = fp.edited_fingerprints(nasty).collect()
    check_edits(rows, [(d[0], d[1]) for d in NASTY])
    assert fp.edited_fingerprints(empty).collect() == []
    one = nasty.where("doc_id = 8")
    assert fp.edited_fingerprints(one).first().near_next == 1.0


def test_any_cut_gives_the_same(small):
    a = fp.with_next(small, groups=3).collect()
    b = fp.with_next(small, groups=50).collect()
    assert sorted(map(key, a)) == sorted(map(key, b))


def test_order_matters(spark):
    words = [f"w{i}" for i in range(400)]
    moved = words[200:] + words[:200]
    rows = spark.createDataFrame([(" ".join(words), " ".join(moved))], "a string, b string").select(
        fp.tuples(F.col("a")).alias("a"), fp.tuples(F.col("b")).alias("b")).select(
        F.size("a").alias("n"), fp.likeness(F.col("a"), F.col("b")).alias("x")).first()
    # the same k-mers, half of the pairs in another order
    assert rows.n == 64 and rows.x < 0.9


def xx(*values):
    """Spark's xxhash64 of strings, longs and (as bytes) ints."""
    seed = 42
    for v in values:
        v = v.encode() if isinstance(v, str) else v.to_bytes(8, "little", signed=True) if isinstance(v, int) else v
        seed = xxhash.xxh64_intdigest(v, seed)
    return seed - (1 << 64) if seed >> 63 else seed


def plain_hashes(text, k=3):
    words = [w.decode() for w in (text or "").encode().split()]
    if 0 < len(words) < k:
        return [xx(k.to_bytes(4, "little"), " ".join(words))]
    seen, out = Counter(), []
    for i in range(len(words) - k + 1):
        h = xx(*words[i:i + k])
        out.append(xx(h, seen[h].to_bytes(4, "little")) if seen[h] else h)
        seen[h] += 1
    return out


def plain_tuples(text, order=lambda t, h: (h - (t << 58) + (1 << 63)) % (1 << 64)):
    hashes, out = plain_hashes(text), []
    for t in range(64 if hashes else 0):
        two = sorted(range(len(hashes)), key=lambda i: order(t, hashes[i]))[:2]
        out.append(f"{t:02X}{xx(*[hashes[i] for i in sorted(two)]) & 0xFFFFFFFF:08X}")
    return out


def test_tuples_equal_plain_minima(spark, small):
    texts = [r.text for r in small.limit(40).collect()] + [d[1] for d in NASTY if d[0] != 4]
    texts += ["a b c " * 9, "a b", "a b c", "a b c d", "x " * 30]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", fp.tuples(F.col("t")).alias("x"))
    assert all(r.x == plain_tuples(r.t) for r in rows.collect())


def test_short_moved_passages_as_with_independent_hashes(spark):
    """Likeness of reversed eighths agrees on average with one independent hash a tuple."""
    rng = random.Random(5)
    pairs = []
    for n in (40, 80, 160):
        for _ in range(30):
            words = [f"w{rng.randrange(10 ** 9)}" for _ in range(n)]
            parts = [words[i:i + n // 8] for i in range(0, n, n // 8)]
            pairs.append((n, " ".join(words), " ".join(w for p in reversed(parts) for w in p)))
    rows = spark.createDataFrame(pairs, "n int, a string, b string").select(
        "n", (F.size(F.array_intersect(fp.tuples(F.col("a")), fp.tuples(F.col("b")))) / 64).alias("x")).collect()
    for n in (40, 80, 160):
        own = [r.x for r in rows if r.n == n]
        want = []
        for m, a, b in pairs:
            if m == n:
                x, y = (plain_tuples(t, lambda t, h: xx(h, t)) for t in (a, b))
                want.append(len(set(x) & set(y)) / 64)
        assert abs(sum(own) - sum(want)) / 30 < 0.04


def test_hot_ids_are_cut(spark):
    """Many rows without a doc_id, of one doc_id and equal in both keep the same next texts."""
    docs = spark.range(16_000).selectExpr(
        "CASE WHEN id < 6000 THEN NULL WHEN id < 12000 THEN 7 ELSE id END AS doc_id",
        "CASE WHEN id % 2 = 0 THEN 'same' ELSE concat('t', id) END AS text").repartition(12)
    whole = fp.with_next(docs, groups=1)
    cut = fp.with_next(docs, groups=64)
    pairs = lambda df: Counter((r.doc_id, r.text, r.next_text) for r in df.collect())
    assert pairs(cut) == pairs(whole)
    assert sum(pairs(cut).values()) == 16_000
    sizes = [r["count"] for r in fp.ranges(docs, 64).groupBy("grp").count().collect()]
    assert max(sizes) <= 1000


def test_occurrence_numbers(spark):
    text = "a b c " * 3
    a, b = spark.createDataFrame([(text,), ("a b c a b",)], "t string").select(fp.tuples(F.col("t")).alias("x")).collect()
    assert set(a.x) != set(b.x)
