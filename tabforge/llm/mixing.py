"""Mixing sources to target weights by pivotal dependent rounding.

A source's documents share its number of copies r = target / size. Every
document is taken floor(r) times; the fractions left over are rounded by
pairs: words move at random between two documents' copy probabilities until
one is 0 or 1, so each keeps its expectation and the pair keeps its sum. The
rounding runs in buckets, whose single left-over documents meet in the next
level of a reduction tree, down to one per source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.llm.common import WORD, prepare
from tabforge.session import cut_lineage

BUCKET = 512  # documents folded together; bounds every collected array
CAP = 3
WEIGHTS = (1, 2, 3)
EPS = 1e-12


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Targets of sources given (source, source_size, n).

    Weights repeat over the sources in code point order, NULL last. A source
    gets min(cap * size, level * weight), where the common level makes the
    targets sum to all sizes: what resharing the excess until no source is
    above its cap comes to. One row per source goes through the windows.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.get(F.array(*map(F.lit, weights)), F.pmod(F.col("source_no") - 1, F.lit(len(weights))))
    ranked = sizes.withColumn("source_no", F.row_number().over(order)).withColumn("weight", pick)
    limit = F.col("source_size") * cap
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), "source_no")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_limit.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    # the level if all sources before this one are at their caps
    level = ((F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(before), F.lit(0)))
             / F.sum("weight").over(onward))
    levels = ranked.withColumn("limit", limit).withColumn("level", level)
    free = F.col("limit") >= F.col("level") * F.col("weight")
    return (levels.withColumn("common", F.min(F.when(free, F.struct(F.col("limit") / F.col("weight"),
                                                                    F.col("level")))).over(every)["level"])
            .select("source", "source_no", "source_size", "n",
                    F.least(F.col("limit").cast("double"), F.col("common") * F.col("weight")).alias("target")))


def _unit(*cols: Column) -> Column:
    """A repeatable number in [0, 1) from the columns."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") / float(1 << 53)


def _step(seed: int):
    """Fold one document into (pending document, decided documents)."""
    none = "CAST(NULL AS STRUCT<h: BIGINT, doc_id: BIGINT, size: BIGINT, source_no: INT, base: BIGINT, row_no: BIGINT, p: DOUBLE>)"
    doc = "named_struct('h', {0}.h, 'doc_id', {0}.doc_id, 'size', {0}.size, 'source_no', {0}.source_no, 'base', {0}.base, 'row_no', {0}.row_no, 'p', {1})"
    # words that a can gain from x, or lose to x
    gain = "least((1 - s.a.p) * s.a.size, x.p * x.size)"
    loss = "least(s.a.p * s.a.size, (1 - x.p) * x.size)"
    coin = f"CAST(shiftrightunsigned(xxhash64({seed}, s.a.h, x.h), 11) AS DOUBLE) / 9007199254740992D"
    moved = f"""transform(array(named_struct('g', {gain}, 'l', {loss})), t ->
        CASE WHEN t.g + t.l <= 0 THEN 0D WHEN {coin} * (t.g + t.l) < t.l THEN t.g ELSE -t.l END)[0]"""
    after = f"""transform(array({moved}), m -> named_struct(
        'pa', s.a.p + m / s.a.size, 'px', x.p - m / x.size))[0]"""
    # the one nearer to a whole number is decided, the other waits
    pair = f"""transform(array({after}), t -> CASE
        WHEN least(t.pa, 1 - t.pa) <= least(t.px, 1 - t.px)
        THEN named_struct('a', {doc.format('x', 't.px')}, 'done', array({doc.format('s.a', 'round(t.pa)')}))
        ELSE named_struct('a', {doc.format('s.a', 't.pa')}, 'done', array({doc.format('x', 'round(t.px)')})) END)[0]"""
    return f"""aggregate(items, named_struct('a', {none}, 'done', slice(items, 1, 0)), (s, x) ->
        CASE WHEN s.a IS NULL THEN named_struct('a', x, 'done', s.done)
        ELSE transform(array({pair}), q -> named_struct('a', q.a, 'done', concat(s.done, q.done)))[0] END)"""


def round_fractions(rows: DataFrame, n_most: int, seed: int) -> list[DataFrame]:
    """Decide every fractional document; the parts together hold each once.

    ``rows``: h, doc_id, size > 0, source_no, base, p in (0, 1), n (rows of
    the source). ``n_most``: the largest n. Each level is one aggregation by
    (source, bucket) with at most about ``BUCKET`` rows a bucket.
    """
    parts, level, n = [], 0, n_most
    while True:
        buckets = F.ceil(F.col("n") / float(BUCKET))
        items = F.array_sort(F.collect_list(F.struct("h", "doc_id", "size", "source_no", "base", "row_no", "p")))
        grouped = (rows.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed + level), "h"), buckets))
                   .groupBy("source_no", "bucket").agg(items.alias("items"), F.first("n").alias("n")))
        folded = cut_lineage(grouped.select("n", F.expr(_step(seed + level)).alias("f")), f"mix-level{level}")
        parts.append(folded.select(F.explode("f.done").alias("d")).select("d.*"))
        left = folded.select("f.a.*", buckets.cast("long").alias("n"))
        n = math.ceil(n / BUCKET)
        if n <= 1:
            coin = _unit(F.lit(seed + 97), F.col("h")) < F.col("p")
            parts.append(left.drop("n").withColumn("p", coin.cast("double")))
            return parts
        rows, level = left, level + 1


def _mixed(docs: DataFrame, weights: tuple[int, ...], cap: int, seed: int, row_no: Column | None = None) -> DataFrame:
    """Rows of ``mix`` with a row number: ``row_no``, or else one given here."""
    spark = docs.sparkSession
    prepare(spark)
    row_no = F.monotonically_increasing_id() if row_no is None else row_no
    base = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), docs["source"].cast("string").alias("source"),
        F.coalesce(F.regexp_count(docs["text"], F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        row_no.alias("row_no"))
    base = cut_lineage(base, "mix-sizes")
    sizes = base.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    targets = cut_lineage(source_targets(sizes, weights, cap), "mix-targets")
    n_most = targets.agg(F.max("n")).first()[0] or 0
    # doc_ids that hold more rows than a bucket may: their rows are told apart by row number
    many = base.groupBy("doc_id").agg(F.count(F.lit(1)).alias("times")).where(f"times > {BUCKET // 8}")
    many = cut_lineage(many.select("doc_id", F.lit(True).alias("often")), "mix-often")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(ratio + EPS)
    rows = (base.join(targets, base["source"].eqNullSafe(targets["source"])).drop(targets["source"])
            .join(many, base["doc_id"].eqNullSafe(many["doc_id"]), "left").drop(many["doc_id"])
            .withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "size",
                                        F.when(F.col("often"), F.col("row_no"))))
            .withColumn("base", F.when(F.col("size") > 0, whole).otherwise(F.lit(0)).cast("long"))
            .withColumn("p", F.when(F.col("size") > 0, ratio - whole).otherwise(F.lit(0.0))))
    rows = rows.select("h", "doc_id", "size", "source_no", "base", "row_no", "p", "n")
    open_ = F.col("p") > EPS
    decided = rows.where(~open_).drop("n").withColumn("p", F.lit(0.0))
    for part in round_fractions(rows.where(open_), n_most, seed):
        decided = decided.unionByName(part)
    copies = F.col("base") + F.col("p").cast("long")
    return (decided.join(targets, "source_no")
            .select("doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"),
                    copies.alias("copies"), "source", "row_no"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: int = 17) -> DataFrame:
    """How often each document is taken so that sources meet their targets.

    Size: words of the text (NULL: 0). Result: doc_id, size, source_size,
    target (words), copies, taken = copies * size, source; one row per input
    row. Documents without words are taken 0 times. NULL sources are one
    source, the last; repeated rows are rounded one by one; an empty table
    gives an empty result; further columns are ignored. Equal inputs with
    equal rows give equal results: the randomness is a hash of row and seed.
    Only rows of a doc_id (or NULL) that more than ``BUCKET`` / 8 rows share
    also hash their place in the input, so which of them are taken may change
    with its partitions; how many does not.
    """
    return _mixed(docs, weights, cap, seed).drop("row_no")


def take_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: int = 17) -> DataFrame:
    """The mixed documents: each row of ``docs`` as often as it is taken.

    Rows are numbered once, by being written with their numbers, so that sizes
    and documents agree however ``docs`` is read. Columns are those of ``docs``.
    """
    prepare(docs.sparkSession)
    numbered = cut_lineage(docs.select(F.monotonically_increasing_id().alias("row_no"),
                                       F.struct(*[docs[c] for c in docs.columns]).alias("doc")), "mix-rows")
    mixed = (_mixed(numbered.select("row_no", "doc.doc_id", "doc.source", "doc.text"), weights, cap, seed, F.col("row_no"))
             .where("copies > 0").select("row_no", "copies"))
    return (numbered.join(mixed, "row_no").select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select("doc.*"))
