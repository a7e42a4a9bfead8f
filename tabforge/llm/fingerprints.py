"""Document fingerprints by Order MinHash over word k-mers.

A text's k-mers are numbered by occurrence and hashed once. Tuple t takes the
k-mers with the smallest hashes under its own hash function, the common hash
less t times a fixed step modulo 2^64 (circulant minima), puts them back into
text order and hashes them. Each tuple so is an Order MinHash of the whole
text, however short it is. Texts share a tuple if they share the k-mers in
the same order, so moved passages count, unlike with sets of k-mers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.llm.common import let, prepare, words_of

K = 3          # words a k-mer
BINS = 64      # tuples a fingerprint; a power of two
KEEP = 2       # k-mers a tuple


def _bin(h: Column, bins: int) -> Column:
    """Which step a hash lies behind, 0 to ``bins`` - 1; rises with the signed hash."""
    return (F.shiftright(h, 64 - (bins.bit_length() - 1)) + bins // 2).cast("int")


def _numbered(h: Column) -> Column:
    """Hashes in text order, later occurrences of a k-mer rehashed with their number."""
    # sort_array, as array_sort calls a comparison expression for each step
    pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

    def number(s: Column) -> Column:
        starts = F.filter(F.transform(s, lambda x, i: F.when(
            (i == 0) | (F.get(s, i - 1)["h"] != x["h"]), i)), lambda i: i.isNotNull())

        def with_starts(b: Column) -> Column:
            occurrence = F.flatten(F.transform(b, lambda at, j: F.sequence(
                F.lit(0), F.coalesce(F.get(b, j + 1), F.size(s)) - at - 1)))
            return let(occurrence, lambda o: F.transform(
                F.sort_array(F.transform(s, lambda x, i: F.struct(
                    x["i"].alias("i"),
                    F.when(F.get(o, i) == 0, x["h"]).otherwise(F.xxhash64(x["h"], F.get(o, i))).alias("h")))),
                lambda x: x["h"]))

        return let(starts, with_starts)

    return let(pairs, number)


def tuples(text: Column, k: int = K, bins: int = BINS, keep: int = KEEP) -> Column:
    """Array of "tuple number, tuple hash" strings of a text (NULL: the empty text).

    Tuple t holds the two hashes that follow step t on the circle of hashes,
    which are the two smallest of hash - step modulo 2^64. A text with one
    k-mer has that alone in each tuple; one without words has no tuples.
    """
    if keep != 2:
        raise ValueError("tuples hold two k-mers")
    words = words_of(text)

    def kmers(w: Column) -> Column:
        # fewer words than a k-mer: the whole sequence is the only one
        few = F.array(F.xxhash64(F.lit(k), F.concat_ws(" ", w)))
        many = F.transform(F.sequence(F.lit(0), F.size(w) - k),
                           lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]))
        return F.when(F.size(w) == 0, F.array().cast("array<bigint>")).when(F.size(w) < k, few).otherwise(many)

    def chosen(h: Column) -> Column:
        # the first two hashes between two steps: no tuple takes another one
        least = let(F.sort_array(h), lambda s: F.filter(s, lambda x, i: F.coalesce(
            _bin(x, bins) != _bin(F.get(s, i - 2), bins), F.lit(True))))
        return let(least, lambda q: let(F.array_intersect(h, q), lambda t: let(
            F.transform(q, lambda x: F.array_position(t, x)), lambda at: picked(q, at))))

    def picked(q: Column, at: Column) -> Column:
        """Tuples from the sorted hashes ``q`` and their places ``at`` in the text's order."""
        own = lambda i: _bin(F.get(q, i), bins)
        # the first hash behind each step; behind the last hash the circle goes on with the first
        first = F.concat(
            F.flatten(F.transform(q, lambda x, i: F.array_repeat(
                i, _bin(x, bins) - F.coalesce(own(i - 1), F.lit(-1))))),
            F.array_repeat(F.lit(0), bins - 1 - own(F.size(q) - 1)))

        def one(i: Column, t: Column) -> Column:
            j = F.when(i + 1 < F.size(q), i + 1).otherwise(F.lit(0))
            a, b = F.get(q, i), F.get(q, j)
            both = F.when(i == j, F.xxhash64(a)).when(F.get(at, i) < F.get(at, j), F.xxhash64(a, b)).otherwise(
                F.xxhash64(b, a))
            return F.concat(F.lpad(F.hex(t), 2, "0"), F.lpad(F.hex(both.bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))

        return F.when(F.size(q) == 0, F.array().cast("array<string>")).otherwise(F.transform(first, one))

    return let(words, lambda w: let(kmers(w), lambda h: let(
        F.when(F.size(F.array_distinct(h)) == F.size(h), h).otherwise(_numbered(h)), chosen)))


def likeness(a: Column, b: Column, keep: int = KEEP) -> Column:
    """Estimated share of common ordered k-mers, 0 to 1.

    Share of equal tuples; as a tuple agrees only if all its k-mers do, the
    ``keep``-th root brings it to the scale of single k-mers. Two texts
    without words are alike (1), one without words is like no other (0).
    """
    either = F.greatest(F.size(a), F.size(b))
    return F.when(either == 0, F.lit(1.0)).otherwise(
        F.pow(F.size(F.array_intersect(a, b)) / either, F.lit(1.0 / keep)))


def ranges(docs: DataFrame, groups: int | None = None) -> DataFrame:
    """doc_id, text, hash, row_no and ``grp``, a struct that rises with doc_id.

    Documents are cut into ranges of doc_id by approximate quantiles. NULL
    doc_ids come last; equal doc_ids follow the order of their texts' hashes.
    A doc_id (or NULL) with far more rows than a range is a range of its own,
    cut further by its texts' hashes, and rows equal in both, whose order
    cannot matter, by their place in the input.
    """
    spark = docs.sparkSession
    base = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    groups = groups or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts, total = base.agg(F.percentile_approx("doc_id", [i / groups for i in range(1, groups)], 10 * groups),
                           F.count(F.lit(1))).first()
    many = 4 * total // groups + 1000
    # at most groups / 4 doc_ids have so many rows
    hot = [r["doc_id"] for r in base.groupBy("doc_id").count().where(F.col("count") > many).collect()]
    cuts = sorted({*(cuts or []), *(x + d for x in hot if x is not None for d in (0, 1) if x + d < 1 << 63)})
    steps = [1 << i for i in reversed(range(len(cuts).bit_length()))]
    # binary search for the number of cuts at or below the doc_id
    cut = F.lit(cuts).cast("array<bigint>")
    above = F.aggregate(F.lit(steps), F.lit(0), lambda n, step: F.when(
        F.get(cut, n + step - 1) <= F.col("doc_id"), n + step).otherwise(n)) if cuts else F.lit(0)
    base = base.withColumn("hash", F.xxhash64("text")).withColumn("row_no", F.monotonically_increasing_id())
    apart, rows_apart = F.lit(False), F.lit(False)
    if hot:
        apart = F.col("doc_id").isin([x for x in hot if x is not None]) if hot != [None] else F.lit(False)
        apart = F.coalesce(apart, F.lit(None in hot))
        twins = [r["hash"] for r in base.where(apart).groupBy("doc_id", "hash").count()
                 .where(F.col("count") > many).collect()]  # again at most groups / 4
        if twins:
            rows_apart = apart & F.col("hash").isin(twins)
    top = max(groups.bit_length(), 1)
    # ranges in order: by doc_id, within a hot one by the hash's leading bits, within equal rows by place
    place = F.struct(
        F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1)).otherwise(above).alias("r"),
        F.when(rows_apart, F.col("hash")).when(apart, F.shiftleft(F.shiftright("hash", 64 - top), 64 - top))
        .otherwise(F.lit(0).cast("long")).alias("h"),
        F.when(rows_apart, F.lit(1)).otherwise(F.lit(0)).alias("t"),
        F.when(rows_apart, F.shiftright("row_no", 33)).otherwise(F.lit(0).cast("long")).alias("p"))
    ranged = base.withColumn("grp", place)
    # hashes above a split-off one in the same leading bits would come before it: they go by its side
    if hot and twins:
        bound = F.lit(sorted(twins)).cast("array<bigint>")
        below = F.aggregate(bound, F.lit(None).cast("long"), lambda s, x: F.when(
            (x < F.col("hash")) & (F.shiftright(x, 64 - top) == F.shiftright("hash", 64 - top)), x).otherwise(s))
        moved = F.struct(F.col("grp.r").alias("r"), F.coalesce(below, F.col("grp.h")).alias("h"),
                         F.when(below.isNull(), F.lit(0)).otherwise(F.lit(2)).alias("t"), F.col("grp.p").alias("p"))
        ranged = ranged.withColumn("grp", F.when(apart & ~rows_apart, moved).otherwise(F.col("grp")))
    return ranged


def with_next(docs: DataFrame, own=lambda text: text, groups: int | None = None) -> DataFrame:
    """doc_id, text, own, next_text, next_own: text and ``own(text)`` of each
    document and of the next in ascending doc_id order.

    The last document is followed by the first. Each of the ``ranges`` is one
    window group, and a copy of each range's first row closes the range before
    it, so any cut gives the same result.
    """
    ranged = ranges(docs, groups)
    # one row per range; which of them follow depends on the ranges that have rows
    heads = ranged.groupBy("grp").agg(F.min_by("text", F.struct(
        F.col("doc_id").isNull(), "doc_id", "hash", "row_no")).alias("text"))
    order = Window.orderBy("grp")
    back = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ghosts = heads.select(
        F.coalesce(F.lag("grp").over(order), F.max("grp").over(back)).alias("grp"),
        F.lit(None).cast("long").alias("doc_id"), "text", F.lit(None).cast("long").alias("hash"),
        F.lit(None).cast("long").alias("row_no"), F.lit(True).alias("ghost"))
    every = ranged.withColumn("ghost", F.lit(False)).unionByName(ghosts).withColumn("own", own(F.col("text")))
    inside = Window.partitionBy("grp").orderBy("ghost", F.col("doc_id").asc_nulls_last(), "hash", "row_no")
    return (every.withColumn("next_text", F.lead("text").over(inside))
            .withColumn("next_own", F.lead("own").over(inside)).where(~F.col("ghost"))
            .select("doc_id", "text", "own", "next_text", "next_own"))


def fingerprints(docs: DataFrame, k: int = K, bins: int = BINS) -> DataFrame:
    """Fingerprint of every document: doc_id, fingerprint (repeated rows repeat)."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"),
                       F.concat_ws("", tuples(docs["text"], k, bins)).alias("fingerprint"))


def edited_fingerprints(docs: DataFrame, k: int = K, bins: int = BINS) -> DataFrame:
    """Fingerprints of every whole text and of its edited text.

    Edited: the last floor(n_chars / 4) code points replaced by the first as
    many (or all) of the next document. Result: doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    NULL texts count as empty; texts without words have the empty
    fingerprint; an empty table gives an empty result; further columns are
    ignored. Texts move once, by range of doc_id.
    """
    prepare(docs.sparkSession)
    rows = with_next(docs, lambda text: tuples(text, k, bins))
    n = F.length("text")
    edited = F.concat(F.substring("text", F.lit(1), n - F.floor(n / 4).cast("int")),
                      F.substring("next_text", F.lit(1), F.floor(n / 4).cast("int")))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "own", "next_own", edited.alias("edited"))
    prints = rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "own", "next_own", tuples(F.col("edited"), k, bins).alias("changed"))
    return prints.select(
        "doc_id", "n_chars", "edited_sha256", F.concat_ws("", "own").alias("fingerprint"),
        F.concat_ws("", "changed").alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"))
