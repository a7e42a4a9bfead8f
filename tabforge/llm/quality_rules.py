"""Quality rules as a ledger of failure bits and measurements.

Every rule is evaluated once per document. The ledger keeps the measurements
and one bit per failed rule; a policy is a versioned mask over the bits, so
policies and ablations are bitwise operations on the ledger and never read a
text again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import GAP, let, words_of

WINDOW = 8
# name -> condition of failure over the measurements; the place is the bit
RULES: dict[str, str] = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "2 * n_dup_lines > n_lines",
    "short_words": "2 * n_words > word_chars",
    "long_words": "word_chars > 14 * n_words",
}
BASE_RULES = ("few_words", "repeated_windows")


@dataclass(frozen=True)
class Policy:
    """A version and the rules that reject under it."""

    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << list(RULES).index(r) for r in self.rules)


POLICY = Policy(1, tuple(RULES))


def repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows of ``window`` words that occur twice or more.

    The windows' hashes show at once whether any repeats; only then they are
    sorted with their places, and the places of the repeated ones give the
    words that they cover.
    """
    def hashes(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - window),
                           lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(window)]))

    def covered(places: Column) -> Column:
        # sorted places: each adds the words up to the next place, at most a window
        return F.aggregate(
            places, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-window).alias("last")),
            lambda s, p: F.struct((s["n"] + F.least(p - s["last"], F.lit(window))).cast("long").alias("n"),
                                  p.alias("last")), lambda s: s["n"])

    def sort_out(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def twice(s: Column) -> Column:
            same = F.filter(s, lambda x, i: ((i > 0) & (F.get(s, i - 1)["h"] == x["h"]))
                            | (F.get(s, i + 1)["h"] == x["h"]))
            return covered(F.sort_array(F.transform(same, lambda x: x["i"])))

        return let(pairs, twice)

    some = let(hashes(words), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long"))
               .otherwise(sort_out(h)))
    return F.when(F.size(words) <= window, F.lit(0).cast("long")).otherwise(some)


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: F.length(F.regexp_replace(x, GAP, "")) > 0)


def measurements(text: Column) -> Column:
    """Struct of all measurements of a text (NULL: the empty text)."""
    text = F.coalesce(text, F.lit(""))
    lines = let(_lines(text), lambda x: F.struct(
        F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")))
    words = let(words_of(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n"), repeat_words(w).alias("rep")))
    return F.struct(
        words.alias("words"), lines.alias("lines"),
        F.length(F.regexp_replace(text, GAP, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"))


def ledger(docs: DataFrame) -> DataFrame:
    """``docs`` columns under ``doc`` plus measurements and ``fail_bits``."""
    m = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"),
                    measurements(docs["text"].cast("string")).alias("m"))
    flat = m.select("doc", F.col("m.words.n").alias("n_words"), F.col("m.word_chars").alias("word_chars"),
                    F.col("m.n_symbols").alias("n_symbols"), F.col("m.lines.dup").alias("n_dup_lines"),
                    F.col("m.words.rep").alias("n_repeat_words"), F.col("m.lines.n").alias("n_lines"))
    bits = [F.when(F.expr(cond), F.lit(1 << i)).otherwise(F.lit(0)) for i, cond in enumerate(RULES.values())]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return flat.withColumn("fail_bits", total.cast("long"))


def apply_policy(rows: DataFrame, policy: Policy = POLICY) -> DataFrame:
    """Verdicts of a policy: ``kept`` and ``policy_version``."""
    kept = F.col("fail_bits").bitwiseAND(F.lit(policy.mask)) == 0
    return rows.withColumn("kept", kept).withColumn("policy_version", F.lit(policy.version))


def ablation(rows: DataFrame, policy: Policy = POLICY) -> DataFrame:
    """Per rule of the policy: rejected by it, only by it, and kept without it.

    One pass of bitwise sums over the ledger; one row per rule.
    """
    names = list(policy.rules)
    hit = F.col("fail_bits").bitwiseAND(F.lit(policy.mask))
    sums = []
    for r in names:
        bit = 1 << list(RULES).index(r)
        sums.append(F.struct(
            F.lit(r).alias("rule"),
            F.count_if(hit.bitwiseAND(F.lit(bit)) != 0).alias("rejected"),
            F.count_if(hit == bit).alias("only"),
            F.count_if(hit.bitwiseAND(F.lit(policy.mask & ~bit)) == 0).alias("kept_without")))
    return rows.agg(F.array(*sums).alias("a")).select(F.explode("a").alias("r")).select("r.*")


def quality(docs: DataFrame, policy: Policy = POLICY) -> DataFrame:
    """Measurements, failure bits and verdict of every whole document.

    Result: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, fail_bits, policy_version; one row per
    input row, also for repeated rows and NULL doc_ids. A NULL or empty text
    has no words and fails; an empty table gives an empty result; further
    columns are ignored. One pass, no shuffle; built-in functions only.
    """
    base = sum(1 << list(RULES).index(r) for r in BASE_RULES)
    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    failed = F.col("fail_bits").bitwiseAND(F.lit(base)) != 0
    return (apply_policy(ledger(narrow), policy).withColumn("base_failed", failed)
            .select("doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", (F.col("kept") & ~F.col("base_failed")).alias("kept"),
                    "fail_bits", "policy_version"))


def keep_good(docs: DataFrame, policy: Policy = POLICY) -> DataFrame:
    """The documents that the policy keeps, with their own columns."""
    return apply_policy(ledger(docs), policy).where("kept").select("doc.*")
