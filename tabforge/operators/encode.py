"""Categorical dictionaries, one-hot encoding and feature assembly.

The relational forms (``fit_dictionary`` and what uses it) hold a dictionary
as rows, so domains of any size can be fitted and applied: all columns' cells
become one long frame of (row, column, value), meet the dictionary in one join
(broadcast where the dictionary is measured small) and are put back together
by row. The ML path (``one_hot_stages``, for fitted models) uses Spark ML
stages, whose labels and vectors are as large as the domain.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.operators.clean import require_columns
from tabforge.operators.lookup import Lookup, feature_lookup
from tabforge.session import cut_lineage

# A dictionary with at most so many entries in all is broadcast (tens of MB).
BROADCAST_ENTRIES = 100_000
# Values with this share of all cells do not gather in one task (see lookup).
HOT_SHARE = 0.01

IDX, OHE = "__idx", "__ohe"


def category_domains(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct non-NULL values per categorical column with their index.

    ``(feature, category, idx)``; ``idx`` = alphabetical position (0-based).
    The distinct of all columns runs as one partially aggregated group-by. No task
    holds a whole domain: the distinct values are range-sorted across
    partitions, numbered by ``monotonically_increasing_id`` (frozen by materialising to the shared
    checkpoint folder), and turned into dense positions with per-partition
    offsets (one row per partition) and per-feature starts (one row per
    feature).
    """
    cols = list(cols)
    require_columns(df, cols)
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [], cols, "feature", "category"
    )
    dom = long.where(F.col("category").isNotNull()).distinct()
    ranked = cut_lineage(
        dom.orderBy("feature", "category").withColumn("_mid", F.monotonically_increasing_id()),
        "domains",
    ).withColumns({
        "_pid": F.shiftright(F.col("_mid"), 33),
        "_local": F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)),
    })
    offsets = ranked.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_off",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)),
    ).select("_pid", "_off")
    pos = ranked.join(F.broadcast(offsets), "_pid").withColumn("_pos", F.col("_off") + F.col("_local"))
    starts = pos.groupBy(F.col("feature").alias("_f")).agg(F.min("_pos").alias("_first"))
    return (
        pos.join(F.broadcast(starts), F.col("feature") == F.col("_f"))
        .select("feature", "category", (F.col("_pos") - F.col("_first")).cast("int").alias("idx"))
    )


def indexer(cols: Sequence[str], handle_invalid: str = "keep") -> StringIndexer:
    """Alphabetical string indexer; with ``keep`` unseen/NULL get index k."""
    return StringIndexer(
        inputCols=list(cols),
        outputCols=[f"{c}{IDX}" for c in cols],
        stringOrderType="alphabetAsc",
        handleInvalid=handle_invalid,
    )


def one_hot_stages(cols: Sequence[str]) -> list:
    """Indexer + one-hot with the extra 'unknown' slot dropped.

    The indexer maps unseen values and NULL to the extra index k, so the
    encoder sees k + 1 categories; dropping the last slot drops exactly that
    unknown bucket. Known categories keep all k columns, unseen/NULL -> zeros.
    """
    return [
        indexer(cols, "keep"),
        OneHotEncoder(
            inputCols=[f"{c}{IDX}" for c in cols],
            outputCols=[f"{c}{OHE}" for c in cols],
            dropLast=True,
            handleInvalid="error",
        ),
    ]


def assembler(cat: Sequence[str], num: Sequence[str], output: str = "features") -> VectorAssembler:
    """One-hot blocks first, then the numeric columns, in order."""
    return VectorAssembler(
        inputCols=[f"{c}{OHE}" for c in cat] + list(num), outputCol=output, handleInvalid="keep"
    )


@dataclass(frozen=True)
class Dictionary:
    """Values of several categoricals as rows, and the number per column."""

    domains: DataFrame  # (feature, category, idx)
    sizes: Mapping[str, int]

    @property
    def entries(self) -> int:
        return sum(self.sizes.values())


def fit_dictionary(df: DataFrame, cols: Sequence[str]) -> Dictionary:
    """Alphabetical dictionary of every column (written once; one size per column reaches the driver)."""
    domains = cut_lineage(category_domains(df, cols), "dictionary")
    sizes = {c: 0 for c in cols}
    for r in domains.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect():
        sizes[r["feature"]] = r["n"]
    return Dictionary(domains, sizes)


def _cell(feature: Column | str, value: Column) -> Column:
    """One join key of a column's cell (NULL for a missing value)."""
    return F.concat(feature if isinstance(feature, Column) else F.lit(feature), F.lit("="), value)


def _with_index(cells: DataFrame, dictionary: Dictionary, broadcast_entries: int, hot_share: float | None,
                how: str = "left") -> DataFrame:
    """``cells`` (with ``_cell``) and the ``idx`` of each: one join for all columns."""
    entries = dictionary.domains.select(_cell(F.col("feature"), F.col("category")).alias("_cell"), "idx")
    if dictionary.entries <= broadcast_entries:
        return cells.join(F.broadcast(entries), "_cell", how)  # counted: at most broadcast_entries rows
    return feature_lookup(cells, Lookup(entries, ("idx",), "_cell"), how, hot_share)


def dictionary_encode(df: DataFrame, cols: Sequence[str], dictionary: Dictionary | None = None,
                      broadcast_entries: int = BROADCAST_ENTRIES, hot_share: float | None = HOT_SHARE) -> DataFrame:
    """Replace each categorical by its alphabetical index (unseen/NULL -> k).

    A dictionary of at most ``broadcast_entries`` values is broadcast and rows
    are encoded where they are. Beyond that the rows are written once with a
    row number, the cells of all columns are joined with the dictionary as one
    long frame of (row, column, value), whatever the number of columns, and
    each row's codes come back as one array sorted by column.
    """
    cols = list(cols)
    require_columns(df, cols)
    dictionary = dictionary or fit_dictionary(df, cols)
    missing = [F.lit(dictionary.sizes[c]) for c in cols]
    if dictionary.entries <= broadcast_entries:
        out = df
        for c, k in zip(cols, missing):
            d = dictionary.domains.where(F.col("feature") == F.lit(c)).select(
                F.col("category").alias("_value"), F.col("idx").alias("_idx"))
            # counted: at most broadcast_entries rows
            out = out.join(F.broadcast(d), F.col(c).cast("string") == F.col("_value"), "left").withColumn(
                c, F.coalesce("_idx", k).cast("int")).drop("_value", "_idx")
        return out
    rows = cut_lineage(df.withColumn("_row", F.monotonically_increasing_id()), "encode-rows")
    cells = rows.select("_row", F.posexplode(F.array(*[_cell(c, F.col(c).cast("string")) for c in cols])).alias("_c", "_cell"))
    codes = _with_index(cells, dictionary, broadcast_entries, hot_share).groupBy("_row").agg(
        F.array_sort(F.collect_list(F.struct("_c", "idx"))).alias("_codes"))  # one entry per column
    return rows.join(codes, "_row").withColumns(
        {c: F.coalesce(F.col("_codes")[i]["idx"], k).cast("int") for i, (c, k) in enumerate(zip(cols, missing))}
    ).drop("_row", "_codes")


def fit_one_hot(df: DataFrame, cols: Sequence[str]) -> PipelineModel:
    return Pipeline(stages=one_hot_stages(cols)).fit(df)


def one_hot_cells(df: DataFrame, key: str, cols: Sequence[str], dictionary: Dictionary,
                  broadcast_entries: int = BROADCAST_ENTRIES, hot_share: float | None = HOT_SHARE) -> DataFrame:
    """Long-form one-hot ``(key, feature, category, idx, value)`` for any domain size.

    A value outside the dictionary (or NULL) yields no row, like the all-zero
    block of the vector form. One join for all columns; only the key and the
    cells are shuffled, and nothing at all where the dictionary is broadcast.
    """
    cols = list(cols)
    require_columns(df, [key, *cols])
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category")) for c in cols])
    cells = df.select(key, F.explode(entries).alias("_e")).select(key, "_e.*").where(F.col("category").isNotNull())
    cells = cells.withColumn("_cell", _cell(F.col("feature"), F.col("category")))
    return _with_index(cells, dictionary, broadcast_entries, hot_share, "inner").select(
        key, "feature", "category", "idx", F.lit(1.0).alias("value"))


def assemble_cells(df: DataFrame, key: str, cat: Sequence[str], num: Sequence[str], dictionary: Dictionary,
                   **how) -> DataFrame:
    """Non-zero slots ``(key, pos, value)`` of each row's feature vector.

    One-hot blocks first, in the order of ``cat``, then the numbers in theirs
    (a missing number stays as NULL): the positions of the assembled vector
    without ever building its zeros.
    """
    first, at = {}, 0
    for c in cat:
        first[c], at = at, at + dictionary.sizes[c]
    start = F.coalesce(*[F.when(F.col("feature") == F.lit(c), F.lit(n)) for c, n in first.items()]) if cat else F.lit(0)
    ones = one_hot_cells(df, key, cat, dictionary, **how).select(key, (start + F.col("idx")).cast("int").alias("pos"), "value")
    numbers = F.array(*[F.struct(F.lit(at + i).alias("pos"), F.col(c).cast("double").alias("value")) for i, c in enumerate(num)])
    rest = df.select(key, F.explode(numbers).alias("_e")).select(key, "_e.*")
    return ones.unionByName(rest.where(F.col("value").isNull() | (F.col("value") != 0)))


def one_hot_long(df: DataFrame, key: str, cols: Sequence[str], model: PipelineModel
                 ) -> DataFrame:
    """Encoded rows in long form ``(key, feature, category, value)``.

    One row per non-zero one-hot slot, produced in a single pass: each row's
    blocks become an array of (feature, slot) structs that is exploded; the
    slot -> category mapping is the fitted indexer's (bounded) label list.
    """
    cols = list(cols)
    enc = model.transform(df.select(key, *cols))
    labels = model.stages[0].labelsArray
    entries = []
    for c, labs in zip(cols, labels):
        lab_arr = F.array(*[F.lit(v) for v in labs]) if labs else F.array().cast("array<string>")
        pos = F.array_position(vector_to_array(F.col(f"{c}{OHE}")), F.lit(1.0))
        entries.append(
            F.when(pos > 0, F.struct(F.lit(c).alias("feature"),
                                     F.element_at(lab_arr, pos.cast("int")).alias("category"),
                                     F.lit(1.0).alias("value")))
        )
    return (
        enc.select(key, F.explode(F.array(*entries)).alias("_e"))
        .where(F.col("_e").isNotNull())
        .select(key, "_e.feature", "_e.category", "_e.value")
    )


# Fixed value: stand-in for a missing numeric in tree inputs. It lies below
# any realistic observation, so every split sends missing rows the same way
# at training and at scoring time (a data-derived value could differ).
MISSING_SENTINEL = -1.0e15


def fill_for_trees(df: DataFrame, cols: Sequence[str], indicator: bool = False,
                   sentinel: float = MISSING_SENTINEL) -> DataFrame:
    """Missing numeric policy for tree models (which reject NaN/NULL).

    NULL/NaN -> a fixed sentinel below every observed value; optional 0/1
    ``<col>_missing`` columns. A narrow projection, no statistics needed.
    """
    cols = list(cols)
    if not cols:
        return df
    require_columns(df, cols)
    clean = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in cols}
    out = df
    if indicator:
        out = out.withColumns({f"{c}_missing": clean[c].isNull().cast("int") for c in cols})
    return out.withColumns({c: F.coalesce(clean[c], F.lit(float(sentinel))) for c in cols})
