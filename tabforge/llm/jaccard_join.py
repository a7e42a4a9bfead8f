"""N-gram Jaccard join: tiles, bitmap signatures, exact intersection.

Documents with equal shingle sets are one class. Two classes can only link if
they share a shingle among the first (1 - t) of each in some common order, so
a class enters the tiles of those shingles; the order puts shingles of
crowded cells of a fixed-size count sketch last, so that common passages open
few tiles (the order cannot change the result). In a tile, neighbours in size
are linked first; pairs already connected need no look. The others meet in
size-banded joins whose condition bounds the overlap by bit counts of hashed
bitmaps, and the pairs left are settled by intersecting sorted arrays.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import BinaryType

from tabforge.llm.common import prepare
from tabforge.llm.components import components
from tabforge.session import cut_lineage, released_scratch, scratch_path

SHINGLE = 5
PERCENT = 75
CELLS = 1 << 24       # count sketch for the order: fixed size, counts up to 255
CROWDS = 1 << 20      # count sketch for crowded tiles: fixed size
BLOCK = 1 << 14       # cells per sketch row
MARKS = 1 << 24       # hash marks of asked-for documents: fixed size
WORDS = 32            # 64-bit words of a bitmap signature
FOLDS = 16            # words of the folded bitmap that tiles compare first
LARGEST = 4           # tiles a class names, so that pairs meet in a named common one only
BANDED = 32           # classes of a tile above which it is cut into size bands
ROWS = 256            # rows of a batch that are prepared together
SLICE = 1 << 20       # bytes of text prepared together in a task (a longer text goes alone)
LOOKS = 512           # pairs a row that cost less to look at than another round of neighbours
SMALL_PAIRS = 1_000_000  # pairs up to this number have their cells broadcast (16 bytes a class)
GROUP = 1 << 18       # shingles (8 bytes each) of pairs that are intersected together
TILE = 10_000         # rows of a tile before it is salted, above the mean load

_rng = np.random.default_rng(20240501)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_POWER = np.uint64(0x9E3779B97F4A7C15)
_JOIN = np.uint64(0xD6E8FEB86659FD93)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 9, 10, 11, 12, 13]] = True


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text, texts hashed together."""
    a = np.frombuffer(b"\n".join(t.lower() for t in texts) + b"\n", np.uint8)  # bytes.lower is A-Z only
    blank = _BLANK[a]
    inside = ~blank
    begin = np.flatnonzero(inside & np.r_[True, blank[:-1]])
    if not len(begin):
        return [np.empty(0, np.uint64)] * len(texts)
    finish = np.flatnonzero(blank & np.r_[False, inside[:-1]])
    lens = finish - begin
    at = np.cumsum(lens) - lens
    place = np.arange(int(lens.sum())) - np.repeat(at, lens)
    power = np.cumprod(np.r_[np.uint64(1), np.full(int(lens.max()), _POWER)])
    word = _mix(np.add.reduceat(_BYTE[a[inside]] * power[place], at) + lens.astype(np.uint64) * _JOIN)
    ends = np.cumsum([len(t) + 1 for t in texts])
    bounds = np.r_[0, np.searchsorted(begin, ends)]
    shingle = word.copy()
    for j in range(1, k):
        shingle[:-j or None] = shingle[:-j or None] * _JOIN + word[j:] if j < len(word) else shingle[:-j or None]
    shingle = _mix(shingle)
    out = []
    for i, j in zip(bounds[:-1], bounds[1:]):
        if j - i >= k:
            out.append(np.unique(shingle[i:j - k + 1]))
        elif j > i:
            few = np.uint64(j - i)
            for w in word[i:j]:
                few = few * _JOIN + w
            out.append(_mix(np.array([few ^ _JOIN], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def shingle_sets(texts: list[bytes | None], k: int = SHINGLE) -> Iterator[np.ndarray]:
    """``_sets`` over slices of bounded size, so arrays stay small."""
    held, size = [], 0
    with np.errstate(over="ignore"):
        for t in texts:
            t = t or b""
            if held and size + len(t) > SLICE:
                yield from _sets(held, k)
                held, size = [], 0
            held.append(t)
            size += len(t)
        if held:
            yield from _sets(held, k)


def prefix_length(n: int, percent: int) -> int:
    """Shingles of which two linked sets must share one: n - ceil(t n) + 1."""
    return n - (-(-percent * n // 100)) + 1


def _packed(x: np.ndarray) -> bytes:
    """zlib with or without matches: dense small counts repeat by chance only, sparse ones in long runs."""
    z = zlib.compressobj(1, strategy=zlib.Z_HUFFMAN_ONLY)
    return min(zlib.compress(x.tobytes(), 1), z.compress(x.tobytes()) + z.flush(), key=len)


def _fixed_arrays(rows: DataFrame, fill, kinds: list[tuple[int, str]], merge) -> list[np.ndarray]:
    """Arrays of fixed sizes and types that tasks fill and merge block by block.

    ``fill(arrays, batch)`` works on a task's own arrays; equal blocks of all
    tasks meet in one place and are merged as they stream by. The result has
    the same size whatever the input, so the driver may hold it.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(size, kind) for size, kind in kinds]
        for b in _parts(batches):
            fill(totals, b)
        for a, total in enumerate(totals):
            for i in range(0, len(total), BLOCK):
                if total[i:i + BLOCK].any():
                    yield pa.RecordBatch.from_pydict({
                        "a": pa.array([a], pa.int32()), "block": pa.array([i // BLOCK], pa.int32()),
                        "n": [_packed(total[i:i + BLOCK])]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            for a, i, x in zip(b.column("a").to_pylist(), b.column("block").to_pylist(), b.column("n").to_pylist()):
                x = np.frombuffer(zlib.decompress(x), kinds[a][1])
                held[a, i] = merge(held[a, i], x) if (a, i) in held else x
        for (a, i), x in held.items():
            yield pa.RecordBatch.from_pydict({"a": pa.array([a], pa.int32()), "block": pa.array([i], pa.int32()),
                                              "n": [_packed(x)]})

    schema = "a int, block int, n binary"
    blocks = rows.mapInArrow(run, schema).repartition("a", "block").mapInArrow(add, schema)
    out = [np.zeros(size, kind) for size, kind in kinds]
    for r in blocks.collect():  # the arrays' sizes in all
        x = np.frombuffer(zlib.decompress(r["n"]), kinds[r["a"]][1])
        out[r["a"]][r["block"] * BLOCK:r["block"] * BLOCK + len(x)] = x
    return out


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches in slices of a few rows, so that arrays made of them stay small."""
    for b in batches:
        for i in range(0, b.num_rows, ROWS):
            yield b.slice(i, ROWS)


def _add_counts(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.minimum(x.astype(np.uint64) + y, np.iinfo(x.dtype).max).astype(x.dtype)  # enough for an order


def count_sketches(docs: DataFrame, k: int, kinds: list[tuple[int, str]]) -> list[np.ndarray]:
    """Shingle counts by hash cell over all documents, in one pass: an array
    for each (cells, type), whose counts stop at the type's largest number."""
    def fill(totals: list[np.ndarray], batch: pa.RecordBatch) -> None:
        for s in shingle_sets(batch.column("text").to_pylist(), k):
            for total in totals:
                at = (s % np.uint64(len(total))).astype(np.int64)
                now = total[at]
                total[at] = now + (now < np.iinfo(total.dtype).max)

    return _fixed_arrays(docs.select("text"), fill, kinds, _add_counts)


def _cell(ids: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (_mix(ids.astype(np.int64).view(np.uint64)) % np.uint64(MARKS)).astype(np.int64)


def id_marks(ids: DataFrame) -> np.ndarray:
    """Hash marks of the column ``node``: a text without a mark is not asked for."""
    def fill(totals: list[np.ndarray], batch: pa.RecordBatch) -> None:
        totals[0][_cell(batch.column("node").to_numpy(zero_copy_only=False))] = 1

    return _fixed_arrays(ids.select("node"), fill, [(MARKS, "u1")], np.maximum)[0]


def _sent_marks(ids: DataFrame) -> Broadcast:
    return ids.sparkSession.sparkContext.broadcast(np.packbits(id_marks(ids)))  # fixed size: MARKS bits


def _marked(ids: DataFrame):
    """Column function: whether a doc_id (not NULL) has the mark of one in ``ids`` (node)."""
    marks = _sent_marks(ids)

    @F.pandas_udf("boolean")
    def marked(column: pd.Series) -> pd.Series:
        at = _cell(column.to_numpy())
        return pd.Series((marks.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool))

    return marked


PRINT_SCHEMA = "row_no long, doc_id long, n_shingles long, s1 long, s2 long, bits array<long>"
TILE_SCHEMA = "doc_id long, n_shingles long, s1 long, s2 long, keys array<long>, salts array<int>"


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.r_[0, np.cumsum([len(x) for x in arrays])].astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def _digest(s: np.ndarray) -> tuple[np.uint64, np.uint64]:
    return np.bitwise_xor.reduce(_mix(s)), np.add.reduce(_mix(s ^ _JOIN))


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """Per document: set size, set digest and bitmap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _parts(batches):
            n, s1, s2, bits = [], [], [], []
            with np.errstate(over="ignore"):
                for s in shingle_sets(b.column("text").to_pylist(), k):
                    n.append(len(s))
                    a, c = _digest(s)
                    s1.append(a)
                    s2.append(c)
                    sig = np.zeros(WORDS * 64, np.uint8)
                    sig[(s >> np.uint64(48)) % np.uint64(WORDS * 64)] = 1
                    bits.append(np.packbits(sig).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column("row_no"), b.column("doc_id"), pa.array(n, pa.int64()), _signed(np.array(s1, np.uint64)),
                 _signed(np.array(s2, np.uint64)), _lists(bits, pa.int64())],
                names=["row_no", "doc_id", "n_shingles", "s1", "s2", "bits"])

    return docs.select(F.monotonically_increasing_id().alias("row_no"), "doc_id", "text").mapInArrow(run, PRINT_SCHEMA)


def tile_keys(docs: DataFrame, loads: Broadcast, k: int, percent: int) -> DataFrame:
    """Per document with words: set size, set digest, and the shingles of its tiles by the sketches ``loads``.

    They are made from the texts where they are needed: a stored column of
    them would be larger than all other columns together.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        load, heavy = loads.value
        cells, wide = len(load), len(heavy)
        crowd = TILE + 4 * int(heavy.sum(dtype=np.uint64)) // wide
        for b in _parts(batches):
            n, s1, s2, keys, salts = [], [], [], [], []
            with np.errstate(over="ignore"):
                for s in shingle_sets(b.column("text").to_pylist(), k):
                    n.append(len(s))
                    a, c = _digest(s)
                    s1.append(a)
                    s2.append(c)
                    take = prefix_length(len(s), percent) if len(s) else 0
                    own = load[(s % np.uint64(cells)).astype(np.int64)]
                    held = heavy[(s % np.uint64(wide)).astype(np.int64)].astype(np.int64)
                    # full counters are told apart by the wide ones
                    first = np.lexsort((s, np.where(own < 255, 0, held), own))[:take]
                    keys.append(s[first].view(np.int64))
                    parts = held[first] // crowd + 1
                    salts.append((int(a >> np.uint64(11)) % parts).astype(np.int32) + np.where(parts > 1, 1, 0))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), _signed(np.array(s1, np.uint64)),
                 _signed(np.array(s2, np.uint64)), _lists(keys, pa.int64()), _lists(salts, pa.int32())],
                names=["doc_id", "n_shingles", "s1", "s2", "keys", "salts"])

    return docs.select("doc_id", "text").mapInArrow(run, TILE_SCHEMA).where("n_shingles > 0")


def _class_tiles(texts: DataFrame, classes: DataFrame, repeats: DataFrame, order: np.ndarray, crowds: np.ndarray,
                 k: int, percent: int) -> DataFrame:
    """(node, n, keys, salts): the tiles of each class once, from its least doc_id.

    Documents whose doc_id no row of ``repeats`` has are classes; others leave
    by an anti join. A doc_id with other rows beside its class's first one (a
    repeated row, another text) comes back by its classes' digests.
    """
    loads = texts.sparkSession.sparkContext.broadcast((order, crowds))  # fixed size: 1 and 4 bytes a cell
    row = ["doc_id", "s1", "s2", "n_shingles"]
    rows, ids = texts.where("doc_id IS NOT NULL"), repeats.select("doc_id")
    mixed = cut_lineage(classes.select(F.col("node").alias("doc_id"), *row[1:]).join(ids, "doc_id", "left_semi"),
                        "jaccard-mixed")
    once = tile_keys(rows.join(ids, "doc_id", "left_anti"), loads, k, percent)
    again = (tile_keys(rows.join(mixed.select("doc_id"), "doc_id", "left_semi"), loads, k, percent)
             .join(mixed, row, "left_semi")
             .groupBy(*row).agg(F.first("keys").alias("keys"), F.first("salts").alias("salts")))
    return once.unionByName(again).select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), "keys", "salts")


def asked_texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(node, items): the texts of the documents in ``ids`` (node), and of a few others whose hash mark is the same.

    A text is sent instead of its shingles: it packs to a fraction of their 8 bytes each.
    """
    marks = _sent_marks(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = np.unpackbits(marks.value).view(bool)
        for b in _parts(batches):
            b = b.filter(b.column("doc_id").is_valid())
            b = b.filter(pa.array(asked[_cell(b.column("doc_id").to_numpy(zero_copy_only=False))], pa.bool_()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pc.fill_null(b.column("text"), b"")],
                                             names=["node", "items"])

    return docs.select("doc_id", "text").mapInArrow(run, "node long, items binary")


def overlap_possible(x: str, y: str, percent: int) -> Column:
    """Bit counts allow a link: shingles whose bit the other lacks are not shared."""
    # word by word, so that the count is compiled into the join
    def missing(p: str, q: str) -> str:
        return "(" + " + ".join(f"bit_count({p}.bits[{i}] & ~{q}.bits[{i}])" for i in range(WORDS)) + ")"
    most = f"least({x}.n - {missing(x, y)}, {y}.n - {missing(y, x)})"
    return F.expr(f"{100 + percent} * {most} >= {percent} * ({x}.n + {y}.n)")


def size_band(n: Column, percent: int) -> Column:
    """Linked sets lie in the same band or in neighbouring ones."""
    return F.floor(F.log(n.cast("double")) / float(np.log(100 / percent)) + 1e-9).cast("int")


def _dealt(pairs: DataFrame, sizes: DataFrame, small: bool, group: int) -> DataFrame:
    """(a, b, cell): pairs dealt to cells, so that pairs with a class in common mostly share one.

    A pair's cell is the least class next to one of its two. Where a cell's
    classes have more than ``group`` shingles, they are cut into blocks by
    hash, and a cell holds the pairs of two blocks.
    """
    both = pairs.select(F.col("a").alias("node"), "b").union(pairs.select("b", "a"))
    least = both.groupBy("node").agg(F.least("node", F.min("b")).alias("least"))
    if small:  # at most two rows a pair
        least = F.broadcast(least)
    named = (pairs.join(least.toDF("a", "i"), "a").join(least.toDF("b", "j"), "b")
             .select("a", "b", F.least("i", "j").alias("least")))
    named = cut_lineage(named, "jaccard-named")
    held = named.select("least", F.col("a").alias("node")).union(named.select("least", "b")).distinct()
    large = (held.join(sizes.select("node", "n"), "node").groupBy("least").agg(F.sum("n").alias("s"))
             .where(F.col("s") > group))
    blocks = F.ceil(F.coalesce("s", F.lit(1)) / group)
    i, j = (F.pmod(F.xxhash64(c), blocks) for c in "ab")
    # classes whose hashes are equal share a cell: each pair still finds its own sets there
    cell = F.xxhash64("least", F.least(i, j), F.greatest(i, j)).alias("cell")
    return cut_lineage(named.join(large, "least", "left").select("a", "b", cell), "jaccard-dealt")


def exact_links(pairs: DataFrame, sizes: DataFrame, sets: DataFrame, percent: int, small: int = SMALL_PAIRS,
                group: int = GROUP, k: int = SHINGLE) -> DataFrame:
    """The pairs (a, b) whose sorted shingle arrays intersect enough, as u, v.

    ``pairs`` is a written table. ``sets`` has the column items: sorted shingle
    arrays, or texts, whose arrays are made where they meet. A set is shuffled once for each cell with a
    pair of its class (``_dealt``), mostly once in all. Where the pairs are
    counted small, the cells are broadcast to the sets, so that no other set
    is shuffled.
    """
    few = pairs.count() <= small  # at most `small` rows of two numbers
    dealt = _dealt(pairs, sizes, few, group)
    nodes = dealt.select("cell", F.col("a").alias("node")).union(dealt.select("cell", "b")).distinct()
    sent = sets.join(F.broadcast(nodes) if few else nodes, "node")
    kind = sets.schema["items"].dataType
    whole = isinstance(kind, BinaryType)
    rows = (sent.select("cell", F.col("node").alias("a"), F.lit(None).cast("long").alias("b"), "items")
            .unionByName(dealt.withColumn("items", F.lit(None).cast(kind)))
            # a cell's sets come before its pairs
            .repartition("cell").sortWithinPartitions("cell", F.col("b").isNotNull()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, {}
        for batch in _parts(batches):
            u, v, items = [], [], batch.column("items")
            made = shingle_sets([x for x in items.to_pylist() if x is not None], k) if whole else None
            numbers = (batch.column(c).to_pylist() for c in ("cell", "a", "b"))
            for i, (cell, a, b) in enumerate(zip(*numbers)):
                if cell != now:
                    now, held = cell, {}
                if b is None:
                    # repeated rows of a doc_id are held once
                    x = next(made) if whole else items[i].values.to_numpy(zero_copy_only=False)
                    held.setdefault(a, {}).setdefault((len(x), int(np.bitwise_xor.reduce(x))), x.copy())
                elif any(_linked(x, y, percent) for x in held.get(a, {}).values() for y in held.get(b, {}).values()):
                    u.append(a)
                    v.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return rows.select("cell", "a", "b", "items").mapInArrow(run, "u long, v long")


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    # arrays hold each hash once, so a hit on both sides is a shared shingle
    z = np.sort(np.concatenate((x, y)))
    common = int((z[1:] == z[:-1]).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def _neighbours(rows: DataFrame, by: list[str], order: list) -> DataFrame:
    """Pairs of rows that follow each other in a tile and may link by size."""
    w = Window.partitionBy(*by).orderBy(*order)
    near = rows.withColumn("p", F.lag(F.struct("node", "n", "component")).over(w)).where("p IS NOT NULL")
    return (near.where("p.component <> component")
            .select(F.least("node", "p.node").alias("a"), F.greatest("node", "p.node").alias("b")).distinct())


def jaccard_components(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, cells: int = CELLS) -> DataFrame:
    """Components of documents linked by shingle sets of Jaccard >= percent / 100.

    Result: doc_id, n_shingles, component_id (least doc_id reachable), one row
    per input row. A-Z is lower-cased; a text of fewer than ``k`` words is one
    shingle; texts without words (NULL, empty, blank) link with nothing.
    Equal texts and repeated rows are one class; a doc_id stands for one
    document; rows with a NULL doc_id get no links and a NULL component. An
    empty table gives an empty result; further columns are ignored.
    """
    spark = docs.sparkSession
    prepare(spark)
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("binary").alias("text"))
    order, crowds = count_sketches(texts, k, [(cells, "u1"), (CROWDS, "u4")])
    prints = cut_lineage(signatures(texts, k), "jaccard-prints")
    digest = ["s1", "s2", "n_shingles"]
    named = prints.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = cut_lineage(named.groupBy(*digest).agg(F.min(F.struct("doc_id", "row_no")).alias("r"))
                          .select(*digest, F.col("r.doc_id").alias("node"), F.col("r.row_no").alias("first_row")),
                          "jaccard-classes")
    # rows that only repeat a class; usually few, so the anti joins can leave the prints and texts where they are
    repeats = cut_lineage(named.select("row_no", "doc_id", *digest).join(classes, digest).where("row_no <> first_row")
                          .select("row_no", "doc_id"), "jaccard-repeats")
    firsts = (named.join(repeats.select("row_no"), "row_no", "left_anti")
              .select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), "bits"))
    linked = _link_classes(texts, firsts, _class_tiles(texts, classes, repeats, order, crowds, k, percent), k, percent)
    by_digest = classes.select(*digest, "node").join(linked, "node", "left").select(
        *digest, F.coalesce("component", "node").alias("component_id"))
    labelled = prints.select("doc_id", *digest).join(by_digest, digest, "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return labelled.select("doc_id", "n_shingles", own.alias("component_id"))


def _link_classes(texts: DataFrame, classes: DataFrame, tiles: DataFrame, k: int, percent: int) -> DataFrame:
    """(node, component) of all classes that link with another one."""
    tiles = (tiles.select("node", "n", F.explode(F.arrays_zip("keys", "salts")).alias("t"))
             .select(F.col("t.keys").alias("key"), F.col("t.salts").alias("salt"), "node", "n"))
    # tiles of one class have no pairs; salted ones are judged as a whole later
    within = Window.partitionBy("key", "salt").orderBy("n", "node")
    shared = cut_lineage(
        tiles.withColumn("before", F.lag("node").over(within)).withColumn("next", F.lead("node").over(within))
        .where("before IS NOT NULL OR next IS NOT NULL OR salt > 0").select("key", "salt", "node", "n"),
        "jaccard-shared")
    shared = cut_lineage(_widest(_distinct_tiles(shared)), "jaccard-tiles")
    named = _largest(shared)
    sizes = cut_lineage(classes.select("node", "n", "bits").join(shared.select("node").distinct(), "node", "left_semi"),
                        "jaccard-bits")
    sets = None

    def linked(pairs: DataFrame) -> DataFrame:
        """Exact links among the pairs, fetching texts not yet at hand."""
        nonlocal sets
        pairs = cut_lineage(pairs, "jaccard-pairs")
        ids = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        ids = ids if sets is None else ids.join(sets.select("node"), "node", "left_anti")
        new = cut_lineage(asked_texts(texts, ids), "jaccard-sets")
        sets = new if sets is None else sets.unionByName(new)
        return cut_lineage(exact_links(pairs, sizes, sets, percent, k=k), "jaccard-links")

    def bounded(pairs: DataFrame) -> DataFrame:
        x = sizes.select(F.col("node").alias("a"), F.struct("n", "bits").alias("x"))
        y = sizes.select(F.col("node").alias("b"), F.struct("n", "bits").alias("y"))
        return pairs.join(x, "a").join(y, "b").where(overlap_possible("x", "y", percent)).select("a", "b")

    links, labels, turn, before = None, None, 0, 0.0
    while True:
        if labels is None:
            rows = shared.withColumn("component", F.col("node"))
        else:
            rows = (shared.join(labels, "node", "left")
                    .withColumn("component", F.coalesce("component", "node")))
        # tiles that still hold several components
        open_ = (rows.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                 .where("lo < hi").select("key"))
        rows = cut_lineage(rows.join(open_, "key", "left_semi"), "jaccard-open")
        per = rows.groupBy("key", "component").agg(F.count(F.lit(1)).alias("m"))
        tot = per.groupBy("key").agg(F.sum("m").alias("s"), F.sum(F.col("m") * F.col("m")).alias("q"))
        left, cross = tot.agg(F.sum("s"), F.sum((F.col("s") * F.col("s") - F.col("q")) / 2.0)).first()
        if not left:
            break
        # neighbours once, as near copies need no other look; then on to the pairs
        # left when they are cheap to look at or neighbours no longer halve them
        last = bool(turn) and (cross <= LOOKS * left or cross > before / 2)
        before = cross
        if last:
            pairs = bounded(_cross_pairs(rows, sizes, named, percent))
        else:
            # by size first, then in random orders that differ from round to round
            order = [F.col("n"), F.col("node")] if not turn else [F.xxhash64(F.lit(turn), "node")]
            pairs = bounded(_neighbours(rows, ["key", "salt"], order).unionByName(
                _neighbours(_heads(rows), ["key"], order)).distinct())
        new = linked(pairs)
        found = new.agg(F.count(F.lit(1))).first()[0]
        links = new if links is None else links.unionByName(new)
        if found:
            labels = cut_lineage(components(links), "jaccard-components")
            links = labels.select(F.col("node").alias("u"), F.col("component").alias("v"))
        if last:
            break
        turn += 1
    if labels is None:
        return texts.sparkSession.createDataFrame([], "node long, component long")
    return labels


def _distinct_tiles(rows: DataFrame) -> DataFrame:
    """One tile of those with the same classes: a shared passage opens a tile per shingle."""
    members = rows.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.bit_xor(F.xxhash64("node")).alias("d1"),
                                      F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("d2"))
    kept = members.groupBy("m", "d1", "d2").agg(F.min("key").alias("key")).select("key")
    return cut_lineage(rows.join(kept, "key", "left_semi"), "jaccard-distinct")


def _widest(rows: DataFrame) -> DataFrame:
    """Tiles without those whose classes all stand in one and the same larger tile too.

    Each class names the largest of its tiles; if all of a tile name the same
    other one, that one meets all its pairs.
    """
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("m"))
    largest = rows.join(sizes, "key").groupBy("node").agg(F.max(F.struct("m", "key")).alias("t"))
    kept = (rows.join(largest.select("node", F.col("t.key").alias("named")), "node")
            .groupBy("key").agg(F.min("named").alias("lo"), F.max("named").alias("hi"))
            .where("lo <> hi OR lo = key").select("key"))
    return rows.join(kept, "key", "left_semi")


def _heads(rows: DataFrame) -> DataFrame:
    """The first class of each salted part of a crowded tile."""
    return rows.where("salt > 0").groupBy("key", "salt").agg(
        F.min(F.struct("node", "n", "component")).alias("h")).select("key", "salt", "h.*")


def _largest(rows: DataFrame, most: int = LARGEST) -> DataFrame:
    """(node, named): the largest tiles of each class as structs (m, key), at most ``most``."""
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("m"))
    order = Window.partitionBy("node").orderBy(F.desc("m"), F.desc("key"))
    return (rows.select("key", "node").distinct().join(sizes, "key").withColumn("place", F.row_number().over(order))
            .where(F.col("place") <= most).groupBy("node").agg(F.collect_list(F.struct("m", "key")).alias("named")))


def _cross_pairs(rows: DataFrame, sizes: DataFrame, named: DataFrame, percent: int, distinct: bool = True) -> DataFrame:
    """All pairs of a tile in different components that size and bits allow.

    A tile's largest component never stands on the left, so its own pairs
    (all connected already) are not met. Two classes that both name a larger
    tile than this one meet there: the largest of all tiles that hold a pair
    never leaves it to another. In tiles of more than ``BANDED`` classes,
    these meet in size bands: each stands in its own, and is a guest in the
    neighbouring ones.
    """
    per = rows.groupBy("key", "component").agg(F.count(F.lit(1)).alias("m"))
    main = per.groupBy("key").agg(F.max_by("component", F.struct("m", "component")).alias("main"))
    # a tile is open with all its rows or none, so this counts what ``named`` has counted
    sized = rows.groupBy("key").agg(F.count(F.lit(1)).alias("m"))
    # bitmaps folded to FOLDS words: a condition this short is compiled to machine code
    folds = [F.expr(" | ".join(f"bits[{j}]" for j in range(i, WORDS, FOLDS))).alias(f"w{i}") for i in range(FOLDS)]
    full = (rows.select("key", "node", "n", "component").join(main.join(sized, "key"), "key")
            .join(sizes.select("node", *folds).join(named, "node"), "node")
            .withColumn("larger", F.expr("transform(filter(named, t -> t.m > m OR (t.m = m AND t.key > key)), t -> t.key)"))
            .withColumn("band", F.when(F.col("m") > BANDED, size_band(F.col("n"), percent)).otherwise(-2))
            .withColumn("in_main", F.col("component") == F.col("main")).drop("m", "main", "named"))
    bands = F.when(F.col("band") >= 0, F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).otherwise(F.array("band"))
    guest = full.withColumn("band", F.explode(bands))
    x, y = full.where(~F.col("in_main")).alias("x"), guest.alias("y")

    def missing(p: str, q: str) -> str:
        return "(" + " + ".join(f"bit_count({p}.w{i} & ~{q}.w{i})" for i in range(FOLDS)) + ")"

    meet = F.expr(f"""x.key = y.key AND x.band = y.band AND x.component <> y.component
        AND (y.in_main OR y.n < x.n OR (y.n = x.n AND y.node < x.node))
        AND 100 * x.n >= {percent} * y.n AND 100 * y.n >= {percent} * x.n
        AND {100 + percent} * (x.n - {missing("x", "y")}) >= {percent} * (x.n + y.n)
        AND {100 + percent} * (y.n - {missing("y", "x")}) >= {percent} * (x.n + y.n)
        AND NOT arrays_overlap(x.larger, y.larger)""")
    met = x.join(y, meet).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
    return met.distinct() if distinct else met


def keep_one(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One document of each component, the one with the least doc_id, with its columns.

    Of repeated rows one stays; documents without words and rows with a NULL
    doc_id all stay.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "jaccard-result")
    with released_scratch(spark):
        jaccard_components(docs, k, percent).write.parquet(path)
    found = spark.read.parquet(path)
    counted = F.col("n_shingles") > 0
    fates = (found.groupBy("doc_id").agg(F.max(F.col("component_id") != F.col("doc_id")).alias("lost"),
                                         F.count_if(counted & (F.col("component_id") == F.col("doc_id"))).alias("c"))
             .where("lost OR c > 1").select("doc_id", "lost"))
    fates = cut_lineage(fates, "jaccard-fates")
    marked = _marked(fates.select(F.col("doc_id").alias("node")))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.struct(*[docs[c] for c in docs.columns]).alias("doc"))
    rows = rows.withColumn("asked", F.col("doc_id").isNotNull() & marked(F.coalesce("doc_id", F.lit(0))))
    # only texts with a mark are shuffled
    asked = rows.where("asked").drop("asked")
    once = asked.join(fates, "doc_id", "left_anti").select("doc.*")
    again = (asked.join(fates.where("NOT lost"), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("doc").alias("doc"))
             .select("doc.*"))
    return rows.where("NOT asked").select("doc.*").unionByName(once).unionByName(again)
