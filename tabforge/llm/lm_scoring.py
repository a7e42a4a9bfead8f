"""Language-model scores of whole documents (see ``gru_lm`` for the model).

Words of the training documents are counted by a shuffle. Every task trains
the same first model on its own share of the training documents, and the
shares' models are averaged by tokens, in rounds that each use other
documents. Scoring is one pass; only words outside a bounded head vocabulary
look up their counts through a join.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.llm import gru_lm as lm
from tabforge.llm.common import prepare
from tabforge.session import cut_lineage

HEAD = 1 << 17        # words whose counts travel with the tasks: a fixed bound
ROUNDS = 2            # averagings; every training document is used in one of them
CHUNK = 400_000       # tokens split into words together (a longer document goes alone)
LANED = 3_000_000     # tokens put into lanes together: long documents leave few lanes empty
FLUSH = 400_000       # distinct words that a counting task holds
BLOCK = 8192          # numbers of a parameter block
OCTAVES = 16          # classes of head words outside the short list, by powers of 2 of their counts
HASHED = 16           # classes of words outside the head, by crc32
END = b""             # the end token; no word is empty


def remainder(doc_id: Column) -> Column:
    """crc32 of doc_id as text, modulo 7 (NULL: as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")))


def _split(texts: list[bytes | None]) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts, one after another, and how many each has (bytes: A-Z and ASCII white space only)."""
    # a view checks no UTF-8, and the ascii functions leave other bytes alone
    text = pc.ascii_lower(pa.array([t or b"" for t in texts], pa.binary()).view(pa.string()))
    parts = pc.ascii_split_whitespace(text)
    words, ends = parts.flatten(), np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False))
    some = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0  # white space in front or behind leaves empty ones
    if not some.all():
        words = words.filter(pa.array(some))
    return words.view(pa.binary()), np.diff(np.r_[0, np.cumsum(some)][ends], prepend=0)


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over the rows' texts and their ends."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ends = None, 0
        new: list[pa.Table] = []

        def merged() -> pa.Table:
            t = pa.concat_tables(new if held is None else [held, *new])
            new.clear()
            t = t.group_by("word", use_threads=False).aggregate([("n", "sum")])
            return t.select(["word", "n_sum"]).rename_columns(["word", "n"])

        for rows in _chunks(b.select(["text"]) for b in batches):
            words, _ = _split([r[0] for r in rows])
            ends += len(rows)
            counted = pc.value_counts(words)
            new.append(pa.table({"word": counted.field("values"), "n": counted.field("counts")}))
            if sum(map(len, new)) > FLUSH:
                held = merged()
                if len(held) > FLUSH:
                    yield from held.to_batches()
                    held = None
        new.append(pa.table({"word": pa.array([END], pa.binary()), "n": pa.array([ends], pa.int64())}))
        yield from merged().to_batches()

    return (texts.select("text").mapInArrow(run, "word binary, n long").where("n > 0")
            .groupBy("word").agg(F.sum("n").alias("n")))


def head_words(counts: DataFrame, most: int = HEAD) -> list[tuple[bytes, int]]:
    """The most frequent words, at most ``most``, by count and word.

    A histogram over powers of 2^(1/16) gives the least count that leaves no
    more words than that.
    """
    level = F.floor(F.log2("n") * 16)
    hist = sorted(((r["l"], r["c"]) for r in counts.groupBy(level.alias("l")).agg(F.count(F.lit(1)).alias("c")).collect()),
                  reverse=True)
    least, total = None, 0
    for l, c in hist:
        total += c
        if total > most:
            break
        least = l
    if least is None:
        return []
    rows = counts.where(level >= least).collect()  # at most `most` rows
    return sorted(((bytes(r["word"]), r["n"]) for r in rows), key=lambda x: (-x[1], x[0]))


class Vocabulary:
    """Head words by rank; the first are the model's short list.

    The other head words are classes by counts, words outside the head by
    hash. ``crc``: (crc32 % HASHED) -> (tokens, distinct) of all training words.
    """

    def __init__(self, head: list[tuple[bytes, int]], tokens: int, distinct: int, crc: dict[int, tuple[int, int]]):
        self.words = [w for w, _ in head]
        self.counts = np.array([n for _, n in head], np.int64)
        self.tokens, self.distinct = tokens, distinct
        self.shape = lm.Shape.of(distinct, OCTAVES + HASHED, len(head))
        short = self.shape.short
        octave = np.minimum(np.log2(np.maximum(self.counts, 1)).astype(np.int64), OCTAVES - 1)
        self.id_of = np.r_[np.arange(min(short, len(head))), short + octave[short:]].astype(np.int64)
        self.hashed = short + OCTAVES
        self.end = next((i for i, w in enumerate(self.words) if w == END), len(self.words))  # its rank
        # tokens and distinct words of the rest classes
        size = np.zeros((OCTAVES + HASHED, 2), np.int64)
        np.add.at(size, octave[short:], np.c_[self.counts[short:], np.ones_like(self.counts[short:])])
        for k, (n, d) in crc.items():
            size[OCTAVES + k] += (n, d)
        if head:
            mine = [OCTAVES + zlib.crc32(w) % HASHED for w in self.words]
            np.add.at(size, mine, -np.c_[self.counts, np.ones_like(self.counts)])
        self.rest_tokens = size[:, 0]
        # one more for words that training never saw
        self.rest_log = np.log10(np.maximum(size.sum(1) + np.repeat([0, 1], [OCTAVES, HASHED]), 1))

    def first(self) -> lm.Params:
        short = np.zeros(self.shape.short, np.int64)
        short[:min(len(short), len(self.counts))] = self.counts[:len(short)]
        return lm.Params.first(short, self.rest_tokens, shape=self.shape)

    def lookup(self) -> dict[bytes, int]:
        return {w: i for i, w in enumerate(self.words)}

    def ids(self, words: list[bytes], rank: np.ndarray) -> np.ndarray:
        """The model's ids of words with these ranks (len(self.words): outside the head)."""
        out = np.r_[self.id_of, 0][rank]
        for i in np.flatnonzero(rank == len(self.words)):
            out[i] = self.hashed + zlib.crc32(words[i]) % HASHED
        return out


CRC_TABLE = np.arange(256, dtype=np.uint32)
for _ in range(8):
    CRC_TABLE = (CRC_TABLE >> 1) ^ np.where(CRC_TABLE & 1, np.uint32(0xEDB88320), np.uint32(0))


def crc32s(words: pa.Array, most: int = 64) -> np.ndarray:
    """crc32 of each word: the k-th bytes of all words at once, words over ``most`` bytes one by one."""
    sizes = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words)].astype(np.int64)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    by = np.argsort(-sizes, kind="stable")
    long = int((sizes > most).sum())
    out = np.full(len(by), 0xFFFFFFFF, np.uint32)
    at, live = first[by], np.cumsum(np.bincount(np.minimum(sizes, most), minlength=most + 1)[::-1])[::-1]
    for k in range(most):
        if not (n := int(live[k + 1])):
            break
        c = out[:n]
        out[:n] = CRC_TABLE[(c ^ data[at[:n] + k]) & 255] ^ (c >> 8)
    out ^= np.uint32(0xFFFFFFFF)
    for i in range(long):
        out[i] = zlib.crc32(data[at[i]:at[i] + sizes[by[i]]])
    place = np.empty_like(out)
    place[by] = out
    return place


class Numbered:
    """Ranks and the model's ids of texts' words and ends, and the words outside the head.

    ``ends``: where each text's tokens end. ``at``: tokens outside the head;
    each is word ``code`` of ``lost``.
    """

    def __init__(self, texts: list[bytes | None], v: Vocabulary, head: pa.Array):
        words, sizes = _split(texts)
        size, ends = len(v.words), np.cumsum(sizes)
        rank = pc.index_in(words, value_set=head).fill_null(size).to_numpy(zero_copy_only=False)
        self.rank = np.insert(rank, ends, v.end)
        self.ends = ends + np.arange(1, len(ends) + 1)
        self.at = np.flatnonzero(self.rank == size)
        word = np.insert(np.arange(len(words)), ends, len(words))[self.at]
        lost = pa.concat_arrays([words, pa.array([END], pa.binary())]).take(pa.array(word)).dictionary_encode()
        self.lost, self.code = lost.dictionary, lost.indices.to_numpy(zero_copy_only=False)
        self.ids = np.append(v.id_of, 0).astype(np.int32)[self.rank]
        self.ids[self.at] = v.hashed + (crc32s(self.lost) % HASHED).astype(np.int32)[self.code]

    def docs(self) -> list[np.ndarray]:
        return np.split(self.ids, self.ends[:-1])

    def misses(self) -> pa.Array:
        """Each text's words outside the head, and how often it has them."""
        kinds = max(1, len(self.lost))
        row = np.searchsorted(self.ends, self.at, "right")
        pair, n = np.unique(row * kinds + self.code, return_counts=True)
        to = np.searchsorted(pair // kinds, np.arange(len(self.ends) + 1))
        return pa.ListArray.from_arrays(pa.array(to, pa.int32()), pa.StructArray.from_arrays(
            [self.lost.take(pa.array(pair % kinds)), pa.array(n, pa.int32())], names=["word", "n"]))


def _chunks(batches: Iterator[pa.RecordBatch], size: int = CHUNK):
    """Rows (as tuples of a batch's columns) gathered up to ``size`` bytes / 6 of text; a longer one alone."""
    held, n = [], 0
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            more = len(row[-1] or b"") // 6 + 1
            if held and n + more > size:
                yield held
                held, n = [], 0
            held.append(row)
            n += more
            if n >= size:
                yield held
                held, n = [], 0
    if held:
        yield held


def _laned(parts: Iterator[Numbered], size: int = LANED) -> Iterator[list[Numbered]]:
    """Parts gathered up to ``size`` tokens; a longer one alone."""
    held, n = [], 0
    for x in parts:
        if held and n + len(x.ids) > size:
            yield held
            held, n = [], 0
        held.append(x)
        n += len(x.ids)
    if held:
        yield held


def train_round(texts: DataFrame, params: np.ndarray, vocabulary: Vocabulary) -> np.ndarray | None:
    """Average (by tokens) of the models that tasks train on their rows; None without rows."""
    start = texts.sparkSession.sparkContext.broadcast((params, vocabulary))  # bounded by HEAD and the model's size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, v = start.value
        p, adam, seen = lm.Params(flat.copy(), v.shape), lm.Adam(), 0
        head = pa.array(v.words, pa.binary())
        for part in _laned(Numbered([r[-1] for r in rows], v, head) for rows in _chunks(batches)):
            seen += lm.train([d for x in part for d in x.docs()], p, adam)
        if seen:
            moved = (p.flat - flat).astype(np.float16)  # models pass the shuffle as their differences, halved
            blocks = [moved[i:i + BLOCK].tobytes() for i in range(0, len(moved), BLOCK)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(blocks)), pa.int32()), pa.array([seen] * len(blocks), pa.int64()),
                 pa.array(blocks, pa.binary())], names=["block", "tokens", "x"])

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for b in batches:
            for i, n, x in zip(*(c.to_pylist() for c in b.columns)):
                x = np.frombuffer(x, np.float16).astype(np.float64) * n
                if i in total:
                    total[i][0] += n
                    total[i][1] += x
                else:
                    total[i] = [n, x]
        for i, (n, x) in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([n], pa.int64()),
                                              pa.array([(x / n).astype(np.float16).tobytes()], pa.binary())],
                                             names=["block", "tokens", "x"])

    schema = "block int, tokens long, x binary"
    # averages of 32 tasks each first, so that no task adds all tasks' models
    part = (texts.select("text").mapInArrow(run, schema).withColumn("salt", F.floor(F.spark_partition_id() / 32))
            .repartition("block", "salt").select("block", "tokens", "x").mapInArrow(average, schema)
            .repartition("block").mapInArrow(average, schema))
    out, n = params.copy(), 0
    for r in part.collect():  # the model: a bounded size
        x = np.frombuffer(r["x"], np.float16)
        out[r["block"] * BLOCK:r["block"] * BLOCK + len(x)] += x
        n = r["tokens"]
    return out if n else None


ROW_SCHEMA = ("row_no long, doc_id long, held_out boolean, n_tokens long, known long, base double, tail_log double, "
              "model double, misses array<struct<word:binary,n:int>>")


def _score_rows(rows: DataFrame, params: np.ndarray, vocabulary: Vocabulary) -> DataFrame:
    """Per row what the model and the head vocabulary give, and the words left."""
    sent = rows.sparkSession.sparkContext.broadcast((params, vocabulary))  # bounded by HEAD and the model's size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, v = sent.value
        p, size, head = lm.Params(flat, v.shape), len(v.words), pa.array(v.words, pa.binary())
        logs = np.r_[np.log10(v.counts + 1.0), 0.0]

        def numbered() -> Iterator[Numbered]:
            for rows in _chunks(batches):
                x = Numbered([r[-1] for r in rows], v, head)
                begin = np.r_[0, x.ends[:-1]]
                logc = logs[x.rank]
                tail = np.maximum(x.ids - v.shape.short, 0)
                shares = np.where(x.ids < v.shape.short, 0.0, logc - v.rest_log[tail])
                x.columns = [*(pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.bool_()))),
                             pa.array(x.ends - begin, pa.int64()),
                             pa.array(np.add.reduceat(x.rank < size, begin, dtype=np.int64), pa.int64()),
                             pa.array(np.add.reduceat(logc, begin), pa.float64()),
                             pa.array(np.add.reduceat(shares, begin), pa.float64())]
                x.lists = x.misses()
                x.rank = x.at = x.code = x.lost = None
                yield x

        for part in _laned(numbered()):
            docs = [d for x in part for d in x.docs()]
            model = lm.score(docs, p)
            for x in part:
                own, model = model[:len(x.ends)], model[len(x.ends):]
                yield pa.RecordBatch.from_arrays([*x.columns, pa.array(own, pa.float64()), x.lists],
                                                 names=[c.split()[0] for c in ROW_SCHEMA.split(", ")])

    return rows.mapInArrow(run, ROW_SCHEMA)


def score_documents(docs: DataFrame, rounds: int = ROUNDS, head: int = HEAD) -> DataFrame:
    """Unigram and recurrent-model scores of every whole text.

    Learns from documents whose crc32(doc_id as text) mod 7 is not 2. Tokens:
    words (A-Z lower-cased), then one end. Result: doc_id, held_out, n_tokens,
    n_known, train_tokens, base_score (add-one unigram), score (the model),
    both log10 probabilities of the whole text; one row per input row. NULL
    and empty texts are the end alone; a NULL doc_id counts as the empty text
    in the split; without training documents the scores are those of the
    untrained model; an empty table gives an empty result; further columns
    are ignored.
    """
    spark = docs.sparkSession
    prepare(spark)
    crc = remainder(docs["doc_id"].cast("long"))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), (crc % 7 == 2).alias("held_out"), crc.alias("crc"),
                       docs["text"].cast("binary").alias("text"))
    learn = rows.where(~F.col("held_out"))
    counts = cut_lineage(word_counts(learn), "lm-counts")
    tokens, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    hashed = counts.groupBy((F.crc32("word") % HASHED).cast("int").alias("k")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("d")).collect()  # at most HASHED rows
    v = Vocabulary(head_words(counts, head), tokens, distinct, {r["k"]: (r["n"], r["d"]) for r in hashed})
    params = v.first().flat
    for i in range(rounds):
        share = learn.where(F.floor(F.col("crc") / 7) % rounds == i)
        new = train_round(share, params, v)
        params = params if new is None else new
    # row numbers are fixed by being written
    numbered = rows.select(F.monotonically_increasing_id().alias("row_no"), "doc_id", "held_out", "text")
    scored = cut_lineage(_score_rows(numbered, params, v), "lm-scores")
    missed = scored.select("row_no", F.explode("misses").alias("m")).select("row_no", "m.word", F.col("m.n").alias("times"))
    found = missed.join(counts, "word")  # words that training never saw add log10(1) = 0
    extra = found.groupBy("row_no").agg(F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more"),
                                        F.sum("times").alias("more_known"))
    zero = lambda c, x: F.coalesce(F.col(c), F.lit(x))
    all_log = float(np.log10(tokens + distinct + 1.0))
    return scored.drop("misses").join(extra, "row_no", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + zero("more_known", 0)).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + zero("more", 0.0) - F.col("n_tokens") * F.lit(all_log)).alias("base_score"),
        (F.col("model") + F.col("tail_log") + zero("more", 0.0)).alias("score"))
