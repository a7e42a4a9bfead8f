"""Token counts by rank-synchronous merging of ragged arrays.

All new pre-tokens of a batch lie in one flat array of symbol ids with their
sequence numbers. Each round finds every sequence's lowest merge rank and
applies that pair to all its places at once, left to right; sequences without
a mergeable pair leave the arrays with their symbol counts. The number of
rounds is the longest merge chain, not the number of pre-tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tabforge.llm.bpe import Memo, PairRanks, parsed
from tabforge.llm.common import prepare

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def count_symbols(sequences: list[list[int]], pairs: PairRanks) -> np.ndarray:
    """Number of symbols left of each sequence after all merges."""
    lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
    counts = lengths.copy()
    sym = np.fromiter((s for q in sequences for s in q), np.int64, int(lengths.sum()))
    seq = np.repeat(np.arange(len(sequences)), lengths)
    # rank and merged id of each symbol with its right neighbour
    rank, new = np.full(len(sym), PairRanks.NONE), np.zeros(len(sym), np.int64)

    def look(at: np.ndarray) -> None:
        inside = at[(at >= 0) & (at + 1 < len(sym))]
        rank[at[at >= 0]] = PairRanks.NONE
        inside = inside[seq[inside] == seq[inside + 1]]
        rank[inside], new[inside] = pairs.of(sym[inside], sym[inside + 1])

    look(np.arange(len(sym)))
    while len(sym):
        starts = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
        sizes = np.diff(np.r_[starts, len(sym)])
        best = np.repeat(np.minimum.reduceat(rank, starts), sizes)
        counts[seq[starts]] = sizes
        live = best < PairRanks.NONE
        if not live.all():
            sym, seq, rank, new, best = (a[live] for a in (sym, seq, rank, new, best))
            if not len(sym):
                break
        hit = rank == best
        # of overlapping places (a a a) the leftmost, then every second one
        run = np.flatnonzero(hit)
        if len(run) > 1 and (np.diff(run) == 1).any():
            begins = np.r_[True, (np.diff(run) != 1)]
            first = run[np.flatnonzero(begins)][np.cumsum(begins) - 1]
            run = run[(run - first) % 2 == 0]
        sym[run] = new[run]
        keep = np.ones(len(sym), bool)
        keep[run + 1] = False
        at = np.cumsum(keep)[run] - 1
        sym, seq, rank, new = (a[keep] for a in (sym, seq, rank, new))
        look(np.unique(np.r_[at - 1, at]))
    return counts


class Counter:
    """Token counts of texts, with a bounded memory of chunk counts."""

    def __init__(self, raw: bytes, memo: int):
        self.bpe = parsed(raw)
        self.pairs = PairRanks(self.bpe)
        self.memo = Memo(memo)

    def learn(self, chunks: set[str]) -> None:
        owners, sequences = [], []
        need = self.memo.missing(chunks)
        totals = dict.fromkeys(need, 0)
        for c in need:
            for p in self.bpe.pre_tokens(c):
                if isinstance(p, int):
                    totals[c] += 1
                else:
                    owners.append(c)
                    sequences.append(self.bpe.symbols(p))
        if sequences:
            for c, n in zip(owners, count_symbols(sequences, self.pairs).tolist()):
                totals[c] += n
        self.memo.young.update(totals)

    def counts(self, texts: list[str], group: int = 200_000) -> list[int]:
        """``group``: chunks prepared together; bounds the arrays, not the texts."""
        out, held, held_words, held_docs = [], [], set(), 0

        def flush() -> None:
            nonlocal held_docs
            self.learn(held_words)
            get = self.memo.young.__getitem__
            out.extend(sum(map(get, words)) for words in held)
            held.clear()
            held_words.clear()
            held_docs = 0

        for t in texts:
            words = self.bpe.chunks(t)
            held.append(words)
            held_words.update(words)
            held_docs += len(words)
            if held_docs >= group:
                flush()
        flush()
        return out


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 2048, memo: int = 500_000) -> DataFrame:
    """Tokens of every whole text, as the ``tokenizers`` library counts them.

    Result: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit),
    one row per input row (repeated rows repeat). NULL and empty texts have 0
    bytes and tokens; a NULL doc_id stays NULL; an empty table gives an empty
    result; further columns of ``docs`` are ignored. No shuffle: each task
    reads its split; ``memo`` bounds the chunk counts it remembers.
    """
    prepare(docs.sparkSession)
    with open(tokenizer_path, "rb") as f:
        raw = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary: size fixed by its file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(raw.value, memo)
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            n = counter.counts(texts)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(t.encode()) for t in texts], pa.int64()),
                 pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    return narrow.mapInArrow(run, SCHEMA)
