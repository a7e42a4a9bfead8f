"""BPE encoding and decoding.

Encoding keeps a pre-token's symbols in a doubly linked list and its possible
merges in a priority queue of (rank, place); entries whose symbols have
changed since are stale and skipped. Decoding joins vocabulary strings.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator, Sequence
from heapq import heapify, heappop, heappush
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tabforge.llm.bpe import Bpe, Memo, parsed
from tabforge.llm.common import prepare

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def merge(ids: list[int], merges: dict[int, int]) -> list[int]:
    """Apply merges to the symbols, lowest rank first, leftmost first.

    A queue entry packs (rank, merged id, place); it is stale if the pair now
    at its place would merge differently or not at all.
    """
    n = len(ids)
    if n < 2:
        return ids
    get = merges.get
    # merge of each symbol with the next one, -1 without: an entry of the queue is stale if its place has another
    now = [get(left << 16 | right, -1) for left, right in zip(ids, ids[1:])]
    queue = [m << 32 | i for i, m in enumerate(now) if m >= 0]
    if not queue:
        return ids
    now.append(-1)
    after = [*range(1, n), -1]
    before = [*range(-1, n - 1)]
    heapify(queue)
    while queue:
        entry = heappop(queue)
        i, m = entry & 0xFFFFFFFF, entry >> 32
        if now[i] != m:  # stale
            continue
        j = after[i]
        new = ids[i] = m & 0xFFFF
        ids[j] = now[j] = -1
        k = after[i] = after[j]
        if k >= 0:
            before[k] = i
            m = now[i] = get(new << 16 | ids[k], -1)
            if m >= 0:
                heappush(queue, m << 32 | i)
        else:
            now[i] = -1
        h = before[i]
        if h >= 0:
            m = now[h] = get(ids[h] << 16 | new, -1)
            if m >= 0:
                heappush(queue, m << 32 | h)
    return [x for x in ids if x >= 0]


def decode(bpe: Bpe, ids: Sequence[int]) -> str:
    """Vocabulary strings with a blank between: what a file without decoder means."""
    return " ".join(map(bpe.tokens.__getitem__, ids))


# Longer chunks and pre-tokens are computed each time: at most about 500 bytes a remembered entry.
LONG = 64
SLICE = 1 << 20  # bytes of text encoded together: what a batch's lists and columns take beside the batch


_ids_of = itemgetter(0)


def _joined(pieces: list[tuple[bytes, str]]) -> tuple[bytes, str]:
    """Ids and decoded text of a whole text."""
    ids, shown = zip(*pieces) if pieces else ((), ())
    return b"".join(ids), " ".join(shown)


class Codec:
    """Encoder and decoder with a bounded memory by chunk."""

    def __init__(self, raw: bytes, memo: int):
        self.bpe = parsed(raw)
        self.memo = Memo(memo)
        self.parts = Memo(memo)

    def _piece(self, ids: Sequence[int]) -> tuple[bytes, str]:
        return struct.pack(f"<{len(ids)}I", *ids), decode(self.bpe, ids)

    def encode(self, chunk: str) -> tuple[bytes, str]:
        """One chunk's ids as little-endian uint32 and decoded string; its pre-tokens
        are often known from other chunks, and a chunk that is one shares its piece."""
        pre = self.bpe.pre_tokens(chunk)
        if len(pre) == 1 and isinstance(pre[0], bytes) and len(pre[0]) <= LONG:  # most chunks
            p = pre[0]
            if not self.parts.has(p):
                self.parts.young[p] = self._piece(merge(self.bpe.symbols(p), self.bpe.merges))
            return self.parts.young[p]
        long: dict[bytes, tuple[bytes, str]] = {}
        for p in self.parts.missing({p for p in pre if isinstance(p, bytes) and len(p) <= LONG}):
            self.parts.young[p] = self._piece(merge(self.bpe.symbols(p), self.bpe.merges))
        young = self.parts.young
        for p in pre:
            if isinstance(p, bytes) and len(p) > LONG and p not in long:
                long[p] = self._piece(merge(self.bpe.symbols(p), self.bpe.merges))
        return _joined([(young.get(p) or long[p]) if isinstance(p, bytes) else self._piece((p,)) for p in pre])

    def pieces(self, text: str) -> list[tuple[bytes, str]]:
        """Per chunk with tokens: ids as little-endian uint32, decoded string."""
        chunks = self.bpe.chunks(text)
        need = self.memo.missing(set(chunks))
        young, long = self.memo.young, {}
        for c in need:
            # only short chunks are remembered, so the memory is bounded in bytes too
            (young if len(c) <= LONG else long)[c] = self.encode(c)
        found = [young.get(c) or long[c] for c in chunks] if long else map(young.__getitem__, chunks)
        return list(filter(_ids_of, found))

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(p[0] for p in self.pieces(text)), "<u4")


def _slices(batch: pa.RecordBatch, size: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of at most ``size`` bytes of text (a longer text goes alone)."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def _rows(docs: DataFrame, tokenizer_path: str, memo: int, make, schema: str) -> DataFrame:
    prepare(docs.sparkSession)
    with open(tokenizer_path, "rb") as f:
        raw = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary: size fixed by its file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(raw.value, memo)
        for b in (part for whole in batches for part in _slices(whole)):
            cols = make(codec, b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *cols.values()], names=["doc_id", *cols])

    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    return narrow.mapInArrow(run, schema)


def encode(docs: DataFrame, tokenizer_path: str, memo: int = 150_000) -> DataFrame:
    """Token ids of every whole text, and their decoded text's digest.

    Result: doc_id, n_tokens, input_ids array<int>, decoded_sha256. NULL and empty texts give an empty list; NULL doc_ids stay; repeated rows
    repeat; further columns of ``docs`` are ignored. No shuffle.
    """
    def make(codec: Codec, texts: list) -> dict:
        ids, dec = [], []
        for t in texts:
            packed, shown = _joined(codec.pieces(t or ""))
            ids.append(packed)
            dec.append(hashlib.sha256(shown.encode()).hexdigest())
        n = np.array([len(x) // 4 for x in ids], np.int64)
        flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)], pa.int32()), pa.array(flat, pa.int32()))
        return {"n_tokens": pa.array(n), "input_ids": lists, "decoded_sha256": pa.array(dec, pa.string())}

    return _rows(docs, tokenizer_path, memo, make,
                 "doc_id long, n_tokens long, input_ids array<int>, decoded_sha256 string")


def round_trip(docs: DataFrame, tokenizer_path: str, memo: int = 400_000) -> DataFrame:
    """Encode every whole text, decode the ids, and return digests of both.

    Result: doc_id, n_tokens, ids_sha256 (ids as little-endian uint32),
    decoded_sha256 (UTF-8), one row per input row. NULL and empty texts have
    no tokens and decode to the empty text; further columns are ignored.
    """
    def make(codec: Codec, texts: list) -> dict:
        n, enc, dec = [], [], []
        for t in texts:
            ids, shown = _joined(codec.pieces(t or ""))
            n.append(len(ids) // 4)
            enc.append(hashlib.sha256(ids).hexdigest())
            dec.append(hashlib.sha256(shown.encode()).hexdigest())
        return {"n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(enc, pa.string()),
                "decoded_sha256": pa.array(dec, pa.string())}

    return _rows(docs, tokenizer_path, memo, make, SCHEMA)
