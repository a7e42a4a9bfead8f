"""Token counts and BPE codec against the tokenizers library."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
from llm_cases import NASTY, empty, nasty, small  # noqa: F401
from tokenizers import Tokenizer

from tabforge.llm import bpe_codec, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
RAW = open(PATH, "rb").read()


def expected(docs):
    out = Counter()
    for i, t in docs:
        ids = LIBRARY.encode(t or "", add_special_tokens=False).ids
        text = LIBRARY.decode(ids, skip_special_tokens=False)
        out[(i, len((t or "").encode()), len(ids), len(ids) > 2048, hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
             hashlib.sha256(text.encode()).hexdigest())] += 1
    return out


def check(df):
    want = expected([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])
    counts = token_counts.token_counts(df, PATH).collect()
    assert Counter(map(tuple, counts)) == sum(
        (Counter({k[:4]: n}) for k, n in want.items()), Counter())
    codec = bpe_codec.round_trip(df, PATH).collect()
    assert Counter(map(tuple, codec)) == sum((Counter({(k[0], k[2], k[4], k[5]): n}) for k, n in want.items()), Counter())


def test_small(small):
    check(small)


def test_nasty_and_empty(nasty, empty):
    check(nasty)
    assert token_counts.token_counts(empty, PATH).collect() == []
    assert bpe_codec.round_trip(empty, PATH).collect() == [] and bpe_codec.encode(empty, PATH).collect() == []


def test_odd_strings():
    r = random.Random(1)
    chars = list("abcABC'sStT .,!<|>\x1c\x00\x7f̈́̀ͅéeΣσς 　Ⅷ½१_1İ")
    texts = ["a<|endoftext|>b <|startoftext|>", "<|ENDOFTEXT|>", "I'm we'LL", "Å क़", " <|endoftext|><|endoftext|>"]
    texts += ["".join(r.choice(chars) for _ in range(r.randint(0, 60))) for _ in range(2000)]
    want = [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
    assert token_counts.Counter(RAW, 50).counts(texts, group=20) == [len(w) for w in want]  # memory turns over
    codec = bpe_codec.Codec(RAW, 50)
    assert [codec.ids(t).tolist() for t in texts] == want


def test_long_chunks_are_not_remembered():
    codec = bpe_codec.Codec(RAW, 1000)
    texts = ["x" * 5000, "\u65e5\u672c\u8a9e" * 100, "short words and " + "y" * 70, "a" * 64 + " " + "b" * 65]
    for t in texts * 2:
        assert codec.ids(t).tolist() == LIBRARY.encode(t, add_special_tokens=False).ids
    assert max(map(len, codec.memo.young)) <= bpe_codec.LONG and max(map(len, codec.parts.young)) <= bpe_codec.LONG


def test_merge_keeps_the_first_of_equal_ranks():
    """Queue entries whose place has changed since are stale; a run of one symbol merges from the left."""
    from tabforge.llm.bpe_codec import merge

    merges = {1 << 16 | 1: 0 << 16 | 2, 2 << 16 | 1: 1 << 16 | 3, 2 << 16 | 2: 2 << 16 | 4, 4 << 16 | 3: 3 << 16 | 5}
    for n, want in ((1, [1]), (2, [2]), (3, [3]), (4, [4]), (5, [2, 3]), (7, [5]), (8, [4, 4]), (9, [4, 2, 3])):
        assert merge([1] * n, merges) == want


def test_memo_moves_entries_back():
    from tabforge.llm.bpe import Memo

    m = Memo(3)
    for c in m.missing({"a", "b"}):
        m.young[c] = c
    assert sorted(m.missing({"a", "c", "d"})) == ["c", "d"] and m.has("a") and m.has("b") and not m.has("c")


def test_merge_looks_up_each_pair_once():
    """Stale queue entries are told by their place alone: two lookups a merge beside the first ones."""
    from tabforge.llm.bpe_codec import merge

    class Counted(dict):
        looked = 0

        def get(self, *a):
            self.looked += 1
            return super().get(*a)

    merges = Counted({1 << 16 | 1: 0 << 16 | 2, 2 << 16 | 2: 1 << 16 | 3})
    assert merge([1] * 16, merges) == [3] * 4
    assert merges.looked <= 15 + 2 * 12


def test_batches_are_encoded_in_slices():
    """What a task makes of a batch is bounded by bytes of text, and a longer text goes alone."""
    import pyarrow as pa

    texts = ["a b", None, "", "x" * 40, "c d", "e" * 9, "f"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(texts)], names=["doc_id", "text"])
    parts = [p.column("text").to_pylist() for p in bpe_codec._slices(batch, 10)]
    assert [t for p in parts for t in p] == texts and parts == [["a b", None, ""], ["x" * 40], ["c d"], ["e" * 9, "f"]]
    assert list(bpe_codec._slices(batch.slice(0, 0), 10)) == []


def test_a_chunk_of_one_pre_token_is_remembered_once():
    codec = bpe_codec.Codec(RAW, 1000)
    codec.ids("internationalization words")
    for c in ("internationalization", "words"):
        assert codec.memo.young[c] is codec.parts.young[c.encode()]
