"""Chat formatting on tokens.

Every turn's role and text are encoded by themselves and spliced between
reserved ids that no text can produce, so a control string inside a text
stays text. For readers of the rendered string such strings are also escaped,
reversibly. Loss masks are prefix sums of +1 / -1 marks at segment borders.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import prepare

# Markers of this template, and control strings of common ones.
TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
MARKERS = (TURN, SAYS, END)
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>",
           "<|endoftext|>", "<|startoftext|>", "<|turn|>", "<|says|>", "<|end|>")
ESC = "\x1a"
# every ESC of an escaped text is followed by 0 (a real one) or 1 (put into a control string)
_CONTROL = re.compile("|".join(re.escape(c) for c in sorted(CONTROL, key=len, reverse=True)))
_ESCAPED = re.compile(ESC + "([01])")
# the tokenizer's pattern backtracks over a run of white space and overflows near a million characters
RUN = 10_000
_LONG_GAP = re.compile(r"(?<!\s)\s{%d,}" % (RUN + 1))

TURN_SCHEMA = ("conv_id long, turn_no long, role string, input_ids array<int>, loss_mask array<byte>, "
               "first_token long, formatted string")
DIGEST_SCHEMA = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                 "formatted_chars long")


def escape(text: str) -> str:
    text = text.replace(ESC, ESC + "0")
    return _CONTROL.sub(lambda m: m[0][0] + ESC + "1" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: ESC if m[1] == "0" else "", text)


_ENCODINGS: dict[int, object] = {}


def encoding(raw: bytes):
    """tiktoken encoding of a rank file, with the markers as reserved ids above it."""
    key = hash(raw)
    if key not in _ENCODINGS:
        import public_tokenizers
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
        top = max(ranks.values()) + 2
        _ENCODINGS.clear()
        _ENCODINGS[key] = tiktoken.Encoding(
            "chat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
            special_tokens={m: top + i for i, m in enumerate(MARKERS)})
    return _ENCODINGS[key]


def encode(enc, text: str) -> list[int]:
    """Ids of a text; every ``RUN`` characters inside a longer run of white space end a piece."""
    ids, start = [], 0
    for gap in _LONG_GAP.finditer(text):
        for cut in range(gap.start() + RUN, gap.end(), RUN):
            ids += enc.encode_ordinary(text[start:cut])
            start = cut
    return ids + enc.encode_ordinary(text[start:])


def turn_ids(enc, role: str, text: str) -> np.ndarray:
    """Ids of one turn: role and text, escaped and encoded apart, between the markers."""
    turn, says, end = (enc.encode_single_token(m) for m in MARKERS)
    return np.array([turn, *encode(enc, escape(role)), says, *encode(enc, escape(text)), end], np.int32)


def loss_mask(ids: np.ndarray, says: int, learn: bool) -> np.ndarray:
    """1 on the text's tokens of a turn to learn from, by prefix sums of marks at its borders."""
    edges = np.zeros(len(ids) + 1, np.int8)
    if learn:
        edges[np.argmax(ids == says) + 1] += 1
        edges[len(ids) - 1] -= 1
    return np.cumsum(edges[:-1], dtype=np.int8)


def rendered(role: str, text: str) -> str:
    return TURN + escape(role) + SAYS + escape(text) + END


def _broadcast(df: DataFrame, path: str):
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary: size fixed by its file


def format_turns(turns: DataFrame, tokenizer_path: str, learn_role: str = "assistant") -> DataFrame:
    """Token rows of all conversations, a row per turn, in conversation order.

    Result: conv_id, turn_no (0, 1, ... by turn, then role and text), role,
    input_ids, loss_mask (1 on the text tokens of ``learn_role``),
    first_token (place of the row's first token in its conversation),
    formatted (the rendered turn). A conversation is its rows in order of
    turn_no. NULL role or text: empty; NULL conv_ids are one conversation;
    NULL turns come first; repeated rows stay; further columns are ignored.
    Turns are encoded where they are read, before the one shuffle that brings
    conversations together; behind it a task passes through its sorted rows
    holding one batch, and only numbers, masks and renders them. White space
    of more than ``RUN`` characters in a row is encoded in pieces, whose ids
    decode to the same text.
    """
    spark = turns.sparkSession
    prepare(spark)
    raw = _broadcast(turns, tokenizer_path)
    narrow = turns.select(
        turns["conv_id"].cast("long").alias("conv_id"), turns["turn"].cast("long").alias("turn"),
        F.coalesce(turns["role"], F.lit("")).alias("role"), F.coalesce(turns["text"], F.lit("")).alias("text"))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(raw.value)
        for b in batches:
            ids = [turn_ids(enc, r, t) for r, t in zip(b.column("role").to_pylist(), b.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(ids, pa.list_(pa.int32()))], names=[*b.schema.names, "input_ids"])

    ordered = (narrow.mapInArrow(encoded, "conv_id long, turn long, role string, text string, input_ids array<int>")
               .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        says = encoding(raw.value).encode_single_token(SAYS)
        last, number, place = object(), 0, 0
        for b in batches:
            convs, roles, texts = (b.column(c).to_pylist() for c in ("conv_id", "role", "text"))
            column = b.column("input_ids")
            flat, ends = column.flatten().to_numpy(), np.cumsum(column.value_lengths().to_numpy())
            numbers, places, masks = [], [], []
            for c, r, stop, start in zip(convs, roles, ends, [0, *ends[:-1]]):
                if c != last:
                    last, number, place = c, 0, 0
                numbers.append(number)
                places.append(place)
                masks.append(loss_mask(flat[start:stop], says, r == learn_role))
                number += 1
                place += int(stop - start)
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), pa.array(numbers, pa.int64()), b.column("role"), column,
                 pa.array(masks, pa.list_(pa.int8())), pa.array(places, pa.int64()),
                 pa.array([rendered(r, t) for r, t in zip(roles, texts)], pa.string())],
                names=["conv_id", "turn_no", "role", "input_ids", "loss_mask", "first_token", "formatted"])

    return ordered.mapInArrow(run, TURN_SCHEMA)


def read_turn(enc, ids: list[int], mask: list[int]) -> tuple[str, str, str]:
    """Role, text and text under the loss mask, from the token output alone."""
    turn, says, end = (enc.encode_single_token(m) for m in MARKERS)
    if ids[0] != turn or ids[-1] != end:
        raise ValueError("not a turn")
    cut = ids.index(says)
    read = lambda part: unescape(enc.decode_bytes(part).decode())
    return read(ids[1:cut]), read(ids[cut + 1:-1]), read([i for i, m in zip(ids, mask) if m])


def read_back(rows: DataFrame, tokenizer_path: str) -> DataFrame:
    """Digests of conversations, read back from ``format_turns`` rows.

    ``rows`` must hold conversations together and in order, as
    ``format_turns`` returns them. Texts stream through the hashes, so a
    conversation of any length needs the memory of one batch.
    """
    raw = _broadcast(rows, tokenizer_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(raw.value)
        names = [x.split()[0] for x in DIGEST_SCHEMA.split(", ")]
        state, done = None, []

        def close() -> None:
            if state:
                done.append((state["conv"], state["n"], state["turns"].hexdigest(), state["chars"],
                             state["loss"].hexdigest(), state["formatted"]))

        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("conv_id", "turn_no", "input_ids", "loss_mask", "formatted")]
            for conv, number, ids, mask, shown in zip(*cols):
                if number == 0:
                    close()
                    state = {"conv": conv, "n": 0, "turns": hashlib.sha256(), "chars": 0,
                             "loss": hashlib.sha256(), "formatted": 0}
                role, text, learnt = read_turn(enc, ids, mask)
                state["n"] += 1
                state["turns"].update(f"{role}\n{text}\n".encode())
                state["loss"].update(learnt.encode())
                state["chars"] += len(learnt)
                state["formatted"] += len(shown)
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(names, d)) for d in done], pa_schema)
                done = []
        close()
        yield pa.RecordBatch.from_pylist([dict(zip(names, d)) for d in done], pa_schema)

    pa_schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                           ("loss_chars", pa.int64()), ("loss_sha256", pa.string()),
                           ("formatted_chars", pa.int64())])
    return rows.mapInArrow(run, DIGEST_SCHEMA)
