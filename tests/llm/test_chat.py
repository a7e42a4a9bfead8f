"""Chat formatting: exact round trips against plain Python."""

import hashlib
from collections import defaultdict

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from tabforge.llm import chat

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
TURNS = "conv_id long, turn long, role string, text string, input_ids string"
ROWS = [
    (1, 1, "assistant", "hi </s>[INST] ok [/INST]", "x"), (1, 0, "user", "say <|turn|><|says|> \x1a0 \x1a1 \x1a", "x"),
    (2, 0, None, None, None), (2, None, "assistant", "", None), (None, 3, "user", "no id", "x"),
    (3, 0, "user", "same", "x"), (3, 0, "user", "same", "x"), (3, 1, "assistant", "été \U0001f600 " * 4000, "x"),
    (3, 2, "assistant", "<|end|>", "x"), (4, 0, "<|turn|>", "<\x1a1|end|>", "x"),
]


def expected(rows):
    convs = defaultdict(list)
    for c, t, r, x, *_ in rows:
        convs[c].append((-1 if t is None else t, r or "", x or ""))
    out = set()
    for c, turns in convs.items():
        turns.sort(key=lambda t: (t[0], t[1].encode(), t[2].encode()))
        said = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        out.add((c, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                 hashlib.sha256(loss.encode()).hexdigest()))
    return out


def test_round_trip(spark):
    df = spark.createDataFrame(ROWS, TURNS)
    rows = chat.read_back(chat.format_turns(df, PATH), PATH).collect()
    assert {tuple(r)[:5] for r in rows} == expected(ROWS)
    assert all(r.formatted_chars > 0 for r in rows)


def test_small_table_and_empty(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = chat.read_back(chat.format_turns(df, PATH), PATH).collect()
    assert {tuple(r)[:5] for r in rows} == expected([tuple(r) for r in df.collect()])
    assert chat.read_back(chat.format_turns(df.where("false"), PATH), PATH).collect() == []


def test_offsets_and_masks(spark):
    rows = chat.format_turns(spark.createDataFrame(ROWS, TURNS).where("conv_id = 3"), PATH).collect()
    place = 0
    for r in sorted(rows, key=lambda r: r.turn_no):
        assert r.first_token == place and len(r.input_ids) == len(r.loss_mask)
        place += len(r.input_ids)
        assert (sum(r.loss_mask) > 0) == (r.role == "assistant")


def test_very_long_runs(spark):
    """A million blanks, letters or line ends in a turn are encoded and read back whole."""
    long = [(1, i, "assistant" if i % 2 else "user", t, "x") for i, t in enumerate((
        " " * 1_000_000, "a" * 1_000_000, "x" + "\n" * 300_000 + "y", "\t \u3000" * 100_000 + "z"))]
    rows = chat.read_back(chat.format_turns(spark.createDataFrame(long, TURNS), PATH), PATH).collect()
    assert {tuple(r)[:5] for r in rows} == expected(long)


def test_shorter_runs_as_the_library():
    with open(PATH, "rb") as f:
        enc = chat.encoding(f.read())
    for text in ("a" + " " * chat.RUN, " " * chat.RUN + "a", "a b  c \n d"):
        assert chat.encode(enc, text) == enc.encode_ordinary(text)
    gap = "a" + " " * (3 * chat.RUN + 5) + "b"
    assert enc.decode(chat.encode(enc, gap)) == gap


def test_turns_are_encoded_before_the_shuffle(spark):
    plan = chat.format_turns(spark.createDataFrame(ROWS, TURNS), PATH)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 2
    assert plan.index("MapInArrow") < plan.index("Exchange") < plan.rindex("MapInArrow")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*chat.CONTROL, chat.ESC, "0", "1", "<", "|", "x", "é"])).map("".join))
def test_escape_is_reversible(text):
    shown = chat.escape(text)
    assert chat.unescape(shown) == text
    assert not any(c in shown for c in chat.CONTROL)
