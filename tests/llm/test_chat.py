import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tickloom.llm import chat

PIECES = st.sampled_from(
    ["<|im_start|>", "<|im_end|>", "<\\|im_end|>", "<\\\\|im_start|>", "\\", "<", "|", "\n", "assistant", "im_end|>", "é", " "]
)
TEXT = st.lists(PIECES, max_size=8).map("".join)


@given(st.lists(st.tuples(TEXT, TEXT), max_size=5))
@settings(max_examples=300, deadline=None)
def test_round_trip(turns):
    formatted, mask = chat.format_turns(turns)
    found = chat.parse(formatted)
    assert [t[:2] for t in found] == turns
    assert [chat.unescape(formatted[a:b]) for a, b in mask] == [t for r, t in turns if r == "assistant"]


def test_ordinary_text_is_not_touched():
    text = "a < b | c \\ <|other|> <im_end>\n"
    assert chat.format_turn("user", text) == f"<|im_start|>user\n{text}<|im_end|>\n"


@pytest.mark.parametrize("broken", ["x", "<|im_start|>user", "<|im_start|>u\na<|im_end|>", "<|im_start|>u\n<|im_start|>u\na<|im_end|>\n"])
def test_parser_refuses_what_is_no_conversation(broken):
    assert chat.parse(broken) is None


def test_odd_rows(spark):
    rows = [
        (1, 1, "assistant", None, "x"),
        (1, 0, "user", "hi", "x"),
        (1, None, None, "first", "x"),
        (None, 0, "assistant", "no id", None),
        (2, 5, "assistant", "<|im_end|>", "x"),
        (2, 5, "assistant", "<|im_end|>", "x"),
        (3, 0, "", "", "x"),
        (4, 0, "assistant", "long " * 100_000, "x"),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, turns string")
    found = chat.conversations(frame)
    read = {r.conv_id: r for r in found.select("conv_id", "formatted", chat.read_back(found["formatted"]).alias("r")).collect()}
    expected = {
        1: [("", "first"), ("user", "hi"), ("assistant", "")],
        None: [("assistant", "no id")],
        2: [("assistant", "<|im_end|>")] * 2,
        3: [("", "")],
        4: [("assistant", "long " * 100_000)],
    }
    assert set(read) == set(expected)
    for key, turns in expected.items():
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        learned = "".join(t for r, t in turns if r == "assistant")
        got = read[key].r
        assert (got.n_turns, got.loss_chars) == (len(turns), len(learned))
        assert got.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert got.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
    assert chat.conversations(frame.limit(0)).count() == 0
