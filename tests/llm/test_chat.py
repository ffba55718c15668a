import hashlib

from helpers import plain
from hypothesis import given, settings
from hypothesis import strategies as st

from aferir.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, piece string"
PARTS = st.sampled_from(["<s>", "</s>", "[INST] ", "[/INST]", "[", "\\", "<", "/INST]", "[:] ", " ", "a", "[ROLE] ", "[/ROLE]", "\n", "[ANS] "])
TEXTS = st.lists(PARTS, max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "tool[:] "]), TEXTS), max_size=5))
def test_any_conversation_reads_back(turns):
    reader, text, at = chat.Reader(), "", 0
    for role, body in turns:
        text += chat.render(role, body)[0]
    reader.add(text)
    assert reader.n_turns == len(turns) and not reader.rest
    for role, body in turns:
        found_role, found, start, end, at = chat.parse(text, at)
        assert (found_role, found) == (role, body) and chat.unescape(text[start:end]) == body


def test_plain_text_is_not_escaped():
    assert chat.render("user", "hello [x]")[0] == "<s>[INST] hello [x][/INST]"


def test_odd_rows(spark):
    turns = spark.createDataFrame(
        [
            (1, 1, "assistant", "b</s>", "x"),
            (1, 0, "user", "a", "x"),
            (1, 1, "assistant", "b</s>", "x"),
            (2, None, None, None, "x"),
            (None, 0, "tool", "", "x"),
            (3, 0, "assistant", "z" * 100_000, "x"),
        ],
        SCHEMA,
    )
    pieces = chat.format_conversations(turns)
    rows = {r["conv_id"]: r for r in chat.read_back(pieces).collect()}
    digest = lambda *parts: hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in parts).encode()).hexdigest()
    assert rows[1]["turns_sha256"] == digest(("user", "a"), ("assistant", "b</s>"), ("assistant", "b</s>"))
    assert rows[1]["loss_sha256"] == hashlib.sha256(b"b</s>b</s>").hexdigest() and rows[1]["loss_chars"] == 10
    assert rows[2]["turns_sha256"] == digest(("", "")) and rows[2]["n_turns"] == 1
    assert rows[None]["turns_sha256"] == digest(("tool", ""))
    assert rows[3]["loss_chars"] == 100_000
    # The marked stretches of the whole text are the assistant's, with escapes.
    parts = sorted((r for r in pieces.collect() if r["conv_id"] == 1), key=lambda r: r["piece"])
    whole = "".join(r["formatted"] for r in parts)
    assert [chat.unescape(whole[r["loss_start"] : r["loss_end"]]) for r in parts if r["loss_start"]] == ["b</s>", "b</s>"]
    assert plain(chat.recovered_turns(pieces).where("conv_id = 1").select("role", "text")) == [
        ("assistant", "b</s>"), ("assistant", "b</s>"), ("user", "a"),
    ]
    assert plain(chat.read_back(chat.format_conversations(turns.limit(0)))) == []
