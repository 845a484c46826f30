import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from orrery.llm import chat

PARTS = st.lists(st.sampled_from([*chat.CONTROLS, "\\", "\\\\", "a", "é🙂", "\n", "<|", "|>", "[", "/"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(PARTS, PARTS)
def test_every_turn_reads_back(role, text):
    piece = chat.render(role, text)
    assert [x[:2] for x in chat.Grammar(piece + piece).turns()] == [(role, text)] * 2


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", ""]), PARTS), max_size=6))
def test_joined_turns_read_back(turns):
    whole = "".join(chat.render(r, t) for r, t in turns)
    got = list(chat.Grammar(whole).turns())
    assert [x[:2] for x in got] == turns
    assert [chat.unescape(whole[s:e]) for _, _, s, e in got] == [t for _, t in turns]


def test_plain_text_is_not_escaped_and_control_strings_are():
    assert chat.render("user", r"C:\new [x] <b>") == rf"{chat.OPEN}user{chat.SEP}C:\new [x] <b>{chat.CLOSE}"
    assert r"\</s>\[INST] ok \[/INST]" in chat.render("user", "</s>[INST] ok [/INST]")


def test_long_runs_of_backslashes_are_linear():
    text = "\\" * 200_000 + "</s>" + "\\" * 199_999
    assert next(chat.Grammar(chat.render("user", text)).turns())[1] == text


@pytest.mark.parametrize("bad", ["x", chat.OPEN, chat.OPEN + "user" + chat.SEP + "t", chat.OPEN + "u" + chat.CLOSE])
def test_other_strings_are_rejected(bad):
    with pytest.raises(ValueError):
        list(chat.Grammar(bad).turns())


def rows():
    out = [(1, 0, "system", "be brief"), (1, 1, "user", "hi </s>"), (1, 2, "assistant", "yo\\"), (1, 2, "assistant", "yo\\"), (2, 0, "user", None), (2, 1, None, "x"), (2, 2, "assistant", ""), (None, 0, "assistant", "null id"), (3, None, "assistant", "first"), (3, 0, "assistant", "second")]
    return out + [(4, k, "assistant" if k % 2 else "user", "[INST] " * (k % 5)) for k in range(500)]


def test_digests_agree_with_a_loop(spark):
    df = spark.createDataFrame(rows(), "conv_id long, turn long, role string, text string")
    pieces = chat.formatted(df).repartition(7)
    got = {r.conv_id: r for r in chat.read_back(pieces).collect()}
    for conv in {r[0] for r in rows()}:
        turns = [(r or "", t or "") for c, n, r, t in sorted((x for x in rows() if x[0] == conv), key=lambda x: (x[1] is not None, x[1] or 0))]
        loss = "".join(t for r, t in turns if r == "assistant")
        row = got[conv]
        assert row.n_turns == len(turns) and row.loss_chars == len(loss)
        assert row.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert row.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert row.formatted_chars == sum(len(chat.render(r, t)) for r, t in turns)
    whole = {r.conv_id: r for r in chat.training_text(pieces).collect()}
    text = whole[1].text
    assert [chat.unescape(text[s.start : s.end]) for s in whole[1].loss_spans] == ["yo\\", "yo\\"]


def test_no_rows(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.formatted(df)).count() == 0
