"""Chat formatting against a plain version, and what is read back."""

import hashlib

import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from stockloom.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def plain(rows):
    """rows in order of a conversation's turns."""
    convs, out = {}, []
    for c, _, role, text in rows:
        convs.setdefault(c, []).append((role or "", text or ""))
    machine = chat.Machine()
    for c, turns in convs.items():
        state = machine.first
        chars = 0
        for role, text in turns:
            state = machine.step(state, role)
            chars += len("<|im_start|>" + chat.escape_role(role) + "\n" + chat.escape(text) + "<|im_end|>\n")
        learned = "".join(t for r, t in turns if r == "assistant")
        out.append((c, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learned), sha(learned), chars,
                    state != "error", state == "assistant"))
    return sorted(out, key=repr)


def result(df, **more):
    return sorted(map(tuple, chat.conversation_report(chat.format_conversations(df, **more), **more).collect()), key=repr)


PIECES = st.lists(st.sampled_from(["<", "|", "\\", "<|", "<|im_end|>", "\n", "a", "é", "|>", "<\\|", "<|im_start|>assistant"]), max_size=8)


@given(PIECES.map("".join))
def test_escape_is_reversible_and_hides_control_strings(text):
    assert chat.unescape(chat.escape(text)) == text
    assert "<|" not in chat.escape(text)
    assert chat.unescape_role(chat.escape_role(text)) == text
    assert "\n" not in chat.escape_role(text)
    template = chat.Template()
    formatted = "".join(s for s, _ in chat.format_turn(template, text, text))
    assert chat.read_turn(template, formatted) == (text, text)
    assert formatted.count("<|im_start|>") == formatted.count("<|im_end|>") == 1


def test_escapes_are_one_to_one():
    texts = {"".join(p) for p in __import__("itertools").product("<|\\", repeat=5)}
    assert len({chat.escape(t) for t in texts}) == len(texts)


def test_odd_rows(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", None), (1, 2, "assistant", "<|im_end|>"), (2, 0, "assistant", "early"), (2, 1, "user", ""),
            (3, 0, "user", "u"), (3, 1, "robot\n<|x", "t"), (3, 2, "assistant", "a"), (4, 0, None, "x"),
            (5, None, "user", "first"), (5, 3, "assistant", "x" * 300_000), (None, 0, "user", "a"), (None, 1, "assistant", "b")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = result(df)
    assert got == plain(rows)
    assert result(df.repartition(5)) == got
    assert {r[0]: r[6:] for r in got} == {1: (True, True), 2: (False, False), 3: (False, False), 4: (False, False), 5: (True, True), None: (True, True)}


def test_ties_go_by_role_then_text_and_repeated_rows_stay(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "assistant", "a"), (1, 0, "user", "b")]
    got = result(spark.createDataFrame(rows, SCHEMA))
    assert got == plain([rows[1], rows[0], rows[0]])


@pytest.mark.parametrize("broken", [None, 0, 1, 700, 1_999])
def test_one_conversation_over_many_ranges(spark, broken):
    """The machine's state reaches a turn through all ranges before it."""
    rows = [(9, i, ("assistant" if i % 2 else "user") if i != broken else "system", f"t{i}") for i in range(2_000)]
    rows += [(c, i, r, "x") for c in range(8) for i, r in enumerate(("user", "assistant"))] + [(10, 0, "user", "end")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    turns = chat.format_conversations(df)
    assert turns.where("conv = 9").select("part").distinct().count() > 1
    assert result(df) == plain(sorted(rows))
    states = [r["state"] for r in turns.where("conv = 9").orderBy("part", "place").collect()]
    machine, state = chat.Machine(), "start"
    for (_, _, role, _), got in zip(rows, states):
        state = machine.step(state, role)
        assert got == state


def test_template_and_machine_are_data(spark):
    loud = (chat.Segment("<|im_start|>"), chat.Segment(field=chat.ROLE), chat.Segment("\n"), chat.Segment(field=chat.TEXT, loss=True), chat.Segment("<|im_end|>\n"))
    template = chat.Template(roles={"user": loud})
    machine = chat.Machine(first="a", error="dead", moves={("a", "user"): "b", ("b", "user"): "a"}, last=("a",))
    rows = [(1, 0, "user", "x"), (1, 1, "user", "yy"), (2, 0, "user", "x"), (3, 0, "assistant", "x")]
    turns = chat.format_conversations(spark.createDataFrame(rows, SCHEMA), template, machine)
    got = {r["conv_id"]: (r["loss_chars"], r["valid"], r["complete"]) for r in chat.conversation_report(turns, template, machine).collect()}
    assert got == {1: (3, True, True), 2: (1, True, False), 3: (0, False, False)}


def test_empty_and_clashing_columns(spark):
    assert result(spark.createDataFrame([], SCHEMA)) == []
    rows = [(1, 0, "user", "u"), (1, 1, "assistant", "a")]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("conv", "part", "place", "copy", "text_key", "formatted", "state", "after", "lengths", "first", "end"):
        df = df.withColumn(c, F.lit("x"))
    assert result(df) == plain(rows)


def test_a_damaged_turn_is_an_error():
    with pytest.raises(ValueError):
        chat.read_turn(chat.Template(), "<|im_start|>user\nx<|im_end|>\n<|im_start|>user\ny<|im_end|>\n")
