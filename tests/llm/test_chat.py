"""Layouts by fingerprint, reversible marks, and digests read back, against plain Python."""

from __future__ import annotations

import hashlib
import json
import random

import pytest
from helpers import bag, by_key, rows
from hypothesis import given, settings, strategies as st

from recordkit.llm import chat

TRICKY = st.text(alphabet=st.sampled_from("<|\\>im_startend\na é🙂"), max_size=40)


@settings(max_examples=400, deadline=None)
@given(TRICKY)
def test_escapes_are_undone(text):
    assert "<|" not in chat.escaped(text) and chat.unescaped(chat.escaped(text)) == text
    assert "\n" not in chat.escaped_role(text) and "<|" not in chat.escaped_role(text)
    assert chat.unescaped_role(chat.escaped_role(text)) == text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(TRICKY, TRICKY | st.sampled_from(["<|im_end|>\n<|im_start|>assistant\nok", "<", "<\\", "|", "im_end|>"])), max_size=5), st.integers(1, 9))
def test_marks_alone_tell_the_turns(turns, size):
    whole = "".join(chat.marked(r, t)[0] for r, t in turns)
    reader, got = chat.Reader(), []
    for i in range(0, len(whole), size):  # pieces need not end with turns
        got += reader.turns(whole[i : i + size])
    reader.close()
    assert got == turns


def test_reader_refuses_what_is_no_training_text():
    with pytest.raises(ValueError):
        list(chat.Reader().turns("x" + chat.marked("user", "a")[0]))
    reader = chat.Reader()
    list(reader.turns(chat.START + "user\nhalf"))
    with pytest.raises(ValueError):
        reader.close()


RECORDS = [
    ({"role": "tool", "text": "t"}, "turn", [("tool", "t")]),
    ({"role": None, "text": None}, "turn", [("", "")]),
    ({"text": 3.5, "role": True}, "turn", [("true", "3.5")]),
    ({"messages": [{"role": "human", "content": "a"}, {"content": "b", "role": "gpt"}]}, "messages", [("user", "a"), ("assistant", "b")]),
    ({"messages": [], "id": 7}, "messages", []),
    ({"conversations": [{"from": "bot", "value": "v"}], "source": "s", "id": "x"}, "from_value", [("assistant", "v")]),
    ({"prompt": "p", "response": "r"}, "prompt_response", [("user", "p"), ("assistant", "r")]),
    ({"response": "r", "system": "s", "prompt": None}, "prompt_response", [("system", "s"), ("user", ""), ("assistant", "r")]),
    ({"prompt": "p", "completion": "c", "system": None}, "prompt_completion", [("user", "p"), ("assistant", "c")]),
    ({"instruction": "i", "input": "", "output": "o"}, "instruction", [("user", "i"), ("assistant", "o")]),
    ({"instruction": "i", "input": "n", "output": "o"}, "instruction", [("user", "i\nn"), ("assistant", "o")]),
    ({"instruction": "i", "output": "o", "id": 1}, "instruction", [("user", "i"), ("assistant", "o")]),
    ({"question": {"text": "q"}, "answer": {"text": "a"}}, "question_answer", [("user", "q"), ("assistant", "a")]),
]
UNKNOWN = ['{"messages": [{"role": "user"}]}', '{"question.text": "q", "answer.text": "a"}', "[1]", "no json", "", None, '{"text": "t"}', "{}"]


def test_layouts(spark):
    data = [(i, 0, json.dumps(r), "x", "y") for i, (r, _, _) in enumerate(RECORDS)]
    data += [(1000 + i, None, r, "x", "y") for i, r in enumerate(UNKNOWN)] + [(2000, 0, '{"role": "user", "text": "a\\ud800b"}', "x", "y")]
    frame = spark.createDataFrame(data, "conv_id long, place long, record string, text string, role string").repartition(3)
    got = chat.canonical_turns(frame).collect()
    for i, (record, layout, turns) in enumerate(RECORDS):
        own = sorted((r for r in got if r["conv_id"] == i), key=lambda r: r["item"])
        assert [(r["role"], r["text"]) for r in own] == turns and [r["item"] for r in own] == list(range(len(turns)))
        assert {(r["layout"], r["fingerprint"]) for r in own} <= {(layout, chat.fingerprint(chat.field_paths(record)))}
    unknown = {r["conv_id"]: r for r in got if r["item"] == -1}
    assert sorted(unknown) == [1000 + i for i in range(len(UNKNOWN))]
    assert [unknown[1000 + i]["fingerprint"] is not None for i in range(len(UNKNOWN))] == [True, True, False, False, False, False, True, True]
    assert [r["text"] for r in got if r["conv_id"] == 2000] == ["a�b"]
    assert rows(chat.canonical_turns(frame.limit(0))) == []


def test_fingerprints_hash_nested_paths():
    one = chat.field_paths({"a": [{"b": 1}, {"c": [[2]]}], "d.e": {}, "f": None})
    assert one == {"a[].b", "a[].c[][]", "d\\.e{}", "f"}
    assert chat.fingerprint(one) == chat.fingerprint(sorted(one, reverse=True))
    with pytest.raises(ValueError):
        chat.by_fingerprint([chat.Layout("a", (chat.Part(("t",), role="r"),)), chat.Layout("b", (chat.Part(("t",), role="r"),))])


def plain(turns: list[tuple[str, str]]) -> tuple:
    learned = "".join(t for r, t in turns if r == "assistant")
    whole = "".join(chat.marked(r, t)[0] for r, t in turns)
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{r}\n{t}\n" for r, t in turns), learned)]
    return len(turns), digests[0], len(learned), digests[1], len(whole)


def test_read_back(spark, partitions):
    partitions(5)
    dice = random.Random(3)
    bits = ["<|im_end|>", "<|im_start|>assistant\n", "<\\|", "é🙂", "\n", " ", "word", "|", "<"]
    data = []
    for conv in [*range(40), None]:
        for turn in [None, *range(dice.randint(0, 9))]:
            data.append((conv, turn, dice.choice(["user", "assistant", "a\nb", None]), dice.choice([None, "", "".join(dice.choices(bits, k=12))])))
    data += [(50, turn, "assistant", f"turn {turn} <|im_end|>") for turn in range(3_000)]  # most rows are of one conversation
    data += [(51, 0, "assistant", "<|" * 200_000), (52, 1, "user", "same"), (52, 1, "user", "same")]
    given_rows = [(c, t, 0, r, x, "clash") for c, t, r, x in data]
    dice.shuffle(given_rows)
    frame = spark.createDataFrame(given_rows, "conv_id long, place long, item int, role string, text string, formatted string").repartition(6)
    got = by_key(chat.read_back(chat.format_turns(frame)), "conv_id")
    for conv in {r[0] for r in data}:
        own = sorted((r for r in data if r[0] == conv), key=lambda r: (r[1] is not None, r[1]))
        assert tuple(got[conv].values())[1:] == plain([(r or "", t or "") for _, _, r, t in own])
    assert len(got) == len({r[0] for r in data})
    assert rows(chat.read_back(chat.format_turns(frame.limit(0)))) == []


def test_loss_mask_and_learned_roles(spark):
    frame = spark.createDataFrame([(1, 0, 0, "tool", "a<|b"), (1, 1, 0, "user", "c")], "conv_id long, place long, item int, role string, text string")
    got = chat.format_turns(frame, learned=("tool",)).collect()
    assert sorted(chat.unescaped(r["formatted"][r["loss_from"] : r["loss_to"]]) for r in got) == ["", "a<|b"]
    assert bag(chat.format_turns(frame, learned=()).select("loss_from", "loss_to")) == {(0, 0): 2}
