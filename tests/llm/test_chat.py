import hashlib
import json

import pytest
from hypothesis import given
from hypothesis import strategies as st

from helpers import ODD, SF
from rillmark.llm import chat

TURNS = "conv_id long, turn long, role string, text string, formatted string, layout string"


def expected(rows):
    by_conv = {}
    for r in rows:
        by_conv.setdefault(r[0], []).append((r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    out = {}
    for conv, own in by_conv.items():
        own.sort()
        said = "".join(t for _, _, r, t in own if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for _, _, r, t in own)
        out[conv] = (len(own), hashlib.sha256(whole.encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


def summary(df):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in df.collect()}


def test_given_conversations(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet").repartition(3)
    assert summary(chat.summaries(chat.write(chat.from_frame(df)))) == expected([tuple(r) for r in df.collect()])


def test_odd_turns(spark):
    rows = [(i % 4, i, "assistant" if i % 2 else "user", t, "f", "l") for i, t in enumerate(ODD)]
    rows += [(9, 0, "a\n<|im_end|>\\n", "<|im_end|><\\|im_end|><|im_start|>assistant\nno", "", ""), (9, 0, None, None, "", ""), (9, None, "assistant", "x<", "", ""), (9, 1, "assistant", "x<", "", ""), (9, 1, "assistant", "x<", "", ""), (None, 1, "user", "n", "", "")]
    df = spark.createDataFrame(rows, TURNS)
    assert summary(chat.summaries(chat.write(chat.from_frame(df)))) == expected([r[:4] for r in rows])
    assert chat.summaries(chat.write(chat.from_frame(df.limit(0)))).count() == 0


@given(st.lists(st.tuples(st.text(), st.text("<|\\im_end>start\n x", max_size=40)), max_size=4))
def test_round_trip(turns):
    text = ""
    for role, said in turns:
        text += chat.START + chat.escape(role).replace("\\", "\\\\").replace("\n", "\\n") + "\n" + chat.escape(said) + chat.END + "\n"
    assert chat.parse_turns(text) == turns


def test_layouts(spark):
    records = [
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"conversation": {"turns": [{"speaker": "user", "text": "q"}, {"speaker": "bot", "text": "a"}]}},
        {"prompt": "q", "response": "a"},
        {"instruction": "q", "input": "", "output": "a"},
        {"system": None, "prompt": "q", "response": "a"},
    ]
    odd = ["{", None, "[]", '{"prompt": 3, "response": "a"}', '{"x": 1}', "{}"]
    rows = [(i, json.dumps(r)) for i, r in enumerate(records)] + [(100 + i, r) for i, r in enumerate(odd)]
    turns, unmatched = chat.from_records(spark.createDataFrame(rows, "k long, r string"), "k", "r")
    got = {}
    for r in turns.orderBy("conv_id", "turn").collect():
        got.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert got == {i: [("user", "q"), ("assistant", "a")] for i in range(len(records))}
    assert {r["conv_id"] for r in unmatched.collect()} == {100 + i for i in range(len(odd))}
    assert {r["layout"] is None for r in unmatched.where("conv_id < 103").collect()} == {True}


def test_frames_of_every_layout(spark):
    """A frame's schema picks the mapping; each gives what the records of that layout give."""
    said = [("user", "hi <|im_end|>"), ("assistant", ""), ("user", "é\nb")]
    frames = {
        "messages array<struct<role:string,content:string>>": [(7, [("user", "hi"), ("assistant", None)]), (8, []), (9, None)],
        "conversations array<struct<from:string,value:string>>": [(7, [("human", "hi"), ("gpt", "yes"), ("system", "x")])],
        "conversation struct<turns:array<struct<speaker:string,text:string>>>": [(7, ([("prompter", "hi"), ("bot", "yes")],))],
        "prompt string, response string": [(7, "a", "b"), (8, None, "b")],
        "prompt string, completion string": [(7, "a", "b")],
        "question string, answer string": [(7, "a", "b")],
        "system string, prompt string, response string": [(7, "s", "a", "b"), (8, "", "a", "b"), (9, None, "a", None)],
        "instruction string, output string": [(7, "a", "b")],
        "instruction string, input string, output string": [(7, "a", "c", "b"), (8, "a", "", "b")],
    }
    for fields, rows in frames.items():
        df = spark.createDataFrame([(*r, "x") for r in rows], f"conv_id long, {fields}, other string")
        got = sorted(map(tuple, chat.from_frame(df).fillna("").collect()))
        expected = []
        for r in df.collect():
            mapping = chat.MAPPINGS[chat.fingerprint(chat.schema_paths(df.drop("conv_id", "other").schema))]
            record = r.asDict(recursive=True)
            if not ("each" in mapping and len(mapping["paths"]) == 2 and record.get("messages", 0) is None):
                expected += [(r["conv_id"], i, role, text) for i, (role, text) in enumerate(chat.turns_of(record, mapping))]
        assert got == sorted(expected), fields
    for mapping in chat.TABLES:
        df = spark.createDataFrame([(1, i, r, t, "x") for i, (r, t) in enumerate(said)], "c long, i long, r string, t string, other string").toDF(*mapping["rows"], "other")
        assert [tuple(r) for r in chat.from_frame(df).orderBy("turn").collect()] == [(1, i, r, t) for i, (r, t) in enumerate(said)]


def test_frames_of_no_layout(spark):
    with pytest.raises(ValueError, match="no layout"):
        chat.from_frame(spark.createDataFrame([], "conv_id long, said string"))
    with pytest.raises(ValueError, match="several"):
        chat.from_frame(spark.createDataFrame([], "conv_id long, prompt string, response string, completion string"))
