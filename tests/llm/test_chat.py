import json

from pyspark.sql import functions as F

from lakesteward.llm import chat
from lakesteward.llm.queries import conversation_records

RECORDS = [
    ({"messages": [{"role": "user", "content": "hi"}, {"content": "yo", "role": "assistant"}]}, "messages", [("user", "hi"), ("assistant", "yo")]),
    ({"messages": [{"role": "user", "content": 5}, {"role": "assistant", "content": None}]}, "messages", [("user", "5"), ("assistant", "")]),
    ({"messages": []}, "no_messages", []),
    ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}, {"from": "tool", "value": "c"}]}, "conversations",
     [("user", "a"), ("assistant", "b"), ("tool", "c")]),
    ({"prompt": "p", "response": "r\n\\"}, "prompt", [("user", "p"), ("assistant", "r\n\\")]),
    ({"completion": "c", "prompt": None}, "completion", [("user", ""), ("assistant", "c")]),
    ({"output": "o", "instruction": "i", "input": "</s>"}, "instruction", [("system", "i"), ("user", "</s>"), ("assistant", "o")]),
    ({"instruction": "i", "output": "o"}, "short_instruction", [("user", "i"), ("assistant", "o")]),
    ({"question": "q", "answer": "[INST][/INST]"}, "question", [("user", "q"), ("assistant", "[INST][/INST]")]),
    ({"unknown": 1}, None, None),
]


def test_layouts_and_round_trip(spark):
    rows = [(i, json.dumps(r), "clash") for i, (r, _, _) in enumerate(RECORDS)] + [(90, None, ""), (91, "{broken", "")]
    table = chat.canonical_turns(spark.createDataFrame(rows, "id long, record string, formatted string").drop("formatted"))
    found = {r.id: r for r in table.collect()}
    for i, (_, layout, turns) in enumerate(RECORDS):
        assert found[i].layout == layout
        assert (None if found[i].turns is None else [tuple(t) for t in found[i].turns]) == turns
    assert found[90].turns is None and found[91].turns is None
    read = {r.id: r for r in chat.read_turns(chat.format_turns(table)).collect()}
    for i, (_, layout, turns) in enumerate(RECORDS):
        if turns is not None:
            assert [tuple(t) for t in read[i].turns] == turns
            assert read[i].loss_texts == [t for role, t in turns if role == "assistant"]


def test_escapes_are_reversible(spark):
    odd = ["", "\\", "\\\\", "[INST]", "[\\INST]", "</s>", "<\\/s>", "[[INST]]</s></s>\\", "[/INST", "<s>", "\\[/INST]", "é\n[/INST]\\n", "[" * 50]
    rows = spark.createDataFrame([(t,) for t in odd], "t string").select("t", chat.escape(F.col("t")).alias("e"))
    for r in rows.select("t", "e", chat.unescape(F.col("e")).alias("u")).collect():
        assert r.u == r.t
        assert not any(mark in r.e for mark in (chat.OPEN, chat.MIDDLE, chat.END))


def test_odd_conversations(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "x"), (2, 0, "assistant", "[INST]role"), (2, 0, "assistant", "[INST]role"), (3, None, "human", "h"), (3, 2, "assistant", "a"),
            (None, 0, "user", "n"), (5, 0, "user", "u"), (5, 1, "assistant", "v"), (7, 0, "user", "b"), (7, 1, "user", "c")]
    talks = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("mask", F.lit("clash"))
    records = conversation_records(talks)
    read = chat.read_turns(chat.format_turns(chat.canonical_turns(records)).select("conv_id", "formatted", "mask")).collect()
    found = {r.conv_id: [tuple(t) for t in r.turns] for r in read}
    assert found == {1: [("user", ""), ("", "x")], 2: [("assistant", "[INST]role")] * 2, 3: [("human", "h"), ("assistant", "a")], None: [("user", "n")],
                     5: [("user", "u"), ("assistant", "v")], 7: [("user", "b"), ("user", "c")]}
    assert conversation_records(talks.limit(0)).count() == 0


def test_unread_records_are_reported(spark):
    rows = [(1, '{"prompt":"a","response":"b"}'), (2, "no json"), (3, '{"other":1}'), (4, None)]
    records = spark.createDataFrame(rows, "conv_id long, record string")
    assert {(r.conv_id, r.reason) for r in chat.unread_records(records).collect()} == {(2, "unreadable"), (3, "unknown layout")}
