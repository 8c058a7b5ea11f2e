import hashlib
import random

import pytest
from pyspark.sql import functions as F

from marketloom.llm import chat_schema

MARKS = ["\\", "<", "|", ">", "<|end|>", "<|user|>", "\n", "a", "é", "😀", "\\<", "$1", "###"]


def _digest(turns):
    whole = "".join(f"{role}\n{text}\n" for role, text in turns)
    loss = "".join(text for role, text in turns if role == "assistant")
    return (
        len(turns),
        hashlib.sha256(whole.encode()).hexdigest(),
        len(loss),
        hashlib.sha256(loss.encode()).hexdigest(),
    )


def test_round_trip_of_any_text(spark):
    rng = random.Random(1)
    rows, expected = [], {}
    for conv in range(60):
        turns = []
        for turn in range(rng.randrange(1, 7)):
            role = rng.choice(["user", "assistant", "a|b", "<\\"])
            turns.append((role, "".join(rng.choices(MARKS, k=rng.randrange(12)))))
            rows.append((conv, turn, *turns[-1]))
        expected[conv] = _digest(turns)
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat_schema.read_back(chat_schema.chat(chat_schema.turn_records(frame))).collect()
    assert {r.conv_id: tuple(r)[1:5] for r in got} == expected


RECORDS = [
    ('{"messages":[{"role":"user","content":"q"},{"role":"assistant","content":null}]}', "messages", [("user", "q"), ("assistant", "")]),
    ('{"messages":[]}', "no messages", []),
    ('{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"a"}]}', "conversations", [("user", "q"), ("assistant", "a")]),
    ('{"prompt":"q","completion":"a"}', "prompt and completion", [("user", "q"), ("assistant", "a")]),
    ('{"response":"a","prompt":"q"}', "prompt and response", [("user", "q"), ("assistant", "a")]),
    ('{"system":"","prompt":"q","response":"a"}', "system, prompt and response", [("user", "q"), ("assistant", "a")]),
    ('{"system":"s","prompt":"q","response":"a"}', "system, prompt and response", [("system", "s"), ("user", "q"), ("assistant", "a")]),
    ('{"instruction":"do","input":"this","output":"a"}', "instruction", [("user", "do\n\nthis"), ("assistant", "a")]),
    ('{"instruction":"do","input":null,"output":7}', "instruction", [("user", "do"), ("assistant", "7")]),
    ('{"instruction":"do","output":"a"}', "instruction alone", [("user", "do"), ("assistant", "a")]),
    ('{"turn":4,"role":"user","text":"t"}', "turn row", [("user", "t")]),
    ('{"question":"q"}', None, None),
    ("null", None, None),
    (None, None, None),
]


def test_layouts(spark):
    frame = spark.createDataFrame([(i, r[0]) for i, r in enumerate(RECORDS)], "conv_id long, j string")
    records = frame.select("conv_id", F.try_parse_json("j").alias("record"), F.lit(1).alias("turns_"))
    got = chat_schema.canonical_turns(records).orderBy("conv_id").collect()
    for r, (_, layout, turns) in zip(got, RECORDS, strict=True):
        found = None if r.turns is None else [(t.role, t.text or "") for t in r.turns]
        assert (r.layout, found) == (layout, turns)


def test_odd_rows(spark):
    rows = [
        (1, 1, "user", None),
        (1, None, None, "first"),
        (1, 1, "assistant", "z"),
        (1, 1, "assistant", "z"),
        (None, 0, "user", "x" * 200_000),
        (2, 0, "user", ""),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat_schema.read_back(chat_schema.chat(chat_schema.turn_records(frame))).collect()
    expected = {
        1: _digest([("", "first"), ("assistant", "z"), ("assistant", "z"), ("user", "")]),
        None: _digest([("user", "x" * 200_000)]),
        2: _digest([("user", "")]),
    }
    assert {r.conv_id: tuple(r)[1:5] for r in got} == expected
    empty = chat_schema.chat(chat_schema.turn_records(frame.limit(0)))
    assert chat_schema.read_back(empty).collect() == []


def test_conversations_without_turns_stay(spark):
    unknown = '{"id":1,"messages":[{"role":"user","content":"q"}]}'
    rows = [(1, unknown), (2, None), (3, '{"messages":[]}'), (4, RECORDS[0][0]), (4, unknown), (4, None)]
    frame = spark.createDataFrame(rows, "conv_id long, j string")
    chat = chat_schema.chat(frame.select("conv_id", F.try_parse_json("j").alias("record")))
    got = {r.conv_id: r for r in chat.collect()}
    assert sorted(got) == [1, 2, 3, 4]
    assert [got[i].formatted for i in (1, 2, 3)] == ["", "", ""]
    assert [got[i].layout for i in (1, 2, 3, 4)] == [None, None, "no messages", "messages"]
    mark = spark.range(1).select(chat_schema.fingerprint(F.parse_json(F.lit(unknown)))).first()[0]
    assert [got[i].unread for i in (1, 2, 3, 4)] == [[mark], [], [], [mark]]
    assert got[4].formatted == "<|user|>q<|end|><|assistant|><|end|>"
    assert chat_schema.read_back(chat).filter("conv_id = 1").first().n_turns == 0


def test_fingerprints_differ(spark):
    names = [layout.paths for layout in chat_schema.LAYOUTS]
    marks = spark.range(1).select([F.xxhash64(F.lit(n)) for n in names]).first()
    assert len(set(marks)) == len(names)


@pytest.mark.parametrize("text", ["", "<|x|>", "no template"])
def test_foreign_text_has_no_turns(spark, text):
    found = spark.range(1).select(chat_schema.parsed(F.lit(text)).alias("t")).first().t
    assert found == []
