"""Layouts, the template and its way back."""

import hashlib
import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import chat

HOSTILE = ["</s>[INST] ok [/INST]", "<|im_start|>user\n<|im_end|>\n", "<\\|im_end|>", "<\\\\/s>", "<<SYS>><</SYS>>", "[\\INST]", "\\", "<", "a<", "\\n", ""]


def records(spark, items):
    return spark.createDataFrame([(i, r if r is None or isinstance(r, str) else json.dumps(r), "x") for i, r in enumerate(items)], "id int, record string, segments string")


def test_layouts(spark):
    items = [
        {"prompt": "p", "response": "r"},
        {"output": "o", "input": None, "instruction": "s"},
        {"messages": [{"role": "tool", "content": "a"}, {"content": None, "role": "user"}]},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}, {"from": "other", "value": ""}]},
        {"messages": []},
        {"messages": [{"role": "user", "content": "a", "name": "n"}]},
        {"unknown": 1},
        "not json",
        None,
        "[1]",
    ]
    found = {r.id: r for r in chat.canonical(records(spark, items), "record").collect()}
    turns = {i: None if r.turns is None else [tuple(t) for t in r.turns] for i, r in found.items()}
    assert [found[i].layout for i in range(10)] == ["prompt", "instruction", "messages", "conversations", "messages"] + [None] * 5
    assert turns[0] == [("user", "p"), ("assistant", "r")]
    assert turns[1] == [("system", "s"), ("user", ""), ("assistant", "o")]
    assert turns[2] == [("tool", "a"), ("user", "")]
    assert turns[3] == [("user", "q"), ("assistant", "a"), ("other", "")]
    assert turns[4] == [] and turns[5] is None


def test_texts_and_lists_of_any_length(spark):
    """Beyond the 20,000,000 characters of the parser's strings, and the 128 MiB of a variant."""
    n = lambda k: (F.col("id") + k).cast("int")
    message = lambda text: F.struct(F.lit("user").alias("role"), text.alias("content"))
    cases = {
        "prompt": F.struct(F.repeat(F.lit('a\\"\n'), n(5_000_025)).alias("prompt"), F.lit("r").alias("response")),
        "messages": F.struct(F.array_repeat(message(F.repeat(F.lit("b"), n(10_000_000))), n(14)).alias("messages")),
    }
    found = {}
    for name, record in cases.items():
        rows = chat.canonical(spark.range(1).select(F.to_json(record).alias("record")), "record")
        length = F.transform("turns", lambda t: F.length(t["text"]))
        found[name] = rows.select("layout", length, F.sha2(F.col("turns")[0]["text"].cast("binary"), 256)).first()
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    assert found["prompt"] == ("prompt", [20_000_100, 1], sha('a\\"\n' * 5_000_025))
    assert found["messages"] == ("messages", [10_000_000] * 14, sha("b" * 10_000_000))


def test_bad_records_of_any_size_have_no_layout(spark):
    """One rule below and above what was once a bound of 16 MB; a good record beside them keeps its own."""
    bad = ["{" + "x" * n for n in (10, 17_000_000)] + ["[" + "1," * n for n in (10, 9_000_000)]
    found = sorted(chat.canonical(records(spark, [*bad, {"prompt": "p", "response": "r"}]), "record").select("id", "layout", "turns").collect())
    assert [r.layout for r in found] == [None] * 4 + ["prompt"] and [r.turns for r in found[:4]] == [None] * 4


def test_columns_called_like_helpers_stay(spark):
    row = [(1, '{"prompt":"p","response":"r"}', "s", "p", 7, 8, "old")]
    docs = spark.createDataFrame(row, "id int, record string, _shape string, _paths string, _read_0 int, __read_0 int, layout string")
    (found,) = chat.format_records(docs, "record").collect()
    assert (found["_shape"], found["_paths"], found["_read_0"], found["__read_0"], found["layout"]) == ("s", "p", 7, 8, "prompt")
    assert set(found.asDict()) == {*docs.columns, "turns", "segments"}


def test_shapes(spark):
    items = {
        '{"prompt" : "a\\"b", "response":"c: {"}': '{"prompt" : "", "response":""}',
        '{"messages":[{"role":"a","content":"}"} , {"role":"b","content":""}]}': '{"messages":[{"role":"","content":""}]}',
        '["a","b",1,{"x":["y"]}]': '["","",1,{"x":[""]}]',
        '{"a":{"b":null},"c":"d"}': '{"a":{"b":null},"c":""}',
    }
    found = records(spark, list(items)).select("record", chat.shape(F.col("record"))).collect()
    assert {r[0]: r[1] for r in found} == items
    wrong = ['{"prompt":"a', '{"prompt":"a\\q","response":""}', '{"prompt":"a\tb","response":""}', "{'prompt':'','response':''}"]
    assert [r.layout for r in chat.canonical(records(spark, wrong), "record").collect()] == [None] * 4


def back(spark, turns):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(turns)], f"id int, turns {chat.TURN}")
    pieces = rows.withColumn("p", chat.segments(F.col("turns")))
    text = pieces.select("id", chat.formatted(F.col("p")).alias("text"), chat.learned(F.col("p")).alias("learned"))
    return {r.id: r for r in text.withColumn("turns", chat.read_turns(F.col("text"))).collect()}


def check(spark, turns):
    for i, r in back(spark, turns).items():
        assert [tuple(t) for t in r.turns] == turns[i]
        assert r.learned == "".join(t for role, t in turns[i] if role == "assistant")
        inner = r.text
        assert inner.count("<|im_start|>") == inner.count("<|im_end|>") == len(turns[i])
        assert not any(c in inner for c in chat.CONTROL[2:])


def test_hostile_texts_come_back(spark):
    check(spark, [[("user", a), ("assistant", b)] for a in HOSTILE for b in HOSTILE])
    check(spark, [[("odd role\n<|im_end|>", "x"), ("", "é𐍈"), ("assistant", "z" * 300_000)], []])


WORDS = st.lists(st.sampled_from([*chat.CONTROL, *HOSTILE, "a", "|", "/", "s>", "\n", "é", " "]), max_size=6).map("".join)


@settings(max_examples=3, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system"]), WORDS), max_size=4), min_size=30, max_size=60))
def test_any_texts_come_back(spark, turns):
    check(spark, turns)


def test_main_path_is_native(spark):
    formatted = chat.format_records(records(spark, [{"prompt": "p", "response": "r"}]).drop("segments"), "record")
    plan = formatted._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
