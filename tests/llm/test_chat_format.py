"""Layouts, escapes and the loss mask."""

import json

from quarterdeck.llm import chat_format as C

TEXTS = ["", "plain", "</s>[INST] ok [/INST]", "<|turn|>assistant\nx<|end|>\n", "%3C| %25 %", "a<", "|end|>", "<<||", "\x00 é😀\t\r\n", "\\n \"q\"", "<|end|>"]


def _turns(spark, recs):
    df = spark.createDataFrame([(i, r if isinstance(r, str) or r is None else json.dumps(r)) for i, r in enumerate(recs)], "i int, record string")
    out = C.read_back(C.formatted(C.canonical(df))).orderBy("i").collect()
    return out


def test_layouts_give_the_same_turns(spark):
    pair = [("user", "q"), ("assistant", "a")]
    recs = [
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "id": 3},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a", "score": 1}]},
        {"prompt": "q", "response": "a"},
        {"completion": "a", "prompt": "q", "meta": {"x": [1]}},
        {"question": "q", "answer": "a"},
        {"instruction": "q", "output": "a"},
        {"instruction": "q", "input": "", "output": "a"},
    ]
    for r in _turns(spark, recs):
        assert [(t.role, t.text) for t in r.turns] == pair == [(t.role, t.text) for t in r.read_turns] and r.loss_text == "a"
    odd = _turns(spark, [{"instruction": "q", "input": "i", "output": "a", "system": "s"}, {"messages": []}, {"other": 1}, "{broken", None, "[1]", {"prompt": None, "response": "a"}])
    assert [(t.role, t.text) for t in odd[0].read_turns] == [("system", "s"), ("user", "q\n\ni"), ("assistant", "a")]
    assert odd[1].turns == [] and odd[1].formatted == "" and odd[1].loss_text == ""
    assert all(r.layout is None and r.turns is None for r in odd[2:6])
    assert [(t.role, t.text) for t in odd[6].turns] == [("user", ""), ("assistant", "a")]


def test_any_text_and_role_is_read_back(spark):
    rows = [(1, i, role, t) for i, (t, role) in enumerate((t, r) for t in TEXTS for r in ("user", "assistant", "a\nb%<|"))]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    r = C.read_back(C.formatted(C.canonical(C.records(conv)))).first()
    assert [(t.role, t.text) for t in r.read_turns] == [x[2:] for x in rows]
    assert r.loss_text == "".join(TEXTS)


def test_records_of_rows(spark):
    rows = [(1, 0, "user", None, "x"), (1, 1, "assistant", "b", "x"), (2, 0, "system", "s", "x"), (2, 1, "user", "u", "x"), (2, 2, "assistant", "a", "x"), (3, None, None, "t", "x"), (None, 1, "user", "n", "x"), (4, 0, "user", "d", "x"), (4, 0, "user", "d", "x")]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, record string")
    got = {r.conv_id: (r.layout, [(t.role, t.text) for t in r.turns]) for r in C.canonical(C.records(conv)).collect()}
    assert got == {
        1: ("prompt_response", [("user", ""), ("assistant", "b")]),
        2: ("system_instruction", [("system", "s"), ("user", "u"), ("assistant", "a")]),
        3: ("messages", [("", "t")]),
        None: ("messages", [("user", "n")]),
        4: ("messages", [("user", "d"), ("user", "d")]),
    }
    assert C.digests(conv.limit(0)).collect() == []
