"""Chat formatting: layouts by their fields, and an exact round trip."""

import json
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import chatformat
from corpusloom.llm.queries import in_many_layouts
from corpusloom.llm.streams import per_group

U, A, S = "user", "assistant", "system"

RECORDS = [
    ({"messages": [{"role": "user", "content": "a"}, {"content": "b", "role": "assistant"}]}, "messages", [(U, "a"), (A, "b")]),
    ({"messages": [{"role": "user", "content": None}, {"role": "x", "content": "b", "name": "n"}], "id": 3}, "messages", [(U, ""), ("x", "b")]),
    ({"messages": [], "source": None}, "messages", []),
    ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}, {"from": "tool", "value": "c"}], "id": "q"}, "conversations", [(U, "a"), (A, "b"), ("tool", "c")]),
    ({"instruction": "do", "input": "this", "output": "done"}, "instruction", [(U, "do\n\nthis"), (A, "done")]),
    ({"instruction": "do", "input": "", "output": "done", "system": "be"}, "instruction", [(S, "be"), (U, "do"), (A, "done")]),
    ({"instruction": "do", "output": None}, "instruction", [(U, "do"), (A, "")]),
    ({"prompt": "p", "completion": "c"}, "prompt_completion", [(U, "p"), (A, "c")]),
    ({"response": "c", "prompt": "p", "system": None}, "prompt_response", [(U, "p"), (A, "c")]),
    ({"question": "q", "answer": "a", "context": "c"}, "question_answer", [(U, "c\n\nq"), (A, "a")]),
    ({"message": {"role": "user", "content": "é\u0000\t\"\\"}}, "message", [(U, "é\u0000\t\"\\")]),
    ({"role": None, "text": "t"}, "row", [("", "t")]),
    ({"prompt": "p", "completion": {"text": "c"}}, None, None),
    ({"messages": [{"role": "user"}]}, None, None),
    ({"messages": ["a", "b"]}, None, None),
    ({}, None, None),
    ({"a b": {"c`d": [1, "x", [True]]}}, None, None),
]


def test_layouts(spark):
    rows = [(i, json.dumps(r)) for i, (r, _, _) in enumerate(RECORDS)] + [(100, None), (101, "{not json"), (102, "[1]"), (103, '"s"'), (104, '{"prompt":1,"prompt":2}')]
    df = spark.createDataFrame(rows, "layout int, record string")
    out = chatformat.with_turns(df)
    assert out.columns == ["layout", "record", "fingerprint", "_layout", "turns"]
    got = {r["layout"]: (r["_layout"], r["turns"] and [tuple(t) for t in r["turns"]]) for r in out.collect()}
    for i, (_, layout, turns) in enumerate(RECORDS):
        assert got[i] == (layout, turns if layout is None or turns else []), RECORDS[i]
    assert all(got[i] == (None, None) for i in range(100, 105))
    flat = [(r["layout"], r["role"], r["text"]) for r in chatformat.turn_rows(out, ["layout"]).collect()]
    assert sorted(flat) == sorted((i, *t) for i, (_, _, turns) in enumerate(RECORDS) for t in turns or [])
    report = {(r["shape"], r["layout"]): r["n_records"] for r in chatformat.layout_report(df).collect()}
    assert report["OBJECT<completion, prompt>", "prompt_completion"] == 1
    assert report["OBJECT<completion: OBJECT<text>, prompt>", None] == 1 and report[None, None] == 3
    assert report["OBJECT<`a b`: OBJECT<`c``d`: ARRAY<*>>>", None] == 1
    assert chatformat.with_turns(df.filter("false")).count() == 0


def test_shapes():
    """Values and types do not count, names and nesting do."""
    assert chatformat.shape_of(("b", "a[].y", "a[].x", "c.d", "e[]", "f[].*")) == "OBJECT<a: ARRAY<OBJECT<x, y>>, b, c: OBJECT<d>, e: ARRAY<>, f: ARRAY<*>>"
    shapes = [s for layout in chatformat.LAYOUTS for s in layout.shapes()]
    assert len(shapes) == len(set(shapes))


def test_numbers_do_not_change_the_layout(spark):
    records = [{"prompt": p, "completion": c} for p, c in [(1, 2.5), ("x", None), (12345678901234567890, True), (None, "y")]]
    out = chatformat.with_turns(spark.createDataFrame([(json.dumps(r),) for r in records], "record string"))
    assert {r["layout"] for r in out.collect()} == {"prompt_completion"} and out.select("fingerprint").distinct().count() == 1


CONTROLS = chatformat.Template().controls()


def odd_texts(seed, n):
    draw = random.Random(seed)
    bits = [*CONTROLS, "\\", "<", "[", "/", "]", ">", "a", "b", "s", "INST", "\n", " ", "é", "日本", "\U0001f600", "\\\\a", "\\b"]
    return ["".join(draw.choice(bits) for _ in range(draw.randint(0, 12))) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_round_trip(spark, seed):
    draw = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", "[INST]", "a\\b</s>", None]
    rows = [(c, t, draw.choice(roles), draw.choice([text, text, None])) for c in range(40) for t, text in enumerate(odd_texts(c * 10 + seed, 6))]
    rows += [(90, None, "user", "first?"), (90, 0, "assistant", "x" * 300_000 + "</s>"), (None, 1, "assistant", "[BOT]"), (None, 1, "assistant", "[BOT]")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    template = chatformat.Template()
    pieces = chatformat.formatted(df.withColumn("piece", F.lit("clash")), template)
    assert pieces.columns == ["conv_id", "turn", "role", "text", "piece", "_piece"]
    for r in pieces.collect():
        inner = r["_piece"]["formatted"]
        loss = inner[r["_piece"]["loss_begin"] : r["_piece"]["loss_end"]]
        assert template.unescaped(loss) == ((r["text"] or "") if r["role"] == "assistant" else "")
        marks = sum(inner.count(c) for c in CONTROLS)
        assert marks == (2 if r["role"] in (U, A, S) else 3), inner  # none from a role or text
    flat = pieces.select("conv_id", "turn", "_piece.*")

    class Joined(chatformat.ReadBack):
        """All pieces of a conversation as one string: marks alone must tell its turns apart."""

        def __init__(self):
            super().__init__(template)
            self.whole = ""

        def add(self, row):
            self.whole += row["formatted"]

        def result(self):
            chatformat.ReadBack.add(self, {"formatted": self.whole, "loss_begin": 0, "loss_end": 0})
            return super().result()

    one = per_group(flat, "conv_id", ["turn", "formatted"], lambda: chatformat.ReadBack(template), chatformat.READ_BACK)
    other = per_group(flat, "conv_id", ["turn", "formatted"], Joined, chatformat.READ_BACK)
    key = lambda r: (r["conv_id"] is None, r["conv_id"])
    one, other = sorted(one.collect(), key=key), sorted(other.collect(), key=key)
    assert [(r["conv_id"], r["n_turns"], r["turns_sha256"], r["formatted_chars"]) for r in one] == [
        (r["conv_id"], r["n_turns"], r["turns_sha256"], r["formatted_chars"]) for r in other
    ]
    assert sum(r["n_turns"] for r in one) == len(rows)
    assert chatformat.formatted(df.filter("false")).count() == 0


def test_many_layouts_lose_nothing(spark):
    rows = [(c, t, role, text) for c in range(30) for t, (role, text) in enumerate([(U, "a\"\\"), (A, ""), (S, "s\n"), ("tool", "t"), (None, "n"), (U, None), ("human", "h"), (A, "é")])]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    out = chatformat.with_turns(in_many_layouts(df))
    got = {(r["conv_id"], r["turn"]): [tuple(t) for t in r["turns"]] for r in out.collect()}
    assert got == {(c, t): [(role or "", text or "")] for c, t, role, text in rows}
    assert out.select("layout").distinct().count() >= 8
