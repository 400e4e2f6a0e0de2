"""Repair of conversations against a search over all edits."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import repair
from corpusloom.llm.queries import damaged
from corpusloom.llm.streams import per_group

SPACE = re.compile(r"[\x20\x09-\x0D]")


def cheapest(rows):
    """``(cost, audit, repaired lines)`` by trying every edit of every row; rows are (role, text, fault)."""
    heads = {(): (0, "", ())}  # by the initials so far: cheapest, then least audit
    begun = re.compile(r"s?(ua)*u?")

    def grown(heads):
        for _ in range(2):
            more = dict(heads)
            for said, (cost, audit, lines) in heads.items():
                for role in ("user", "assistant"):
                    keep(more, said + (role[0],), cost + 3, audit + "I", lines + (f"{role}:",))
            heads = more
        return heads

    def keep(heads, said, cost, audit, lines):
        if begun.fullmatch("".join(said)) and (said not in heads or (cost, audit) < heads[said][:2]):
            heads[said] = cost, audit, lines

    for role, text, fault in rows:
        after = {}
        for said, (cost, audit, lines) in grown(heads).items():
            keep(after, said, cost + 4, audit + "D", lines)
            if fault in ("", "truncated"):
                extra = 3 if fault else 0
                if role[:1] in "sua" and role:
                    keep(after, said + (role[0],), cost + extra, audit + "K", lines + (f"{role}:{text}",))
                for new in ("user", "assistant"):
                    keep(after, said + (new[0],), cost + 3 + extra, audit + "R", lines + (f"{new}:{text}",))
        heads = after
    done = [v for said, v in grown(heads).items() if re.fullmatch(r"(s?(ua)+)?", "".join(said))]
    return min(done)


def expected(rows):
    """The contract's columns for the rows of one conversation: (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
    seen, marked = set(), []
    for _, role, text in rows:
        left = SPACE.sub("", text)
        fault = "blank" if not left else "duplicate" if (role, text) in seen else "truncated" if left[-1] not in ".!?" else ""
        seen.add((role, text))
        marked.append((role, text, fault))
    turns = [t for t, _, _ in rows if t is not None]
    cost, audit, lines = cheapest(marked)
    pairs = [a[0][:1] + b[0][:1] for a, b in zip(rows_of(rows), rows_of(rows)[1:])]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        "blank": sum(f == "blank" for *_, f in marked),
        "duplicate": sum(f == "duplicate" for *_, f in marked),
        "truncated": sum(f == "truncated" for *_, f in marked),
        "illegal": sum(p not in ("su", "ua", "au") for p in pairs),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    }


def rows_of(rows):
    return [(role, text) for _, role, text in rows]


def check(rows, spark, hold, parts):
    """The operator's audits of the table ``rows`` against the search."""
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(parts)
    edits = repair.with_edits(df, hold=hold)
    got = {r["conv_id"]: r.asDict() for r in per_group(edits, "conv_id", ["block", "ord", "sub"], repair.Audit, repair.AUDIT).collect()}
    by_conv = {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append((turn, role or "", text or ""))
    assert set(got) == set(by_conv)
    for conv, said in by_conv.items():
        assert got[conv] == {"conv_id": conv, **expected(said)}, (conv, said)


def made_up(seed, conversations, longest):
    draw = random.Random(seed)
    rows = []
    for conv in [*range(conversations), None]:
        n = draw.randint(1, longest)
        turn = 0
        for i in range(n):
            turn += draw.choice([0, 1, 1, 1, 2])
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "sage"])
            text = draw.choice(["Yes.", "No!", "Maybe", "", " \t", None, f"Number {i}.", f"number {i} ", "é?", "x. \n"])
            rows.append((conv, draw.choice([turn, turn, turn, turn, None]), role, text))
    return rows


@pytest.mark.parametrize("hold,parts", [(100, 3), (2, 5), (1, 1)])
def test_against_search(spark, hold, parts):
    check(made_up(hold, 60, 9), spark, hold, parts)


def test_one_conversation_over_many_tasks(spark):
    """Two thirds of the rows in one conversation, with runs of equal rows."""
    draw = random.Random(5)
    rows = []
    for turn in range(120):
        role = draw.choice(["user"] * 5 + ["assistant", "system"])
        rows += [(7, turn // 2, role, draw.choice(["Same.", f"Row {turn}.", "cut", ""]))] * draw.choice([1, 1, 4])
    rows += made_up(1, 20, 4)
    spark.conf.set("spark.sql.shuffle.partitions", 9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check(rows, spark, 7, 4)
        check(rows, spark, 1000, 2)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_runs_of_powers():
    """Long runs unrolled from binary powers against one row at a time."""
    draw = random.Random(3)
    for _ in range(60):
        symbols = [s for _ in range(draw.randint(1, 5)) for s in [draw.randrange(12)] * draw.choice([1, 2, 3, 17, 70])]
        after, steps = repair.CLOSING, []
        for s in reversed(symbols):
            steps.append(after)
            after = repair.applied(repair.power(s, 0), after)
        state, plain = 0, []
        for s, behind in zip(symbols, reversed(steps)):
            edits, _, state = min(repair.moves(s, state), key=lambda m: (m[1] + behind[m[2]], m[0]))
            plain.append((edits, state))
        made, end = repair.choices(repair.runs_of(symbols), repair.CLOSING, 0)
        assert made == plain and end == state
        matrix = repair.matrix_of(repair.runs_of(symbols))
        assert repair.applied(matrix, repair.CLOSING) == after


def test_edges(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, block int, ord string, edit string, sub int"
    rows = [
        (1, 1, "user", "Hello." * 200_000, 1, "x", "x", 1),
        (1, 2, "assistant", "Hi." + " " * 500_000, 1, "x", "x", 1),
        (2, None, None, None, None, None, None, None),
        (None, None, "user", "a.", 1, "x", "x", 1),
    ]
    edits = repair.with_edits(spark.createDataFrame(rows, schema)).collect()
    by = {}
    for r in sorted(edits, key=lambda r: (r["block"], r["ord"], r["sub"])):
        by[r["conv_id"]] = by.get(r["conv_id"], "") + r["edit"]
    assert by == {1: "KK", 2: "D", None: "KI"}
    left = repair.repaired(repair.with_edits(spark.createDataFrame(rows, schema)))
    assert sorted(len(r["text"]) for r in left.collect()) == [0, 2, 500_003, 1_200_000]
    nothing = spark.createDataFrame([], schema)
    assert repair.with_edits(nothing).count() == 0


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in range(30) for t in range(4)] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = sorted(map(tuple, damaged(df).collect()), key=str)
    want = []
    for c, t, role, text in rows:
        luck = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text, role = (" " if text is None else text), (" " if role is None else role)
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(luck, text)
        role = "user" if luck == 4 else role
        want += [(c, t, role, text)] * {0: 0, 3: 2}.get(luck, 1)
    assert got == sorted(want, key=str)
    assert damaged(df.filter("false")).count() == 0
    assert df.select(F.count("*")).first()[0] == len(rows)
