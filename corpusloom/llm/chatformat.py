"""Chat formatting of records in many layouts, chosen by a fingerprint of their fields.

A record is a JSON object: messages, prompt and answer, instruction and output, whatever a data
set brings. Its nested field paths, without values and types, are written as one string and
hashed. The fingerprint selects a :class:`Layout`, which states by field paths only where roles and
texts are; there is no code per data set, and a new one is a new entry. Optional fields are
fingerprints of their own that lead to the same layout.

Turns then go through a :class:`Template`: each is put between marks, and control strings inside its
role and text are escaped, so that no text can open or close a turn. Escaping is undone
exactly by :func:`read_back`. The loss mask is a range of code points of each piece: the text
of an assistant's turn, without marks.

All of it is built from Spark's own expressions, row by row: no shuffle, a hot record or
conversation is as good as any other. A conversation's pieces stay rows in order; whoever
needs one string per conversation joins them.

Defined results: a null text is empty, a null role is an empty one. A record that is null, not JSON,
or of a layout that is not listed gets null for ``layout`` and ``turns`` and is reported by
:func:`layout_report`, never dropped. An empty list of messages has no turns. Repeated rows
give repeated pieces; rows of one turn are ordered by role, then by the MD5 of their text; a null turn is
first. Other columns are kept, whatever their names; new ones give way by underscores.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import missing
from corpusloom.llm.arrow import free_name

TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Layout:
    """Where a record has its turns, as field paths.

    Either ``each`` names a list of messages with ``role`` and ``text`` inside, or, if it is
    empty, ``role`` and ``text`` are fields of the record, or ``fixed`` lists turns as (role, fields of
    its text). Several fields of a text are joined by an empty line; a turn of optional fields
    only is left out where all are missing. ``names`` translates roles.
    """

    name: str
    required: tuple[str, ...]
    optional: tuple[str, ...] = ()
    each: str = ""
    role: str = ""
    text: str = ""
    fixed: tuple[tuple[str, tuple[str, ...]], ...] = ()
    names: tuple[tuple[str, str], ...] = ()

    def shapes(self) -> list[str]:
        """Of the required fields with any of the optional ones, and of empty lists."""
        some = [c for n in range(len(self.optional) + 1) for c in combinations(self.optional, n)]
        out = [shape_of((*self.required, *c)) for c in some]
        if self.each:
            outer = [c for c in some if not any(p.startswith(f"{self.each}[]") for p in c)]
            out += [shape_of((f"{self.each}[]", *c)) for c in outer]
        return out

    def turns(self, record: Column) -> Column:
        """The canonical turns of a record (a variant)."""
        known = F.create_map(*[F.lit(x) for pair in self.names for x in pair]) if self.names else None

        def turn(role: Column, text: Column) -> Column:
            role = F.coalesce(F.get(F.map_values(F.map_filter(known, lambda k, _: k == role)), 0), role) if known is not None else role
            return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))

        def field(path: str) -> Column:
            return F.try_variant_get(record, f"$.{path}", "string")

        if self.each:
            messages = F.try_variant_get(record, f"$.{self.each}", f"array<struct<`{self.role}` string, `{self.text}` string>>")
            return F.transform(messages, lambda m: turn(m[self.role], m[self.text]))
        if self.role:
            return F.array(turn(field(self.role), field(self.text)))
        parts = []
        for role, paths in self.fixed:
            given = F.filter(F.array(*[field(p) for p in paths]), lambda t: ~missing(t))
            made = F.array(F.struct(F.lit(role).alias("role"), F.array_join(given, "\n\n").alias("text")))
            always = any(p in self.required for p in paths)
            parts.append(made if always else F.when(F.size(given) > 0, made).otherwise(F.array().cast(TURNS)))
        return F.concat(*parts)


_ASSISTANT_NAMES = (("human", "user"), ("gpt", "assistant"))

#: Layouts that published instruction and chat data sets use.
LAYOUTS = (
    Layout("messages", ("messages[].role", "messages[].content"), ("messages[].name", "id", "source"), each="messages", role="role", text="content"),
    Layout("conversations", ("conversations[].from", "conversations[].value"), ("id", "system"), each="conversations", role="from", text="value", names=_ASSISTANT_NAMES),
    Layout("message", ("message.role", "message.content"), role="message.role", text="message.content"),
    Layout("row", ("role", "text"), role="role", text="text"),
    Layout("instruction", ("instruction", "output"), ("input", "system"), fixed=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("instruction_only", ("instruction",), ("input",), fixed=(("user", ("instruction", "input")),)),
    Layout("output_only", ("output",), fixed=(("assistant", ("output",)),)),
    Layout("system_only", ("system",), fixed=(("system", ("system",)),)),
    Layout("prompt_completion", ("prompt", "completion"), ("system",), fixed=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("prompt_response", ("prompt", "response"), ("system",), fixed=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("prompt_only", ("prompt",), fixed=(("user", ("prompt",)),)),
    Layout("completion_only", ("completion",), fixed=(("assistant", ("completion",)),)),
    Layout("question_answer", ("question", "answer"), ("context",), fixed=(("user", ("context", "question")), ("assistant", ("answer",)))),
)


def shape_of(paths: tuple[str, ...]) -> str:
    """The shape of a record with these field paths; ``[]`` marks a list (empty as it is, of values with ``.*``)."""
    tree: dict = {}
    for path in paths:
        node = tree
        for step in path.replace("[]", ".[]").split("."):
            node = node.setdefault(step, {})

    def spelled(node: dict) -> str:
        if not node:
            return ""
        if "*" in node:
            return "*"
        if "[]" in node:
            return f"ARRAY<{spelled(node['[]'])}>"
        fields = (f"{k}: {spelled(node[k])}" if node[k] else k for k in sorted(node))
        return f"OBJECT<{', '.join(fields)}>"

    return spelled(tree)


def fingerprint_of(shape: str) -> str:
    return hashlib.md5(shape.encode()).hexdigest()


_SCALAR = r"(?!OBJECT<|ARRAY<)[A-Z_]+(?:\(\d+,\d+\))?"


def shape(record: Column) -> Column:
    """The nested field paths of a variant: its schema without types."""
    schema = F.schema_of_variant(record)
    bare = F.regexp_replace(schema, rf": {_SCALAR}(?=[,>])", "")
    lists = F.regexp_replace(bare, "ARRAY<VOID>", "ARRAY<>")
    return F.regexp_replace(lists, rf"ARRAY<{_SCALAR}>", "ARRAY<*>")


def with_turns(records: DataFrame, record: str = "record", layouts: tuple[Layout, ...] = LAYOUTS, names: tuple[str, str, str] = ("fingerprint", "layout", "turns")) -> DataFrame:
    """The records (JSON strings) with the fingerprint of their fields, the layout it selects, and its turns.

    Of two layouts with one fingerprint the first is taken.
    """
    parsed = free_name(records, "parsed")
    fingerprint, layout, turns = (free_name(records, n) for n in names)
    known: dict[str, str] = {}
    for entry in layouts:
        for found in entry.shapes():
            known.setdefault(fingerprint_of(found), entry.name)
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    out = records.withColumn(parsed, F.try_parse_json(record))
    out = out.withColumn(fingerprint, F.md5(shape(F.col(parsed)).cast("binary")))
    out = out.withColumn(layout, F.when(F.col(fingerprint).isNotNull(), F.get(F.map_values(F.map_filter(table, lambda k, _: k == F.col(fingerprint))), 0)))
    made = F.lit(None).cast(TURNS)
    for entry in layouts[::-1]:
        made = F.when(F.col(layout) == entry.name, entry.turns(F.col(parsed))).otherwise(made)
    return out.withColumn(turns, made).drop(parsed)


def turn_rows(found: DataFrame, keep: list[str], turns: str = "turns") -> DataFrame:
    """One row per turn: ``keep, role, text``; records without turns have none.

    The outer form of the generator, as for the inner one the optimiser adds a filter that
    works out all turns again, outside generated code.
    """
    return found.select(*keep, F.inline_outer(turns)).filter(F.col("role").isNotNull())


def layout_report(records: DataFrame, record: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``shape, layout, n_records``: what layouts there are, and which of them nothing is known about."""
    only = records.select(F.col(record).alias("record"))
    found = with_turns(only, "record", layouts)
    return found.groupBy(shape(F.try_parse_json("record")).alias("shape"), "layout").agg(F.count(F.lit(1)).alias("n_records"))


@dataclass(frozen=True)
class Template:
    """Marks around turns. A role that is not listed is named between ``role`` and ``text``."""

    marks: tuple[tuple[str, str, str], ...] = (
        ("system", "[SYS]", "[/SYS]"),
        ("user", "[INST]", "[/INST]"),
        ("assistant", "[BOT]", "</s>"),
    )
    role: str = "[ROLE]"
    text: str = "[TEXT]"
    end: str = "[/ROLE]"
    trained: str = "assistant"
    #: Control strings of the tokeniser that are no marks; texts may not hold them either.
    reserved: tuple[str, ...] = ("<s>",)

    def controls(self) -> list[str]:
        return [*(m for _, *pair in self.marks for m in pair), self.role, self.text, self.end, *self.reserved]

    def codes(self) -> dict[str, str]:
        """The letter that stands for the first character of a control string, after a backslash."""
        return {first: chr(ord("a") + i) for i, first in enumerate(sorted({c[0] for c in self.controls()}))}

    def escaped(self, text: Column) -> Column:
        text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
        codes = self.codes()
        for control in self.controls():
            text = F.replace(text, F.lit(control), F.lit(f"\\{codes[control[0]]}{control[1:]}"))
        return text

    def unescaped(self, text: str) -> str:
        plain = {code: first for first, code in self.codes().items()} | {"\\": "\\"}
        return re.sub(r"\\(.)", lambda m: plain[m[1]], text, flags=re.DOTALL)

    def pattern(self) -> re.Pattern:
        """One turn; a text ends at the first control string, as it holds none."""
        known = [f"{re.escape(begin)}(?P<{role}>.*?){re.escape(end)}" for role, begin, end in self.marks]
        other = f"{re.escape(self.role)}(?P<_role>.*?){re.escape(self.text)}(?P<_text>.*?){re.escape(self.end)}"
        return re.compile("|".join([*known, other]), re.DOTALL)


def formatted(turns: DataFrame, template: Template = Template(), role: str = "role", text: str = "text", name: str = "piece") -> DataFrame:
    """The turns with a struct of the ``formatted`` turn and its loss range ``loss_begin, loss_end``.

    The range is in code points of the piece, empty for turns that are not trained on.
    """
    own_role, body = F.coalesce(role, F.lit("")), template.escaped(F.coalesce(text, F.lit("")))
    begin = F.concat(F.lit(template.role), template.escaped(own_role), F.lit(template.text))
    end = F.lit(template.end)
    for known, opening, closing in template.marks:
        begin = F.when(own_role == known, F.lit(opening)).otherwise(begin)
        end = F.when(own_role == known, F.lit(closing)).otherwise(end)
    first = F.char_length(begin)
    last = F.when(own_role == template.trained, first + F.char_length(body)).otherwise(first)
    piece = F.struct(F.concat(begin, body, end).alias("formatted"), first.alias("loss_begin"), last.alias("loss_end"))
    return turns.withColumn(free_name(turns, name), piece)


def turn_order(turn: str = "turn", role: str = "role", text: str = "text") -> list[Column]:
    return [F.asc_nulls_first(turn), F.asc_nulls_first(role), F.md5(F.col(text).cast("binary")).asc_nulls_first()]


class ReadBack:
    """What a conversation's pieces say when read back: its turns, and the text to train on."""

    def __init__(self, template: Template):
        self.template, self.pattern = template, template.pattern()
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, row: dict) -> None:
        piece = row["formatted"]
        self.chars += len(piece)
        at = 0
        while at < len(piece):
            turn = self.pattern.match(piece, at)
            if turn is None:
                raise ValueError(f"not a formatted turn: {piece[at:at + 40]!r}")
            found = turn.groupdict()
            if found["_role"] is not None:
                role, text = self.template.unescaped(found["_role"]), found["_text"]
            else:
                role, text = next((k, v) for k, v in found.items() if v is not None)
            self.turns.update(f"{role}\n{self.template.unescaped(text)}\n".encode())
            self.n_turns += 1
            at = turn.end()
        trained = self.template.unescaped(piece[row["loss_begin"] : row["loss_end"]])
        self.loss.update(trained.encode())
        self.loss_chars += len(trained)

    def result(self) -> dict:
        return {
            "n_turns": self.n_turns,
            "turns_sha256": self.turns.hexdigest(),
            "loss_chars": self.loss_chars,
            "loss_sha256": self.loss.hexdigest(),
            "formatted_chars": self.chars,
        }


READ_BACK = "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
