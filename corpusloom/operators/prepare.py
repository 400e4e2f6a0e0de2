"""Instruction rows to chat turns, and the row filters around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import missing

# Per layout, the field names and the label in front of the extra text.
LAYOUTS = {
    "dolly": {"user": "instruction", "extra": "context", "label": "Context", "assistant": "response"},
    "alpaca": {"user": "instruction", "extra": "input", "label": "Input", "assistant": "output"},
}
USER_FIELDS = ("prompt", "instruction", "question")
ASSISTANT_FIELDS = ("response", "output", "answer")
LENGTH_FACTOR = 2  # fixed value: examples longer than this many sequence lengths are dropped


def style_for(dataset_name: str) -> str:
    """Layout of an instruction dataset by its name."""
    return next((s for s in LAYOUTS if s in dataset_name), "generic")


def style_column(name: Column) -> Column:
    """The same choice for a column of dataset names."""
    choice = F.lit("generic")
    for style in reversed(LAYOUTS):
        choice = F.when(name.contains(style), style).otherwise(choice)
    return choice


def _field(df: DataFrame, name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")) if name in df.columns else F.lit("")


def _first_present(df: DataFrame, names: tuple[str, ...], mixed: bool) -> Column:
    """The first field that exists, empty or not; later ones are no substitute.

    In a table that mixes layouts a row lacks the fields that are null; an empty text is there.
    """
    there = [n for n in names if n in df.columns]
    if mixed:
        return F.coalesce(*[F.col(n) for n in there], F.lit(""))
    return _field(df, there[0] if there else "")


def chat_sides(df: DataFrame, style: str, mixed: bool = False) -> tuple[Column, Column]:
    """User and assistant text of a row in the given layout."""
    if style not in LAYOUTS:
        return _first_present(df, USER_FIELDS, mixed), _first_present(df, ASSISTANT_FIELDS, mixed)
    layout = LAYOUTS[style]
    user, extra = _field(df, layout["user"]), _field(df, layout["extra"])
    with_extra = F.concat(user, F.lit(f"\n\n{layout['label']}: "), extra)
    # A row without an instruction is incomplete, whatever its extra text.
    text = F.when(missing(user), F.lit("")).when(missing(extra), user).otherwise(with_extra)
    return text, _field(df, layout["assistant"])


def to_chat(df: DataFrame, style: str, keep: list[str]) -> DataFrame:
    """Columns ``keep`` plus ``user`` and ``assistant``; incomplete rows are dropped."""
    user, assistant = chat_sides(df, style)
    sides = df.select(*keep, user.alias("user"), assistant.alias("assistant"))
    return sides.filter(~missing(F.col("user")) & ~missing(F.col("assistant")))


def to_chat_by_source(df: DataFrame, source: str, keep: list[str]) -> DataFrame:
    """Like :func:`to_chat` for a table that mixes layouts, in one pass over it."""
    style = style_column(F.col(source))
    users, assistants = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name in ["generic", *LAYOUTS]:
        user, assistant = chat_sides(df, name, mixed=True)
        users = F.when(style == name, user).otherwise(users)
        assistants = F.when(style == name, assistant).otherwise(assistants)
    sides = df.select(*keep, users.alias("user"), assistants.alias("assistant"))
    return sides.filter(~missing(F.col("user")) & ~missing(F.col("assistant")))


def messages(df: DataFrame, keep: list[str]) -> DataFrame:
    """User and assistant text as turns ``(turn, role, text)``, one row each."""
    turn = lambda n, role: F.struct(
        F.lit(n).cast("bigint").alias("turn"), F.lit(role).alias("role"), F.col(role).alias("text")
    )
    both = F.array(turn(0, "user"), turn(1, "assistant"))
    return df.select(*keep, F.inline(both))


def drop_long(df: DataFrame, seq_length: int, ids: str = "token_ids") -> DataFrame:
    """Drop examples longer than twice the sequence length."""
    return df.filter(F.size(ids) <= LENGTH_FACTOR * seq_length)


def on_cadence(df: DataFrame, interval: int, step: str = "step", from_zero: bool = False) -> DataFrame:
    """Rows at multiples of ``interval``; step 0 counts for logging, not for evals or saves."""
    due = F.col(step) % interval == 0
    return df.filter(due if from_zero else due & (F.col(step) > 0))


def save_points(df: DataFrame, interval: int, run: list[str], step: str = "step") -> DataFrame:
    """Periodic saves plus the last step of each run."""
    last = df.groupBy(*run).agg(F.max(step).alias(step)).withColumn("final", F.lit(True))
    periodic = on_cadence(df.select(*run, step), interval, step).withColumn("final", F.lit(False))
    return periodic.unionByName(last).groupBy(*run, step).agg(F.max("final").alias("final"))
