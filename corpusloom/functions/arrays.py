"""Array expressions for examples: truncate, pad, shift, mask, cut."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IGNORED = -1  # fixed value: a target that takes no part in the loss
PAD_ID = 0  # fixed value: padding uses id 0, not the end-of-text id

ints = lambda a: a.cast("array<int>")


def truncated(a: Column, seq_length: int) -> Column:
    return F.slice(a, 1, seq_length + 1)


def padded(a: Column, seq_length: int, value: int = PAD_ID) -> Column:
    room = F.greatest(F.lit(seq_length + 1) - F.size(a), F.lit(0))
    return F.concat(a, F.array_repeat(F.lit(value), room))


def without_last(a: Column) -> Column:
    return F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0)))


def without_first(a: Column) -> Column:
    return F.slice(a, F.lit(2), F.greatest(F.size(a) - 1, F.lit(0)))


def masked_targets(y: Column, mask: Column) -> Column:
    return F.zip_with(y, mask, lambda t, m: F.when(m == 0, F.lit(IGNORED)).otherwise(t))


def cut_before(a: Column, stop_id: int) -> Column:
    """The part before the first ``stop_id``; everything when it does not occur."""
    at = F.array_position(a, stop_id)
    return F.when(at > 0, F.slice(a, F.lit(1), (at - 1).cast("int"))).otherwise(a)


def in_order(items: Column, field: str) -> Column:
    """Collected ``struct(position, <field>)`` values back in order, flattened."""
    return F.flatten(F.transform(F.sort_array(items), lambda s: s[field]))
