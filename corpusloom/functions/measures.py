"""Scalar measures of a run, as expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TRAINING_CAP = 20.0  # fixed values: loss caps before exponentiation
EVALUATION_CAP = 100.0


def perplexity(loss: Column, cap: float = TRAINING_CAP) -> Column:
    return F.exp(F.least(loss, F.lit(float(cap))))


def learning_rate(step: Column, peak: float, floor: float, warmup: int, max_steps: int) -> Column:
    """Linear warm-up to ``peak``, then half a cosine down to ``floor``."""
    progress = (step - warmup) / F.lit(float(max_steps - warmup or 1))
    decay = F.lit(floor) + (peak - floor) * 0.5 * (1 + F.cos(F.lit(math.pi) * progress))
    ramp = F.lit(float(peak)) * (step + 1) / F.lit(float(warmup or 1))
    return F.when(step < warmup, ramp).when(step >= max_steps, F.lit(float(floor))).otherwise(decay)


def tokens_per_step(batch: Column, seq: Column, accumulation: Column, ranks: Column) -> Column:
    return (batch * seq * accumulation * ranks).cast("bigint")


def elapsed_seconds(text: Column) -> Column:
    """Seconds in ``59s``, ``12m`` or ``1h02m``; null for any other text."""
    part = lambda unit: F.coalesce(
        F.try_to_number(F.regexp_extract(text, rf"(\d+){unit}", 1), F.lit("9999999999")).cast("bigint"),
        F.lit(0).cast("bigint"),
    )
    known = text.rlike(r"^(\d+s|\d+m|\d+h\d+m)$")
    return F.when(known, part("h") * 3600 + part("m") * 60 + part("s"))


def elapsed_text(seconds: Column) -> Column:
    """Seconds as ``59s``, ``12m`` or ``1h02m``."""
    hours = F.floor(seconds / 3600)
    minutes = F.floor(F.pmod(seconds, F.lit(3600)) / 60)
    return (
        F.when(seconds < 60, F.format_string("%ds", F.bround(seconds).cast("bigint")))
        .when(seconds < 3600, F.format_string("%dm", F.bround(seconds / 60).cast("bigint")))
        .otherwise(F.format_string("%dh%02dm", hours.cast("bigint"), minutes.cast("bigint")))
    )
