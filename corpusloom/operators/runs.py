"""Questions about logged runs: smoothed loss, trend, schedule, best step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.measures import learning_rate
from corpusloom.operators.metrics import best_checkpoint
from corpusloom.operators.ordered import numbered, running, with_lookback

# The frames of the loss trend and its tolerance upwards.
RECENT = 10
HISTORY = 50
RISE = 1.01
ARROWS = {"down": "↓", "up": "↑", "flat": "→"}


def loss_trend(
    steps: DataFrame, run: list[str], step: str = "step", loss: str = "loss", width: int = 100_000
) -> DataFrame:
    """Mean of the last 10 losses, the 40 before them, and the arrow between the two."""
    blocked = with_lookback(numbered(steps, run, step, width), run, HISTORY - 1, width)
    frame = Window.partitionBy(*run, "_block").orderBy("row")
    recent = F.avg(loss).over(frame.rowsBetween(-(RECENT - 1), 0))
    older = F.avg(loss).over(frame.rowsBetween(-(HISTORY - 1), -RECENT))
    rows = (
        blocked.withColumn("avg_recent", recent)
        .withColumn("avg_older", F.when(F.col("row") >= HISTORY, older))
        .filter(~F.col("_halo"))
        .drop("_block", "_halo")
    )
    arrow = (
        F.when(F.col("avg_older").isNull(), "")
        .when(F.col("avg_recent") < F.col("avg_older"), ARROWS["down"])
        .when(F.col("avg_recent") > F.col("avg_older") * RISE, ARROWS["up"])
        .otherwise(ARROWS["flat"])
    )
    return rows.withColumn("trend", arrow)


def with_schedule(
    steps: DataFrame, peak: float, floor: float, warmup: int, max_steps: int, step: str = "step"
) -> DataFrame:
    """The scheduled learning rate next to each step."""
    return steps.withColumn("lr", learning_rate(F.col(step), peak, floor, warmup, max_steps))


def schedule_check(steps: DataFrame, logged: Column, tolerance: float = 0.005) -> DataFrame:
    """Flag steps whose logged rate differs from the schedule by more than its rounding."""
    off = F.abs(logged - F.col("lr")) > F.col("lr") * tolerance
    return steps.withColumn("off_schedule", off)


def recent_train_loss(
    evals: DataFrame, steps: DataFrame, run: list[str], step: str = "step", loss: str = "loss"
) -> DataFrame:
    """Each eval with the smoothed train loss as of its step (the last one at or before it)."""
    smooth = loss_trend(steps, run, step, loss).select(
        *run, F.col(step).alias("_step"), F.col("avg_recent").alias("_train"), F.lit(0).alias("_is_eval")
    )
    points = evals.select(
        *run, F.col(step).alias("_step"), F.lit(None).cast("double").alias("_train"), F.lit(1).alias("_is_eval")
    )
    # Twice the step plus the kind orders a step's train row in front of its eval.
    both = smooth.unionByName(points).withColumn("_at", F.col("_step") * 2 + F.col("_is_eval"))
    known = running(both, run, "_at", {"train_loss": ("last", F.col("_train"))})
    return (
        known.filter("_is_eval = 1")
        .select(*run, F.col("_step").alias(step), "train_loss")
        .join(evals, [*run, step])
    )


def run_summary(evals: DataFrame, run: list[str], step: str = "step", loss: str = "val_loss") -> DataFrame:
    """Best step of a run, and the later evals that are worse: the point of divergence."""
    best = best_checkpoint(evals, run, step, loss)
    later = evals.join(best.select(*run, "best_step", "best_loss"), run).filter(F.col(step) > F.col("best_step"))
    worse = later.groupBy(*run).agg(
        F.count_if(F.col(loss) > F.col("best_loss")).alias("n_worse"),
        F.min(F.when(F.col(loss) > F.col("best_loss"), F.col(step))).alias("diverged_at"),
    )
    return best.join(worse, run, "left").withColumn("n_worse", F.coalesce("n_worse", F.lit(0)))
