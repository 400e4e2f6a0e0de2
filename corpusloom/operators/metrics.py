"""Counters, losses, perplexity and run accounting as grouped aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from corpusloom.functions.arrays import IGNORED
from corpusloom.functions.measures import tokens_per_step
from corpusloom.operators.ordered import running
from corpusloom.session import stage

INFINITY = float("inf")
NOT_A_NUMBER = float("nan")
LOGIT_STRIP = 64.0  # exp() of a value within one strip cannot overflow
PLAN_FIELDS = ("name", "seq_length", "batch_size", "grad_accum_steps", "max_steps")


def stage_counters(df: DataFrame, group: list[str], ids: str = "token_ids") -> DataFrame:
    """Documents and tokens per group."""
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.coalesce(F.sum(F.size(ids)), F.lit(0)).cast("bigint").alias("n_tokens"),
    )


def _written(kept: Column, size: Column) -> list[Column]:
    return [
        F.count_if(kept).alias("written"),
        F.count_if(~kept).alias("skipped"),
        F.coalesce(F.sum(F.when(kept, size)), F.lit(0)).cast("bigint").alias("tokens_written"),
    ]


def write_counters(df: DataFrame, kept: Column, group: list[str], size: Column) -> DataFrame:
    """Rows and tokens written, rows skipped, per group."""
    return df.groupBy(*group).agg(*_written(kept, size))


def stage_with_counters(df: DataFrame, kept: Column, size: Column, name: str, path: str | None = None) -> tuple[DataFrame, dict[str, int]]:
    """The rows kept, as a written table, and the same counters, observed while it was written.

    There is no second pass: the tasks that write the rows count them on the way.
    """
    seen = Observation()
    table = stage(df.observe(seen, *_written(kept, size)).filter(kept), name, path)
    return table, seen.get


def exact_quantiles(df: DataFrame, group: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Discrete quantiles from value counts: the smallest value that reaches the share.

    The window runs over distinct values with their counts, not over rows.
    """
    counts = df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(*group).orderBy(value)
    total = F.sum("_n").over(Window.partitionBy(*group))
    reached = counts.withColumn("_c", F.sum("_n").over(upto)).withColumn("_total", total)
    return reached.groupBy(*group).agg(
        *[F.min(F.when(F.col("_c") >= F.col("_total") * F.lit(s), F.col(value))).alias(n) for n, s in shares.items()]
    )


def token_statistics(df: DataFrame, group: list[str], ids: str = "token_ids") -> DataFrame:
    """Documents, tokens, mean, extremes and quartiles of length per group.

    The lengths are written, as two passes read them: the texts are encoded once.
    """
    sized = stage(df.select(*group, F.size(ids).cast("bigint").alias("n")), "sizes")
    plain = sized.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum("n").alias("n_tokens"),
        F.min("n").alias("min_tokens"),
        F.max("n").alias("max_tokens"),
        F.avg("n").alias("avg_tokens"),
    )
    quartiles = exact_quantiles(sized, group, "n", {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return plain.join(quartiles, group)


def log_normalizer(logits: DataFrame, position: list[str], logit: str = "logit") -> DataFrame:
    """log(sum(exp(logit))) per position, safe from overflow and without moving raw logits.

    Logits are summed per strip of 64, which combines map-side; the few strip sums of a
    position are then scaled to its highest strip.
    """
    strips = (
        logits.withColumn("_s", F.floor(F.col(logit) / LOGIT_STRIP))
        .groupBy(*position, "_s")
        .agg(F.sum(F.exp(F.col(logit) - F.col("_s") * LOGIT_STRIP)).alias("_e"))
    )
    scaled = F.aggregate(
        "_all", F.lit(0.0), lambda acc, s: acc + s["_e"] * F.exp((s["_s"] - F.col("_top")) * LOGIT_STRIP)
    )
    return (
        strips.groupBy(*position)
        .agg(F.max("_s").alias("_top"), F.collect_list(F.struct("_s", "_e")).alias("_all"))
        .select(*position, (F.log(scaled) + F.col("_top") * LOGIT_STRIP).alias("log_norm"))
    )


def token_losses(logits: DataFrame, targets: DataFrame, position: list[str]) -> DataFrame:
    """``targets`` plus the loss of each: log normaliser minus the target's logit.

    Ignored targets (-1) keep their row with a null loss. A target without a logit has
    probability zero, and so an infinite loss.
    """
    wanted = targets.filter(F.col("y") != IGNORED).select(*position, F.col("y").alias("token_id"))
    hit = logits.join(wanted, [*position, "token_id"]).select(*position, F.col("logit").alias("_hit"))
    norm = log_normalizer(logits, position)
    return (
        targets.join(norm, position, "left")
        .join(hit, position, "left")
        .withColumn("nll", F.when(F.col("y") != IGNORED, F.coalesce(F.col("log_norm") - F.col("_hit"), F.lit(INFINITY))))
        .drop("_hit", "log_norm")
    )


def batch_losses(losses: DataFrame, batch: list[str], nll: str = "nll") -> DataFrame:
    """Mean over the counted targets of a batch; NaN where a batch has none."""
    return losses.groupBy(*batch).agg(
        F.coalesce(F.avg(nll), F.lit(NOT_A_NUMBER)).alias("loss"), F.count(nll).alias("n_targets")
    )


def mean_loss(batch_table: DataFrame, group: list[str]) -> DataFrame:
    """Unweighted mean of batch means (one NaN batch makes it NaN)."""
    return batch_table.groupBy(*group).agg(F.avg("loss").alias("loss"), F.count(F.lit(1)).alias("n_batches"))


def overall_loss(batch_table: DataFrame) -> DataFrame:
    """One row over everything: infinity when there is no batch at all."""
    return batch_table.agg(
        F.coalesce(F.avg("loss"), F.lit(INFINITY)).alias("loss"), F.count(F.lit(1)).alias("n_batches")
    )


def token_weighted_loss(batch_table: DataFrame, group: list[str]) -> DataFrame:
    """The variant that weighs each batch by its counted targets."""
    weight = F.sum(F.when(F.col("n_targets") > 0, F.col("loss") * F.col("n_targets")))
    return batch_table.groupBy(*group).agg((weight / F.sum("n_targets")).alias("loss"))


def mean_over_ranks(rank_losses: DataFrame, group: list[str]) -> DataFrame:
    """Average of per-rank means."""
    return rank_losses.groupBy(*group).agg(F.avg("loss").alias("loss"), F.count(F.lit(1)).alias("n_ranks"))


def accumulated_loss(micro: DataFrame, group: list[str], accumulation: int, loss: str = "loss") -> DataFrame:
    """Loss of a step: the sum of its micro-batch losses, each divided by the accumulation."""
    return micro.groupBy(*group).agg(F.sum(F.col(loss) / accumulation).alias("loss"))


def progress(
    steps: DataFrame, run: list[str], per_step: int, max_steps: int, step: str = "step", dt: str = "dt"
) -> DataFrame:
    """Cumulative tokens and time, throughput, share of the target, time left.

    The time left extrapolates the elapsed time per step taken since the run's first
    step; it is null at that first step.
    """
    measures = {
        "tokens": ("count", F.lit(1)),
        "elapsed": ("sum", F.col(dt)),
        "first_step": ("min", F.col(step)),
    }
    rows = running(steps, run, step, measures)
    taken = F.greatest(F.col(step) - F.col("first_step"), F.lit(1))
    left = F.col("elapsed") / taken * (max_steps - F.col(step))
    return (
        rows.withColumn("tokens", (F.col("tokens") * per_step).cast("bigint"))
        .withColumn("tokens_per_sec", F.try_divide(F.lit(float(per_step)), F.col(dt)))
        .withColumn("percent", F.col("tokens") / F.lit(float(per_step * max_steps)) * 100)
        .withColumn("eta", F.when(F.col(step) > F.col("first_step"), left))
        .drop("first_step")
    )


def best_so_far(evals: DataFrame, run: list[str], step: str = "step", loss: str = "val_loss") -> DataFrame:
    """Best loss before each eval, whether the eval beats it (strictly), best after it."""
    rows = running(evals, run, step, {"_prev": ("min", F.col(loss))}, inclusive=False)
    previous = F.coalesce(F.col("_prev"), F.lit(INFINITY))
    return (
        rows.withColumn("is_best", F.col(loss) < previous)
        .withColumn("best_loss", F.least(previous, F.col(loss)))
        .drop("_prev")
    )


def best_checkpoint(evals: DataFrame, run: list[str], step: str = "step", loss: str = "val_loss") -> DataFrame:
    """The first step that reaches the lowest loss, and the last step, per run."""
    return evals.groupBy(*run).agg(
        F.min(loss).alias("best_loss"),
        F.min_by(F.col(step), F.struct(loss, step)).alias("best_step"),
        F.max(step).alias("last_step"),
        F.max_by(F.col(loss), F.col(step)).alias("last_loss"),
    )


def clip_report(steps: DataFrame, run: list[str], grad_clip: float, norm: str = "grad_norm") -> DataFrame:
    """Share of logged steps whose gradient norm was clipped; N/A rows count apart."""
    value = F.col(norm).try_cast("double")
    logged = F.count(value)
    clipped = F.count_if(value > grad_clip)
    return steps.groupBy(*run).agg(
        logged.alias("n_logged"),
        F.count_if(value.isNull()).alias("n_off"),
        clipped.alias("n_clipped"),
        F.try_divide(clipped, logged).alias("clipped_share"),
    )


def run_plan(totals: DataFrame, configs: list[dict], ranks: int, corpus_tokens: str = "n_tokens") -> DataFrame:
    """What each configuration would do with a corpus of the counted size.

    The few configurations ride along as an array on each total, so nothing is joined.
    """
    options = F.array(
        *[F.struct(*[F.lit(c[f]).alias(f) for f in PLAN_FIELDS]) for c in configs]
    )
    planned = totals.withColumn("_c", F.explode(options)).select(*totals.columns, "_c.*")
    effective = F.col("batch_size") * ranks * F.col("grad_accum_steps")
    per_step = tokens_per_step(
        F.col("batch_size").cast("bigint"), F.col("seq_length"), F.col("grad_accum_steps"), F.lit(ranks)
    )
    return (
        planned.withColumn("effective_batch", effective.cast("bigint"))
        .withColumn("tokens_per_step", per_step)
        .withColumn("target_tokens", per_step * F.col("max_steps"))
        .withColumn("corpus_passes", F.try_divide(F.col("target_tokens"), F.col(corpus_tokens)))
    )
