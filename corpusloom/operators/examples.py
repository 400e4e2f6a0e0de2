"""Fine-tuning examples to fixed-length inputs and targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.arrays import (
    IGNORED,
    ints,
    masked_targets,
    padded,
    truncated,
    without_first,
    without_last,
)


def to_tensors(
    df: DataFrame, seq_length: int, ids: str = "token_ids", mask: str = "loss_mask"
) -> DataFrame:
    """Truncate, pad, shift and mask: columns ``x`` and ``y`` of ``seq_length`` each."""
    tokens = padded(truncated(F.col(ids), seq_length), seq_length)
    flags = padded(truncated(F.col(mask), seq_length), seq_length, 0)
    return (
        df.withColumn("_t", tokens)
        .withColumn("_m", flags)
        .withColumn("x", ints(without_last(F.col("_t"))))
        .withColumn("y", ints(masked_targets(without_first(F.col("_t")), without_first(F.col("_m")))))
        .drop("_t", "_m")
    )


def shifted(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Input and target of a window: the target is one token ahead."""
    return df.withColumn("x", ints(without_last(F.col(tokens)))).withColumn(
        "y", ints(without_first(F.col(tokens)))
    )


def validity_report(
    examples: DataFrame, seq_length: int, group: list[str], ids: str = "token_ids"
) -> DataFrame:
    """How much of each group trains: truncated rows, fully masked rows, trained share."""
    trained = F.size(F.filter("y", lambda t: t != IGNORED))
    rows = examples.withColumn("_trained", trained).withColumn("_long", F.size(ids) > seq_length + 1)
    return rows.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_examples"),
        F.count_if("_long").alias("n_truncated"),
        F.count_if(F.col("_trained") == 0).alias("n_fully_masked"),
        F.sum("_trained").alias("n_trained"),
        (F.sum("_trained") / (F.count(F.lit(1)) * seq_length)).alias("trained_share"),
    )
