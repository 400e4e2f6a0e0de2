"""Which example goes to which rank, batch and step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.keys import joined
from corpusloom.operators.ordered import seeded_position


def shard(df: DataFrame, key: list[str], world_size: int, seed: int = 42, epochs: int = 1) -> DataFrame:
    """Per epoch: shuffle, pad to a multiple of the ranks, deal out in turn.

    Padding repeats the shuffle from its start, so every rank gets the same count. Returns
    ``key, epoch, rank, place`` and the common row count ``per_rank``.
    """
    each = df.select(*key, F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"))
    placed = seeded_position(each, [*key], joined(seed, F.col("epoch")), ("epoch",))
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    per_rank = F.ceil(total / world_size)
    padded = per_rank * world_size
    places = F.sequence(F.col("position"), (padded - 1).cast("bigint"), total)
    return placed.select(*key, "epoch", F.explode(places).alias("_i")).select(
        *key,
        "epoch",
        (F.col("_i") % world_size).cast("int").alias("rank"),
        F.floor(F.col("_i") / world_size).alias("place"),
        per_rank.alias("per_rank"),
    )


def batches(sharded: DataFrame, batch_size: int) -> DataFrame:
    """Full batches only: ``batch_id`` and ``slot`` per (epoch, rank); the short rest is dropped."""
    dealt = sharded.withColumn("batch_id", F.floor(F.col("place") / batch_size)).withColumn(
        "slot", (F.col("place") % batch_size).cast("int")
    )
    full = F.floor(F.col("per_rank") / batch_size)
    return dealt.filter(F.col("batch_id") < full).drop("per_rank", "place")


def first_batches(df: DataFrame, limit: int, batch: str = "batch_id") -> DataFrame:
    """Only the first ``limit`` batches take part in an evaluation."""
    return df.filter(F.col(batch) < limit)


def schedule(
    df: DataFrame,
    key: list[str],
    steps: int,
    accumulation: int,
    batch_size: int,
    world_size: int = 1,
    seed: int = 42,
) -> DataFrame:
    """Every step's micro-batches: step s uses batches s*G .. s*G+G-1, wrapping into new epochs.

    ``key, rank, step, micro_step, epoch, batch_id, slot``. The number of epochs follows
    from one count of the examples.
    """
    spark = df.sparkSession
    per_rank = -(-df.count() // world_size)
    per_epoch = per_rank // batch_size
    if per_epoch == 0:
        raise ValueError(f"{per_rank} examples per rank do not fill a batch of {batch_size}")
    needed = steps * accumulation
    dealt = batches(shard(df, key, world_size, seed, -(-needed // per_epoch)), batch_size)
    micro = spark.range(needed).select(
        F.floor(F.col("id") / accumulation).alias("step"),
        (F.col("id") % accumulation).cast("int").alias("micro_step"),
        F.floor(F.col("id") / per_epoch).cast("int").alias("epoch"),
        (F.col("id") % per_epoch).alias("batch_id"),
    )
    return micro.join(dealt, ["epoch", "batch_id"])

