"""Joins whose frequent keys are spread over tasks."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import stage, task_count


def _met(a: DataFrame, b: DataFrame, keys: list[str], how: str) -> DataFrame:
    own = {k: f"_own_{k}" for k in keys}
    on: list[Column] = [F.col(k) == F.col(o) for k, o in own.items()]
    return a.join(b.withColumnsRenamed(own), reduce(and_, on), how).drop(*own.values())


def split_join(many: DataFrame, few: DataFrame, keys: list[str], how: str = "inner", counts: DataFrame | None = None) -> DataFrame:
    """``many`` with the columns of ``few``, which has each key once, or few times; inner or left.

    Keys that hold more than twice a task's share of ``many`` are found by a count (or given as
    ``keys, n`` in ``counts``). Their rows are dealt over as many parts as they fill shares, by a
    hash of the row, and their rows of ``few`` are copied to each part; all other rows are
    joined as they are. Fewer keys can be frequent than half the tasks, which is what is
    broadcast. Rows and columns are those of the plain join, nulls match nothing.
    """
    tasks = task_count(many.sparkSession)
    if counts is None:
        counts = many.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    counts = stage(counts.select(*keys, "n").dropna(subset=keys), "key-counts")
    share = counts.agg((F.coalesce(F.sum("n"), F.lit(0)) / tasks).alias("share")).first()["share"]
    frequent = counts.filter(F.col("n") > F.lit(2.0 * share)).select(*keys, F.ceil(F.col("n") / F.lit(max(share, 1.0))).cast("int").alias("_parts"))
    frequent = F.broadcast(frequent)
    parts = F.coalesce("_parts", F.lit(1))
    dealt = _met(many, frequent, keys, "left").withColumn("_part", F.pmod(F.xxhash64(*many.columns, F.spark_partition_id()), parts)).drop("_parts")
    copied = _met(few, frequent, keys, "left").withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), parts.cast("bigint") - 1))).drop("_parts")
    return _met(dealt, copied, [*keys, "_part"], how).drop("_part")
