"""Seeded shuffle, count-exact splits, selection by index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.ordered import key_at, seeded, seeded_position

SHUFFLE_SEED = 42  # fixed values: default seed and validation shares
CORPUS_VAL_FRACTION = 0.005
CHAT_VAL_FRACTION = 0.02


def shuffled(df: DataFrame, key: list[str], seed: int = SHUFFLE_SEED) -> DataFrame:
    """Each row with its place in the seeded shuffle (``position``)."""
    return seeded_position(df, key, seed).drop("order_key", "bucket")


def _val_count(total, fraction: float):
    if fraction <= 0:
        return F.lit(0).cast("bigint")
    return F.greatest(F.floor(total * F.lit(float(fraction))), F.lit(1))


def split_corpus(
    df: DataFrame,
    key: list[str],
    fraction: float = CORPUS_VAL_FRACTION,
    seed: int = SHUFFLE_SEED,
    ids: DataFrame | None = None,
) -> DataFrame:
    """Label rows train / val; val is the last max(int(n * fraction), 1) of the shuffle.

    The label is a comparison with one key found from two narrow passes over the ids,
    so the rows themselves are not shuffled. Where ``df`` is costly to make, ``ids`` names
    a cheaper table with the same keys for those passes.
    """
    keyed = seeded(df, key, seed)
    among = keyed if ids is None else seeded(ids, key, seed)
    cut = key_at(among, lambda n: n - _val_count(n, fraction)).scalar()
    label = F.when(F.col("order_key") >= cut, "val").otherwise("train")
    return keyed.withColumn("split", label)


def split_examples(
    df: DataFrame, key: list[str], fraction: float = CHAT_VAL_FRACTION, seed: int = SHUFFLE_SEED
) -> DataFrame:
    """Label rows train / val; val is the first max(int(n * fraction), 1), none for 0."""
    keyed = seeded(df, key, seed)
    cut = key_at(keyed, lambda n: _val_count(n, fraction)).scalar()
    label = F.when(cut.isNull() | (F.col("order_key") < cut), "val").otherwise("train")
    return keyed.withColumn("split", label)


def select_rows(df: DataFrame, indices: DataFrame, index: str = "position") -> DataFrame:
    """Rows whose index is in ``indices`` (a table with the same column)."""
    return df.join(indices.select(index), index, "left_semi")


def pick_in_order(df: DataFrame, indices: DataFrame, index: str = "position") -> DataFrame:
    """One row per entry of ``indices(slot, position)``; repeats and order are kept in ``slot``."""
    return indices.select("slot", index).join(df, index)
