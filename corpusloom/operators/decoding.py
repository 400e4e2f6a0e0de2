"""Next-token selection over ``logits(seq keys, token_id, logit)``.

Every window is over one sequence's distribution, whose size the vocabulary bounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.keys import uniform

# Defaults of bulk replies and of the samples written while training.
REPLY_TEMPERATURE, REPLY_TOP_K, REPLY_TOP_P, REPLY_TOKENS = 0.7, 50, 0.9, 512
SAMPLE_TEMPERATURE, SAMPLE_TOP_K, SAMPLE_TOKENS = 0.8, 40, 100
EVAL_TOKENS = 200


def temperature(logits: DataFrame, t: float) -> DataFrame:
    return logits if t == 1.0 else logits.withColumn("logit", F.col("logit") / F.lit(float(t)))


def top_k(logits: DataFrame, seq: list[str], k: int) -> DataFrame:
    """Keep logits at or above the k-th value; ties stay, k <= 0 keeps all."""
    if k <= 0:
        return logits
    rank = F.rank().over(Window.partitionBy(*seq).orderBy(F.desc("logit")))
    return logits.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")


def softmax(logits: DataFrame, seq: list[str]) -> DataFrame:
    """Add ``prob``, normalised over the rows that are left."""
    whole = Window.partitionBy(*seq)
    weight = F.exp(F.col("logit") - F.max("logit").over(whole))
    return (
        logits.withColumn("_w", weight).withColumn("prob", F.col("_w") / F.sum("_w").over(whole)).drop("_w")
    )


def nucleus(logits: DataFrame, seq: list[str], p: float) -> DataFrame:
    """Keep a token while the probability mass in front of it is below p; p >= 1 keeps all."""
    if p >= 1.0:
        return logits
    order = Window.partitionBy(*seq).orderBy(F.desc("logit"), "token_id")
    before = F.coalesce(F.sum("prob").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    # The first token stays whatever p is.
    kept = (F.col("_before") < p) | (F.col("_first") == 1)
    scored = softmax(logits, seq).withColumn("_before", before).withColumn("_first", F.row_number().over(order))
    return scored.filter(kept).drop("_before", "_first", "prob")


def cumulative(probs: DataFrame, seq: list[str]) -> DataFrame:
    """Add ``cum``: probability up to and including the token, likeliest first."""
    order = Window.partitionBy(*seq).orderBy(F.desc("logit"), "token_id")
    upto = F.sum("prob").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return probs.withColumn("cum", upto)


def draw(probs: DataFrame, seq: list[str], seed, *parts: Column) -> DataFrame:
    """One token per sequence: the first whose cumulative probability passes the draw.

    If rounding leaves none, the last token. ``prob`` need not sum to one; the draw is
    scaled to its sum.
    """
    u = uniform(seed, *[F.col(s) for s in seq], *parts)
    scaled = u * F.max("cum").over(Window.partitionBy(*seq))
    at = cumulative(probs, seq).withColumn("_u", scaled)
    first = F.min_by("token_id", F.when(F.col("cum") > F.col("_u"), F.struct("cum", "token_id")))
    last = F.max_by("token_id", F.struct("cum", "token_id"))
    return at.groupBy(*seq).agg(F.coalesce(first, last).alias("token_id"))


def distribution(logits: DataFrame, seq: list[str], t: float, k: int, p: float) -> DataFrame:
    """Temperature, top-k, nucleus, softmax: what the next token is drawn from."""
    return softmax(nucleus(top_k(temperature(logits, t), seq, k), seq, p), seq)


def sample_distribution(
    logits: DataFrame, seq: list[str], t: float = SAMPLE_TEMPERATURE, k: int = SAMPLE_TOP_K
) -> DataFrame:
    """The variant used for samples while training: softmax first, then exactly k tokens."""
    scored = softmax(temperature(logits, t), seq)
    order = Window.partitionBy(*seq).orderBy(F.desc("prob"), "token_id")
    return scored.withColumn("_row", F.row_number().over(order)).filter(F.col("_row") <= k).drop("_row")
