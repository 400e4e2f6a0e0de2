"""An interpolated n-gram model as count tables: fit, fine-tune, score, save, resume.

The model is one table of trigram counts ``(w1, w2, w3, n)``; shorter orders are its
re-aggregations. Positions before the start of a stream or example count as token -1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions.arrays import IGNORED, ints
from corpusloom.operators.bitmap import among
from corpusloom.operators.metrics import NOT_A_NUMBER
from corpusloom.operators.skew import split_join
from corpusloom.operators.vocabulary import BROADCAST_ROWS
from corpusloom.session import stage

START = -1
INT_MIN = -(1 << 31)
COUNTED_TOKENS = 1 << 21  # 17 MB a column while they are sorted
TRIGRAM = ["w1", "w2", "w3"]
MET = ["c3", "n2", "c2", "n1", "c1"]
WEIGHT = 0.7  # share of each order's own estimate against the order below


@dataclass(frozen=True)
class NgramModel:
    """Trigram counts, vocabulary size, interpolation weight, and run metadata."""

    counts: DataFrame
    size: int
    weight: float = WEIGHT
    step: int = 0
    val_loss: float = float("inf")

    def _bounded(self, df: DataFrame) -> DataFrame:
        """Tables with at most one row per token may be broadcast if tokens are few."""
        return F.broadcast(df) if self.size <= BROADCAST_ROWS else df

    @cached_property
    def pairs(self) -> DataFrame:
        return self.counts.groupBy("w2", "w3").agg(F.sum("n").alias("c2"))

    @cached_property
    def pair_contexts(self) -> DataFrame:
        return self.counts.groupBy("w1", "w2").agg(F.sum("n").alias("n2"))

    @cached_property
    def contexts(self) -> DataFrame:
        return self._bounded(self.counts.groupBy("w2").agg(F.sum("n").alias("n1")))

    @cached_property
    def tokens(self) -> DataFrame:
        return self._bounded(self.counts.groupBy("w3").agg(F.sum("n").alias("c1")))

    def total(self) -> Column:
        return self.tokens.agg(F.coalesce(F.sum("c1"), F.lit(0.0)).alias("n")).scalar()

    def mix(self, hits: Column, seen: Column, lower: Column) -> Column:
        """A seen context mixes its own estimate with the order below; an unseen one defers."""
        mixed = self.weight * F.coalesce(hits, F.lit(0.0)) / seen + (1 - self.weight) * lower
        return F.when(F.coalesce(seen, F.lit(0.0)) > 0, mixed).otherwise(lower)

    def p1(self) -> Column:
        return self.mix(F.col("c1"), self.total(), F.lit(1.0 / self.size))

    def p2(self) -> Column:
        return self.mix(F.col("c2"), F.col("n1"), self.p1())

    def p3(self) -> Column:
        return self.mix(F.col("c3"), F.col("n2"), self.p2())

    def counted(self, path: str | None = None) -> "NgramModel":
        """The same model with its counts written: what follows reads them, not the text."""
        return replace(self, counts=stage(self.counts, "ngram-trigrams", path))

    def summed(self) -> "NgramModel":
        """The same model with its tables of a row per token written, if tokens are few and they are not."""
        if self.size > BROADCAST_ROWS or "tokens" in self.__dict__:
            return self
        kept = replace(self)
        for table in ("contexts", "tokens"):
            kept.__dict__[table] = self._bounded(stage(getattr(self, table), f"ngram-{table}"))
        return kept

    def under(self, weight: float, step: int) -> "NgramModel":
        """The same tables under another weight."""
        other = replace(self, weight=weight, step=step)
        other.__dict__.update({t: self.__dict__[t] for t in ("pairs", "pair_contexts", "contexts", "tokens") if t in self.__dict__})
        return other

    def stored(self, name: str = "ngram") -> "NgramModel":
        """The same model with all its tables written, for use token by token."""
        kept = self.counted()
        for table in ("pairs", "pair_contexts"):
            kept.__dict__[table] = stage(getattr(kept, table), f"{name}-{table}")
        for table in ("contexts", "tokens"):
            kept.__dict__[table] = self._bounded(stage(getattr(kept, table), f"{name}-{table}"))
        return kept


def _triples(tokens: Column) -> Column:
    """Consecutive triples of an array as structs; none if it is shorter than three."""
    triple = lambda i: F.struct(
        F.get(tokens, i).alias("w1"), F.get(tokens, i + 1).alias("w2"), F.get(tokens, i + 2).alias("w3")
    )
    last = F.size(tokens) - 3
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), triple))


def packed_triples(arrays: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """The different triples of some token arrays as three columns, and how often each occurs."""
    return packed(*(np.concatenate([a[i : len(a) - 2 + i] for a in arrays if len(a) > 2] or [np.zeros(0, np.int32)]) for i in range(3)))


def packed(w1: np.ndarray, w2: np.ndarray, w3: np.ndarray) -> tuple[np.ndarray, ...]:
    """The different triples of three columns as three columns, and how often each occurs."""
    w1, w2, w3 = (w.astype(np.int64) for w in (w1, w2, w3))
    least = min((int(a.min()) for a in (w1, w2, w3) if len(a)), default=0)
    if all(int(a.max()) - least < 1 << 21 for a in (w1, w2, w3) if len(a)):
        keys, n = np.unique(((w1 - least) << 42) + ((w2 - least) << 21) + w3 - least, return_counts=True)
        return *(((keys >> by & (1 << 21) - 1) + least).astype(np.int32) for by in (42, 21, 0)), n
    # Pairs are numbered, so that a number and an id of any size share 64 bits.
    pairs, at = np.unique((w1 << 32) + w2, return_inverse=True)
    keys, n = np.unique((at.astype(np.int64) << 32) + w3 - INT_MIN, return_counts=True)
    pair = pairs[keys >> 32]
    # The lower half of a pair carries the sign of its second token.
    second = (pair & 0xFFFFFFFF).astype(np.uint32).view(np.int32)
    return ((pair - second) >> 32).astype(np.int32), second, ((keys & 0xFFFFFFFF) + INT_MIN).astype(np.int32), n


def _inner_counts(stream: DataFrame) -> DataFrame:
    """``(w1, w2, w3, n)`` of the triples inside chunks, counted ``COUNTED_TOKENS`` tokens at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in packed_triples(held)], [*TRIGRAM, "n"])

        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for tokens in batch.column(0):
                if tokens.is_valid and len(tokens) > 2:
                    held.append(tokens.values.to_numpy(zero_copy_only=False))
                    size += len(held[-1])
                if size >= COUNTED_TOKENS:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    return stream.select(ints(F.col("tokens"))).mapInArrow(run, "w1 int, w2 int, w3 int, n bigint")


def stream_counts(stream: DataFrame, weight: float = 1.0) -> DataFrame:
    """How often each token of a stream comes after the two before it.

    Triples inside a chunk come from the chunk alone; the first two tokens of a chunk
    take their context from the last two of the chunk before, an equi-join on two-token
    rows. Chunks other than the last must hold at least two tokens. Each task counts the
    former in arrays, so that only different triples become rows.
    """
    ends = stream.select(
        "split", "chunk_id", F.slice("tokens", 1, 2).alias("head"), F.slice("tokens", -2, 2).alias("tail")
    )
    previous = ends.select("split", (F.col("chunk_id") + 1).alias("chunk_id"), F.col("tail").alias("lead"))
    start = F.array(F.lit(START), F.lit(START))
    met = ends.join(previous, ["split", "chunk_id"], "left")
    edge = met.select(F.concat(F.coalesce("lead", start), "head").alias("tokens"))
    across = edge.select(F.inline(_triples(F.col("tokens")))).withColumn("n", F.lit(1).cast("bigint"))
    both = _inner_counts(stream).unionByName(across).groupBy(*TRIGRAM)
    return both.agg((F.sum("n") * F.lit(float(weight))).alias("n"))


def example_positions(examples: DataFrame, keep: list[str]) -> DataFrame:
    """Targets of ``(x, y)`` rows with their two-token context; ignored targets have null w3."""
    context = F.concat(F.array(F.lit(START)), F.slice("x", F.lit(1), F.greatest(F.size("x") - 1, F.lit(0))))
    target = F.when(F.col("_t.y") != IGNORED, F.col("_t.y"))
    return (
        examples.withColumn("_w1", context)
        .select(*keep, F.posexplode(F.arrays_zip("_w1", "x", "y")).alias("pos", "_t"))
        .select(*keep, "pos", F.col("_t._w1").alias("w1"), F.col("_t.x").alias("w2"), target.alias("w3"))
    )


def count_triples(triples: DataFrame, weight: float = 1.0) -> DataFrame:
    return triples.groupBy(*TRIGRAM).agg((F.count(F.lit(1)) * F.lit(float(weight))).alias("n"))


def fit_lm(stream: DataFrame, size: int, weight: float = WEIGHT) -> NgramModel:
    """Count a token stream; duplicates combine before the shuffle."""
    return NgramModel(stream_counts(stream), size, weight)


def merged(model: NgramModel, more: DataFrame) -> NgramModel:
    """Counts added up; those of the model that ``more`` surely lacks stay where they are."""
    more = stage(more, "more-counts")
    key = F.xxhash64(*TRIGRAM)
    maybe = among(more.select(key.alias("h")))
    both = model.counts.filter(maybe(key)).unionByName(more).groupBy(*TRIGRAM).agg(F.sum("n").alias("n"))
    return replace(model, counts=model.counts.filter(~maybe(key)).unionByName(both))


def finetune_lm(model: NgramModel, examples: DataFrame, weight: float = 1.0) -> NgramModel:
    """Start from the base counts and learn only the targets that are not ignored."""
    learned = example_positions(examples, []).filter(F.col("w3").isNotNull())
    return merged(model, count_triples(learned.select(*TRIGRAM), weight))


def resume_lm(model: NgramModel, stream: DataFrame) -> NgramModel:
    """Go on training: add a stream to the old counts, one step later."""
    grown = merged(model, stream_counts(stream))
    return replace(grown, step=model.step + 1)


def resize_vocab(model: NgramModel, size: int) -> NgramModel:
    """Old counts unchanged; new ids hold only the uniform share."""
    return replace(model, size=size)


def met_triples(model: NgramModel, wanted: DataFrame) -> DataFrame:
    """Each distinct triple with its counts ``c3, n2, c2, n1, c1`` in the model, null where there is none.

    Count tables are first cut to the wanted keys where they are read, by a bitmap of hashes, so
    that of a large model little more is shuffled than is asked for.
    """
    def only(table: DataFrame, keys: list[str]) -> DataFrame:
        return table.filter(among(wanted.select(F.xxhash64(*keys).alias("h")))(F.xxhash64(*keys)))

    def by_token(found: DataFrame, table: DataFrame, key: str) -> DataFrame:
        """Small tables are sent around; beyond that a frequent token's rows are split."""
        return found.join(table, key, "left") if model.size <= BROADCAST_ROWS else split_join(found, table, [key], "left")

    found = (
        wanted.join(only(model.counts, TRIGRAM).withColumnRenamed("n", "c3"), TRIGRAM, "left")
        .join(only(model.pair_contexts, ["w1", "w2"]), ["w1", "w2"], "left")
        .join(only(model.pairs, ["w2", "w3"]), ["w2", "w3"], "left")
    )
    found = by_token(by_token(found, model.contexts, "w2"), model.tokens, "w3")
    return found.select(*TRIGRAM, *MET)


def score_triples(model: NgramModel, wanted: DataFrame) -> DataFrame:
    """``log_prob`` of each distinct triple."""
    model = model.summed()
    return met_triples(model, wanted).select(*TRIGRAM, F.log(model.p3()).alias("log_prob"))


def score(model: NgramModel, examples: DataFrame, keep: list[str]) -> DataFrame:
    """Log-probability of every target; null where the target is ignored.

    Each distinct triple is scored once and joined back to its positions, those of a frequent
    one in several tasks. Ignored positions stay out of the join, where their null keys would meet in one task.
    """
    positions = example_positions(examples, keep)
    wanted = positions.filter(F.col("w3").isNotNull())
    counts = stage(wanted.groupBy(*TRIGRAM).agg(F.count(F.lit(1)).alias("n")), "triples")
    scored = split_join(wanted, score_triples(model, counts.select(*TRIGRAM)), TRIGRAM, "left", counts)
    ignored = positions.filter(F.col("w3").isNull()).withColumn("log_prob", F.lit(None).cast("double"))
    return scored.unionByName(ignored)


def _triple_counter(model: NgramModel):
    """An Arrow function: inputs and targets of a row -> its different triples, and how often each occurs.

    Tokens that the model has not seen all have the same estimate there, and what precedes one
    that it has not seen in front of another does not matter. They become one id below all others,
    so that they are counted together. Ignored targets and null tokens are left out.
    """
    known = None
    if model.size <= BROADCAST_ROWS:
        last, next_ = (np.array([r[0] for r in t.collect() if r[0] is not None], np.int64) for t in (model.contexts.select("w2"), model.tokens.select("w3")))
        known = (last, next_, min([START, *last.tolist(), *next_.tolist()]) - 1)
    shared = model.counts.sparkSession.sparkContext.broadcast(known)

    def columns(x: pa.Array, y: pa.Array) -> tuple[np.ndarray, ...]:
        n = min(len(x), len(y))
        x, y = x.slice(0, n), y.slice(0, n)
        w2, w3 = (pc.fill_null(a, 0).to_numpy(zero_copy_only=False).astype(np.int64) for a in (x, y))
        there = x.is_valid().to_numpy(zero_copy_only=False)
        use = there & y.is_valid().to_numpy(zero_copy_only=False) & (w3 != IGNORED)
        use[1:] &= there[:-1]
        w1 = np.concatenate([[START], w2[:-1]])[: len(w2)]
        w1, w2, w3 = w1[use], w2[use], w3[use]
        if shared.value is not None:
            last, next_, unseen = shared.value
            met = np.isin(w2, last)
            w1, w2, w3 = np.where(met, w1, unseen), np.where(met, w2, unseen), np.where(np.isin(w3, next_), w3, unseen)
        return packed(w1, w2, w3)

    def count(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        empty = np.zeros(0, np.int32)
        for xs, ys in batches:
            rows = [columns(x.values, y.values) if x.is_valid and y.is_valid else (empty,) * 4 for x, y in zip(xs, ys)]
            ends = np.concatenate([[0], np.cumsum([len(r[3]) for r in rows])]).astype(np.int32)
            parts = [pa.array(np.concatenate([empty, *c]), t) for c, t in zip(zip(*rows), (pa.int32(),) * 3 + (pa.int64(),))]
            yield pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(parts, [*TRIGRAM, "n"]))

    return F.arrow_udf(count, "array<struct<w1:int,w2:int,w3:int,n:bigint>>")


def met_batches(model: NgramModel, examples: DataFrame, batch: list[str]) -> DataFrame:
    """The different triples of each batch, how often each occurs (``_n``), and its counts in the model, written.

    Repeated triples of a batch are counted before they are joined, so a hot triple joins once
    per batch and not once per position. No weight is used: models of one set of counts share it.
    """
    model = model.summed()
    counter = _triple_counter(model)
    counted = examples.select(*batch, F.inline(counter(ints(F.col("x")), ints(F.col("y")))))
    counted = stage(counted.groupBy(*batch, *TRIGRAM).agg(F.sum("n").alias("_n")), "batch-triples")
    counts = stage(counted.groupBy(*TRIGRAM).agg(F.count(F.lit(1)).alias("n")), "triples")
    met = met_triples(model, counts.select(*TRIGRAM))
    return stage(split_join(counted, met, TRIGRAM, "inner", counts), "batch-counts")


def batch_scores(model: NgramModel, examples: DataFrame, batch: list[str], met: DataFrame | None = None) -> DataFrame:
    """Mean loss per batch, NaN where every target is ignored; ``met``: :func:`met_batches`, if at hand."""
    model = model.summed()
    met = met_batches(model, examples, batch) if met is None else met
    sums = met.withColumn("log_prob", F.log(model.p3())).groupBy(*batch).agg(
        F.sum(F.col("_n") * F.col("log_prob")).alias("_sum"), F.sum("_n").alias("n_targets")
    )
    every = examples.select(*batch).distinct().join(sums, batch, "left")
    return every.select(
        *batch,
        F.coalesce(-F.col("_sum") / F.col("n_targets"), F.lit(NOT_A_NUMBER)).alias("loss"),
        F.coalesce("n_targets", F.lit(0)).alias("n_targets"),
    )


def likely_after(model: NgramModel, lasts: DataFrame, n: int) -> DataFrame:
    """``(w2, w3, p2)``: the tokens whose pair estimate reaches the ``n``-th largest after w2.

    Candidates are the seen followers and every token at least as common as the ``n``-th
    commonest; any other token has only its smaller overall count. A model that has seen
    fewer than ``n`` tokens offers all ids, as the unseen ones tie.
    """
    top = model.tokens.orderBy(F.desc("c1")).limit(n).agg(F.count(F.lit(1)).alias("n"), F.min("c1").alias("c1")).first()
    if top["n"] < min(n, model.size):
        listed = F.sequence(F.lit(0), F.lit(model.size - 1))
    else:
        listed = model.tokens.filter(F.col("c1") >= top["c1"]).agg(F.collect_list("w3").alias("ids")).scalar()
    seen = lasts.join(model.pairs, "w2").select("w2", "w3", "c2")
    always = lasts.select("w2", F.explode(listed).alias("w3"))
    every = (
        seen.unionByName(always, True)
        .groupBy("w2", "w3")
        .agg(F.max("c2").alias("c2"))
        .join(model.contexts, "w2", "left")
        .join(model.tokens, "w3", "left")
        .select("w2", "w3", model.p2().alias("p2"))
    )
    order = F.rank().over(Window.partitionBy("w2").orderBy(F.desc("p2")))
    return every.withColumn("_row", order).filter(F.col("_row") <= n).drop("_row")


def candidates(model: NgramModel, contexts: DataFrame, n: int) -> DataFrame:
    """``(w1, w2, token_id, logit)``: what may follow each distinct context.

    The seen continuations of the pair, plus the tokens that reach the ``n``-th largest
    estimate after its last token. A token in neither is beaten by ``n`` others, since for
    it only the pair estimate counts, so top-k with all its ties is exact for k <= n.
    """
    by_last = contexts.join(likely_after(model, contexts.select("w2").distinct(), n), "w2")
    by_pair = (
        contexts.join(model.counts, ["w1", "w2"])
        .withColumnRenamed("n", "c3")
        .join(model.pairs, ["w2", "w3"], "left")
        .join(model.contexts, "w2", "left")
        .join(model.tokens, "w3", "left")
        .select(*TRIGRAM, "c3", model.p2().alias("p2"))
    )
    every = (
        by_pair.unionByName(by_last, True)
        .groupBy(*TRIGRAM)
        .agg(F.max("c3").alias("c3"), F.max("p2").alias("p2"))
        .join(model.pair_contexts, ["w1", "w2"], "left")
    )
    p3 = model.mix(F.col("c3"), F.col("n2"), F.col("p2"))
    return every.select("w1", "w2", F.col("w3").alias("token_id"), F.log(p3).alias("logit"))


def save_model(model: NgramModel, path: str) -> None:
    """Counts and a one-row metadata table under ``path``, which must be new.

    A folder is never overwritten: the model may be read from it.
    """
    spark = model.counts.sparkSession
    model.counts.write.mode("errorifexists").parquet(f"{path}/counts")
    meta = [(model.size, model.weight, model.step, model.val_loss)]
    spark.createDataFrame(meta, "size int, weight double, step int, val_loss double").write.mode(
        "errorifexists"
    ).parquet(f"{path}/meta")


def judged(model: NgramModel, loss: DataFrame) -> NgramModel:
    """The model with the validation loss of a one-row evaluation, which is saved with it."""
    return replace(model, val_loss=float(loss.first()["loss"]))


def load_model(spark: SparkSession, path: str) -> NgramModel:
    meta = spark.read.parquet(f"{path}/meta").first()
    return NgramModel(
        spark.read.parquet(f"{path}/counts"), meta["size"], meta["weight"], meta["step"], meta["val_loss"]
    )
