"""Whole sequences drawn in one pass, with the model's counts at hand in each task.

The rows are every seen continuation of every two-token context, and per last token the list
that :func:`~corpusloom.operators.language_model.candidates` offers besides. If both
together have at most ``MODEL_ROWS`` rows of 28 bytes, which is counted first, they are sent
around as sorted arrays; otherwise they go to each executor as a sorted file
(``operators/rowfile``), of which a worker reads the blocks it needs. A context is worked out
when a sequence first reaches it, and kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpusloom.operators import rowfile
from corpusloom.operators.decoding import distribution, sample_distribution
from corpusloom.operators.language_model import NgramModel, likely_after

MODEL_ROWS = 6_000_000  # 168 MB
FILE_ROWS = 500_000_000  # 18 GB on the disk of each executor
MEMO_CONTEXTS = 100_000
UNSEEN = -2  # stands for every last token that the model has not seen


@dataclass(frozen=True)
class Rule:
    """How the next token is chosen: temperature, top k, nucleus ``p``; without ``p``, softmax first and exactly ``k``."""

    t: float
    k: int
    p: float | None = None

    def __call__(self, logits: DataFrame, seq: list[str]) -> DataFrame:
        if self.p is None:
            return sample_distribution(logits, seq, self.t, self.k)
        return distribution(logits, seq, self.t, self.k, self.p)

    def kept(self, ids: np.ndarray, probs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tokens that may be drawn, likeliest first, and their running probability."""
        logits = np.log(probs)
        if self.t != 1.0:
            logits = logits / self.t
        order = np.lexsort((ids, -logits))
        ids, logits = ids[order], logits[order]
        if self.p is None:
            share = _softmax(logits)[: self.k]
            return ids[: self.k], np.cumsum(share)
        if 0 < self.k < len(ids):
            n = int(np.count_nonzero(logits >= logits[self.k - 1]))
            ids, logits = ids[:n], logits[:n]
        if self.p < 1.0:
            upto = np.cumsum(_softmax(logits))
            n = 1 + int(np.count_nonzero(upto[:-1] < self.p))
            ids, logits = ids[:n], logits[:n]
        return ids, np.cumsum(_softmax(logits))


def _softmax(logits: np.ndarray) -> np.ndarray:
    weight = np.exp(logits - logits.max())
    return weight / weight.sum()


@dataclass(frozen=True)
class Counts:
    """Rows sorted by context, and by last token."""

    weight: float
    contexts: np.ndarray  # w1 and w2 in one integer
    next_id: np.ndarray
    hits: np.ndarray  # c3 and n2 of the row
    seen: np.ndarray
    lower: np.ndarray
    lasts: np.ndarray
    likely_id: np.ndarray
    likely: np.ndarray

    def options(self, w1: int, w2: int) -> tuple[np.ndarray, np.ndarray]:
        """Tokens that may follow, and their probability."""
        at = slice(*np.searchsorted(self.lasts, [w2, w2 + 1]))
        if at.start == at.stop:
            at = slice(*np.searchsorted(self.lasts, [UNSEEN, UNSEEN + 1]))
        ids, probs = self.likely_id[at], self.likely[at]
        key = _context(w1, w2)
        own = slice(*np.searchsorted(self.contexts, [key, key + 1]))
        if own.start == own.stop:
            return ids, probs
        return _mixed(self.weight, ids, probs, self.next_id[own], self.hits[own], self.seen[own], self.lower[own])


@dataclass(frozen=True)
class FileCounts:
    """The same from a file; the list of a last token is filed under the token alone."""

    weight: float
    rows: rowfile.RowFile

    def options(self, w1: int, w2: int) -> tuple[np.ndarray, np.ndarray]:
        listed = self.rows.find(_last(w2))
        if not len(listed):
            listed = self.rows.find(_last(UNSEEN))
        ids, probs = listed["id"], listed["lower"]
        own = self.rows.find(_context(w1, w2))
        return _mixed(self.weight, ids, probs, own["id"], own["hits"], own["seen"], own["lower"]) if len(own) else (ids, probs)


def _mixed(weight: float, ids, probs, mine, hits, seen, lower) -> tuple[np.ndarray, np.ndarray]:
    mixed = weight * hits / seen + (1 - weight) * lower
    other = ~np.isin(ids, mine)
    return np.concatenate([mine, ids[other]]), np.concatenate([mixed, (1 - weight) * probs[other]])


def _last(w2):
    """Smaller than any context, as tokens before a start count as -1."""
    return w2 + 2


def _context(w1, w2):
    return (w1 + 2) * (1 << 32) + (w2 + 2)


def _column(table: pa.Table, name: str, kind) -> np.ndarray:
    return table.column(name).to_numpy().astype(kind)


def _with_shares(model: NgramModel) -> DataFrame:
    """All trigrams with the counts and the share that their probability is mixed from."""
    return (
        model.counts.withColumnRenamed("n", "c3")
        .join(model.pair_contexts, ["w1", "w2"])
        .join(model.pairs, ["w2", "w3"])
        .join(model.contexts, "w2")
        .join(model.tokens, "w3")
        .select("w1", "w2", "w3", F.col("c3").cast("double"), F.col("n2").cast("double"), model.p2().alias("p2"))
    )


def _last_tokens(model: NgramModel) -> DataFrame:
    unseen = model.counts.sparkSession.range(1).select(F.lit(UNSEEN).cast("int").alias("w2"))
    return model.counts.select("w2").distinct().unionByName(unseen)


def filed(model: NgramModel, k: int) -> list[str]:
    """The names of the model's files, which are sent to the executors."""
    key = _context(F.col("w1").cast("bigint"), F.col("w2").cast("bigint"))
    own = _with_shares(model).select(key.alias("key"), F.col("w3").alias("id"), F.col("c3").alias("hits"), F.col("n2").alias("seen"), F.col("p2").alias("lower"))
    none = F.lit(0.0)
    listed = likely_after(model, _last_tokens(model), k).select(
        _last(F.col("w2").cast("bigint")).alias("key"), F.col("w3").cast("int").alias("id"), none.alias("hits"), none.alias("seen"), F.col("p2").alias("lower")
    )
    return rowfile.publish(own.unionByName(listed))


def counts_of(model: NgramModel, k: int, most: int) -> Counts | None:
    """The model's arrays, or None if they have more than ``most`` rows."""
    n = model.counts.limit(most + 1).count()
    if n > most:
        return None
    likely = likely_after(model, _last_tokens(model), k).limit(most - n + 1).toArrow()
    if n + likely.num_rows > most:
        return None
    rows = _with_shares(model).toArrow()
    w1, w2, w3 = (_column(rows, c, np.int64) for c in ("w1", "w2", "w3"))
    order = np.lexsort((w3, w2, w1))
    by_last = np.lexsort((_column(likely, "w3", np.int64), _column(likely, "w2", np.int64)))
    return Counts(
        model.weight,
        _context(w1, w2)[order],
        w3[order].astype(np.int32),
        *(_column(rows, c, np.float64)[order] for c in ("c3", "n2", "p2")),
        _column(likely, "w2", np.int64)[by_last],
        _column(likely, "w3", np.int32)[by_last],
        _column(likely, "p2", np.float64)[by_last],
    )


def _uniform(seed: int, key: str | None, step: int) -> float:
    """The same number as :func:`~corpusloom.functions.keys.uniform`."""
    text = ":".join(str(part) for part in (seed, key, step) if part is not None)
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16) / float(2**60)


def drawn_in_one_pass(
    state: DataFrame,
    model: NgramModel,
    key: str,
    n_tokens: int,
    rule: Rule,
    seed: int,
    stops: tuple[int, ...],
    most: int = MODEL_ROWS,
    most_filed: int = FILE_ROWS,
) -> DataFrame | None:
    """``key, new_ids`` for each ``key, w1, w2``; None if the model is too large even for files."""
    counts = counts_of(model, rule.k, most)
    if counts is None and model.counts.count() > most_filed:
        return None
    shared = state.sparkSession.sparkContext.broadcast(counts)
    names = filed(model, rule.k) if counts is None else []
    weight = model.weight
    schema = T.StructType([state.schema[key], T.StructField("new_ids", T.ArrayType(T.IntegerType()))])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        found = shared.value if shared.value is not None else FileCounts(weight, rowfile.opened(names))
        for batch in batches:
            made = []
            for name, w1, w2 in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                new: list[int] = []
                while len(new) < n_tokens and not (new and new[-1] in stops):
                    choices = known.get((w1, w2))
                    if choices is None:
                        if len(known) >= MEMO_CONTEXTS:
                            known.clear()
                        choices = known[w1, w2] = rule.kept(*found.options(w1, w2))
                    ids, upto = choices
                    u = _uniform(seed, name, len(new)) * upto[-1]
                    at = min(int(np.searchsorted(upto, u, "right")), len(ids) - 1)
                    new.append(int(ids[at]))
                    w1, w2 = w2, new[-1]
                made.append(new)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.list_(pa.int32()))], schema=arrow)

    dealt = state.select(key, F.col(key).cast("string").alias("_name"), "w1", "w2")
    cores = state.sparkSession.sparkContext.defaultParallelism
    if dealt.rdd.getNumPartitions() < cores:
        dealt = dealt.repartition(cores)
    return dealt.mapInArrow(run, schema)
