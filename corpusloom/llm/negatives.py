"""Hard negatives by Fagin's threshold algorithm over integer vectors.

An anchor's positives are the best rows of its own label; its negatives are the best rows of
other labels whose score lies in a window below a positive's. A score is the inner product
of integer components, so results are exact and ties are real.

Rows are dealt over blocks of at most about ``BLOCK_ROWS`` by the hash of the whole row, labels
apart or not, so a hot label spreads. A task holds one block: a sorted list of it per dimension.
Each anchor visits every block: it reads all lists in step, from the top where its component is
positive and from the bottom where it is negative (sorted access), scores each row when it
first turns up (random access), and adds up the products at the lists' present places: no row
still unseen scores higher than that threshold. It stops once the threshold lies strictly below
the kth score of every window, or below the window. What the blocks find, at most k rows per
window and block, is ranked again over all blocks.

Two passes, as windows need the positives of all blocks. Every anchor meets every row's
block, which is the stated query set against all rows; anchors are copied to the blocks, rows
are not. A task's memory is one block and one Arrow batch of anchors.

Defined results: rows with a null label, a null vector, or a null or non-finite component take
no part. Shorter vectors are filled with zeros; an empty one scores zero. Rows equal in id,
label and vector are one row; rows that only share an id are different rows, each of which may
be an anchor. Ties go to the smaller id, a null id last. An anchor without rows of its label has
no result, one without rows in a window none for that window. Scores of 2**53 and more are
computed with whole numbers of any length and cut to 64 bits in the output only. Empty tables
give empty results; other columns are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.arrow import column
from corpusloom.session import stage

BLOCK_ROWS = 65_536  # of 64 dimensions: 34 MB of components, 17 MB of lists
SMALL_BLOCK = 2_048  # blocks are not cut smaller than this for the sake of more tasks
FIRST_ACCESS = 16  # places of each list read at first; doubled after that
SCALE = 256
N_POSITIVES, N_NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # window of a negative's score, in hundredths of the positive's

_EXACT = 2**53  # doubles hold all integers up to here
_NO_ID = 2**63 - 1


def components(vectors: pa.Array, scale: int) -> np.ndarray:
    """``floor(scale * x)`` of each vector, one row each: doubles, or Python integers if they need it."""
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    width = int(lengths.max()) if len(lengths) else 0
    if np.abs(flat).max(initial=0) * scale >= _EXACT:
        whole = [int(x) * scale if abs(x) >= _EXACT else int(np.floor(x * scale)) for x in flat.tolist()]
        flat = np.array(whole, object)
    else:
        flat = np.floor(flat * scale)
    if len(flat) == width * len(lengths):
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), flat.dtype)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(np.arange(len(lengths)), lengths), place] = flat
    return out


class Lists:
    """The rows of ``x``, sorted by each dimension."""

    def __init__(self, x: np.ndarray):
        self.x = x
        order = np.argsort(x, axis=0, kind="stable")
        self.values = np.ascontiguousarray(np.take_along_axis(x, order, 0).T)
        self.order = np.ascontiguousarray(order.T.astype(np.int32))
        self.largest = int(np.abs(x).max()) if x.size else 0
        self.exact_x: np.ndarray | None = None

    def search(self, q: np.ndarray, visit: Callable[[np.ndarray, np.ndarray, int | float], bool]) -> int:
        """Sorted access for ``q`` until ``visit(rows, scores, threshold)`` says that it is enough.

        Each row is visited once at most; returns the depth reached.
        """
        n, width = self.x.shape
        if len(q) != width:
            q = np.concatenate([q, np.zeros(max(0, width - len(q)), q.dtype)])[:width]
        x, values = self.x, self.values
        if 100 * width * self.largest * int(np.abs(q).max(initial=0)) >= _EXACT:
            if self.exact_x is None:
                self.exact_x = _whole(self.x)
            x, q = self.exact_x, _whole(q)
        elif x.dtype == object:
            q = _whole(q)
        up, down = np.flatnonzero(q > 0), np.flatnonzero(q < 0)
        seen = np.zeros(n, bool)
        depth, n_seen = 0, 0
        while depth < n and n_seen < n:
            upto = min(n, max(2 * depth, FIRST_ACCESS))
            if len(up) + len(down):
                met = np.zeros(n, bool)
                met[self.order[up, n - upto : n - depth]] = True
                met[self.order[down, depth:upto]] = True
                rows = np.flatnonzero(met & ~seen)
            else:  # a zero vector scores zero with all, and has no list to read
                rows, upto = np.arange(n), n
            seen[rows] = True
            n_seen += len(rows)
            depth = upto
            ends = [values[up, n - upto], values[down, upto - 1]]
            if x.dtype == object:
                ends = [_whole(e) for e in ends]
            threshold = (ends[0] * q[up]).sum() + (ends[1] * q[down]).sum()
            if visit(rows, x[rows] @ q, threshold):
                break
        return depth


def _whole(x: np.ndarray) -> np.ndarray:
    return x if x.dtype == object else np.array([int(v) for v in x.ravel().tolist()], object).reshape(x.shape)


class Best:
    """The ``k`` best rows of a window: highest score first, ties by the smaller row."""

    def __init__(self, k: int, bottom=None, top=None):
        self.k, self.bottom, self.top = k, bottom, top
        self.rows = np.zeros(0, np.int64)
        self.scores = np.zeros(0)

    @property
    def full(self) -> bool:
        return len(self.rows) == self.k

    def offer(self, rows: np.ndarray, scores: np.ndarray) -> None:
        """``bottom`` and ``top`` bound a hundredfold score."""
        fits = np.ones(len(rows), bool)
        if self.bottom is not None:
            fits = (scores * 100 >= self.bottom) & (scores * 100 <= self.top)
        if self.full:
            fits &= scores >= self.scores[-1]
        fits = fits.astype(bool)
        if fits.any():
            rows = np.concatenate([self.rows, rows[fits]])
            scores = np.concatenate([self.scores, scores[fits]])
            by_row = np.argsort(rows, kind="stable")
            best = by_row[np.argsort(-scores[by_row], kind="stable")][: self.k]
            self.rows, self.scores = rows[best], scores[best]

    def settled(self, threshold) -> bool:
        if self.full and threshold < self.scores[-1]:
            return True
        return self.bottom is not None and (self.bottom > self.top or threshold * 100 < self.bottom)


class Block:
    """One block of rows, sorted by id, equal rows once."""

    def __init__(self, batches: list[pa.RecordBatch], scale: int):
        rows = pa.Table.from_batches(batches).combine_chunks()
        keys, ids = rows["key"].to_numpy(), rows["id"].fill_null(_NO_ID).to_numpy()
        first = np.ones(len(keys), bool)
        first[1:] = (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])  # equal rows lie side by side
        rows = rows.filter(pa.array(first))
        self.keys, self.ids = keys[first], rows["id"].combine_chunks()
        self.labels = rows["label"].to_numpy()
        self.x = components(rows["vector"].combine_chunks(), scale)
        self.by_label: dict[int, tuple[np.ndarray, Lists]] = {}
        self._all: Lists | None = None

    @property
    def lists(self) -> Lists:
        if self._all is None:
            self._all = Lists(self.x)
        return self._all

    def of_label(self, label: int) -> tuple[np.ndarray, Lists]:
        if label not in self.by_label:
            rows = np.flatnonzero(self.labels == label)
            self.by_label[label] = rows, Lists(self.x[rows])
        return self.by_label[label]


def _positives(block: Block, key: int, label: int, q: np.ndarray, windows, n: int) -> Iterator[tuple]:
    places, lists = block.of_label(label)
    best = Best(n)

    def visit(rows, scores, threshold) -> bool:
        other = block.keys[places[rows]] != key
        best.offer(places[rows[other]], scores[other])
        return best.settled(threshold)

    lists.search(q, visit)
    yield 0, best


def _negatives(block: Block, key: int, label: int, q: np.ndarray, windows, n: int, low: int, high: int) -> Iterator[tuple]:
    best = [Best(n, low * w["score"], high * w["score"]) for w in windows]

    def visit(rows, scores, threshold) -> bool:
        other = block.labels[rows] != label
        for b in best:
            b.offer(rows[other], scores[other])
        return all(b.settled(threshold) for b in best)

    if not all(b.bottom > b.top for b in best):
        block.lists.search(q, visit)
    yield from ((w["slot"], b) for w, b in zip(windows, best, strict=True))


_FOUND = "anchor_id bigint, anchor_key bigint, slot int, id bigint, key bigint, score bigint"


def _visit_blocks(batches: Iterator[pa.RecordBatch], find, scale: int) -> Iterator[pa.RecordBatch]:
    """Rows of a block, then the anchors that visit it, block after block."""
    current, held, block = None, [], None
    for batch in batches:
        at = np.stack([column(batch, "block").to_numpy(), column(batch, "kind").to_numpy()])
        cuts = [0, *(np.flatnonzero((at[:, 1:] != at[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
        for begin, end in zip(cuts, cuts[1:], strict=False):
            if begin == end:
                continue
            number, kind = at[:, begin].tolist()
            if number != current:
                current, held, block = number, [], None
            part = batch.slice(begin, end - begin)
            if kind == 0:
                held.append(part)
                continue
            if block is None and held:
                block, held = Block(held, scale), []
            if block is not None:
                yield _found(block, part, find, scale)


def _found(block: Block, anchors: pa.RecordBatch, find, scale: int) -> pa.RecordBatch:
    q = components(column(anchors, "vector"), scale)
    heads: list[tuple] = []
    rows: list[np.ndarray] = []
    scores: list[int] = []
    names = ("id", "key", "label", "windows")
    for vector, anchor, key, label, windows in zip(q, *(column(anchors, c).to_pylist() for c in names), strict=True):
        for slot, best in find(block, key, label, vector, windows or []):
            heads += [(anchor, key, slot)] * len(best.rows)
            rows.append(best.rows)
            scores += [max(-(2**63), min(2**63 - 1, int(s))) for s in best.scores.tolist()]
    places = np.concatenate([np.zeros(0, np.int64), *rows])
    ids = block.ids.take(pa.array(places))
    types = (pa.int64(), pa.int64(), pa.int32())
    parts = [pa.array([h[i] for h in heads], t) for i, t in enumerate(types)]
    return pa.RecordBatch.from_arrays(
        [*parts, ids, pa.array(block.keys[places]), pa.array(scores, pa.int64())],
        ["anchor_id", "anchor_key", "slot", "id", "key", "score"],
    )


_WINDOWS = "array<struct<slot:int,id:bigint,score:bigint>>"


def _visits(rows: DataFrame, anchors: DataFrame, blocks: int, find, scale: int) -> DataFrame:
    """What each block offers each anchor."""
    fields = ["id", "key", "label", "vector"]
    block = F.pmod(F.hash("id", "key"), F.lit(blocks))
    held = rows.select(block.alias("block"), F.lit(0).alias("kind"), *fields, F.lit(None).cast(_WINDOWS).alias("windows"))
    visits = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"), *fields, "windows")
    dealt = held.unionByName(visits).repartition(blocks, "block")
    dealt = dealt.sortWithinPartitions("block", "kind", F.asc_nulls_last("id"), "key")
    return dealt.mapInArrow(lambda batches: _visit_blocks(batches, find, scale), _FOUND)


def _ranked(found: DataFrame, by: list[str], n: int, name: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id"), "key")
    return found.withColumn(name, F.row_number().over(order)).filter(F.col(name) <= n)


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str | Column = "label",
    n_positives: int = N_POSITIVES,
    n_negatives: int = N_NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    A negative fits a positive if ``low * positive_score <= 100 * negative_score <= high *
    positive_score``; both scores are with the anchor.
    """
    label = F.col(label) if isinstance(label, str) else label
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    fit = rows.filter(F.col(embedding).isNotNull() & finite & label.isNotNull())
    named = fit.select(F.col(vec_id).cast("bigint").alias("id"), label.cast("bigint").alias("label"), F.col(embedding).alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    named = named.withColumn("key", F.xxhash64("id", "label", "vector"))
    n = named.count()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, -(-n // block_rows), min(cores, -(-n // SMALL_BLOCK)))
    anchors = named.filter("anchor").dropDuplicates(["key"]).withColumn("windows", F.lit(None).cast(_WINDOWS))

    met = _visits(named, anchors, blocks, partial(_positives, n=n_positives), scale)
    positives = stage(_ranked(met, ["anchor_key"], n_positives, "place"), "positives")
    window = F.struct(F.col("place").alias("slot"), "id", "score")
    windows = positives.groupBy(F.col("anchor_key").alias("key")).agg(F.sort_array(F.collect_list(window)).cast(_WINDOWS).alias("windows"))
    seeking = anchors.drop("windows").join(windows, "key")

    met = _visits(named, seeking, blocks, partial(_negatives, n=n_negatives, low=low, high=high), scale)
    negatives = _ranked(met, ["anchor_key", "slot"], n_negatives, "rank")
    of = positives.select("anchor_key", F.col("place").alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return negatives.join(of, ["anchor_key", "slot"]).select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
