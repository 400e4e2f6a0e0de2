"""One addressable token stream per split: layout and window sampling."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.arrays import in_order, ints
from corpusloom.functions.keys import hash60
from corpusloom.operators.examples import shifted
from corpusloom.operators.ordered import bucket_prefix
from corpusloom.operators.skew import split_join
from corpusloom.session import stage, task_count

CHUNK_TOKENS = 8192
BROADCAST_DRAWS = 1_000_000  # 24 bytes each
STRETCH_TOKENS = 1 << 21  # chunks of a stretch are laid out together
TASK_TOKENS = 1 << 25  # 128 MB, sorted in memory
EPOCH_LENGTH = 100_000  # fixed value: window draws per epoch


def _stretched(docs: DataFrame, ids: str, chunk: int) -> tuple[DataFrame, int, int]:
    """Rows with the start of their bucket, once per stretch it touches; a stretch's chunks; all tokens.

    No bucket holds more tokens than a stretch, so none touches more than two.
    """
    n = F.col("n_tokens") if "n_tokens" in docs.columns else F.size(ids)
    keyed = docs.select("split", "bucket", "order_key", F.col(ids).alias("ids"), n.cast("bigint").alias("n")).filter("n > 0")
    totals = keyed.groupBy("split", "bucket").agg(F.sum("n").alias("_n"))
    sizes = totals.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("all"), F.coalesce(F.max("_n"), F.lit(0)).alias("most")).first()
    chunks = -(-max(STRETCH_TOKENS, sizes["most"]) // chunk)
    last = F.col("before") + F.col("_n") - 1
    touched = F.explode(F.sequence(F.floor(F.col("before") / (chunk * chunks)), F.floor(last / (chunk * chunks))))
    starts = bucket_prefix(totals, "_n", ("split",)).select("split", "bucket", "before", touched.alias("stretch"))
    # At most two rows per bucket and split, of which there are 65,536.
    return keyed.join(F.broadcast(starts), ["split", "bucket"]), chunks, sizes["all"]


def _chunks(batches: Iterator[pa.RecordBatch], chunk: int, chunks: int) -> Iterator[pa.RecordBatch]:
    """The chunks of each stretch, from its documents in order; those at its ends come with tokens of others."""
    names: list[str] = []
    ends: list[int] = []
    cut: list[pa.Array] = []
    held: list[pa.Array] = []
    at, bucket = 0, None  # the place after the last token seen, and where it was

    def close() -> None:
        names.append(bucket[0])
        ends.append(at)
        cut.append(held[0] if len(held) == 1 else pa.concat_arrays(held))
        held.clear()

    def made() -> pa.RecordBatch:
        sizes = np.array([len(x) for x in cut])
        tokens = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.concat_arrays(cut))
        last = np.array(ends)
        columns = [pa.array(names, pa.string()), pa.array((last - 1) // chunk), pa.array(last - sizes), pa.array(sizes), tokens]
        names.clear(), ends.clear(), cut.clear()
        return pa.RecordBatch.from_arrays(columns, ["split", "chunk_id", "start_pos", "n_tokens", "tokens"])

    for batch in batches:
        splits, stretches, starts, ids = batch.columns
        splits, stretches, starts = np.array(splits.to_pylist(), object), stretches.to_numpy(), starts.to_numpy()
        new = (splits[1:] != splits[:-1]) | (stretches[1:] != stretches[:-1]) | (starts[1:] != starts[:-1])
        edges = [0, *(np.flatnonzero(new) + 1).tolist(), len(splits)]
        for first, end in zip(edges[:-1], edges[1:], strict=True):
            if first == end:
                continue
            here = (splits[first], int(stretches[first]), int(starts[first]))
            if held and here[:2] != bucket[:2]:
                close()
            if here != bucket:  # else the bucket goes on from the batch before
                bucket, at = here, here[2]
            tokens = ids.slice(first, end - first).flatten()
            begin = here[1] * chunk * chunks
            start, after = at, at + len(tokens)
            at, upto = max(start, begin), min(after, begin + chunk * chunks)
            while at < upto:
                take = min(chunk - at % chunk, upto - at)
                held.append(tokens.slice(at - start, take))
                at += take
                if at % chunk == 0:
                    close()
            at = after  # the tokens of other stretches are passed over
        if cut:
            yield made()
    if held:
        close()
        yield made()


def lay_out_stream(docs: DataFrame, ids: str = "token_ids", chunk: int = CHUNK_TOKENS) -> DataFrame:
    """Concatenate documents per split in seeded order, cut into chunks of fixed size.

    ``docs`` carries ``split, bucket, order_key`` from a split operator and should be a
    stored table, as it is read twice; with a stored ``n_tokens`` the first pass reads
    only that. Documents move once, to their stretch of whole chunks, and are sorted there;
    those of a bucket on the border of two stretches go to both. As many tasks take part as
    sort their share in memory, or as the session is sized for.
    """
    placed, chunks, total = _stretched(docs, ids, chunk)
    tasks = -(-total // TASK_TOKENS)
    number = [tasks] if tasks > task_count(docs.sparkSession) else []
    in_place = placed.repartition(*number, "split", "stretch").sortWithinPartitions("split", "stretch", "before", "order_key")
    return in_place.select("split", "stretch", "before", ints(F.col("ids"))).mapInArrow(
        lambda batches: _chunks(batches, chunk, chunks),
        "split string, chunk_id bigint, start_pos bigint, n_tokens bigint, tokens array<int>",
    )


def stream_length(stream: DataFrame) -> DataFrame:
    """Tokens per split, from the stored counts alone."""
    return stream.groupBy("split").agg(F.sum("n_tokens").alias("n_tokens"))


def draw_offsets(
    spark: SparkSession, n_tokens: Column, draws: int, seq_length: int, seed: int = 0, rank: int = 0
) -> DataFrame:
    """Uniform window starts in [0, n_tokens - seq_length - 1), with replacement."""
    room = n_tokens - F.lit(seq_length + 1)
    checked = F.when(room > 0, room).otherwise(
        F.raise_error(F.lit("the stream is too short for one window"))
    )
    return spark.range(draws).select(
        F.col("id").alias("window_id"),
        F.pmod(hash60(seed, rank, F.col("id")), checked.cast("bigint")).alias("offset"),
    )


def _touching(draws: DataFrame, chunks: DataFrame) -> DataFrame:
    draws = stage(draws, "draws")
    counts = stage(draws.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n")), "draw-counts")
    n = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    if n > BROADCAST_DRAWS:
        return split_join(draws, chunks, ["chunk_id"], counts=counts)
    share = n / task_count(draws.sparkSession)
    frequent = [r["chunk_id"] for r in counts.filter(F.col("n") > 2 * share).collect()]
    hot = F.col("chunk_id").isin(frequent)
    met = chunks.join(F.broadcast(draws.filter(~hot)), "chunk_id").select(*draws.columns, "start_pos", "tokens")
    if not frequent:
        return met
    spread = split_join(draws.filter(hot), chunks.filter(hot), ["chunk_id"], counts=counts)
    return met.unionByName(spread.select(met.columns))


def read_windows(stream: DataFrame, offsets: DataFrame, seq_length: int, chunk: int = CHUNK_TOKENS) -> DataFrame:
    """The ``seq_length + 1`` tokens at each offset, by an equi-join on the chunks touched.

    Chunks stay where they are read: the draws, two numbers each, go to them while there are at
    most ``BROADCAST_DRAWS``. Chunks that more than two task shares of the draws touch, fewer
    than half the tasks, are copied to the parts over which their draws are dealt; so are
    all when there are more draws.
    """
    last = F.col("offset") + F.lit(seq_length)
    touched = offsets.withColumn(
        "chunk_id", F.explode(F.sequence(F.floor(F.col("offset") / chunk), F.floor(last / chunk)))
    )
    met = _touching(touched, stream.select("chunk_id", "start_pos", "tokens"))
    at = F.greatest(F.col("offset"), F.col("start_pos"))
    end = F.least(last + 1, F.col("start_pos") + F.size("tokens"))
    part = F.slice("tokens", (at - F.col("start_pos") + 1).cast("int"), (end - at).cast("int"))
    return (
        met.filter(end > at)
        .select("window_id", "offset", at.alias("at"), part.alias("part"))
        .groupBy("window_id", "offset")
        .agg(F.collect_list(F.struct("at", "part")).alias("_parts"))
        .select("window_id", "offset", ints(in_order(F.col("_parts"), "part")).alias("tokens"))
    )


def sample_windows(
    stream: DataFrame,
    split: str,
    seq_length: int,
    draws: int = EPOCH_LENGTH,
    seed: int = 0,
    rank: int = 0,
    chunk: int = CHUNK_TOKENS,
) -> DataFrame:
    """Random training windows ``(window_id, offset, x, y)`` of one split."""
    one = stream.filter(F.col("split") == split)
    total = one.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n")).scalar()
    offsets = draw_offsets(stream.sparkSession, total, draws, seq_length, seed, rank)
    return shifted(read_windows(one, offsets, seq_length, chunk)).drop("tokens")


def consecutive_windows(stream: DataFrame, split: str, seq_length: int) -> DataFrame:
    """The whole split as windows ``(window_id, x, y)`` one after the other; the last may be shorter.

    Neighbours share one token, so that each token but the first is a target once. A chunk hands
    each window its part of it; only those parts are shuffled.
    """
    end = F.col("start_pos") + F.size("tokens")
    # A window's first token is also the last target of the one before.
    first = F.floor(F.greatest(F.col("start_pos") - 1, F.lit(0)) / seq_length)
    cut = (
        stream.filter(F.col("split") == split)
        .filter(F.size("tokens") > 0)
        .select("start_pos", "tokens", end.alias("end"), F.explode(F.sequence(first, F.floor((end - 1) / seq_length))).alias("window_id"))
    )
    at = F.greatest(F.col("window_id") * seq_length, F.col("start_pos"))
    upto = F.least(F.col("window_id") * seq_length + seq_length + 1, F.col("end"))
    part = F.slice("tokens", (at - F.col("start_pos") + 1).cast("int"), (upto - at).cast("int"))
    whole = cut.filter(upto > at).groupBy("window_id").agg(F.collect_list(F.struct(at.alias("at"), part.alias("part"))).alias("_parts"))
    tokens = whole.select("window_id", ints(in_order(F.col("_parts"), "part")).alias("tokens")).filter(F.size("tokens") > 1)
    return shifted(tokens).drop("tokens")
