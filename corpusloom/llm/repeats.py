"""Suffix-array deduplication of long repeated byte strings.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else, in the
same text or another. Strings of that length are the windows; each has an anchor, the least
hash of its grams (16 bytes in 25 of the length; the last such), so equal windows have equal anchors at
the same place, and neighbouring windows with one anchor make a stretch.

1. Anchors are counted. Those seen once end it for their windows. A bitmap of fixed size of
   the others is broadcast.
2. The stretches of the other anchors are counted by their bytes. Every window of a stretch
   that occurs twice is repeated.
3. Anchors with several different stretches go into a sparse suffix array: the suffixes
   that start at them, up to the end of the stretch. Tasks sort them into front-coded runs,
   cut at splitters (by their first eight bytes, ties by anchor); ranges of runs are exchanged and merged by loser trees that use the
   LCPs they know. Along the merged array, windows at one distance from their anchors
   are equal if the LCPs in between reach far enough and the bytes before the anchors
   agree.
4. Repeated windows go back to their texts, which lose their bytes.

No group is gathered whole: equal stretches are added up on the map side, and rows of a hot
stretch meet its verdict in a join. An anchor with more than ``CLUSTER`` different stretches
stays out of the suffix array; the windows of its stretches are counted by hash, added up
on the map side, which is as exact.

Hashes are of 64 bits, for stretches two of them; equality of the bytes themselves is not
checked again except in the suffix array.

Defined results: a null text is empty; a text shorter than ``LENGTH`` loses nothing;
repeated rows repeat each other's bytes; null ids are ids; empty tables give empty results;
other columns are not looked at, whatever their names, and kept by :func:`without_repeats`,
which drops what removal leaves of a character cut in two.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.arrow import add_columns, column, free_name, text_bytes, text_chunks
from corpusloom.llm.bitmap import BITS, bitmap_of, contains
from corpusloom.llm.suffixes import decoded, front_coded, merged
from corpusloom.llm.words import mix, powers, sliding, span_hashes
from corpusloom.session import stage

LENGTH = 400
RUN_BYTES = 24_000_000  # of records that a task sorts at a time
RANGE_BYTES = 16_000_000  # of the suffix array at most, about, per range
CHUNK = 1 << 18  # bytes of text whose windows are hashed at a time
CLUSTER = 100_000

_EVEN = 64 - BITS
_PLACE_BITS = np.uint64(31)  # a text has fewer than 2**31 bytes
_RUN = "part int, lcp binary, tail binary, tails binary, left binary, lefts binary, hashes binary"


def _gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k bytes in a row."""
    n = max(0, len(data) - k + 1)
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    return mix((total[k:] - total[:n]) * down[:n])


def stretches(data: np.ndarray, starts: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """``(first window, last window, anchor, anchor's hash)`` of every stretch."""
    none = np.zeros(0, np.int64)
    n = len(data) - length + 1
    if n <= 0:
        return none, none, none, np.zeros(0, np.uint64)
    grams = _gram_hashes(data, gram)
    # The hash's leading bits, then the place from the right: the least is the last of equals.
    place = np.uint64((1 << 31) - 1) - np.arange(len(grams), dtype=np.uint64)
    packed = (grams >> _PLACE_BITS << _PLACE_BITS) | place
    least = sliding(packed, length - gram + 1, np.minimum)
    anchor = ((1 << 31) - 1) - (least & np.uint64((1 << 31) - 1)).astype(np.int64)
    ends = np.repeat(starts[1:], np.diff(starts))[:n]
    whole = np.flatnonzero(np.arange(n) + length <= ends)
    if not len(whole):
        return none, none, none, np.zeros(0, np.uint64)
    anchors = anchor[whole]
    new = np.ones(len(whole), bool)
    new[1:] = (anchors[1:] != anchors[:-1]) | (whole[1:] != whole[:-1] + 1)
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(whole)) - 1
    return whole[begin], whole[last], anchors[begin], grams[anchors[begin]]


def _even(h: np.ndarray) -> np.ndarray:
    """Anchors are least hashes, small ones: their even last bits lead in the bitmaps."""
    return h << np.uint64(_EVEN)


def _bitmap(anchors: DataFrame) -> np.ndarray:
    return bitmap_of(anchors.select(F.shiftleft("h", _EVEN).alias("h")))


def _stretches_of(batch: pa.RecordBatch, length: int, gram: int, among: np.ndarray | None = None):
    """Chunks of a batch with the stretches of anchors in the bitmap ``among`` (all, if None)."""
    for begin, _, data, starts in text_chunks(column(batch, "text"), CHUNK):
        first, last, anchor, h = stretches(data, starts, length, gram)
        if among is not None:
            keep = contains(among, _even(h))
            first, last, anchor, h = first[keep], last[keep], anchor[keep], h[keep]
        rows = np.searchsorted(starts, first, "right") - 1
        yield data, begin + rows, first - starts[rows], first, last, anchor, h


def _anchor_rows(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Anchors and how many stretches a batch has of each."""
    for batch in batches:
        found = [h for *_, h in _stretches_of(batch, length, gram)]
        h, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *found]), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])


def _place_rows(batches: Iterator[pa.RecordBatch], length: int, gram: int, among) -> Iterator[pa.RecordBatch]:
    """Where the stretches of repeated anchors are, a hash of their bytes, and how their suffix begins."""
    for batch in batches:
        for data, rows, at, first, last, anchor, h in _stretches_of(batch, length, gram, among.value):
            s = span_hashes(data, first, last + length)
            lead = np.zeros(len(anchor), np.uint64)
            for i in range(8):
                lead = (lead << np.uint64(8)) | data[anchor + i].astype(np.uint64)
            picked = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    column(batch, "doc_id").take(picked),
                    column(batch, "text_key").take(picked),
                    pa.array(at),
                    pa.array(last - first + 1),
                    pa.array(h.view(np.int64)),
                    pa.array(s.view(np.int64)),
                    pa.array((lead ^ np.uint64(1 << 63)).view(np.int64)),
                ],
                ["doc_id", "text_key", "first", "n", "h", "s", "lead"],
            )


def parts_of(leads: np.ndarray, anchors: np.ndarray, splitters: np.ndarray) -> np.ndarray:
    """The range of each suffix: by how it begins, and among equal splitters by its anchor.

    Suffixes of one anchor stay together, which is what equal windows need; a beginning that very
    many suffixes share is spread over as many ranges as it fills.
    """
    low, high = (np.searchsorted(splitters, leads, side) for side in ("left", "right"))
    return low + (mix(anchors) % (high - low + 1).astype(np.uint64)).astype(np.int64)


def _sorted_runs(batches: Iterator[pa.RecordBatch], length: int, gram: int, mixed, dense, splitters: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Front-coded sorted runs of suffixes, one row per range of the splitters."""
    names = ["part", "lcp", "tail", "tails", "left", "lefts", "hashes"]
    held: dict[tuple[int, int], tuple] = {}
    size = 0

    def run() -> pa.RecordBatch:
        records = list(held.values())
        leads = np.array([int.from_bytes(r[0][:8], "big") - (1 << 63) for r in records], np.int64)
        parts = parts_of(leads, np.array([r[2] for r in records], np.uint64), splitters)
        rows = []
        for part in np.unique(parts).tolist():
            coded = front_coded([records[i] for i in np.flatnonzero(parts == part).tolist()])
            rows.append({"part": part, **coded})
        types = [pa.int32()] + [pa.binary()] * 6
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, types, strict=True)], names)

    for batch in batches:
        for data, _, _, first, last, anchor, h in _stretches_of(batch, length, gram, mixed.value):
            if dense.value is not None:
                keep = ~contains(dense.value, _even(h))
                first, last, anchor, h = first[keep], last[keep], anchor[keep], h[keep]
            s = span_hashes(data, first, last + length)
            raw = data.tobytes()
            for b, e, a, key, content in zip(first.tolist(), last.tolist(), anchor.tolist(), h.tolist(), s.tolist(), strict=True):
                if (key, content) not in held:  # equal stretches of a run stand for each other
                    held[key, content] = (raw[a : e + length], raw[b:a], key, content)
                    size += e + length - b
            if size > RUN_BYTES:
                yield run()
                held, size = {}, 0
    if held:
        yield run()


def _window_rows(batches: Iterator[pa.RecordBatch], length: int, gram: int, dense) -> Iterator[pa.RecordBatch]:
    """Hashes of all windows of the stretches of dense anchors."""
    for batch in batches:
        for data, _, _, first, last, _, h in _stretches_of(batch, length, gram, dense.value):
            s = span_hashes(data, first, last + length)
            n = last - first + 1
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            begin = np.repeat(first, n) + place
            window = span_hashes(data, begin, begin + length)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(h, n).view(np.int64)), pa.array(np.repeat(s, n).view(np.int64)), pa.array(place), pa.array(window.view(np.int64))],
                ["h", "s", "place", "window"],
            )


def _equal_windows(block: list, lcps: np.ndarray, length: int) -> np.ndarray:
    """Which windows of the sorted suffixes have an equal (suffix by distance to the anchor).

    ``block`` has ``(suffix, left)``; ``lcps[i]`` is the LCP of suffix i with i - 1.
    """
    n = len(block)
    reach = np.array([len(s) for s, _ in block])  # a window at distance d needs length - d of it
    lefts = np.array([len(left) for _, left in block])
    widest = int(lefts.max()) + 1 if n else 0
    out = np.zeros((n, widest), bool)
    padded = np.zeros((n, max(widest, 2) - 1), np.uint8)
    for i, (_, left) in enumerate(block):
        if left:
            padded[i, : len(left)] = np.frombuffer(left, np.uint8)[::-1]
    before = np.zeros(n, np.uint64)  # hash of the d bytes in front of the anchor
    for d in range(widest):
        if d:
            before = mix(before + padded[:, d - 1].astype(np.uint64) + np.uint64(1))
        has = np.flatnonzero((lefts >= d) & (reach >= length - d))
        if len(has) < 2:
            continue
        segment = np.cumsum(lcps < length - d)[has]
        order = np.lexsort((before[has], segment))
        same = (segment[order[1:]] == segment[order[:-1]]) & (before[has][order[1:]] == before[has][order[:-1]])
        twice = np.zeros(len(has), bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        out[has, d] = twice
    return out


def _runs_of(flags: np.ndarray) -> list[dict]:
    """Runs of True as ``{begin, end}``."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [{"begin": int(b), "end": int(e)} for b, e in zip(edges[::2], edges[1::2], strict=True)]


_RUNS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))


def _judged(table: pa.Table, length: int, gram: int) -> pa.Table:
    """Merge the runs of one range; per stretch the runs of its repeated windows."""
    names = ("lcp", "tail", "tails", "left", "lefts", "hashes")
    columns = [table.column(n).to_pylist() for n in names]
    runs = [decoded(dict(zip(names, row, strict=True))) for row in zip(*columns, strict=True)]
    block, lcps, hashes = [], [], []
    out: tuple[list, list, list] = ([], [], [])

    def judge():
        flags = _equal_windows(block, np.array(lcps), length)
        for (_, left), (h, s), marks in zip(block, hashes, flags, strict=True):
            if found := _runs_of(marks[len(left) :: -1]):  # from the first window to the anchor
                for to, value in zip(out, (h, s, found), strict=True):
                    to.append(value)

    for shared, (suffix, left, h, s) in merged(runs):
        if shared < gram and len(block) >= 4_096:  # an anchor's suffixes stay together
            judge()
            block, lcps, hashes = [], [], []
        block.append((suffix, left))
        lcps.append(shared)
        hashes.append((h, s))
    if block:
        judge()
    return pa.table(
        {
            "h": pa.array(np.array(out[0], np.uint64).view(np.int64)),
            "s": pa.array(np.array(out[1], np.uint64).view(np.int64)),
            "runs": pa.array(out[2], _RUNS),
        }
    )


def _spans(docs: DataFrame, length: int, gram: int, cluster: int) -> DataFrame:
    """``doc_id, text_key, spans``: byte ranges to remove, of texts that have some."""
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    id_type = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("text").filter(F.octet_length("text") >= length)
    anchors = texts.mapInArrow(lambda b: _anchor_rows(b, length, gram), "h bigint, n bigint")
    repeated = share(_bitmap(anchors.groupBy("h").agg(F.sum("n").alias("n")).filter("n > 1")))
    places = stage(
        docs.filter(F.octet_length("text") >= length).mapInArrow(
            lambda b: _place_rows(b, length, gram, repeated),
            f"doc_id {id_type}, text_key bigint, first bigint, n bigint, h bigint, s bigint, lead bigint",
        ),
        "places",
    )
    counts = stage(places.groupBy("h", "s").agg(F.count(F.lit(1)).alias("n"), F.min("lead").alias("lead")), "counts")
    kinds = counts.groupBy("h").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("n"), F.min("lead").alias("lead"))
    several = stage(kinds.filter("kinds > 1"), "several")
    # A task sorts equal stretches once, but other tasks have them too: at most all rows go in.
    n, n_dense = several.agg(F.sum("n"), F.sum(F.when(F.col("kinds") > cluster, 1))).first()
    runs_type = "array<struct<begin:bigint,end:bigint>>"
    # Longer than any stretch: every window of it.
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("begin"), F.lit(length).cast("bigint").alias("end")))
    verdicts = counts.filter("n > 1").select("h", "s", whole.cast(runs_type).alias("runs"))
    if n:
        mixed = share(_bitmap(several))
        dense = share(_bitmap(several.filter(F.col("kinds") > cluster)) if n_dense else None)
        ranges = min(4096, max(1, n * (length + length - gram) // RANGE_BYTES + 1))
        cuts = np.zeros(0, np.int64)
        if ranges > 1:
            points = [i / ranges for i in range(1, ranges)]
            cuts = np.array(several.agg(F.percentile_approx("lead", points, 10_000)).first()[0], np.int64)
        runs = texts.mapInArrow(lambda b: _sorted_runs(b, length, gram, mixed, dense, cuts), _RUN)
        judged = runs.groupBy("part").applyInArrow(
            lambda table: _judged(table, length, gram), f"h bigint, s bigint, runs {runs_type}"
        )
        verdicts = verdicts.unionByName(judged.distinct())
        if n_dense:
            windows = texts.mapInArrow(
                lambda b: _window_rows(b, length, gram, dense), "h bigint, s bigint, place bigint, window bigint"
            )
            twice = windows.groupBy("window").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("window")
            found = windows.distinct().join(twice, "window").groupBy("h", "s")
            run = F.struct(F.col("place").alias("begin"), (F.col("place") + 1).alias("end"))
            verdicts = verdicts.unionByName(found.agg(F.collect_list(run).cast(runs_type).alias("runs")))
    hit = places.join(stage(verdicts, "verdicts"), ["h", "s"])
    hit = hit.select("doc_id", "text_key", "first", "n", F.explode("runs").alias("run"))
    span = F.struct(
        (F.col("first") + F.col("run.begin")).alias("begin"),
        (F.col("first") + F.least("n", "run.end") - 1 + length).alias("end"),
    )
    return hit.groupBy("doc_id", "text_key").agg(F.collect_set(span).alias("spans"))


def _cut(texts: pa.Array, spans: pa.Array, as_text: bool) -> list[pa.Array]:
    """Bytes, removed spans merged, and the bytes left of each text."""
    data, starts = text_bytes(texts)
    raw = data.tobytes()
    sizes, gone, left = [], [], []
    for lo, hi, row in zip(starts[:-1].tolist(), starts[1:].tolist(), spans.to_pylist(), strict=True):
        merged_spans: list[list[int]] = []
        for b, e in sorted((r["begin"], r["end"]) for r in row or ()):
            if merged_spans and b <= merged_spans[-1][1]:
                merged_spans[-1][1] = max(merged_spans[-1][1], e)
            else:
                merged_spans.append([b, e])
        at, kept = lo, []
        for b, e in merged_spans:
            kept.append(raw[at : lo + b])
            at = lo + e
        sizes.append(hi - lo)
        gone.append([{"begin": b, "end": e} for b, e in merged_spans])
        left.append(b"".join([*kept, raw[at:hi]]))
    kept = pa.array([b.decode("utf-8", "ignore") for b in left], pa.string()) if as_text else pa.array(left, pa.binary())
    return [pa.array(sizes, pa.int64()), pa.array(gone, _RUNS), kept]


def with_removed(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    gram: int | None = None,
    cluster: int = CLUSTER,
    drop: tuple[str, ...] = (),
    name: str = "removed",
    as_text: bool = False,
) -> DataFrame:
    """``docs`` and a struct column: n_bytes, spans removed (in bytes), and the bytes kept.

    ``as_text`` gives those as text, without what is left of characters cut in two. ``gram`` is the
    size of an anchor, by default 16 bytes of 25 of the length.
    """
    gram = gram or max(8, length * 16 // 25)
    key = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), key.alias("text_key"))
    spans = _spans(narrow, length, gram, cluster)
    spans = spans.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.col("spans").alias("__spans"))
    own = free_name(docs, "__own")
    left = docs.withColumn(own, key)
    met = left.join(spans, left[doc_id].eqNullSafe(spans["__id"]) & (left[own] == spans["__key"]), "left")
    met = met.drop("__id", "__key", own)
    span_type = T.ArrayType(T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())]))
    types = {"n_bytes": T.LongType(), "spans": span_type, "kept": T.StringType() if as_text else T.BinaryType()}
    new = [T.StructField(free_name(met, f"__new_{n}"), t) for n, t in types.items()]
    out = add_columns(met, new, lambda batch: _cut(column(batch, text), column(batch, "__spans"), as_text), (*drop, "__spans"))
    parts = [F.col(f.name).alias(n) for f, n in zip(new, types, strict=True)]
    return out.select(*[c for c in docs.columns if c not in drop], F.struct(*parts).alias(free_name(docs, name)))


def without_repeats(docs: DataFrame, text: str = "text", n_chars: str = "n_chars", **options) -> DataFrame:
    """The documents with repeated bytes gone from their texts; ``n_chars``, if there, follows.

    Null texts stay null.
    """
    name = free_name(docs, "removed")
    out = with_removed(docs, text=text, as_text=True, **options)
    out = out.withColumn(text, F.when(F.col(text).isNotNull(), F.col(name)["kept"])).drop(name)
    if n_chars in docs.columns:
        size = F.char_length(text).cast(docs.schema[n_chars].dataType)
        out = out.withColumn(n_chars, F.coalesce(size, F.col(n_chars)))
    return out.select(*docs.columns)
