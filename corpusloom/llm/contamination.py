"""Benchmark decontamination by winnowing.

Documents and benchmark items are cut into words; hashes of five words in a row are
winnowed (the least of every six neighbours is kept), so two texts that share ten words in
a row share a kept fingerprint. Document fingerprints are looked up among those of the
benchmark, and each common one is extended left and right, word by word; a shared run of
at least ten words is a hit. An item of fewer than ten words must occur whole; its
word-gram is looked up at every position of a document.

Defined results: a null text has no words and is clean; an item without words never
occurs; repeated rows of documents give repeated results; items with equal ids count
once; a null item id is listed as the empty string; an empty table gives an empty result
or clean documents. Columns other than id and text are not looked at, whatever their name.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.arrow import add_columns, column, free_name, text_bytes, text_chunks
from corpusloom.llm.bitmap import bitmap_of, contains
from corpusloom.llm.words import grams, gram_fits, mix, owner, winnowed, word_hashes
from corpusloom.session import stage

WINDOW = 10  # words that must be shared in a row
GRAM = 5  # words per fingerprint; WINDOW - GRAM + 1 neighbours are winnowed

#: Bytes of benchmark text up to which its index goes to every task (about ten times as
#: much memory); a larger benchmark is joined by shuffling hashes of shared windows.
BROADCAST_BYTES = 16_000_000

SPANS = T.ArrayType(T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())]))
FOUND = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", SPANS),
]


def fingerprints(hashes: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Winnowed word grams: ``(hash, position of the first word)``."""
    values = grams(hashes, GRAM)
    texts = owner(first)
    fits = np.flatnonzero(gram_fits(first, len(values), GRAM))
    kept = winnowed(values[fits], texts[fits], window - GRAM + 1)
    return values[fits[kept]], fits[kept]


@dataclass
class Index:
    """Fingerprints of a set of items, sorted by hash, and the items' words."""

    names: list[str]
    words: np.ndarray
    first: np.ndarray
    window: int = WINDOW
    fp: np.ndarray = field(init=False)
    at: np.ndarray = field(init=False)
    short: dict[int, tuple[np.ndarray, np.ndarray]] = field(init=False)

    def __post_init__(self):
        hashes, at = fingerprints(self.words, self.first, self.window)
        order = np.argsort(hashes, kind="stable")
        self.fp, self.at = hashes[order], at[order]
        sizes = np.diff(self.first)
        self.short = {}
        for size in np.unique(sizes[(sizes > 0) & (sizes < self.window)]).tolist():
            items = np.flatnonzero(sizes == size)
            whole = grams(self.words, size)[self.first[items]]
            order = np.argsort(whole, kind="stable")
            self.short[size] = (whole[order], items[order])

    @classmethod
    def of(cls, names: list[str], texts: pa.Array, window: int = WINDOW) -> Index:
        return cls(names, *word_hashes(*text_bytes(texts)), window)


def lookup(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All ``(position in keys, position in wanted)`` with equal values; ``keys`` is sorted."""
    low = np.searchsorted(keys, wanted, "left")
    count = np.searchsorted(keys, wanted, "right") - low
    hit = np.repeat(np.arange(len(wanted)), count)
    within = np.arange(len(hit)) - np.repeat(np.cumsum(count) - count, count)
    return low[hit] + within, hit


def shared_runs(index: Index, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(begin, end, item)``: runs of document words that an item holds too, long enough to count."""
    if not len(words) or not len(index.words):
        none = np.zeros(0, np.int64)
        return none, none, none
    texts = owner(first)
    values, at = fingerprints(words, first, index.window)
    there, here = lookup(index.fp, values)
    d, b = at[here], index.at[there]
    items = owner(index.first)
    item = items[b]
    # Extend: to the left while the words before agree, to the right while those after do.
    left = np.zeros(len(d), np.int64)
    right = np.full(len(d), GRAM, np.int64)
    for reach, step, d_edge, b_edge in (
        (left, -1, first[texts[d]], index.first[item]),
        (right, 1, first[texts[d] + 1], index.first[item + 1]),
    ):
        active = np.arange(len(d))
        while len(active):
            i = d[active] - reach[active] - 1 if step < 0 else d[active] + reach[active]
            j = b[active] - reach[active] - 1 if step < 0 else b[active] + reach[active]
            room = (i >= d_edge[active]) & (j >= b_edge[active]) if step < 0 else (i < d_edge[active]) & (j < b_edge[active])
            active, i, j = active[room], i[room], j[room]
            active = active[words[i] == index.words[j]]
            reach[active] += 1
    enough = left + right >= index.window
    runs = [(d[enough] - left[enough], d[enough] + right[enough], item[enough])]
    for size, (whole, names) in index.short.items():
        values = grams(words, size)
        fits = np.flatnonzero(gram_fits(first, len(values), size))
        there, here = lookup(whole, values[fits])
        runs.append((fits[here], fits[here] + size, names[there]))
    return tuple(np.concatenate(parts) for parts in zip(*runs, strict=True))


def found_in(index: Index, texts: pa.Array) -> list[pa.Array]:
    """The columns of ``FOUND`` for each text."""
    n_words, n_hit, items, spans = [], [], [], []
    for _, _, data, starts in text_chunks(texts):
        words, first = word_hashes(data, starts)
        begin, end, item = shared_runs(index, words, first)
        step = np.zeros(len(words) + 1, np.int64)
        np.add.at(step, begin, 1)
        np.add.at(step, end, -1)
        covered = np.concatenate([[0], np.cumsum(np.cumsum(step)[:-1] > 0)])
        n_words.append(np.diff(first))
        n_hit.append(covered[first[1:]] - covered[first[:-1]])
        rows = np.searchsorted(first, begin, "right") - 1
        by_row: dict[int, tuple[set, set]] = {}
        for row, lo, hi, which in zip(rows.tolist(), begin.tolist(), end.tolist(), item.tolist(), strict=True):
            names, runs = by_row.setdefault(row, (set(), set()))
            names.add(index.names[which])
            runs.add((lo - int(first[row]), hi - int(first[row])))
        for row in range(len(first) - 1):
            names, runs = by_row.get(row, ((), ()))
            items.append(sorted(names))
            spans.append([{"begin": lo, "end": hi} for lo, hi in merged(runs)])
    span_type = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
    empty = np.zeros(0, np.int64)
    return [
        pa.array(np.concatenate([empty, *n_words])),
        pa.array(np.concatenate([empty, *n_hit])),
        pa.array(items, pa.list_(pa.string())),
        pa.array(spans, span_type),
    ]


def merged(runs) -> list[tuple[int, int]]:
    """Overlapping or touching runs as one, in order."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(runs):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def with_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    broadcast_bytes: int = BROADCAST_BYTES,
    drop: tuple[str, ...] = (),
    name: str = "found",
) -> DataFrame:
    """``docs`` and a struct column: n_words, n_hit, items and hit spans (in words).

    The size of the benchmark is measured first. Up to ``broadcast_bytes`` its index is
    broadcast and documents are only mapped over; beyond that, hashes of the windows that
    items and documents may share are joined by shuffling. The struct column gets
    underscores in front where ``docs`` has a column of that name.
    """
    bench = benchmark.select(
        F.coalesce(F.col(item).cast("string"), F.lit("")).alias("name"), F.col(item_text).alias("text")
    ).distinct()
    size = bench.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    if size <= broadcast_bytes:
        table = bench.toArrow().combine_chunks()  # measured above: a bounded table
        texts = table.column("text").combine_chunks()
        texts = texts if isinstance(texts, pa.Array) else texts.chunk(0)
        index = Index.of(table.column("name").to_pylist(), texts, window)
        shared = docs.sparkSession.sparkContext.broadcast(index)
        fields = [T.StructField(free_name(docs, f"__{f.name}"), f.dataType) for f in FOUND]
        out = add_columns(docs, fields, lambda batch: found_in(shared.value, column(batch, text)), drop)
        parts = [F.col(f.name).alias(g.name) for f, g in zip(fields, FOUND, strict=True)]
        kept = [c for c in out.columns if c not in {f.name for f in fields}]
        return out.select(*kept, F.struct(*parts).alias(free_name(docs, name)))
    return _by_shuffle(docs, bench, text, window, drop, name)


def _by_shuffle(docs, bench, text, window, drop, name) -> DataFrame:
    """The form for a benchmark too large to broadcast; results depend on the text alone.

    What is joined are hashes of whole windows: the ``window``-grams of items of that many
    words, and the one gram of a shorter item. Texts of documents give those of their grams
    that may be an item's: of the lengths that items have, beside a winnowed fingerprint
    that an item may hold too, and inside a bitmap of the items' windows. Bitmaps are of
    fixed size and never miss. Item names are counted together per window before the join,
    so a window meets one row, in however many items it occurs; no text meets another.
    """
    context = docs.sparkSession.sparkContext
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    key = free_name(docs, "__digest")
    keyed = docs.withColumn(key, digest)
    item_rows = bench.filter("text IS NOT NULL").mapInArrow(
        lambda batches: _item_rows(batches, window), "name string, size int, kind int, h bigint"
    )
    item_rows = stage(item_rows.distinct(), "item_windows")
    sizes = sorted(r["size"] for r in item_rows.filter(F.col("kind") == _WINDOW_KIND).select("size").distinct().collect())
    wanted = context.broadcast(bitmap_of(item_rows.filter(F.col("kind") == _WINDOW_KIND)))
    prints = context.broadcast(bitmap_of(item_rows.filter(F.col("kind") == _PRINT_KIND)))
    hits = keyed.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        lambda batches: _document_rows(batches, sizes, window, wanted.value, prints.value),
        "key string, h bigint, begin bigint, end bigint",
    )
    hits = stage(hits.distinct(), "document_windows")
    # Windows of the same items are one set of names; only windows that some text has are collected.
    windows = item_rows.filter(F.col("kind") == _WINDOW_KIND).select("h", "name")
    held = windows.join(hits.select("h").distinct(), "h", "left_semi").groupBy("h").agg(F.array_sort(F.collect_set("name")).alias("names"))
    held = stage(held.withColumn("names_key", F.sha2(F.to_json("names"), 256)), "window_names")
    met = stage(hits.join(held.select("h", "names_key"), "h"), "hits")
    names = met.select("key", "names_key").distinct().join(held.select("names_key", "names").dropDuplicates(["names_key"]), "names_key")
    named = names.select("key", F.explode("names").alias("name")).groupBy("key").agg(F.array_sort(F.collect_set("name")).alias("items"))
    runs = met.groupBy("key").agg(F.array_sort(F.collect_set(F.struct("begin", "end"))).alias("runs"))
    per_text = named.join(runs, "key")
    joined = keyed.join(per_text.withColumnRenamed("key", key), key, "left")
    fields = [T.StructField(free_name(joined, f"__{n}"), t) for n, t in (("n", T.LongType()), ("h", T.LongType()), ("s", SPANS))]
    counted = add_columns(joined, fields, lambda batch: _counted(column(batch, text), column(batch, "runs")), drop)
    parts = [
        F.col(fields[0].name).alias("n_words"),
        F.col(fields[1].name).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col(fields[2].name).alias("spans"),
    ]
    return counted.select(*[c for c in docs.columns if c not in drop], F.struct(*parts).alias(free_name(docs, name)))


_WINDOW_KIND, _PRINT_KIND = 0, 1


def _windows(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams of ``size`` words, tagged with their length, and the positions of their first words."""
    values = grams(words, size)
    fits = np.flatnonzero(gram_fits(first, len(values), size))
    return mix(values[fits] + np.uint64(size)), fits


def _item_rows(batches, window: int):
    """Rows of ``(name, size, kind, h)``: windows and fingerprints of long items, the whole of short ones."""
    for batch in batches:
        for begin, end, data, starts in text_chunks(column(batch, "text")):
            words, first = word_hashes(data, starts)
            texts, lengths = owner(first), np.diff(first)
            values, at = fingerprints(words, first, window)
            parts = [(values, texts[at], window, _PRINT_KIND)]
            for size in [*np.unique(lengths[(lengths > 0) & (lengths < window)]).tolist(), window]:
                values, at = _windows(words, first, size)
                own = lengths[texts[at]] == size if size < window else np.ones(len(at), bool)
                parts.append((values[own], texts[at[own]], size, _WINDOW_KIND))
            names = column(batch, "name").slice(begin, end - begin)
            for values, rows, size, kind in parts:
                if len(values):
                    same = [pa.array(np.full(len(values), x, np.int32)) for x in (size, kind)]
                    yield pa.RecordBatch.from_arrays(
                        [names.take(pa.array(rows)), *same, pa.array(values.view(np.int64))], ["name", "size", "kind", "h"]
                    )


def _document_rows(batches, sizes: list[int], window: int, wanted: np.ndarray, prints: np.ndarray):
    """Rows of ``(key, h, begin, end)``: windows of documents that may be an item's."""
    for batch in batches:
        for begin, end, data, starts in text_chunks(column(batch, "text")):
            words, first = word_hashes(data, starts)
            texts = owner(first)
            keys = column(batch, "key").slice(begin, end - begin)
            for size in sizes:
                values, at = _windows(words, first, size)
                may = contains(wanted, values)
                if size == window:
                    shared, places = fingerprints(words, first, window)
                    near = np.zeros(len(words) + window, bool)
                    for back in range(window - GRAM + 1):  # windows that hold the fingerprint
                        hold = places[contains(prints, shared)] - back
                        near[hold[hold >= 0]] = True
                    may &= near[at]
                values, at = values[may], at[may]
                if len(at):
                    left = at - first[texts[at]]
                    yield pa.RecordBatch.from_arrays(
                        [keys.take(pa.array(texts[at])), pa.array(values.view(np.int64)), pa.array(left), pa.array(left + size)],
                        ["key", "h", "begin", "end"],
                    )


def _counted(texts: pa.Array, runs: pa.Array) -> list:
    n_words = [np.diff(word_hashes(data, starts)[1]) for _, _, data, starts in text_chunks(texts)]
    joined = [merged([(r["begin"], r["end"]) for r in row or ()]) for row in runs.to_pylist()]
    span_type = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
    return [
        pa.array(np.concatenate([np.zeros(0, np.int64), *n_words])),
        pa.array([sum(hi - lo for lo, hi in row) for row in joined], pa.int64()),
        pa.array([[{"begin": lo, "end": hi} for lo, hi in row] for row in joined], span_type),
    ]


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents in which no window of the benchmark occurs, with their own columns."""
    name = free_name(docs, "found")
    return with_contamination(docs, benchmark, **options).filter(F.col(name)["n_hit"] == 0).select(*docs.columns)
