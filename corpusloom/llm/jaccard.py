"""N-gram Jaccard join with a MinHash LSH forest.

A text is the set of hashes of its shingles, five words in a row (all its words if it has
fewer). Each tree of the forest is a sorted prefix trie of paths, ``DEPTH`` MinHash values of
a byte each. Texts that share a prefix are a bucket. Prefixes are shortened from ``START``
values until a pair at the threshold shares one in any tree with the target recall: a long
prefix brings the likeliest texts together first, and a shorter one is followed only where
it joins texts that no longer one has linked, so that settled parts of a trie are left alone.

The values of all trees together are a signature. Texts of a bucket are compared by it, and
those whose share of equal values is within ``SLACK`` deviations of the threshold are
connected; a crowd of texts that are merely somewhat alike falls apart here. Each component
of what is left is then verified exactly, every text against every other, so that a pair
that no tree brought together is found too if others connect it. Classes are components of
verified links.

Texts with equal shingle sets are one node, with a number of copies; only nodes are
compared. Buckets and components are never expanded into pairs: those of many nodes are cut
into blocks of bounded size, which are compared block against block.

Defined results: a text without words (null, empty) is linked to nothing; null ids are
rows like others, and come first where the least id of a class is taken; repeated rows are
copies; empty tables give empty results; other columns are not looked at, whatever their
names, and kept by :func:`one_per_class`.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusloom.llm.arrow import column, free_name, text_bytes, text_chunks
from corpusloom.llm.bitmap import bitmap_of, within
from corpusloom.llm.components import components
from corpusloom.llm.words import grams, mix, word_hashes
from corpusloom.session import stage

SHINGLE = 5
THRESHOLD = 0.8
TREES = 24
DEPTH = 24  # values of a path; those beyond a prefix serve the signature
START = 12
RECALL = 0.9999
SEED = 6
SLACK = 4.5
GLANCE = 96  # values looked at before the whole signature
BLOCK_PATHS = 4096
BLOCK_NODES = 512
BLOCK_SHINGLES = 1_000_000


def depth_for(threshold: float, recall: float, trees: int, depth: int = DEPTH) -> int:
    """The longest prefix with which a pair at the threshold is a candidate as surely as asked."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def prefixes_for(floor: int) -> list[int]:
    """Prefix lengths from ``START`` down to the one that reaches the recall."""
    return sorted({max(START, floor), (max(START, floor) + floor) // 2, floor}, reverse=True)


def shingles(words: np.ndarray, first: np.ndarray, k: int = SHINGLE) -> list[np.ndarray]:
    """Distinct shingle hashes of each text, sorted."""
    whole = grams(words, k)
    out = []
    for begin, end in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if end - begin >= k:
            out.append(np.unique(whole[begin : end - k + 1]))
        elif end > begin:
            out.append(grams(words[begin:end], end - begin))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _sketches(batches: Iterator[pa.RecordBatch], trees: int, k: int) -> Iterator[pa.RecordBatch]:
    """A digest of the shingle set, and the paths: for each tree its number and ``DEPTH`` values."""
    factors = mix(np.arange(1, trees * DEPTH + 1, dtype=np.uint64) + np.uint64(SEED << 32)) | np.uint64(1)
    for batch in batches:
        sizes, nodes, paths = [], [], []
        for begin, end, data, starts in text_chunks(column(batch, "text")):
            sets = shingles(*word_hashes(data, starts), k)
            counts = np.array([len(s) for s in sets])
            sizes.append(counts)
            have = np.flatnonzero(counts)
            digest = np.zeros((end - begin, 2), np.uint64)
            path = np.zeros((end - begin, trees, DEPTH + 1), np.uint8)
            path[:, :, 0] = np.arange(trees)
            if len(have):
                flat = np.concatenate(sets)
                at = (np.cumsum(counts) - counts)[have]
                digest[have, 0] = np.add.reduceat(mix(flat), at)
                digest[have, 1] = np.add.reduceat(mix(flat ^ factors[0]), at)
                half = (flat >> np.uint64(32)).astype(np.uint32)
                for number, factor in enumerate(factors.astype(np.uint32)):
                    value = mix(np.minimum.reduceat(half * factor, at).astype(np.uint64)) >> np.uint64(56)
                    path[have, number // DEPTH, number % DEPTH + 1] = value
            nodes += [row.tobytes() for row in digest]
            paths += [row.tobytes() for row in path]
        yield pa.RecordBatch.from_arrays(
            [
                column(batch, "doc_id"),
                column(batch, "text_key"),
                pa.array(nodes, pa.binary()),
                pa.array(np.concatenate([np.zeros(0, np.int64), *sizes])),
                pa.array(paths, pa.binary()),
            ],
            ["doc_id", "text_key", "node", "n", "paths"],
        )


def _least_equal(threshold: float, values: int) -> float:
    """Equal values that all but a few in a million pairs at the threshold have."""
    return values * threshold - SLACK * (values * threshold * (1 - threshold)) ** 0.5


def connected(signatures: np.ndarray, threshold: float) -> np.ndarray:
    """For each row the first row of its component of probable links.

    Rows are visited from link to link; each is compared with those not yet reached.
    """
    n, values = signatures.shape
    glance = min(GLANCE, values)
    first = np.ascontiguousarray(signatures[:, :glance])
    some, all_ = _least_equal(threshold, glance), _least_equal(threshold, values)
    root = np.arange(n)
    place, live = np.arange(n), np.ones(n, bool)  # rows still compared with, and which of them are not reached
    near = first
    for seed in range(n):
        if root[seed] != seed:
            continue
        live[np.searchsorted(place, seed)] = False
        queue = [seed]
        while queue:
            at = queue.pop()
            if 2 * np.count_nonzero(live) < len(live):
                place, near = place[live], near[live]
                live = np.ones(len(place), bool)
            if not len(place):
                break
            maybe = np.flatnonzero(live & (np.count_nonzero(near == first[at], axis=1) >= some))
            same = np.count_nonzero(signatures[place[maybe]] == signatures[at], axis=1)
            maybe = maybe[same >= all_]
            live[maybe] = False
            root[place[maybe]] = seed
            queue += place[maybe].tolist()
    return root


def _stars(batches: Iterator[pa.RecordBatch], trees: int, threshold: float) -> Iterator[pa.RecordBatch]:
    """``node, root`` for nodes of a cell with a probable link; rows come sorted by cell and node."""
    held: list[pa.RecordBatch] = []

    def stars(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        nodes = pa.concat_arrays([column(b, "node") for b in parts])
        data = b"".join(column(b, "paths")[i].as_py() for b in parts for i in range(len(b)))
        paths = np.frombuffer(data, np.uint8).reshape(len(nodes), trees, DEPTH + 1)[:, :, 1:]
        root = connected(paths.reshape(len(nodes), trees * DEPTH), threshold)
        linked = np.flatnonzero(root != np.arange(len(root)))
        return pa.RecordBatch.from_arrays([nodes.take(pa.array(linked)), nodes.take(pa.array(root[linked]))], ["node", "root"])

    for batch in batches:
        if not len(batch):
            continue
        cells = column(batch, "cell").to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist(), len(cells)]
        for begin, end in zip(edges[:-1], edges[1:], strict=True):
            if held and column(held[0], "cell")[0].as_py() != cells[begin]:
                yield stars(held)
                held = []
            held.append(batch.slice(begin, end - begin))
    if held:
        yield stars(held)


def _trie(nodes: DataFrame, trees: int, floor: int) -> DataFrame:
    """``node, path``: the paths that share a prefix of ``floor`` values with another; others join nothing."""
    numbers = F.sequence(F.lit(0), F.lit(trees - 1))
    path = F.transform(numbers, lambda tree: F.substring("paths", tree * (DEPTH + 1) + 1, F.lit(1 + max(START, floor))))
    paths = nodes.select("node", F.explode(path).alias("path")).withColumn("prefix", F.substring("path", 1, 1 + floor))
    shared = paths.groupBy("prefix").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    return paths.join(shared.select("prefix"), "prefix").select("node", "path")


def _joined_by(trie: DataFrame, nodes: DataFrame, known: DataFrame, depth: int, trees: int, threshold: float) -> DataFrame:
    """Probable links in the buckets of a prefix length that hold texts of more than one component."""
    at = trie.select("node", F.substring("path", 1, 1 + depth).alias("bucket"))
    rooted = at.join(known, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_ = rooted.groupBy("bucket").agg(
        F.min("root").alias("low"),
        F.max("root").alias("high"),
        F.count(F.lit(1)).alias("size"),
        F.min("node").alias("head"),
        F.bit_xor(F.xxhash64("node")).alias("members"),
    )
    open_ = open_.filter("low < high").groupBy("size", "head", "members").agg(F.min("bucket").alias("bucket"))
    open_ = open_.select("bucket", F.ceil(F.col("size") / BLOCK_PATHS).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: (F.col("blocks") == 1) | (x != F.col("block")))
    cells = at.join(open_, "bucket").withColumn("block", block).withColumn("other", F.explode(others))
    cells = cells.select("node", F.xxhash64("bucket", F.least("block", "other"), F.greatest("block", "other")).alias("cell"))
    rows = cells.join(nodes.select("node", "paths"), "node").repartition("cell").sortWithinPartitions("cell", "node")
    return rows.mapInArrow(lambda batches: _stars(batches, trees, threshold), "node binary, root binary")


def _verified(table: pa.Table, threshold: float, k: int) -> pa.Table:
    """Per node of the two blocks: documents it is linked to, and the least node it reaches."""
    limit = Fraction(str(threshold))
    _, keep = np.unique(np.array(table.column("node").to_pylist(), dtype=object), return_index=True)
    table = table.take(pa.array(keep))  # equal rows of one document count once; nodes are now sorted
    texts = table.column("text").combine_chunks()
    texts = texts if isinstance(texts, pa.Array) else texts.chunk(0)
    sets = shingles(*word_hashes(*text_bytes(texts)), k)
    sizes = np.array([len(s) for s in sets])
    n = len(sets)
    flat, row = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    _, place, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count[place] > 1
    place, row = place[shared], row[shared]
    _, place = np.unique(place, return_inverse=True)
    common = np.zeros((n, n), np.float32)
    step = max(1, (1 << 22) // max(n, 1))
    order = np.argsort(place, kind="stable")
    place, row = place[order], row[order]
    for low in range(0, int(place[-1]) + 1 if len(place) else 0, step):
        part = slice(*np.searchsorted(place, [low, low + step]))
        held = np.zeros((n, min(step, int(place[-1]) + 1 - low)), np.float32)
        held[row[part], place[part] - low] = 1
        common += held @ held.T
    common = np.rint(common).astype(np.int64)
    a, b = limit.numerator, limit.denominator
    linked = (a + b) * common >= a * (sizes[:, None] + sizes[None, :])
    np.fill_diagonal(linked, False)
    block = table.column("block").to_numpy()
    if table.column("low")[0].as_py() != table.column("high")[0].as_py():
        linked &= block[:, None] != block[None, :]
    copies = table.column("copies").to_numpy()
    least = np.arange(n)
    while True:  # nodes are sorted, so the least node is the least place
        reached = np.minimum(least, np.where(linked, least[None, :], n).min(axis=1, initial=n))
        reached = np.minimum(reached, reached[reached])
        if (reached == least).all():
            break
        least = reached
    nodes = table.column("node").combine_chunks()
    nodes = nodes if isinstance(nodes, pa.Array) else nodes.chunk(0)
    return pa.table(
        {
            "node": nodes,
            "least": nodes.take(pa.array(least)),
            "n_links": pa.array((linked * copies[None, :]).sum(axis=1)),
            "n_nodes": pa.array(linked.sum(axis=1)),
        }
    )


def _row_hash(doc_id: str, text_key: str) -> Column:
    return F.xxhash64(doc_id, text_key)


def _among(hashes: DataFrame):
    return within(hashes.sparkSession.sparkContext.broadcast(bitmap_of(hashes)))


def _text_key(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def classes(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
    trees: int = TREES,
    recall: float = RECALL,
    k: int = SHINGLE,
) -> DataFrame:
    """One row per document: ``doc_id, text_key, class_id, n_links, copies, keep``.

    A class is a connected component of links, ``class_id`` its least doc_id. ``n_links`` is
    the number of other documents at the threshold or above, copies among them; ``copies``
    how many documents have the same shingles. ``keep`` marks the row of the class with the
    least (doc_id, text_key), and every row without words.
    """
    floor = depth_for(threshold, recall, trees)
    rows = docs.select(F.col(doc_id).alias("doc_id"), _text_key(text).alias("text_key"), F.col(text).alias("text"))
    id_type = docs.schema[doc_id].dataType.simpleString()
    sketch = stage(
        rows.mapInArrow(
            lambda batches: _sketches(batches, trees, k),
            f"doc_id {id_type}, text_key bigint, node binary, n bigint, paths binary",
        ),
        "sketch",
    )
    worded = sketch.filter("n > 0")
    nodes = worded.groupBy("node").agg(
        F.count(F.lit(1)).alias("copies"),
        F.min(F.struct("doc_id", "text_key")).alias("rep"),
        F.max("n").alias("n"),
        F.first("paths").alias("paths"),  # equal nodes have equal paths
    )
    kept = stage(nodes, "nodes")
    nodes = kept.drop("paths")
    trie = stage(_trie(kept, trees, floor), "trie")
    found = kept.sparkSession.createDataFrame([], "node binary, root binary")
    for depth in prefixes_for(floor):
        found = components(found.unionByName(_joined_by(trie, kept, found, depth, trees, threshold)), f"prefix-{depth}")
    roots = found.select("root").distinct().select(F.col("root").alias("node"), "root")
    member = found.select("node", "root").unionByName(roots)
    member = stage(member.join(nodes, "node"), "members")
    blocks = member.groupBy("root").agg(
        F.greatest(
            F.lit(1), F.ceil(F.count(F.lit(1)) / BLOCK_NODES), F.ceil(F.sum("n") / BLOCK_SHINGLES)
        ).cast("int").alias("blocks")
    )
    placed = (
        member.join(blocks, "root")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .select("root", "node", "copies", "blocks", "block", F.col("rep.doc_id").alias("rep_id"), F.col("rep.text_key").alias("rep_key"))
    )
    placed = stage(placed, "placed")
    # Few texts are candidates: a bitmap keeps most of the others out of the shuffle.
    maybe = _among(placed.select(_row_hash("rep_id", "rep_key").alias("h")))
    rows = rows.filter(maybe(_row_hash("doc_id", "text_key")))
    texts = rows.join(placed, rows["doc_id"].eqNullSafe(placed["rep_id"]) & (rows["text_key"] == placed["rep_key"]))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = texts.select("root", "node", "copies", "block", "text", other.alias("other"))
    paired = paired.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    checked = stage(
        paired.select("root", "low", "high", "node", "copies", "block", "text")
        .groupBy("root", "low", "high")
        .applyInArrow(lambda table: _verified(table, threshold, k), "node binary, least binary, n_links bigint, n_nodes bigint"),
        "checked",
    )
    joined = components(checked.select("node", F.col("least").alias("root")), "classes")
    links = checked.groupBy("node").agg(F.sum("n_links").alias("n_links"))
    per_node = (
        nodes.join(links, "node", "left")
        .join(joined.withColumnRenamed("root", "class"), "node", "left")
        .select("node", "copies", "rep", F.coalesce("class", "node").alias("class"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    )
    per_class = per_node.groupBy("class").agg(F.min("rep").alias("first"))
    per_node = per_node.join(per_class, "class").select("node", "copies", "n_links", "first")
    out = sketch.select("doc_id", "text_key", F.when(F.col("n") > 0, F.col("node")).alias("node")).join(per_node, "node", "left")
    keep = F.col("first").isNull() | (
        F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key"))
    )
    return out.select(
        "doc_id",
        "text_key",
        F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
        F.coalesce(F.col("n_links") + F.col("copies") - 1, F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("copies", F.lit(1)).cast("bigint").alias("copies"),
        keep.alias("keep"),
    )


def one_per_class(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents without those that a kept one of their class stands for, with their own columns."""
    found = stage(classes(docs, doc_id, text, **options).select("doc_id", "text_key", "keep"), "kept")
    kept = found.filter("keep").groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n"))
    # Rows that may go: the others of a class, and rows equal in id and text to another.
    maybe = found.filter("NOT keep").select("doc_id", "text_key").unionByName(kept.filter("n > 1").drop("n"))
    maybe = _among(maybe.select(_row_hash("doc_id", "text_key").alias("h")))
    key, row = free_name(docs, "__key"), free_name(docs, "__row")
    keyed = docs.withColumn(key, _text_key(text))
    sure = keyed.filter(~maybe(_row_hash(doc_id, key))).select(*docs.columns)
    left = keyed.filter(maybe(_row_hash(doc_id, key)))
    kept = kept.select(F.col("doc_id").alias("__kept_id"), F.col("text_key").alias("__kept_key"))
    met = left.join(kept, left[doc_id].eqNullSafe(kept["__kept_id"]) & (left[key] == kept["__kept_key"]), "left_semi")
    # Of rows equal in id and text one stays; those without words are nobody's copies.
    number = F.row_number().over(Window.partitionBy(doc_id, key).orderBy(F.lit(0)))
    wordless = F.col(text).isNull() | ~F.col(text).rlike("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]")
    rest = met.withColumn(row, number).filter((F.col(row) == 1) | wordless).select(*docs.columns)
    return sure.unionByName(rest)
