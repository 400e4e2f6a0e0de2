"""Document fingerprints by I-Match with randomised lexicons.

Terms are the distinct words of a text. The lexicon is the band of those whose inverse
document frequency is neither that of the words of every text nor that of the rare ones
which a typo makes. A signature is the hash of a text's sorted terms inside a lexicon: one
for the whole band, and one for each of ``DRAWS`` random subsets of it at each of the fixed
rates 1/2, 1/4, ... ``2 ** -OCTAVES``. A text touches large subsets with many terms, which
any edit changes, and small ones with a single term; which of them tell texts apart depends
on their length, so all rates are drawn. The fingerprint is the list of signatures.

The likeness of two fingerprints is the share of equal signatures among the ``NEAREST``
smallest subsets that either text touches; it is 1 where both have the same terms.

Defined results: a null text is the empty text; a text without a term of the lexicon is
fingerprinted by all its words, one without words by its bytes; equal texts have equal
fingerprints. Rows are put in order by id, then text; null ids come first; the row after
the last one is the first, and a single row follows itself. Repeated rows are rows like
others. Other columns are not looked at, whatever their names.

Terms are known by hashes of ``TERM_BITS`` bits, so the lexicon is a bitmap of
``2 ** TERM_BITS`` bits however many words there are; that is what is broadcast. Words that
share a hash share a document frequency.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.arrow import column, text_chunks
from corpusloom.llm.words import GRAM, mix, owner, span_hashes, word_hashes
from corpusloom.session import task_count

TERM_BITS = 27
MIN_IDF, MAX_IDF = 1.5, 8.0  # natural logarithm of documents / documents with the term
OCTAVES = 16
DRAWS = 12
NEAREST = 16
SEED = 4
MOST_BUCKETS = 1024  # of the order, per shuffle partition at most 16

#: Rate of each subset as a power of 1/2, the smallest subsets first, the whole band last.
RATES = np.append(np.repeat(np.arange(OCTAVES, 0, -1), DRAWS), 0)
SIGNATURES = len(RATES)
_MULTIPLIERS = mix(np.arange(1, SIGNATURES + 1, dtype=np.uint64) + np.uint64(SEED << 32)) | np.uint64(1)


def _terms(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``(text, term)`` pairs in order of text and term."""
    hashes, first = word_hashes(data, starts)
    pairs = (owner(first).astype(np.uint64) << np.uint64(TERM_BITS)) | (hashes >> np.uint64(64 - TERM_BITS))
    pairs = np.unique(pairs)
    return (pairs >> np.uint64(TERM_BITS)).astype(np.int64), pairs & np.uint64((1 << TERM_BITS) - 1)


def learn_lexicon(docs: DataFrame, text: str = "text", min_idf: float = MIN_IDF, max_idf: float = MAX_IDF) -> np.ndarray:
    """The lexicon as a bitmap, from the document frequencies of all words of all texts.

    Counts are added up in each task before they are shuffled. The bitmap is built in 2048
    parts on the executors; its size does not depend on the data.
    """

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def summed():
            terms, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(terms.astype(np.int32)), pa.array(n.astype(np.int32))], ["term", "n"])

        for batch in batches:
            for _, _, data, starts in text_chunks(column(batch, "text")):
                held.append(_terms(data, starts)[1].astype(np.uint32))
                size += len(held[-1])
                if size > 8_000_000:
                    yield summed()
                    held, size = [], 0
        if held:
            yield summed()

    rows = docs.select(F.col(text).alias("text"))
    total = docs.count()
    low, high = total * math.exp(-max_idf), total * math.exp(-min_idf)
    shift = TERM_BITS - 11
    in_band = (
        rows.mapInArrow(counts, "term int, n int")
        .groupBy("term")
        .agg(F.sum("n").alias("df"))
        .filter((F.col("df") >= low) & (F.col("df") <= high))
        .select(F.shiftright("term", shift).alias("part"), "term")
    )

    def bits(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        flags = np.zeros(1 << shift, bool)
        flags[table.column("term").to_numpy() - (part << shift)] = True
        return pa.table({"part": pa.array([part], pa.int32()), "bits": pa.array([np.packbits(flags).tobytes()], pa.binary())})

    bitmap = np.zeros(1 << (TERM_BITS - 3), np.uint8)
    step = 1 << (shift - 3)
    for row in in_band.groupBy("part").applyInArrow(bits, "part int, bits binary").collect():
        bitmap[row["part"] * step : (row["part"] + 1) * step] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return bitmap


def _signatures(rows: np.ndarray, terms: np.ndarray, n: int) -> np.ndarray:
    """Signatures of ``n`` texts (rows by texts) from their terms in order of text and term.

    0 is the signature of no term.
    """
    out = np.zeros((n, SIGNATURES), np.uint16)
    spread = mix(terms + np.uint64(1))
    for j, (rate, factor) in enumerate(zip(RATES.tolist(), _MULTIPLIERS, strict=True)):
        place = spread * factor
        inside = np.flatnonzero(place <= np.uint64((1 << (64 - rate)) - 1))
        if not len(inside):
            continue
        touched, begins, counts = np.unique(rows[inside], return_index=True, return_counts=True)
        turn = (np.arange(len(inside)) - np.repeat(begins, counts)).astype(np.uint64)
        listed = np.add.reduceat(mix(place[inside] + turn * GRAM), begins)
        out[touched, j] = np.maximum(mix(listed) >> np.uint64(48), np.uint64(1)).astype(np.uint16)
    return out


def fingerprints(texts: pa.Array, bitmap: np.ndarray) -> np.ndarray:
    """One row of ``SIGNATURES`` signatures of 16 bits for each text."""
    out = [np.zeros((0, SIGNATURES), np.uint16)]
    for first, end, data, starts in text_chunks(texts):
        rows, terms = _terms(data, starts)
        at = (terms >> np.uint64(3)).astype(np.int64)
        known = (bitmap[at] >> (np.uint64(7) - (terms & np.uint64(7))).astype(np.uint8)) & 1 > 0
        touched = np.zeros(end - first, bool)
        touched[rows[known]] = True
        use = known | ~touched[rows]
        rows, terms = rows[use], terms[use]
        wordless = np.setdiff1d(np.arange(end - first), rows)
        if len(wordless):
            whole = span_hashes(data, starts[wordless], starts[wordless + 1])
            rows, terms = np.concatenate([rows, wordless]), np.concatenate([terms, whole])
            order = np.argsort(rows, kind="stable")
            rows, terms = rows[order], terms[order]
        out.append(_signatures(rows, terms, end - first))
    return np.concatenate(out)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    touched = (a > 0) | (b > 0)  # every text has a term in the last one
    near = touched & (np.cumsum(touched, axis=1) <= NEAREST)
    return (near & (a == b)).sum(axis=1) / np.maximum(near.sum(axis=1), 1)


def as_text(prints: np.ndarray) -> list[str]:
    """Four hexadecimal digits per signature."""
    return [row.hex() for row in prints.astype(">u2").view(np.dtype((np.void, 2 * SIGNATURES))).ravel().tolist()] if len(prints) else []


def edited(text: str, following: str) -> str:
    """The last quarter of the text replaced by as many first characters of the following one."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _in_order(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows in buckets of the id order, each bucket closed by a copy of the row after it.

    The bucket limits are quantiles of the ids, at most ``MOST_BUCKETS`` numbers, and are ids
    that occur, so the row after a bucket is known by its id.
    """
    spark = docs.sparkSession
    key = F.coalesce(F.col(doc_id).cast("bigint"), F.lit(-(2**63)))
    rows = docs.select(key.alias("key"), F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n = min(MOST_BUCKETS, 16 * task_count(spark))
    ids = rows.select("key")
    limits, least = ids.agg(F.percentile_approx("key", [i / n for i in range(1, n)] or [0.5], 100_000), F.min("key")).first()
    limits = np.unique(np.array([least, *limits] if least is not None else [0], np.int64))

    @F.pandas_udf("int")
    def bucket(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(limits, keys.to_numpy(), "right") - 1, dtype="int32")

    first = spark.createDataFrame([(int(v), (i - 1) % len(limits)) for i, v in enumerate(limits)], "key bigint, bucket int")
    closing = (
        rows.select("key", "text")
        .join(F.broadcast(first), "key")  # one row per bucket
        .groupBy("bucket")
        .agg(F.min("text").alias("text"))
        .select("bucket", F.lit(True).alias("closing"), F.lit(None).cast("bigint").alias("key"), F.lit(None).cast(docs.schema[doc_id].dataType).alias("doc_id"), "text")
    )
    dealt = rows.select(bucket("key").alias("bucket"), F.lit(False).alias("closing"), "key", "doc_id", "text").unionByName(closing)
    return dealt.repartition(task_count(spark), "bucket").sortWithinPartitions("bucket", "closing", "key", "text").drop("key")


def with_neighbours(docs: DataFrame, bitmap: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness.

    Texts are shuffled once, into buckets of the id order; each is then read with the next.
    """
    ordered = _in_order(docs, doc_id, text)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[doc_id].dataType),
            T.StructField("n_chars", T.LongType()),
            T.StructField("edited_text", T.BinaryType()),
            T.StructField("fingerprint", T.StringType()),
            T.StructField("edited_fingerprint", T.StringType()),
            T.StructField("near_edited", T.DoubleType()),
            T.StructField("near_next", T.DoubleType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, carry = shared.value, None
        for batch in batches:
            texts = column(batch, "text").cast(pa.string())
            strings = texts.to_pylist()
            prints = fingerprints(texts, bits)
            buckets, ids = column(batch, "bucket").to_numpy(), column(batch, "doc_id")
            if carry is not None:
                strings, prints = [carry[0], *strings], np.concatenate([carry[1], prints])
                buckets = np.concatenate([carry[2], buckets])
                ids = pa.concat_arrays([carry[3], ids])
            carry = (strings[-1], prints[-1:], buckets[-1:], ids.slice(len(ids) - 1)) if strings else carry
            rows = np.flatnonzero(buckets[:-1] == buckets[1:])  # a closing row ends its bucket
            for some in np.array_split(rows, max(1, len(rows) // 512)):
                changed = [edited(strings[i], strings[i + 1]) for i in some]
                other = fingerprints(pa.array(changed, pa.string()), bits)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(some)),
                        pa.array([len(strings[i]) for i in some], pa.int64()),
                        pa.array([t.encode() for t in changed], pa.binary()),
                        pa.array(as_text(prints[some]), pa.string()),
                        pa.array(as_text(other), pa.string()),
                        pa.array(likeness(prints[some], other), pa.float64()),
                        pa.array(likeness(prints[some], prints[some + 1]), pa.float64()),
                    ],
                    names=schema.names,
                )

    return ordered.mapInArrow(run, schema)
