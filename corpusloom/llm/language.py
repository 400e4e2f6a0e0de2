"""Language identification with hyperdimensional profiles.

Each letter has a random vector of signs, a function of its code point. A trigram of
letters is the product of its letters' vectors, turned by two, one and no places, so that
order counts. The trigrams of a text are added up to its profile; the unit profiles of the
different labelled texts of a language, each once however often it is repeated, are added up
to the language's prototype. A text gets the language whose prototype has the largest cosine with its profile, both taken from the mean
of all prototypes, which holds what the languages have in common.

Letters are what Unicode calls letters, lower-cased; any run of other characters is one
space, which takes part in trigrams as a letter does.

Defined results: a text that is null or without a letter is ``und`` with score 0, and so is
every text if nothing could be learned; the score is the cosine, 0 if negative; languages
that tie go to the first by name; a null language is never learned; repeated rows repeat
their result; other columns are kept whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.arrow import add_columns, column, free_name
from corpusloom.llm.words import mix
from corpusloom.session import stage

DIMENSIONS = 1024
SEED = 8
#: Different texts per language that the prototypes are learned from, chosen by a hash of the text.
FIT_PER_LANGUAGE = 5_000
MAX_SEEN = 1 << 17  # chosen texts that a task remembers, to pass copies on once
CHUNK_CHARS = 1 << 20
MAX_CACHED = 1 << 15  # trigram vectors a worker keeps
UNKNOWN = "und"

_SPACE = 32
_worker: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    if "letters" not in _worker:
        _worker["letters"] = np.array([chr(c).isalpha() for c in range(0x110000)])
    return _worker["letters"]


def letter_vectors(codes: np.ndarray) -> np.ndarray:
    """A vector of signs for each code point."""
    words = np.arange(DIMENSIONS // 64, dtype=np.uint64) + np.uint64(SEED << 32)
    random = mix(mix(codes.astype(np.uint64)[:, None] + np.uint64(1)) + words[None, :])
    return (np.unpackbits(random.view(np.uint8), axis=1).astype(np.int8) << 1) - 1


def trigram_vectors(keys: np.ndarray) -> np.ndarray:
    """Bound vectors of trigrams; a key holds three code points of 21 bits."""
    part = np.uint64((1 << 21) - 1)
    a, b, c = (letter_vectors((keys >> np.uint64(s)) & part) for s in (42, 21, 0))
    return np.roll(a, 2, axis=1) * np.roll(b, 1, axis=1) * c


def _cached_vectors(keys: np.ndarray) -> np.ndarray:
    """Vectors for sorted distinct keys, looked up in what this worker has made before."""
    have, vectors = _worker.get("keys"), _worker.get("vectors")
    if have is None or len(have) + len(keys) > MAX_CACHED:
        have, vectors = np.zeros(0, np.uint64), np.zeros((0, DIMENSIONS), np.int8)
    at = np.searchsorted(have, keys)
    known = at < len(have)
    known[known] = have[at[known]] == keys[known]
    if not known.all():
        merged = np.concatenate([have, keys[~known]])
        order = np.argsort(merged, kind="stable")
        have = merged[order]
        vectors = np.concatenate([vectors, trigram_vectors(keys[~known])])[order]
        at = np.searchsorted(have, keys)
    _worker["keys"], _worker["vectors"] = have, vectors
    return vectors[at]


def _profiles_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Profiles (one row per text) and whether the text has a letter."""
    padded = [f" {t.lower()} " for t in texts]
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in padded])
    letter = _letters()[codes]
    has = np.bincount(owner[letter], minlength=len(texts)) > 0
    before = np.zeros(len(codes), bool)
    before[1:] = letter[:-1]
    # The space in front of a text, and the first of each run of other characters.
    first = np.zeros(len(codes), bool)
    first[np.searchsorted(owner, np.arange(len(texts)))] = True
    keep = letter | before | first
    codes, owner = np.where(letter, codes, _SPACE)[keep], owner[keep]
    whole = owner[:-2] == owner[2:] if len(owner) > 2 else np.zeros(0, bool)
    rows = owner[:-2][whole] if len(owner) > 2 else np.zeros(0, np.int64)
    if not len(rows):
        return np.zeros((len(texts), DIMENSIONS), np.float32), has
    seen = np.zeros(0x110000, bool)
    seen[codes] = True
    alphabet = np.flatnonzero(seen)
    n = len(alphabet)
    dense = np.zeros(0x110000, np.int64)
    dense[alphabet] = np.arange(n)
    ids = dense[codes]
    grams = ((ids[:-2] * n + ids[1:-1]) * n + ids[2:])[whole]
    if n**3 <= 1 << 23:
        used = np.flatnonzero(np.bincount(grams, minlength=1))
        place = np.zeros(int(used[-1]) + 1, np.int64)
        place[used] = np.arange(len(used))
        place = place[grams]
    else:
        used, place = np.unique(grams, return_inverse=True)
    a, b, c = alphabet[used // n // n], alphabet[used // n % n], alphabet[used % n]
    keys = (a.astype(np.uint64) << np.uint64(42)) | (b.astype(np.uint64) << np.uint64(21)) | c.astype(np.uint64)
    counts = np.bincount(rows * len(used) + place, minlength=len(texts) * len(used))
    counts = counts.reshape(len(texts), len(used)).astype(np.float32)
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    for part in range(0, len(used), MAX_CACHED // 2):
        vectors = _cached_vectors(keys[part : part + MAX_CACHED // 2]).astype(np.float32)
        out += counts[:, part : part + MAX_CACHED // 2] @ vectors
    return out, has


def profiles(texts: list[str | None]):
    """``(first, end, profiles, has a letter)`` for runs of texts of bounded size."""
    first, size, run = 0, 0, []
    for i, text in enumerate(texts):
        run.append(text or "")
        size += len(run[-1])
        if size >= CHUNK_CHARS or len(run) == 512 or i + 1 == len(texts):
            yield first, i + 1, *_profiles_of(run)
            first, size, run = i + 1, 0, []


def _unit(vectors: np.ndarray) -> np.ndarray:
    length = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1, keepdims=True))
    return vectors / np.maximum(length, 1e-12)


@dataclass
class Prototypes:
    """Learned languages in order of name, and one unit profile each."""

    names: list[str]
    units: np.ndarray

    @property
    def mean(self) -> np.ndarray:
        return self.units.mean(axis=0) if len(self.names) > 1 else np.zeros(self.units.shape[1])

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        if not self.names:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        common = self.mean
        targets = _unit(self.units - common)
        for _, _, vectors, has in profiles(texts):
            likeness = _unit(_unit(vectors) - common) @ targets.T
            best = likeness.argmax(axis=1)
            for i, ok in enumerate(has.tolist()):
                names.append(self.names[best[i]] if ok else UNKNOWN)
                scores.append(float(min(1.0, max(0.0, likeness[i, best[i]]))) if ok else 0.0)
        return names, scores


def _first_copies(batches):
    """Rows of a task without the copies of texts that it has passed on before."""
    seen: set[tuple[str, int]] = set()
    for batch in batches:
        keep = []
        for i, key in enumerate(zip(column(batch, "lang").to_pylist(), column(batch, "hash").to_pylist(), strict=True)):
            if key not in seen:
                seen.add(key)
                keep.append(i)
        yield batch.take(pa.array(keep, pa.int64()))
        if len(seen) > MAX_SEEN:
            seen.clear()


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", per_language: int = FIT_PER_LANGUAGE) -> Prototypes:
    """Prototypes from labelled texts, at most about ``per_language`` different ones of each language.

    Different texts are counted first, by hash; texts are then chosen by that hash at the
    rate of the language's count, and learned once each. A language of ``per_language``
    different texts or fewer is learned from all of them, however many rows repeat them.
    Copies are dropped in the task that reads them, so a text moves once per task at most.
    Profiles are added up on the executors; only one vector per language reaches the driver.
    """
    rows = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).filter("lang IS NOT NULL AND text IS NOT NULL")
    rows = rows.withColumn("hash", F.xxhash64("text"))
    # Written, so that the planner knows its size: one row per language, and texts stay where they are.
    counts = stage(rows.select("lang", "hash").distinct().groupBy("lang").count(), "languages")
    rate = F.least(F.lit(1.0), F.lit(float(per_language)) / F.col("count"))
    chosen = rows.join(counts.select(F.col("lang").alias("l"), rate.alias("rate")), F.col("lang") == F.col("l"))
    chosen = chosen.filter((F.pmod(F.col("hash"), F.lit(1_000_000)) / 1e6) < F.col("rate")).select("lang", "text", "hash")
    chosen = chosen.mapInArrow(_first_copies, chosen.schema).dropDuplicates(["lang", "hash"])

    def sums(batches):
        for batch in batches:
            languages = np.array(column(batch, "lang").to_pylist(), object)
            total: dict[str, np.ndarray] = {}
            for first, end, vectors, has in profiles(column(batch, "text").to_pylist()):
                units = _unit(vectors) * has[:, None]
                for name in set(languages[first:end]):
                    total[name] = total.get(name, 0) + units[languages[first:end] == name].sum(axis=0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string()), pa.array([v.astype(np.float64).tobytes() for v in total.values()], pa.binary())],
                ["lang", "profile"],
            )

    def added(key, table):
        total = sum(np.frombuffer(v, np.float64) for v in table.column("profile").to_pylist())
        return pa.table({"lang": table.column("lang").slice(0, 1), "profile": pa.array([total.tobytes()], pa.binary())})

    schema = "lang string, profile binary"
    parts = chosen.select("lang", "text").mapInArrow(sums, schema).groupBy("lang").applyInArrow(added, schema)
    learned = sorted((r["lang"], np.frombuffer(bytes(r["profile"]), np.float64)) for r in parts.collect())
    learned = [(name, vector) for name, vector in learned if vector.any()]
    vectors = np.array([vector for _, vector in learned]).reshape(len(learned), DIMENSIONS)
    return Prototypes([name for name, _ in learned], _unit(vectors))


def with_language(
    docs: DataFrame, prototypes: Prototypes, text: str = "text", drop: tuple[str, ...] = (), names: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """``docs`` and the predicted language with its score; rows are only mapped over."""
    shared = docs.sparkSession.sparkContext.broadcast(prototypes)
    fields = [T.StructField(free_name(docs, names[0]), T.StringType()), T.StructField(free_name(docs, names[1]), T.DoubleType())]

    def work(batch):
        found, scores = shared.value.predict(column(batch, text).to_pylist())
        return [pa.array(found, pa.string()), pa.array(scores, pa.float64())]

    return add_columns(docs, fields, work, drop)


def fold_of(doc_id: Column, folds: int) -> Column:
    """The fold of a document: crc32 of its id as text, modulo ``folds``; a null id counts as empty."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))
