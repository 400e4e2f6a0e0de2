"""Toxicity from a weighted lexicon matched by Aho-Corasick.

Texts are folded first: lower case, look-alike letters of other scripts, styled letters and
digits or signs that stand for letters inside a word become plain letters; an accent is part
of its letter. The
lexicon is learned from labelled texts: words, and beginnings of words, that are far more
frequent among toxic texts, weighted by the logarithm of the odds. One automaton finds them
and the exception phrases (a matched word, alone or with the word before or after it, that
is frequent in clean texts alone) in a single pass; a match counts if it starts a word
outside every exception, the whole word before its longest beginning. The counted weights,
whole and per hundred words of the text, go into a logistic curve, fitted to the same labels.

Defined results: null, empty and wordless texts have no match and get the score of such
texts; where nothing could be learned every score is the share of toxic labels (0 without
labels); conflicting labels of one id count as toxic, null labels not at all; repeated rows
repeat their result; other columns are kept whatever their names.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.arrow import add_columns, column, free_name
from corpusloom.session import stage

#: Labelled texts that the lexicon and the curve are fitted on, chosen by a hash of the id.
FIT_ROWS = 40_000
MAX_WORDS = 5_000  # of the lexicon: the heaviest
MIN_TOXIC = 5  # toxic texts that must hold a word
MIN_ODDS = 2.0  # least logarithm of the odds ratio
MIN_SIGNIFICANCE = 4.0  # in standard errors
STEMS = range(4, 11)  # letters of a beginning of a word
STEM_ODDS = 3.0  # of a beginning
MIN_CLEAN = 8  # clean texts that an exception must occur in, for each toxic one

# Letters of other scripts that look like Latin ones, as published in tables
# of confusable characters.
LOOK_ALIKES = {
    "а": "a", "в": "b", "е": "e", "ѕ": "s", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o",
    "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l", "һ": "h",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "γ": "y", "ɡ": "g", "ı": "i", "ɩ": "i", "ո": "n", "ս": "u", "օ": "o", "ց": "g",
}
# Digits and signs that stand for letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "i"}

_IN_WORD = re.compile(r"(?<=[^\W_])[@$!|]+(?=[^\W_])|(?<![\w@$!|])[@$](?=[^\W_])")
_WORD = re.compile(r"[^\W\d_]+")


class _Folding(dict):
    """A translation table that fills itself, one entry per character met."""

    def __missing__(self, code: int):
        char = chr(code)
        plain = unicodedata.normalize("NFKC", char).lower()  # full-width and styled letters
        plain = LOOK_ALIKES.get(plain, plain)
        if code < 128:
            plain = SUBSTITUTES[char] if char.isdigit() and char in SUBSTITUTES else plain
        # One character each, so that places in folded and raw text agree; l and i are one.
        plain = plain[0] if len(plain) == 1 else char.lower()[:1]
        self[code] = "i" if plain == "l" else plain
        return self[code]


_FOLDING = _Folding()
_ASCII = bytes(ord(_FOLDING[c]) if c < 128 else c for c in range(256))
_HAS_SIGN = re.compile(r"[@$!|]")


def folded(text: str) -> str:
    """Plain lower-case letters for look-alikes and substitutes; ``l`` becomes ``i`` as ``1`` may be either."""
    if _HAS_SIGN.search(text):
        text = _IN_WORD.sub(lambda m: "".join(SUBSTITUTES[c] for c in m[0]), text)
    if text.isascii():
        return text.encode().translate(_ASCII).decode()
    return text.translate(_FOLDING)


@dataclass
class Model:
    """Lexicon weights, exception phrases and the logistic curve over three features."""

    lexicon: dict[str, float] = field(default_factory=dict)
    exceptions: frozenset[str] = frozenset()
    curve: tuple[float, ...] = (-50.0, 0.0, 0.0, 0.0)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_automaton"}

    @property
    def automaton(self):
        if "_automaton" not in self.__dict__:
            entries: dict[str, list] = {}
            for word, weight in self.lexicon.items():
                stem = word.rstrip("*")
                entries.setdefault(stem, [len(stem), None, None, False])[1 if stem == word else 2] = weight
            for phrase in self.exceptions:
                entries.setdefault(phrase, [len(phrase), None, None, False])[3] = True
            made = ahocorasick.Automaton()
            for stem, entry in entries.items():
                made.add_word(stem, tuple(entry))
            made.make_automaton()
            self.__dict__["_automaton"] = made
        return self.__dict__["_automaton"]

    def matches(self, plain: str) -> list[tuple[int, int, float]]:
        """``(begin, end, weight)`` of the words that count, in folded text."""
        if not self.lexicon:
            return []
        hits: dict[int, tuple[int, float]] = {}
        excepted = []
        for last, (size, whole, beginning, exception) in self.automaton.iter(plain):
            begin, end = last + 1 - size, last + 1
            if begin and plain[begin - 1].isalpha():
                continue
            at_end = end == len(plain) or not plain[end].isalpha()
            if exception and at_end:
                excepted.append((begin, end))
            # Later hits at the same begin are longer, and a whole word is the longest.
            if at_end and whole is not None:
                hits[begin] = (end, whole)
            elif beginning is not None:
                hits[begin] = (end, beginning)
        return [(b, e, w) for b, (e, w) in hits.items() if not any(lo <= b < hi for lo, hi in excepted)]

    def features(self, text: str | None) -> tuple[float, float, float]:
        """Whether a word matched, the logarithm of the weight, the weight per hundred words."""
        plain = folded(text or "")
        hits = self.matches(plain)
        if not hits:
            return 0.0, 0.0, 0.0
        weight = sum(w for _, _, w in hits)
        words = plain.count(" ") + plain.count("\n") + 1
        return 1.0, math.log1p(weight), math.log1p(100.0 * weight / words)

    def score(self, text: str | None) -> float:
        z = self.curve[0] + sum(a * b for a, b in zip(self.curve[1:], self.features(text), strict=True))
        return 1.0 / (1.0 + math.exp(-max(-50.0, min(50.0, z))))


def _labelled(docs, labels, doc_id, text, label, fit_rows) -> DataFrame:
    """At most about ``fit_rows`` labelled texts, chosen by a hash of the id before any join."""
    marks = labels.select(F.col(doc_id).alias("id"), F.col(label).alias("toxic")).filter("id IS NOT NULL AND toxic IS NOT NULL")
    n = marks.count()
    chosen = (F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 1e6) < min(1.0, fit_rows / max(n, 1))
    marks = marks.filter(chosen).groupBy("id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).filter(chosen)
    return stage(texts.join(marks, "id").select("text", "toxic"), "labelled")


def patterns(plain: str) -> list[str]:
    """The words of a folded text, and their beginnings with a star."""
    words = set(_WORD.findall(plain))
    return [*words, *(w[:k] + "*" for w in words for k in STEMS if k < len(w))]


def _counted(rows: DataFrame, patterns_of) -> DataFrame:
    """Toxic and clean texts that hold each pattern."""

    def count(batches):
        for batch in batches:
            total: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for text, toxic in zip(column(batch, "text").to_pylist(), column(batch, "toxic").to_pylist(), strict=True):
                total[toxic].update(set(patterns_of(folded(text or ""))))
            words = list(total[0].keys() | total[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array([total[1][w] for w in words], pa.int64()), pa.array([total[0][w] for w in words], pa.int64())],
                ["word", "toxic", "clean"],
            )

    parts = rows.mapInArrow(count, "word string, toxic bigint, clean bigint")
    return parts.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def learn(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", fit_rows: int = FIT_ROWS
) -> Model:
    """Lexicon, exceptions and curve from the labelled texts (a sample bounded by ``fit_rows``)."""
    rows = _labelled(docs, labels, doc_id, text, label, fit_rows)
    n, n_toxic = rows.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    n_toxic = n_toxic or 0
    if not n_toxic or n_toxic == n:
        return Model(curve=(50.0 if n_toxic else -50.0, 0.0, 0.0, 0.0))
    a, b = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(a / (n_toxic - F.col("toxic") + 0.5)) - F.log(b / (n - n_toxic - F.col("clean") + 0.5))
    words = (
        _counted(rows, patterns)
        .filter(F.col("toxic") >= MIN_TOXIC)
        .withColumn("weight", odds)
        .filter((F.col("weight") >= F.when(F.col("word").endswith("*"), STEM_ODDS).otherwise(MIN_ODDS)) & (F.col("weight") / F.sqrt(1 / a + 1 / b) >= MIN_SIGNIFICANCE))
        .orderBy(F.desc("weight"), "word")
        .limit(MAX_WORDS)
    )
    lexicon = {r["word"]: float(r["weight"]) for r in words.collect()}
    plain_model = Model(lexicon)

    def phrases_of(plain: str) -> list[str]:
        found = []
        for begin, end, _ in plain_model.matches(plain):
            end += len(re.match(r"[^\W\d_]*", plain[end:])[0])
            found.append(plain[begin:end])
            before, after = re.search(r"[^\W\d_]+ $", plain[max(0, begin - 40) : begin]), re.match(r" [^\W\d_]+", plain[end : end + 40])
            found += [before[0] + plain[begin:end]] if before else []
            found += [plain[begin:end] + after[0]] if after else []
        return found

    phrases = _counted(rows, phrases_of).filter(F.col("clean") >= MIN_CLEAN * (F.col("toxic") + 1))
    exceptions = frozenset(r["word"] for r in phrases.orderBy(F.desc("clean"), "word").limit(MAX_WORDS).collect())
    model = Model(lexicon, exceptions)

    def measured(batches):
        for batch in batches:
            made = [model.features(t) for t in column(batch, "text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([m[i] for m in made], pa.float64()) for i in range(3)] + [column(batch, "toxic")], ["a", "b", "c", "toxic"]
            )

    table = rows.mapInArrow(measured, "a double, b double, c double, toxic int").toArrow().to_pandas()  # FIT_ROWS rows
    model.curve = tuple(_fit(table[["a", "b", "c"]].to_numpy(), table["toxic"].to_numpy()))
    return model


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> list[float]:
    """Logistic regression by Newton's method."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)
    keep[0] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + np.diag(keep), x.T @ (y - p) - keep * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w.tolist()


def with_toxicity(docs: DataFrame, model: Model, text: str = "text", drop: tuple[str, ...] = (), name: str = "score") -> DataFrame:
    """``docs`` and the score; rows are only mapped over."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch):
        scorer = shared.value
        return [pa.array([scorer.score(t) for t in column(batch, text).to_pylist()], pa.float64())]

    return add_columns(docs, [T.StructField(free_name(docs, name), T.DoubleType())], work, drop)


def kept(docs: DataFrame, model: Model, threshold: float = 0.5, text: str = "text") -> DataFrame:
    """The documents below the threshold, with their own columns."""
    name = free_name(docs, "score")
    return with_toxicity(docs, model, text).filter(F.col(name) < threshold).select(*docs.columns)
