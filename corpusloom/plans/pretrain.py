"""Corpus to token stream, and stream to model and evaluation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.measures import EVALUATION_CAP, perplexity
from corpusloom.operators.batches import first_batches
from corpusloom.operators.language_model import NgramModel, batch_scores
from corpusloom.operators.metrics import overall_loss, stage_counters
from corpusloom.operators.shuffle import CORPUS_VAL_FRACTION, SHUFFLE_SEED, split_corpus
from corpusloom.operators.stream import CHUNK_TOKENS, consecutive_windows, lay_out_stream, sample_windows
from corpusloom.session import stage

Encoder = Callable[[DataFrame], DataFrame]

EVALUATION_BATCH = 8  # fixed values: batch size and batch cap of an evaluation
EVALUATION_BATCHES = 100


def tokenized_corpus(
    corpus: DataFrame,
    encode: Encoder,
    fraction: float = CORPUS_VAL_FRACTION,
    seed: int = SHUFFLE_SEED,
    path: str | None = None,
) -> DataFrame:
    """Encode once, label train / val, and store; what follows reads the stored table."""
    coded = encode(corpus.select("doc_id", "text")).select(
        "doc_id", "token_ids", F.size("token_ids").cast("bigint").alias("n_tokens")
    )
    return stage(split_corpus(coded, ["doc_id"], fraction, seed, corpus.select("doc_id")), "tokens", path)


def token_stream(tokens: DataFrame, chunk: int = CHUNK_TOKENS, path: str | None = None) -> DataFrame:
    return stage(lay_out_stream(tokens, chunk=chunk), "stream", path)


def split_sizes(tokens: DataFrame) -> DataFrame:
    """Documents and tokens in train and in val."""
    return stage_counters(tokens, ["split"])


def evaluate(
    model: NgramModel,
    examples: DataFrame,
    max_batches: int = EVALUATION_BATCHES,
    cap: float = EVALUATION_CAP,
    met: DataFrame | None = None,
) -> DataFrame:
    """Loss and perplexity over batches: ``examples`` carry ``batch_id, x, y``.

    ``met``: the examples' triples with their counts, shared by models that differ in weight.
    """
    scored = batch_scores(model, first_batches(examples, max_batches), ["batch_id"], met)
    return overall_loss(scored).withColumn("perplexity", perplexity(F.col("loss"), cap))


def evaluation_windows(
    stream: DataFrame, seq_length: int, draws: int, seed: int = 0, chunk: int = CHUNK_TOKENS, split: str = "val"
) -> DataFrame:
    """Windows of the held-out stream, dealt into batches; the short last one is dropped."""
    windows = sample_windows(stream, split, seq_length, draws, seed, chunk=chunk)
    full = draws // EVALUATION_BATCH
    batch = F.floor(F.col("window_id") / EVALUATION_BATCH)
    return windows.withColumn("batch_id", batch).filter(F.col("batch_id") < full)


def whole_split_windows(stream: DataFrame, seq_length: int, split: str = "val") -> DataFrame:
    """Every target of a split once, in windows dealt into batches; the last of either may be short."""
    windows = consecutive_windows(stream, split, seq_length)
    return windows.withColumn("batch_id", F.floor(F.col("window_id") / EVALUATION_BATCH))
