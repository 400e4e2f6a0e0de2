"""Instruction rows to encoded examples, split, tensors and batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.batches import batches, shard
from corpusloom.operators.chat import encode_chat
from corpusloom.operators.examples import to_tensors
from corpusloom.operators.prepare import messages, to_chat, to_chat_by_source
from corpusloom.operators.shuffle import CHAT_VAL_FRACTION, SHUFFLE_SEED, split_examples
from corpusloom.operators.vocabulary import Vocabulary
from corpusloom.session import stage

Encoder = Callable[[DataFrame], DataFrame]


def encoded_examples(
    rows: DataFrame,
    style: str | None,
    vocab: Vocabulary,
    encode: Encoder,
    keys: list[str],
    seq_length: int,
    source: str | None = None,
) -> DataFrame:
    """Complete, short enough examples ``keys, token_ids, loss_mask``.

    ``style`` names the layout, or ``source`` the column of dataset names that tells it.
    Incomplete rows go before the texts are encoded.
    """
    sides = to_chat_by_source(rows, source, keys) if source else to_chat(rows, style or "generic", keys)
    turns = encode(messages(sides, keys)).select(*keys, "turn", "role", "token_ids")
    return encode_chat(turns, vocab, keys, seq_length)


def split_tensors(
    examples: DataFrame,
    keys: list[str],
    seq_length: int,
    fraction: float = CHAT_VAL_FRACTION,
    seed: int = SHUFFLE_SEED,
    path: str | None = None,
) -> DataFrame:
    """Examples with their split and their ``x, y``."""
    stored = stage(examples, "examples", path)
    labelled = split_examples(stored, keys, fraction, seed).drop("order_key", "bucket")
    return to_tensors(labelled, seq_length)


def batched(tensors: DataFrame, keys: list[str], batch_size: int, world_size: int = 1, seed: int = 42) -> DataFrame:
    """``x, y`` with their epoch-0 rank, batch and slot."""
    dealt = batches(shard(tensors.select(*keys), keys, world_size, seed), batch_size)
    return dealt.join(tensors.select(*keys, "x", "y"), keys).filter(F.col("epoch") == 0)
