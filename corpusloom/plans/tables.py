"""Inputs of the registered queries, each derived from the given tables by Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.stream import lay_out_stream
from corpusloom.operators.tokenize import tokenize_by_lookup
from corpusloom.operators.vocabulary import Vocabulary, extend, piece_vocabulary
from corpusloom.plans.pretrain import tokenized_corpus
from corpusloom.session import spread, stage

VOCAB_SIZE = 4096
LEARNED_MERGES = 1000
CHUNK = 4096
SEQ_LENGTH = 512
WORLD_SIZE = 3
BATCH = 4
LM_TOP = 50


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents"))


def conversations(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "conversations")


def vocabulary(spark: SparkSession, folder: str) -> Vocabulary:
    """Counted from the documents, then written: several joins read it."""
    counted = piece_vocabulary(documents(spark, folder), VOCAB_SIZE)
    return Vocabulary(stage(counted.table, "vocab"), counted.size, counted.eos_id, counted.pattern, counted.specials)


def chat_vocabulary(spark: SparkSession, folder: str) -> Vocabulary:
    return extend(vocabulary(spark, folder))


def coded_documents(spark: SparkSession, folder: str) -> DataFrame:
    vocab = piece_vocabulary(documents(spark, folder), VOCAB_SIZE)
    return tokenize_by_lookup(documents(spark, folder), vocab, ["doc_id"])


def split_documents(spark: SparkSession, folder: str, counted: Vocabulary | None = None) -> DataFrame:
    """``counted``: the vocabulary of :func:`vocabulary`, if it is at hand."""
    vocab = counted or piece_vocabulary(documents(spark, folder), VOCAB_SIZE)
    encode = lambda df: tokenize_by_lookup(df, vocab, ["doc_id"])
    return tokenized_corpus(documents(spark, folder), encode)


def stream(spark: SparkSession, folder: str, counted: Vocabulary | None = None) -> DataFrame:
    return stage(lay_out_stream(split_documents(spark, folder, counted), chunk=CHUNK), "stream")


def coded_turns(spark: SparkSession, folder: str, vocab: Vocabulary) -> DataFrame:
    return tokenize_by_lookup(conversations(spark, folder), vocab, ["conv_id", "turn", "role"])


def pairs(spark: SparkSession, folder: str) -> DataFrame:
    """User turns with the assistant turn after them and the conversation's system turn.

    A user turn without an answer has a null response, a conversation without a system
    turn a null context.
    """
    asks = F.col("role") == "user"
    turns = conversations(spark, folder)
    # A question and the answer a turn later meet on the question's turn.
    paired = (
        turns.filter("role IN ('user', 'assistant')")
        .select(
            "conv_id",
            F.when(asks, F.col("turn")).otherwise(F.col("turn") - 1).alias("turn"),
            F.when(asks, F.col("text")).alias("instruction"),
            F.when(~asks, F.col("text")).alias("response"),
            asks.alias("asked"),
        )
        .groupBy("conv_id", "turn")
        .agg(F.max("instruction").alias("instruction"), F.max("response").alias("response"), F.max("asked").alias("asked"))
    )
    systems = turns.filter("role = 'system' AND turn = 0").select("conv_id", F.col("text").alias("context"))
    return paired.filter("asked").drop("asked").join(systems, "conv_id", "left")


def steps(spark: SparkSession, folder: str) -> DataFrame:
    """Events as logged steps: one run per event type, the event id as step."""
    return table(spark, folder, "events").select(
        F.col("event_type").alias("run"),
        F.col("event_id").alias("step"),
        (F.col("value") / 10).alias("loss"),
        ((F.col("user_id") % 50 + 1) / 100).alias("dt"),
        (F.col("user_id") % WORLD_SIZE).cast("int").alias("rank"),
        F.floor(F.col("event_id") / 8).alias("batch_id"),
    )


def turn_logits(spark: SparkSession, folder: str, vocab: Vocabulary) -> DataFrame:
    """``(conv_id, turn, token_id, logit)``: log of how often a token occurs in the turn."""
    tokens = coded_turns(spark, folder, vocab).select("conv_id", "turn", F.explode("token_ids").alias("token_id"))
    counted = tokens.groupBy("conv_id", "turn", "token_id").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("conv_id", "turn", "token_id", F.log(F.col("n").cast("double")).alias("logit"))


def turn_targets(spark: SparkSession, folder: str, vocab: Vocabulary) -> DataFrame:
    """The smallest id of an assistant turn as its target; other turns are ignored."""
    smallest = F.array_min("token_ids")
    return coded_turns(spark, folder, vocab).select(
        "conv_id", "turn", F.when(F.col("role") == "assistant", smallest).otherwise(F.lit(-1)).alias("y")
    )


def conversation_logits(spark: SparkSession, folder: str, vocab: Vocabulary) -> DataFrame:
    """``(conv_id, token_id, logit)`` from the token counts of whole conversations."""
    tokens = coded_turns(spark, folder, vocab).select("conv_id", F.explode("token_ids").alias("token_id"))
    counted = tokens.groupBy("conv_id", "token_id").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("conv_id", "token_id", F.log(F.col("n").cast("double")).alias("logit"))


def written(ids: str | Column) -> Column:
    """Ids as one comma-separated string, which compares the same in every engine."""
    column = F.col(ids) if isinstance(ids, str) else ids
    return F.array_join(column.cast("array<string>"), ",")


def rounded(name: str, digits: int = 6) -> Column:
    return F.round(F.col(name), digits).alias(name)
