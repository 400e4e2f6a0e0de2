"""Chat encoding: turns to ids and loss masks, prompts, history, replies.

Turns live in long form ``(conv_id, turn, role, token_ids)``. Everything that depends on
the whole conversation (total length, history budget) is worked out on per-turn token
counts first, so that only conversations or turns of bounded length are ever collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.arrays import cut_before, in_order, ints
from corpusloom.functions.text import strip
from corpusloom.operators.ordered import running
from corpusloom.operators.prepare import LENGTH_FACTOR
from corpusloom.operators.vocabulary import Vocabulary

ROLES = ("system", "user", "assistant")
LEARNED_ROLE = "assistant"
TURN_BLOCK = 1024


def role_id(role: Column, vocab: Vocabulary) -> Column:
    """Id of a role's token; an unknown role is an error that names it."""
    unknown = F.concat(F.lit("unknown role: "), F.coalesce(role, F.lit("null")))
    choice = F.raise_error(unknown).cast("int")
    for name in ROLES:
        choice = F.when(role == name, vocab.special(name)).otherwise(choice)
    return choice


def framed(vocab: Vocabulary, role: str = "role", ids: str = "token_ids") -> Column:
    """Role token, content, end-of-turn token."""
    content = F.coalesce(F.col(ids), ints(F.array()))
    return ints(
        F.concat(F.array(role_id(F.col(role), vocab)), content, F.array(F.lit(vocab.special("end_turn"))))
    )


def frame_mask(role: str = "role", ids: str = "token_ids") -> Column:
    """1 on an assistant's content and end-of-turn token, 0 elsewhere."""
    learn = F.when(F.col(role) == LEARNED_ROLE, 1).otherwise(0)
    n = F.coalesce(F.size(ids), F.lit(0))
    return ints(F.concat(F.array(F.lit(0)), F.array_repeat(learn, F.greatest(n, F.lit(0)) + 1)))


def encode_turns(turns: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Each turn framed, with its mask. Row-wise."""
    return turns.withColumn("loss_mask", frame_mask()).withColumn("token_ids", framed(vocab))


def encode_chat(
    turns: DataFrame, vocab: Vocabulary, keys: list[str], seq_length: int | None
) -> DataFrame:
    """One example per conversation: ids, mask, and end of text once at the end.

    With a sequence length, conversations over twice that are dropped (the preparation
    rule), and dropped by their summed length before anything is collected.
    """
    coded = encode_turns(turns, vocab)
    if seq_length is not None:
        lengths = coded.groupBy(*keys).agg((F.sum(F.size("token_ids")) + 1).alias("_length"))
        fitting = lengths.filter(F.col("_length") <= LENGTH_FACTOR * seq_length).select(*keys)
        coded = coded.join(fitting, keys, "left_semi")
    part = F.collect_list(F.struct("turn", "token_ids", "loss_mask"))
    whole = coded.groupBy(*keys).agg(part.alias("_turns"))
    return whole.select(
        *keys,
        F.array_append(in_order(F.col("_turns"), "token_ids"), F.lit(vocab.eos_id)).alias("token_ids"),
        F.array_append(in_order(F.col("_turns"), "loss_mask"), F.lit(0)).alias("loss_mask"),
    )


def trim_history(
    turns: DataFrame, vocab: Vocabulary, keys: list[str], seq_length: int, max_tokens: int
) -> DataFrame:
    """Keep the newest turns whose prompt fits the budget, and always the newest one.

    The prompt is the framed turns plus the assistant cue. The count runs from the newest
    turn backwards, in blocks, so a conversation of any length spreads over tasks.
    """
    budget = seq_length - max_tokens
    sized = turns.withColumn("_n", F.size(framed(vocab))).withColumn("_back", -F.col("turn"))
    measured = running(
        sized,
        keys,
        "_back",
        {"_used": ("sum", F.col("_n")), "_rank": ("count", F.lit(1))},
        TURN_BLOCK,
    )
    kept = measured.filter((F.col("_used") + 1 <= budget) | (F.col("_rank") == 1))
    return kept.drop("_n", "_back", "_used", "_rank")


def chat_prompt(turns: DataFrame, vocab: Vocabulary, keys: list[str]) -> DataFrame:
    """Framed turns in order, then the assistant token that cues the reply."""
    framed_turns = turns.select(*keys, "turn", framed(vocab).alias("token_ids"))
    whole = framed_turns.groupBy(*keys).agg(F.collect_list(F.struct("turn", "token_ids")).alias("_turns"))
    cue = F.lit(vocab.special(LEARNED_ROLE))
    return whole.select(*keys, F.array_append(in_order(F.col("_turns"), "token_ids"), cue).alias("token_ids"))


def cut_reply(ids: Column, vocab: Vocabulary) -> Column:
    """New tokens up to the first end of turn, then up to the first end of text."""
    return cut_before(cut_before(ids, vocab.special("end_turn")), vocab.eos_id)


def append_replies(turns: DataFrame, replies: DataFrame, keys: list[str]) -> DataFrame:
    """Add each conversation's reply ``(keys, text)`` as its next assistant turn."""
    following = turns.groupBy(*keys).agg((F.max("turn") + 1).alias("turn"))
    added = following.join(replies, keys).select(
        *keys, "turn", F.lit(LEARNED_ROLE).alias("role"), F.col("text")
    )
    return turns.select(*keys, "turn", "role", "text").unionByName(added)


def drop_blank(turns: DataFrame, text: str = "text") -> DataFrame:
    """Strip each message and skip those with nothing left."""
    stripped = turns.withColumn(text, strip(F.col(text)))
    return stripped.filter(F.coalesce(F.col(text), F.lit("")) != "")
