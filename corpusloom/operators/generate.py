"""Autoregressive generation for many sequences at once.

A model goes to the tasks as arrays, or as a file if its counts exceed a stated bound: sequences
are written to their full length in one pass over the prompts, without a shuffle
(``operators/drawing``). One too large even for the executors' disks, or a rule of one's own, is
joined by context, one Spark job and one written table per token. All draw the same tokens.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.arrays import ints
from corpusloom.functions.keys import uniform
from corpusloom.functions.text import strip
from corpusloom.operators.chat import append_replies, chat_prompt, cut_reply, drop_blank, trim_history
from corpusloom.operators.decoding import (
    EVAL_TOKENS,
    REPLY_TEMPERATURE,
    REPLY_TOKENS,
    REPLY_TOP_K,
    REPLY_TOP_P,
    SAMPLE_TEMPERATURE,
    SAMPLE_TOKENS,
    SAMPLE_TOP_K,
    cumulative,
)
from corpusloom.operators.drawing import FILE_ROWS, MODEL_ROWS, Rule, drawn_in_one_pass
from corpusloom.operators.language_model import START, NgramModel, candidates
from corpusloom.operators.tokenize import detokenize
from corpusloom.operators.vocabulary import Vocabulary
from corpusloom.session import stage

CONTEXT = ["w1", "w2"]
Chooser = Callable[[DataFrame, list[str]], DataFrame]


def last_token(ids, back: int):
    return F.coalesce(F.get(ids, F.size(ids) - back), F.lit(START))


def _choices(model: NgramModel, state: DataFrame, choose: Chooser, k: int) -> DataFrame:
    """Per distinct context: its kept tokens with cumulative probability, likeliest first."""
    offered = candidates(model, state.select(*CONTEXT).distinct(), k)
    kept = cumulative(choose(offered, CONTEXT), CONTEXT)
    return kept.groupBy(*CONTEXT).agg(
        F.sort_array(F.collect_list(F.struct("cum", "token_id"))).alias("_kept")
    )


def generate(
    prompts: DataFrame,
    model: NgramModel,
    key: str,
    n_tokens: int,
    choose: Chooser,
    k: int,
    seed: int = 0,
    ids: str = "token_ids",
    stops: tuple[int, ...] = (),
    model_rows: int = MODEL_ROWS,
    file_rows: int = FILE_ROWS,
) -> DataFrame:
    """Prompt plus ``n_tokens`` new ones: ``key, token_ids, new_ids``.

    A sequence that draws one of ``stops`` ends there. The draw hashes (seed, key, step); it does
    not depend on partitioning, retries, or on whether the model fits ``model_rows`` or ``file_rows``.
    """
    model = model.stored()
    prompts = stage(prompts.select(key, ids), "prompts")
    state = prompts.select(
        key,
        last_token(F.col(ids), 2).alias("w1"),
        last_token(F.col(ids), 1).alias("w2"),
        ints(F.array()).alias("new_ids"),
    )
    made = drawn_in_one_pass(state, model, key, n_tokens, choose, seed, stops, model_rows, file_rows) if isinstance(choose, Rule) else None
    if made is None:
        made = _drawn_step_by_step(state, model, key, n_tokens, choose, k, seed, stops)
    made = stage(made, "generated")
    return prompts.join(made, key).select(key, F.concat(ids, "new_ids").alias("token_ids"), "new_ids")


def _drawn_step_by_step(
    state: DataFrame, model: NgramModel, key: str, n_tokens: int, choose: Chooser, k: int, seed: int, stops: tuple[int, ...]
) -> DataFrame:
    """Each step scores every distinct context once, draws per sequence, and writes the small
    state (key, last two tokens, new tokens) as a table, so no lineage builds up.
    """
    ended = F.coalesce(F.element_at("new_ids", -1).isin(*stops), F.lit(False)) if stops else F.lit(False)
    for step in range(n_tokens):
        state = stage(state, "generated")
        over = F.when(F.size("new_ids") > 0, ended).otherwise(F.lit(False))
        going = state.filter(~over)
        if stops and going.isEmpty():
            break
        u = uniform(seed, F.col(key), step) * F.element_at("_kept", -1)["cum"]
        passing = F.filter("_kept", lambda c: c["cum"] > F.col("_u"))
        drawn = F.coalesce(F.get(passing, F.lit(0))["token_id"], F.element_at("_kept", -1)["token_id"])
        grown = (
            going.join(_choices(model, going, choose, k), CONTEXT)
            .withColumn("_u", u)
            .withColumn("_next", drawn)
            .select(key, F.col("w2").alias("w1"), F.col("_next").alias("w2"), F.array_append("new_ids", F.col("_next")).alias("new_ids"))
        )
        state = grown.unionByName(state.filter(over)) if stops else grown
    return state.select(key, "new_ids")


def nucleus_chooser(t: float = REPLY_TEMPERATURE, k: int = REPLY_TOP_K, p: float = REPLY_TOP_P) -> Rule:
    return Rule(t, k, p)


def sample_chooser(t: float = SAMPLE_TEMPERATURE, k: int = SAMPLE_TOP_K) -> Rule:
    return Rule(t, k)


def completions(
    prompts: DataFrame,
    model: NgramModel,
    vocab: Vocabulary,
    encode: Callable[[DataFrame], DataFrame],
    key: str = "prompt_id",
    n_tokens: int = EVAL_TOKENS,
    seed: int = 0,
) -> DataFrame:
    """(prompt, completion) pairs; the completion repeats the prompt in front.

    ``encode`` adds ``token_ids`` to the prompt table.
    """
    made = generate(encode(prompts), model, key, n_tokens, nucleus_chooser(), REPLY_TOP_K, seed)
    texts = detokenize(made, vocab, [key], "token_ids", "completion")
    return prompts.select(key, "prompt").join(texts, key)


def training_samples(
    prompts: DataFrame,
    model: NgramModel,
    vocab: Vocabulary,
    encode: Callable[[DataFrame], DataFrame],
    key: str = "prompt_id",
    n_tokens: int = SAMPLE_TOKENS,
    seed: int = 0,
) -> DataFrame:
    """The samples of an evaluation while training: softmax first, exact top 40."""
    made = generate(encode(prompts), model, key, n_tokens, sample_chooser(), SAMPLE_TOP_K, seed)
    texts = detokenize(made, vocab, [key], "token_ids", "completion")
    return prompts.select(key, "prompt").join(texts, key)


def chat_replies(
    turns: DataFrame,
    model: NgramModel,
    vocab: Vocabulary,
    encode: Callable[[DataFrame], DataFrame],
    seq_length: int,
    key: str = "conv_id",
    max_tokens: int = REPLY_TOKENS,
    seed: int = 0,
) -> DataFrame:
    """One reply per conversation: ``key, reply``.

    Blank messages are skipped, old turns trimmed, new tokens cut at the stop tokens.
    ``encode`` adds ``token_ids`` to the turn table.
    """
    spoken = stage(encode(drop_blank(turns)), "turns")
    prompts = chat_prompt(trim_history(spoken, vocab, [key], seq_length, max_tokens), vocab, [key])
    stops = (vocab.special("end_turn"), vocab.eos_id)
    made = generate(prompts, model, key, max_tokens, nucleus_chooser(), REPLY_TOP_K, seed, stops=stops)
    cut = made.select(key, cut_reply(F.col("new_ids"), vocab).alias("token_ids"))
    texts = detokenize(cut, vocab, [key], "token_ids", "reply")
    return texts.withColumn("reply", strip(F.coalesce("reply", F.lit(""))))


def continued(turns: DataFrame, replies: DataFrame, key: str = "conv_id") -> DataFrame:
    """The conversations with their replies as the next turns."""
    return append_replies(turns, replies.select(key, F.col("reply").alias("text")), [key])
