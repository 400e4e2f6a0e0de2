"""The registered queries: each runs an operator over the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.arrays import without_first, without_last
from corpusloom.functions.measures import EVALUATION_CAP, elapsed_seconds, elapsed_text, perplexity
from corpusloom.functions.text import WORD_SPLIT, pieces, strip
from corpusloom.operators import batches as bt
from corpusloom.operators import bpe
from corpusloom.operators import chat as ch
from corpusloom.operators import decoding as dc
from corpusloom.operators import examples as ex
from corpusloom.operators import generate as gn
from corpusloom.operators import language_model as lm
from corpusloom.operators import metrics as mt
from corpusloom.operators import prepare as pr
from corpusloom.operators import runs as rn
from corpusloom.operators import shuffle as sh
from corpusloom.operators import stream as st
from corpusloom.operators import tokenize as tk
from corpusloom.operators import versions as vs
from corpusloom.operators import vocabulary as vc
from corpusloom.plans import finetune, pretrain
from corpusloom.plans import tables as tb
from corpusloom.plans.tables import BATCH, CHUNK, LEARNED_MERGES, LM_TOP, SEQ_LENGTH, VOCAB_SIZE, WORLD_SIZE, rounded, written
from corpusloom.session import stage, stage_path
from corpusloom.sources import corpus as src
from corpusloom.sources import tables as files
from corpusloom.sources import tokenbin, trainlog
from corpusloom.streaming import rowwise

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- sources ---------------------------------------------------------------------------


@query
def corpus_by_source(spark, folder):
    corpus = src.read_corpus(spark, f"{folder}/documents.parquet", doc_id="doc_id", keep=("source",))
    return corpus.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.char_length("text")).alias("n_chars")
    )


@query
def subset_by_language(spark, folder):
    corpus = src.read_corpus(spark, f"{folder}/documents.parquet", doc_id="doc_id", keep=("lang",))
    chosen = src.select_subset(corpus, ["de", "es", "fr"], "lang")
    return chosen.groupBy("lang").agg(F.count(F.lit(1)).alias("n_docs"))


@query
def materialised_corpus(spark, folder):
    corpus = src.read_corpus(spark, f"{folder}/documents.parquet", doc_id="doc_id")
    root = stage_path(spark, "raw-corpus")
    src.materialise(corpus, root)
    return src.materialise(corpus, root).select("doc_id", F.md5(F.encode("text", "UTF-8")).alias("digest"))


@query
def instruction_files(spark, folder):
    path = stage_path(spark, "instructions")
    rows = tb.pairs(spark, folder)
    rows.select("instruction", "context", "response").write.json(path)
    read = src.read_instructions(spark, path, "dolly")
    return read.groupBy().agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("context").alias("n_context"),
        F.count("response").alias("n_response"),
        F.sum(F.char_length("instruction")).alias("n_chars"),
    )


@query
def prompt_tokens(spark, folder):
    vocab = tb.vocabulary(spark, folder)
    users = tb.conversations(spark, folder).filter("role = 'user'")
    prompts = users.select(F.concat_ws("-", "conv_id", "turn").alias("prompt_id"), F.col("text").alias("prompt"))
    return tk.tokenize_by_lookup(prompts, vocab, ["prompt_id"], "prompt").select(
        "prompt_id", written("token_ids").alias("ids")
    )


# --- tokenisation ----------------------------------------------------------------------


@query
def byte_tokens(spark, folder):
    coded = tk.byte_tokenize(tb.documents(spark, folder))
    return coded.select("doc_id", F.size("token_ids").alias("n_tokens"), written("token_ids").alias("ids"))


@query
def subword_pieces(spark, folder):
    found = pieces(F.col("text"))
    return tb.documents(spark, folder).select(
        "doc_id", F.size(found).alias("n_pieces"), F.array_join(found, "\x01").alias("pieces")
    )


@query
def word_counts(spark, folder):
    return vc.count_pieces(tb.documents(spark, folder), pattern=WORD_SPLIT)


@query
def piece_vocabulary(spark, folder):
    vocab = vc.extend(vc.piece_vocabulary(tb.documents(spark, folder), VOCAB_SIZE))
    return vocab.table.select("token_id", F.hex("token").alias("token"), "is_special")


@query
def document_tokens(spark, folder):
    return tb.coded_documents(spark, folder).select("doc_id", written("token_ids").alias("ids"))


@query
def turn_tokens_with_eos(spark, folder):
    vocab = tb.vocabulary(spark, folder)
    turns = tb.conversations(spark, folder)
    coded = tk.tokenize_by_lookup(turns, vocab, ["conv_id", "turn"], add_eos=True)
    return coded.select("conv_id", "turn", written("token_ids").alias("ids"))


@query
def special_tokens_in_text(spark, folder):
    """Conversations flattened to one text with the control tokens written out, then encoded."""
    vocab = tb.chat_vocabulary(spark, folder)
    turns = tb.conversations(spark, folder).select(
        "conv_id", "turn", F.concat(F.lit("<|"), "role", F.lit("|>"), "text", F.lit(" <|end_turn|>")).alias("text")
    )
    coded = tk.tokenize_by_lookup(turns, vocab, ["conv_id", "turn"])
    return coded.select("conv_id", "turn", written("token_ids").alias("ids"))


@query
def decoded_documents(spark, folder):
    vocab = tb.vocabulary(spark, folder)
    coded = tk.tokenize_by_lookup(tb.documents(spark, folder), vocab, ["doc_id"])
    return tk.detokenize(coded, vocab, ["doc_id"])


@query
def compression_by_language(spark, folder):
    vocab = tb.vocabulary(spark, folder)
    docs = tb.documents(spark, folder).select(
        "doc_id", "lang", "text", F.char_length("text").alias("n_chars"), F.octet_length("text").alias("n_bytes")
    )
    coded = tk.tokenize_by_lookup(docs, vocab, ["doc_id", "lang", "n_chars", "n_bytes"])
    report = tk.compression_report(coded, ["lang"])
    return report.select(
        "lang",
        "n_texts",
        "n_chars",
        "n_bytes",
        "n_tokens",
        *[rounded(c) for c in ("tokens_per_char", "avg_chars", "avg_tokens")],
    )


@query
def learned_merges(spark, folder):
    vocab = bpe.learn_vocabulary(tb.documents(spark, folder), 64)
    return vocab.table.select("token_id", F.hex("token").alias("token"), "is_special")


@query
def learned_vocabulary(spark, folder):
    """A vocabulary of a thousand merges, with what each token stands for."""
    vocab = bpe.learn_vocabulary(tb.documents(spark, folder), LEARNED_MERGES)
    return vocab.table.select("token_id", F.hex("token").alias("token"), "is_special")


@query
def learned_tokens_decoded(spark, folder):
    """Encode with a learned byte-pair vocabulary and decode again: the texts come back."""
    docs = tb.documents(spark, folder)
    vocab = bpe.learn_vocabulary(docs, 64)
    coded = tk.tokenize(docs, vocab).select("doc_id", "token_ids")
    return tk.detokenize(coded, vocab, ["doc_id"])


@query
def byte_pair_tokens(spark, folder):
    """Ids by learned merges, in order of rank."""
    docs = tb.documents(spark, folder)
    coded = tk.tokenize(docs, bpe.learn_vocabulary(docs, 64))
    return coded.select("doc_id", written("token_ids").alias("ids"))


@query
def saved_vocabulary(spark, folder):
    path = stage_path(spark, "vocab-file")
    vc.write_vocab(vc.piece_vocabulary(tb.documents(spark, folder), VOCAB_SIZE), path)
    read = vc.read_vocab(spark, path, "ranks", VOCAB_SIZE)
    return read.table.select("token_id", F.hex("token").alias("token"), "is_special")


# --- shuffle, split, stream ------------------------------------------------------------


@query
def shuffled_documents(spark, folder):
    return sh.shuffled(tb.table(spark, folder, "documents").select("doc_id"), ["doc_id"])


@query
def corpus_split(spark, folder):
    docs = tb.table(spark, folder, "documents")
    return sh.split_corpus(docs, ["doc_id"]).select("doc_id", "split")


@query
def split_token_counts(spark, folder):
    """Documents and byte tokens that land in train and in val."""
    coded = tk.byte_tokenize(tb.table(spark, folder, "documents"))
    return mt.stage_counters(sh.split_corpus(coded, ["doc_id"]), ["split"])


@query
def split_subword_counts(spark, folder):
    return pretrain.split_sizes(tb.split_documents(spark, folder))


@query
def tokens_by_source(spark, folder):
    vocab = tb.vocabulary(spark, folder)
    coded = tk.tokenize_by_lookup(tb.documents(spark, folder), vocab, ["doc_id", "source", "lang"])
    stats = mt.token_statistics(coded, ["source", "lang"])
    return stats.withColumn("avg_tokens", F.round("avg_tokens", 6))


@query
def token_stream(spark, folder):
    laid = st.lay_out_stream(tb.split_documents(spark, folder), chunk=CHUNK)
    return laid.withColumn("tokens", written("tokens"))


@query
def stream_table(spark, folder):
    path = stage_path(spark, "stream-table")
    files.write_stream(tb.stream(spark, folder), path)
    return files.read_stream(spark, path).withColumn("tokens", written("tokens"))


@query
def token_files(spark, folder):
    path = stage_path(spark, "token-files")
    tokenbin.write_token_bin(tb.stream(spark, folder), path, VOCAB_SIZE)
    return tokenbin.read_token_bin(spark, path, CHUNK).withColumn("tokens", written("tokens"))


@query
def stream_lengths(spark, folder):
    return st.stream_length(tb.stream(spark, folder))


@query
def training_windows(spark, folder):
    """One random window per document of the corpus."""
    draws = tb.table(spark, folder, "documents").count()
    windows = st.sample_windows(tb.stream(spark, folder), "train", SEQ_LENGTH, draws, chunk=CHUNK)
    return windows.select("window_id", "offset", written("x").alias("x"), written("y").alias("y"))


@query
def selected_documents(spark, folder):
    """The rows of the training range of the shuffle, by index list."""
    rows = sh.shuffled(tb.table(spark, folder, "documents").select("doc_id", "lang"), ["doc_id"])
    n = rows.count()
    n_val = max(int(n * sh.CORPUS_VAL_FRACTION), 1)
    return sh.select_rows(rows, spark.range(n - n_val).withColumnRenamed("id", "position"))


@query
def picked_documents(spark, folder):
    """Rows in the order of a list that names each position twice."""
    rows = sh.shuffled(tb.table(spark, folder, "documents").select("doc_id"), ["doc_id"])
    twice = rows.select(
        F.explode(F.array(F.col("position") * 2, F.col("position") * 2 + 1)).alias("slot"), "position"
    )
    return sh.pick_in_order(rows, twice)


# --- instruction data ------------------------------------------------------------------


def _sides(df):
    return df.select("conv_id", "turn", "user", "assistant")


@query
def dolly_chat(spark, folder):
    return _sides(pr.to_chat(tb.pairs(spark, folder), "dolly", ["conv_id", "turn"]))


@query
def alpaca_chat(spark, folder):
    rows = tb.pairs(spark, folder).withColumnsRenamed({"context": "input", "response": "output"})
    return _sides(pr.to_chat(rows, "alpaca", ["conv_id", "turn"]))


@query
def generic_chat(spark, folder):
    """``prompt`` exists and wins although it is empty for conversations with a system turn."""
    rows = tb.pairs(spark, folder).select(
        "conv_id",
        "turn",
        F.when(F.col("context").isNull(), F.col("instruction")).otherwise("").alias("prompt"),
        "instruction",
        F.col("response").alias("answer"),
    )
    return _sides(pr.to_chat(rows, "generic", ["conv_id", "turn"]))


def _named_pairs(spark, folder):
    names = F.element_at(F.array(F.lit("org/dolly-15k"), F.lit("org/alpaca"), F.lit("own")), (F.col("conv_id") % 3 + 1).cast("int"))
    own = F.col("conv_id") % 3 == 2  # a set with fields of its own; the others' are null in its rows
    return tb.pairs(spark, folder).select(
        "conv_id",
        "turn",
        "context",
        F.when(~own, F.col("instruction")).alias("instruction"),
        F.when(~own, F.col("response")).alias("response"),
        F.when(own, F.col("instruction")).alias("question"),
        F.when(own, F.col("response")).alias("answer"),
        names.alias("dataset"),
        F.col("context").alias("input"),
        F.when(~own, F.col("response")).alias("output"),
    )


@query
def mixed_chat(spark, folder):
    return _sides(pr.to_chat_by_source(_named_pairs(spark, folder), "dataset", ["conv_id", "turn"]))


@query
def dataset_styles(spark, folder):
    rows = _named_pairs(spark, folder).withColumn("style", pr.style_column(F.col("dataset")))
    return rows.groupBy("style").agg(F.count(F.lit(1)).alias("n_rows"))


def _prepared(spark, folder) -> tuple[DataFrame, Column]:
    """Instruction rows with their encoded length (null: incomplete), and which are kept."""
    vocab = tb.chat_vocabulary(spark, folder)
    rows = tb.pairs(spark, folder)
    sides = pr.to_chat(rows, "dolly", ["conv_id", "turn"])
    long = sides.select(F.col("conv_id"), F.col("turn").alias("user_turn"), "user", "assistant")
    turns = pr.messages(long, ["conv_id", "user_turn"])
    coded = tk.tokenize_by_lookup(turns, vocab, ["conv_id", "user_turn", "turn", "role"])
    lengths = coded.groupBy("conv_id", "user_turn").agg((F.sum(F.size("token_ids") + 2) + 1).alias("n"))
    all_rows = rows.select("conv_id", F.col("turn").alias("user_turn")).join(lengths, ["conv_id", "user_turn"], "left")
    return all_rows, F.coalesce(F.col("n"), F.lit(1 << 30)) <= pr.LENGTH_FACTOR * SEQ_LENGTH


VERSION_WEIGHTS = (0.5, 0.7, 0.9)
PAIR_SCHEMA = "conv_id bigint, turn bigint, instruction string, context string, response string"


@query
def streamed_tensors(spark, folder):
    """Tensors of instruction files that arrive in two lots; the stream is started anew for the second.

    Its checkpoint remembers the first lot's files, so that each row is encoded once.
    """
    vocab = vc.extend(vc.byte_vocabulary(spark))
    source, sink, checkpoint = (stage_path(spark, n) for n in ("arriving", "tensors", "progress"))
    rows = tb.pairs(spark, folder).select("conv_id", "turn", "instruction", "context", "response")
    for lot in (0, 1):
        rows.filter(F.pmod("conv_id", F.lit(2)) == lot).write.mode("append").json(source)
        rowwise.follow_instructions(
            spark, source, PAIR_SCHEMA, "dolly", vocab, ["conv_id", "turn"], SEQ_LENGTH * 2, sink, checkpoint
        ).awaitTermination()
    return spark.read.parquet(sink).select("conv_id", "turn", written("x").alias("x"), written("y").alias("y"))


@query
def preparation_counts(spark, folder):
    """Written and skipped rows of a preparation, incomplete and over-long ones apart."""
    all_rows, kept = _prepared(spark, folder)
    return mt.write_counters(all_rows, kept, [], F.col("n"))


@query
def preparation_counts_on_write(spark, folder):
    """The same counters, observed while the rows are written."""
    all_rows, kept = _prepared(spark, folder)
    table, seen = mt.stage_with_counters(all_rows, kept, F.col("n"), "prepared")
    return table.groupBy().agg(
        F.lit(seen["written"]).alias("written"), F.lit(seen["skipped"]).alias("skipped"), F.lit(seen["tokens_written"]).alias("tokens_written")
    )


def _examples(spark, folder, vocab):
    rows = tb.pairs(spark, folder).withColumnRenamed("turn", "user_turn")
    encode = lambda df: tk.tokenize_by_lookup(df, vocab, ["conv_id", "user_turn", "turn", "role"])
    return finetune.encoded_examples(rows, "dolly", vocab, encode, ["conv_id", "user_turn"], SEQ_LENGTH)


@query
def instruction_examples(spark, folder):
    coded = _examples(spark, folder, tb.chat_vocabulary(spark, folder))
    return coded.select("conv_id", "user_turn", written("token_ids").alias("ids"), written("loss_mask").alias("mask"))


@query
def example_files(spark, folder):
    path = stage_path(spark, "examples")
    files.write_examples(_examples(spark, folder, tb.chat_vocabulary(spark, folder)), path)
    read = files.read_examples(spark, path)
    return read.select(written("token_ids").alias("ids"), written("loss_mask").alias("mask"))


@query
def example_split(spark, folder):
    rows = tb.pairs(spark, folder).select("conv_id", "turn")
    return sh.split_examples(rows, ["conv_id", "turn"]).select("conv_id", "turn", "split")


@query
def example_tensors(spark, folder):
    coded = _examples(spark, folder, tb.chat_vocabulary(spark, folder))
    return finetune.split_tensors(coded, ["conv_id", "user_turn"], SEQ_LENGTH).select(
        "conv_id", "user_turn", "split", written("x").alias("x"), written("y").alias("y")
    )


@query
def example_validity(spark, folder):
    coded = _examples(spark, folder, tb.chat_vocabulary(spark, folder))
    tensors = ex.to_tensors(coded, SEQ_LENGTH)
    report = ex.validity_report(tensors, SEQ_LENGTH, [])
    return report.withColumn("trained_share", F.round("trained_share", 6))


# --- chat ------------------------------------------------------------------------------


@query
def encoded_conversations(spark, folder):
    vocab = tb.chat_vocabulary(spark, folder)
    coded = ch.encode_chat(tb.coded_turns(spark, folder, vocab), vocab, ["conv_id"], SEQ_LENGTH * 2)
    return coded.select("conv_id", written("token_ids").alias("ids"), written("loss_mask").alias("mask"))


@query
def encoded_turns(spark, folder):
    vocab = tb.chat_vocabulary(spark, folder)
    coded = ch.encode_turns(tb.coded_turns(spark, folder, vocab), vocab)
    return coded.select("conv_id", "turn", written("token_ids").alias("ids"), written("loss_mask").alias("mask"))


def _trimmed(spark, folder, vocab):
    return ch.trim_history(tb.coded_turns(spark, folder, vocab), vocab, ["conv_id"], SEQ_LENGTH * 2, SEQ_LENGTH)


@query
def trimmed_history(spark, folder):
    return _trimmed(spark, folder, tb.chat_vocabulary(spark, folder)).select("conv_id", "turn")


@query
def chat_prompts(spark, folder):
    vocab = tb.chat_vocabulary(spark, folder)
    prompts = ch.chat_prompt(_trimmed(spark, folder, vocab), vocab, ["conv_id"])
    return prompts.select("conv_id", written("token_ids").alias("ids"))


@query
def cut_replies(spark, folder):
    """Encoded turns joined by stop tokens: what is left before the first of them."""
    vocab = tb.chat_vocabulary(spark, folder)
    turns = tb.coded_turns(spark, folder, vocab).filter("role = 'assistant'")
    ends = F.when(F.col("turn") % 4 == 1, F.array(F.lit(vocab.eos_id), F.lit(vocab.special("end_turn")))).otherwise(
        F.array(F.lit(vocab.special("end_turn")), F.lit(vocab.eos_id))
    )
    reply = F.concat("token_ids", ends, "token_ids")
    cut = turns.select("conv_id", "turn", ch.cut_reply(reply, vocab).alias("token_ids"))
    texts = tk.detokenize(cut, vocab, ["conv_id", "turn"])
    return texts.select("conv_id", "turn", strip(F.col("text")).alias("reply"))


@query
def continued_conversations(spark, folder):
    turns = tb.conversations(spark, folder)
    replies = turns.groupBy("conv_id").agg(F.max_by("text", "turn").alias("text"))
    return ch.append_replies(turns, replies, ["conv_id"])


@query
def spoken_turns(spark, folder):
    """System turns are blanked first, so that the blank rule has something to skip."""
    blanked = F.when(F.col("role") == "system", F.lit(" \n ")).otherwise(F.concat(F.lit("\t "), "text", F.lit(" \n")))
    return ch.drop_blank(tb.conversations(spark, folder).withColumn("text", blanked))


# --- batches ---------------------------------------------------------------------------


def _keys(spark, folder):
    return tb.conversations(spark, folder).select("conv_id", "turn")


@query
def rank_shards(spark, folder):
    dealt = bt.shard(_keys(spark, folder), ["conv_id", "turn"], WORLD_SIZE, epochs=2)
    return dealt.drop("per_rank")


@query
def training_batches(spark, folder):
    return bt.batches(bt.shard(_keys(spark, folder), ["conv_id", "turn"], WORLD_SIZE), BATCH)


@query
def evaluation_batches(spark, folder):
    dealt = bt.batches(bt.shard(_keys(spark, folder), ["conv_id", "turn"], WORLD_SIZE), BATCH)
    return bt.first_batches(dealt, 10).groupBy("rank", "batch_id").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def step_schedule(spark, folder):
    keys = _keys(spark, folder)
    steps = keys.count() // 8
    return bt.schedule(keys, ["conv_id", "turn"], steps, 2, BATCH, WORLD_SIZE)


@query
def batched_tensors(spark, folder):
    coded = _examples(spark, folder, tb.chat_vocabulary(spark, folder))
    tensors = stage(ex.to_tensors(coded, SEQ_LENGTH), "tensors")
    dealt = finetune.batched(tensors, ["conv_id", "user_turn"], BATCH, WORLD_SIZE)
    return dealt.select("conv_id", "user_turn", "rank", "batch_id", "slot", written("x").alias("x"), written("y").alias("y"))


# --- metrics ---------------------------------------------------------------------------


@query
def masked_cross_entropy(spark, folder):
    vocab = tb.vocabulary(spark, folder)
    losses = mt.token_losses(
        stage(tb.turn_logits(spark, folder, vocab), "logits"),
        tb.turn_targets(spark, folder, vocab),
        ["conv_id", "turn"],
    )
    return losses.select("conv_id", "turn", "y", rounded("nll"))


@query
def absent_targets(spark, folder):
    """Targets that the logits may lack: the id after the smallest of an assistant turn."""
    vocab = tb.vocabulary(spark, folder)
    targets = tb.turn_targets(spark, folder, vocab)
    targets = targets.withColumn("y", F.when(F.col("y") >= 0, F.col("y") + 1).otherwise(F.col("y")))
    losses = mt.token_losses(stage(tb.turn_logits(spark, folder, vocab), "logits"), targets, ["conv_id", "turn"])
    return losses.select("conv_id", "turn", "y", rounded("nll"))


@query
def batch_loss(spark, folder):
    """Mean loss per conversation; one without an assistant turn has no loss (NaN)."""
    vocab = tb.vocabulary(spark, folder)
    losses = mt.token_losses(
        stage(tb.turn_logits(spark, folder, vocab), "logits"),
        tb.turn_targets(spark, folder, vocab),
        ["conv_id", "turn"],
    )
    per_batch = mt.batch_losses(losses, ["conv_id"])
    return per_batch.select(
        "conv_id",
        F.isnan("loss").alias("no_loss"),
        F.round(F.when(~F.isnan("loss"), F.col("loss")), 6).alias("loss"),
        "n_targets",
    )


def _batch_table(spark, folder):
    return mt.batch_losses(tb.steps(spark, folder), ["run", "rank", "batch_id"], "loss")


@query
def validation_loss(spark, folder):
    overall = mt.overall_loss(_batch_table(spark, folder))
    return overall.select(
        rounded("loss"),
        "n_batches",
        F.round(perplexity(F.col("loss")), 4).alias("perplexity"),
        F.round(perplexity(F.col("loss"), EVALUATION_CAP), 4).alias("perplexity_eval"),
    )


@query
def loss_by_run(spark, folder):
    per_batch = _batch_table(spark, folder)
    plain = mt.mean_loss(per_batch, ["run"]).select("run", rounded("loss"), "n_batches")
    weighted = mt.token_weighted_loss(per_batch, ["run"])
    return plain.join(weighted.select("run", F.round("loss", 6).alias("weighted_loss")), "run")


@query
def loss_over_ranks(spark, folder):
    per_rank = mt.mean_loss(_batch_table(spark, folder), ["run", "rank"])
    return mt.mean_over_ranks(per_rank, ["run"]).select("run", rounded("loss"), "n_ranks")


@query
def step_loss(spark, folder):
    return mt.accumulated_loss(tb.steps(spark, folder), ["run", "batch_id"], 8).select("run", "batch_id", rounded("loss"))


@query
def run_progress(spark, folder):
    per_step = BATCH * SEQ_LENGTH * WORLD_SIZE
    # Whole hundredths of a second add up the same in any order.
    steps = tb.steps(spark, folder).select("run", "step", F.round(F.col("dt") * 100).cast("bigint").alias("dt"))
    rows = mt.progress(steps, ["run"], per_step, 1_000_000)
    return rows.select(
        "run", "step", "tokens", "elapsed", rounded("tokens_per_sec", 4), rounded("percent", 8), rounded("eta")
    )


@query
def best_evaluations(spark, folder):
    evals = tb.steps(spark, folder).select("run", "step", F.col("loss").alias("val_loss"))
    return mt.best_so_far(evals, ["run"]).select("run", "step", rounded("val_loss"), "is_best", rounded("best_loss"))


@query
def run_summaries(spark, folder):
    evals = tb.steps(spark, folder).select("run", "step", F.col("loss").alias("val_loss"))
    rows = rn.run_summary(evals, ["run"])
    return rows.select("run", rounded("best_loss"), "best_step", "last_step", rounded("last_loss"), "n_worse", "diverged_at")


@query
def clipped_steps(spark, folder):
    """Gradient norms stand in as the event value; every error event logs N/A."""
    events = tb.table(spark, folder, "events")
    norms = F.when(F.col("event_type") == "error", "N/A").otherwise(F.col("value").cast("string"))
    steps = events.select((F.col("user_id") % WORLD_SIZE).alias("run"), norms.alias("grad_norm"))
    return mt.clip_report(steps, ["run"], 20.0).withColumn("clipped_share", F.round("clipped_share", 6))


# The three published run configurations.
RUN_CONFIGS = [
    {"name": "50m", "seq_length": 512, "batch_size": 16, "grad_accum_steps": 2, "max_steps": 10_000},
    {"name": "160m", "seq_length": 1024, "batch_size": 64, "grad_accum_steps": 1, "max_steps": 50_000},
    {"name": "400m", "seq_length": 2048, "batch_size": 4, "grad_accum_steps": 8, "max_steps": 100_000},
]


@query
def run_plans(spark, folder):
    coded = tk.byte_tokenize(tb.table(spark, folder, "documents"))
    totals = mt.stage_counters(coded, [])
    return mt.run_plan(totals, RUN_CONFIGS, WORLD_SIZE).withColumn("corpus_passes", F.round("corpus_passes", 6))


@query
def loss_trends(spark, folder):
    steps = tb.steps(spark, folder).select("run", "step", "loss")
    rows = rn.loss_trend(steps, ["run"], width=256)
    return rows.select("run", "step", rounded("avg_recent"), rounded("avg_older"), "trend")


@query
def learning_rates(spark, folder):
    steps = tb.steps(spark, folder)
    last = steps.agg(F.max("step").alias("n")).first()["n"]
    rows = rn.with_schedule(steps.select("run", "step"), 6e-4, 6e-5, last // 20, last)
    return rows.select("run", "step", F.round(F.col("lr") * 1e6, 6).alias("lr_micro"))


@query
def schedule_deviations(spark, folder):
    """Logged rates keep three digits; those of error events are 10 % off."""
    steps = tb.steps(spark, folder)
    last = steps.agg(F.max("step").alias("n")).first()["n"]
    rows = rn.with_schedule(steps.select("run", "step"), 6e-4, 6e-5, last // 20, last)
    logged = F.format_string("%.2e", F.col("lr") * F.when(F.col("run") == "error", 1.1).otherwise(1.0)).cast("double")
    flagged = rn.schedule_check(rows.withColumn("logged", logged), F.col("logged"), 0.01)
    return flagged.groupBy("run").agg(F.count(F.lit(1)).alias("n"), F.count_if("off_schedule").alias("n_off"))


@query
def elapsed_times(spark, folder):
    written_times = tb.table(spark, folder, "events").select(
        "event_id", elapsed_text(F.col("event_id").cast("double")).alias("elapsed")
    )
    return written_times.withColumn("seconds", elapsed_seconds(F.col("elapsed")))


@query
def evaluations_with_train_loss(spark, folder):
    """Evaluations fall between logged steps: purchases are evaluations, the rest steps."""
    rows = tb.steps(spark, folder).withColumn("series", F.lit("all"))
    evals = rows.filter("run = 'purchase'").select("series", "step", F.col("loss").alias("val_loss"))
    train = rows.filter("run <> 'purchase'").select("series", "step", "loss")
    known = rn.recent_train_loss(evals, train, ["series"])
    return known.select("step", rounded("val_loss"), rounded("train_loss"))


@query
def save_points(spark, folder):
    return pr.save_points(tb.steps(spark, folder), 100, ["run"])


@query
def log_points(spark, folder):
    steps = tb.steps(spark, folder)
    logged = pr.on_cadence(steps, 10, from_zero=True).select("run", "step", F.lit("log").alias("kind"))
    return logged.unionByName(pr.on_cadence(steps, 500).select("run", "step", F.lit("eval").alias("kind")))


# --- training logs ---------------------------------------------------------------------


def _step_lines(events):
    """Events written as step lines; a run restarts at each hundredth step of the log."""
    grad = F.when(F.col("event_type") == "error", "N/A").otherwise(F.format_string("%.4f", F.col("value")))
    return F.format_string(
        "step=%6d | loss=%.4f [##########----------] | lr=%.2e | grad_norm=%s | %dK tok/s | dt=%.2fs | tok=%,d | elapsed=%s",
        F.col("event_id"),
        F.col("value") / 10,
        (F.col("user_id") + 1).cast("double") / 1e6,
        grad,
        F.col("user_id"),
        F.col("value"),
        (F.col("event_id") + 1) * 196608,
        elapsed_text(F.col("event_id").cast("double")),
    )


def _log_folder(spark, lines, name):
    """One file per part, lines in order."""
    path = stage_path(spark, name)
    ordered = lines.repartition("part").sortWithinPartitions("part", "at")
    ordered.select("part", "value").write.partitionBy("part").text(path)
    return path


@query
def logged_steps(spark, folder):
    events = tb.table(spark, folder, "events")
    lines = events.select((F.col("user_id") % 4).alias("part"), F.col("event_id").alias("at"), _step_lines(events).alias("value"))
    steps = trainlog.read_steps(trainlog.read_lines(spark, _log_folder(spark, lines, "steps-log")))
    return steps.select("step", "loss", rounded("lr", 9), "grad_norm", "tok_per_sec", "dt", "tok", "elapsed", "run")


@query
def logged_runs(spark, folder):
    """Each file holds its events twice over: the second pass starts again at a low step."""
    events = tb.table(spark, folder, "events")
    lines = events.select(
        (F.col("user_id") % 4).alias("part"),
        F.explode(F.array(F.col("event_id"), F.col("event_id") + 1_000_000_000)).alias("at"),
        _step_lines(events).alias("value"),
    )
    steps = trainlog.read_steps(trainlog.read_lines(spark, _log_folder(spark, lines, "runs-log")))
    runs = steps.groupBy(F.regexp_extract("file", r"part=(\d+)", 1).cast("bigint").alias("part"), "run")
    return runs.agg(F.count(F.lit(1)).alias("n_steps"), F.min("step").alias("first_step"), F.max("step").alias("last_step"))


@query
def logged_evaluations(spark, folder):
    events = tb.table(spark, folder, "events")
    rule = F.repeat(F.lit("="), F.lit(60))
    loss = F.col("value") / 10
    block = F.concat_ws(
        "\n",
        F.lit(""),
        rule,
        F.format_string("  EVAL @ step %,d | elapsed %s", F.col("event_id"), elapsed_text(F.col("event_id").cast("double"))),
        F.format_string("  Val Loss: %.4f | Perplexity: %.2f", loss, F.col("value")),
        F.format_string("  Train Loss (avg last 10): %.4f", loss + 1),
        F.format_string("  Best Val Loss: %.4f", loss),
        F.format_string("  Tokens Processed: %,d", F.col("event_id") * 1000),
        rule,
    )
    lines = events.select((F.col("user_id") % 4).alias("part"), F.col("event_id").alias("at"), block.alias("value"))
    evals = trainlog.read_evals(trainlog.read_lines(spark, _log_folder(spark, lines, "evals-log")))
    return evals.select("step", "val_loss", "perplexity", "train_loss", "best_val_loss", "tok", "elapsed")


@query
def logged_samples(spark, folder):
    """Each conversation logs its turns as samples: the role as prompt, the text as output."""
    turns = tb.conversations(spark, folder)
    head = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).select(
        "conv_id", F.lit(-1).cast("bigint").alias("turn"), F.format_string("\n--- Sample generations at step %d ---", "conv_id").alias("value")
    )
    body = turns.select(
        "conv_id", "turn", F.format_string("  PROMPT: %s\n  OUTPUT: %s\n", "role", "text").alias("value")
    )
    # Every fifth run stopped in its samples; the next one's first step line follows.
    stopped = F.lit("step=    10 | loss=6.0000 | lr=3.30e-06")
    end = F.when(F.col("conv_id") % 5 == 0, stopped).otherwise("--- End samples ---\n")
    foot = head.select("conv_id", F.lit(1 << 20).cast("bigint").alias("turn"), end.alias("value"))
    lines = head.unionByName(body).unionByName(foot).select(
        (F.col("conv_id") % 4).alias("part"), (F.col("conv_id") * (1 << 21) + F.col("turn")).alias("at"), "value"
    )
    samples = trainlog.read_samples(trainlog.read_lines(spark, _log_folder(spark, lines, "samples-log")))
    return samples.select("step", "sample", "prompt", "output")


# --- decoding --------------------------------------------------------------------------


def _logits(spark, folder):
    return tb.conversation_logits(spark, folder, tb.vocabulary(spark, folder))


SEQ = ["conv_id"]
# A share that no ratio of token counts hits: exact ties would hang on the last bit of a sum.
NUCLEUS = 0.8912345


@query
def top_k_tokens(spark, folder):
    kept = dc.top_k(dc.temperature(_logits(spark, folder), 0.7), SEQ, 50)
    return kept.select("conv_id", "token_id", rounded("logit"))


@query
def token_probabilities(spark, folder):
    return dc.softmax(_logits(spark, folder), SEQ).select("conv_id", "token_id", rounded("prob", 9))


@query
def nucleus_tokens(spark, folder):
    return dc.nucleus(_logits(spark, folder), SEQ, NUCLEUS).select("conv_id", "token_id")


@query
def next_token_distribution(spark, folder):
    kept = dc.distribution(_logits(spark, folder), SEQ, 0.7, 50, 0.9)
    return kept.select("conv_id", "token_id", rounded("prob", 9))


@query
def drawn_tokens(spark, folder):
    return dc.draw(dc.distribution(_logits(spark, folder), SEQ, 0.7, 50, 0.9), SEQ, 7)


@query
def sampled_tokens(spark, folder):
    return dc.draw(dc.sample_distribution(_logits(spark, folder), SEQ), SEQ, 11)


# --- language model --------------------------------------------------------------------


def _base_model(spark, folder, chunks=None, counted=None):
    chunks = tb.stream(spark, folder, counted) if chunks is None else chunks
    return lm.fit_lm(chunks.filter("split = 'train'"), VOCAB_SIZE).counted()


def _sft_tensors(spark, folder, vocab):
    return ex.to_tensors(_examples(spark, folder, vocab), SEQ_LENGTH)


@query
def trigram_counts(spark, folder):
    chunks = tb.stream(spark, folder)
    return lm.fit_lm(chunks.filter("split = 'train'"), VOCAB_SIZE).counts


@query
def finetuned_counts(spark, folder):
    counted = tb.vocabulary(spark, folder)
    vocab = vc.extend(counted)
    tuned = lm.finetune_lm(lm.resize_vocab(_base_model(spark, folder, counted=counted), vocab.size), _sft_tensors(spark, folder, vocab), 2.0)
    return tuned.counts


@query
def resumed_counts(spark, folder):
    """Save, load, go on with the validation stream."""
    chunks = tb.stream(spark, folder)
    path = stage_path(spark, "model")
    lm.save_model(lm.fit_lm(chunks.filter("split = 'train'"), VOCAB_SIZE), path)
    grown = lm.resume_lm(lm.load_model(spark, path), chunks.filter("split = 'val'"))
    return grown.counts.withColumn("step", F.lit(grown.step))


@query
def token_scores(spark, folder):
    """Log-probability of every trained target of the instruction examples, after resizing."""
    counted = tb.vocabulary(spark, folder)
    vocab = vc.extend(counted)
    model = lm.resize_vocab(_base_model(spark, folder, counted=counted), vocab.size)
    tensors = stage(_sft_tensors(spark, folder, vocab), "tensors")
    scored = lm.score(model, tensors, ["conv_id", "user_turn"])
    return scored.filter(F.col("w3").isNotNull()).select("conv_id", "user_turn", "pos", rounded("log_prob"))


@query
def held_out_loss(spark, folder):
    """Loss and perplexity over the whole validation stream, batch after batch."""
    chunks = tb.stream(spark, folder)
    windows = stage(pretrain.whole_split_windows(chunks, SEQ_LENGTH), "windows")
    result = pretrain.evaluate(_base_model(spark, folder, chunks), windows, max_batches=1 << 40)
    return result.select(rounded("loss"), "n_batches", rounded("perplexity", 3))


@query
def best_version(spark, folder):
    """Three weights against the next shorter context: each version's held-out loss, and which is loaded as best."""
    chunks = tb.stream(spark, folder)
    windows = stage(pretrain.whole_split_windows(chunks, SEQ_LENGTH), "windows")
    base = _base_model(spark, folder, chunks).summed()
    met = lm.met_batches(base, windows, ["batch_id"])
    root = stage_path(spark, "versions")
    for step, weight in enumerate(VERSION_WEIGHTS):
        model = base.under(weight, step)
        model = lm.judged(model, pretrain.evaluate(model, windows, max_batches=1 << 40, met=met))
        vs.save_version(model, root, {"weight": weight, "seq_length": SEQ_LENGTH})
    best, config = vs.load_version(spark, root, vs.BEST)
    listed = vs.versions(spark, root)
    return listed.select("step", rounded("val_loss"), (F.col("step") == best.step).alias("best"), F.lit(config["weight"]).alias("best_weight"))


@query
def finetuned_loss(spark, folder):
    """Loss of the fine-tuned model on each held-out instruction example."""
    counted = tb.vocabulary(spark, folder)
    vocab = vc.extend(counted)
    coded = _examples(spark, folder, vocab)
    tensors = stage(finetune.split_tensors(coded, ["conv_id", "user_turn"], SEQ_LENGTH, 0.2), "tensors")
    base = lm.resize_vocab(_base_model(spark, folder, counted=counted), vocab.size)
    tuned = lm.finetune_lm(base, tensors.filter("split = 'train'")).counted()
    scores = lm.batch_scores(tuned, tensors.filter("split = 'val'"), ["conv_id", "user_turn"])
    known = F.when(~F.isnan("loss"), F.col("loss"))
    return scores.select("conv_id", "user_turn", F.round(known, 6).alias("loss"), "n_targets")


@query
def untrained_perplexity(spark, folder):
    """A model without counts is uniform: its perplexity is the vocabulary size."""
    chunks = tb.stream(spark, folder)
    empty = lm.fit_lm(chunks.filter("split = 'none'"), VOCAB_SIZE)
    windows = chunks.select(F.col("chunk_id").alias("batch_id"), without_last(F.col("tokens")).alias("x"), without_first(F.col("tokens")).alias("y"))
    result = pretrain.evaluate(empty, windows, max_batches=1 << 40)
    return result.select("n_batches", rounded("perplexity", 3))


@query
def next_candidates(spark, folder):
    """The likeliest tokens after the last two tokens of every conversation."""
    vocab = tb.vocabulary(spark, folder)
    model = _base_model(spark, folder, counted=vocab).stored()
    turns = tb.coded_turns(spark, folder, vocab)
    ends = turns.groupBy("conv_id").agg(F.max_by("token_ids", "turn").alias("ids"))
    contexts = ends.select(gn.last_token(F.col("ids"), 2).alias("w1"), gn.last_token(F.col("ids"), 1).alias("w2")).distinct()
    kept = dc.softmax(dc.top_k(lm.candidates(model, contexts, LM_TOP), ["w1", "w2"], LM_TOP), ["w1", "w2"])
    return kept.select("w1", "w2", "token_id", rounded("prob", 9))


def _prompts(spark, folder):
    users = tb.conversations(spark, folder).filter("role = 'user'")
    return users.select(F.concat_ws("-", "conv_id", "turn").alias("prompt_id"), F.col("text").alias("prompt"))


@query
def generated_tokens(spark, folder):
    vocab = tb.vocabulary(spark, folder)
    prompts = tk.tokenize_by_lookup(_prompts(spark, folder), vocab, ["prompt_id"], "prompt")
    made = gn.generate(prompts, _base_model(spark, folder, counted=vocab), "prompt_id", 4, gn.nucleus_chooser(), dc.REPLY_TOP_K, seed=3)
    return made.select("prompt_id", written("token_ids").alias("ids"))


@query
def prompt_completions(spark, folder):
    vocab = tb.vocabulary(spark, folder)
    encode = lambda df: tk.tokenize_by_lookup(df, vocab, ["prompt_id"], "prompt")
    return gn.completions(_prompts(spark, folder), _base_model(spark, folder, counted=vocab), vocab, encode, n_tokens=4)


@query
def training_samples(spark, folder):
    vocab = tb.vocabulary(spark, folder)
    encode = lambda df: tk.tokenize_by_lookup(df, vocab, ["prompt_id"], "prompt")
    return gn.training_samples(_prompts(spark, folder), _base_model(spark, folder, counted=vocab), vocab, encode, n_tokens=4)


@query
def evaluation_completions(spark, folder):
    """Completions at the length of an evaluation."""
    vocab = tb.vocabulary(spark, folder)
    encode = lambda df: tk.tokenize_by_lookup(df, vocab, ["prompt_id"], "prompt")
    return gn.completions(_prompts(spark, folder), _base_model(spark, folder, counted=vocab), vocab, encode, n_tokens=dc.EVAL_TOKENS)


@query
def evaluation_samples(spark, folder):
    """The samples of an evaluation while training, at their length."""
    vocab = tb.vocabulary(spark, folder)
    encode = lambda df: tk.tokenize_by_lookup(df, vocab, ["prompt_id"], "prompt")
    return gn.training_samples(_prompts(spark, folder), _base_model(spark, folder, counted=vocab), vocab, encode, n_tokens=dc.SAMPLE_TOKENS)


def _replied(spark, folder, max_tokens: int) -> DataFrame:
    """A reply to every conversation from the fine-tuned model, appended as its next turn."""
    counted = tb.vocabulary(spark, folder)
    vocab = vc.extend(counted)
    base = lm.resize_vocab(_base_model(spark, folder, counted=counted), vocab.size)
    tuned = lm.finetune_lm(base, _sft_tensors(spark, folder, vocab), 4.0)
    turns = tb.conversations(spark, folder)
    encode = lambda df: tk.tokenize_by_lookup(df, vocab, ["conv_id", "turn", "role"])
    replies = gn.chat_replies(turns, tuned, vocab, encode, SEQ_LENGTH * 2, max_tokens=max_tokens)
    return gn.continued(turns, replies)


@query
def chat_replies(spark, folder):
    return _replied(spark, folder, 6)


@query
def whole_chat_replies(spark, folder):
    """Replies up to their stop token, or to the length of a bulk reply."""
    return _replied(spark, folder, dc.REPLY_TOKENS)
