"""Text to ids and back over whole tables."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.arrays import in_order, ints
from corpusloom.functions.text import byte_ids, from_latin, pieces
from corpusloom.operators.bpe import id_speller, piece_encoder
from corpusloom.operators.lookup import piece_finder
from corpusloom.operators.vocabulary import N_BYTES, Vocabulary, token_text
from corpusloom.session import stage


def split_pieces(vocab: Vocabulary, text: Column, allow_special: bool = True) -> Column:
    return pieces(text, vocab.pattern, tuple(vocab.specials) if allow_special else ())


def _finish(ids: Column, vocab: Vocabulary, add_eos: bool) -> Column:
    return F.array_append(ids, F.lit(vocab.eos_id)) if add_eos else ids


def _by_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Texts by key; without a count, so that AQE sizes the tasks."""
    return df.repartition(*keys)


def _by_repetition(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows whose keys occur once, and the others; null keys are keys like any other.

    The repeated keys are written, so that few of them are sent around: rows stay where they are.
    """
    own = {k: f"_own_{k}" for k in keys}
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    repeated = stage(repeated.select(*keys), "repeated-keys").withColumnsRenamed(own)
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(o)) for k, o in own.items()])
    return df.join(repeated, same, "left_anti"), df.join(repeated, same, "left_semi")


def tokenize(
    df: DataFrame,
    vocab: Vocabulary,
    text: str = "text",
    out: str = "token_ids",
    add_eos: bool = False,
    allow_special: bool = True,
) -> DataFrame:
    """Byte-pair encode a text column without any shuffle.

    Spark's regex splits the text; Arrow batches of pieces go to the encoder, which works
    on each distinct piece of a batch once. Row-wise, so it also runs on streams.
    """
    encode = piece_encoder(vocab)
    ids = F.coalesce(encode(split_pieces(vocab, F.col(text), allow_special)), ints(F.array()))
    return df.withColumn(out, _finish(ids, vocab, add_eos))


def tokenize_by_lookup(
    df: DataFrame,
    vocab: Vocabulary,
    keys: list[str],
    text: str = "text",
    out: str = "token_ids",
    add_eos: bool = False,
    allow_special: bool = True,
) -> DataFrame:
    """Whole-piece look-up; pieces outside the vocabulary become their bytes.

    ``keys`` identify a row and are carried through. Rows of equal keys become one: first
    pieces first, then second ones, equal places in order of their ids. While the vocabulary
    may be broadcast, each text's pieces are looked up side by side where the text is read, so
    no piece becomes a row; only the keys are counted, and only texts whose key is repeated
    are moved. A larger vocabulary is joined, and the texts are moved by key.
    """
    known = vocab.table.filter((F.col("token_id") >= N_BYTES) & (F.octet_length("token") > 1)).select(
        F.col("token").cast("string").alias("piece"), "token_id", "is_special"
    )
    if not allow_special:
        known = known.filter(~F.col("is_special"))
    texts = df.select(*keys, F.col(text).alias("_text"))
    if vocab.broadcastable:
        split = lambda t: split_pieces(vocab, t, allow_special)
        places = lambda t: F.transform(split(t), lambda _, at: at)
        find = piece_finder(known)
        once, again = _by_repetition(texts, keys)
        again = again.groupBy(*keys).agg(F.collect_list("_text").alias("_texts"))
        single = find(split(F.col("_text")), F.lit(None).cast("array<int>"))
        several = find(F.flatten(F.transform("_texts", split)), F.flatten(F.transform("_texts", places)))
        done = lambda ids: _finish(F.coalesce(ids, ints(F.array())), vocab, add_eos).alias(out)
        return once.select(*keys, done(single)).unionAll(again.select(*keys, done(several)))
    texts = _by_key(texts, keys)
    exploded = texts.select(*keys, F.posexplode_outer(split_pieces(vocab, F.col("_text"), allow_special)).alias("at", "piece"))
    found = exploded.join(known.drop("is_special"), "piece", "left")
    ids = F.when(F.col("token_id").isNull(), byte_ids(F.col("piece"))).otherwise(F.array("token_id"))
    ids = F.coalesce(ids, ints(F.array()))
    return (
        found.withColumn("_ids", ids)
        .groupBy(*keys)
        .agg(F.collect_list(F.struct("at", "_ids")).alias("_all"))
        .select(*keys, _finish(ints(in_order(F.col("_all"), "_ids")), vocab, add_eos).alias(out))
    )


def byte_tokenize(df: DataFrame, text: str = "text", out: str = "token_ids") -> DataFrame:
    """Ids 0..255, one per UTF-8 byte."""
    return df.withColumn(out, F.coalesce(byte_ids(F.col(text)), ints(F.array())))


def detokenize(
    df: DataFrame, vocab: Vocabulary, keys: list[str], ids: str = "token_ids", out: str = "text"
) -> DataFrame:
    """Ids back to text: token bytes in order, decoded once per row.

    Row-wise while the vocabulary may be broadcast. Unknown ids spell nothing; null ids are
    an empty text, broken UTF-8 becomes U+FFFD.
    """
    if vocab.broadcastable:
        spelled_bytes = F.coalesce(id_speller(vocab)(ints(F.col(ids))), F.lit(b""))
        return df.select(*keys, F.make_valid_utf8(spelled_bytes.cast("string")).alias(out))
    spelled = vocab.small(vocab.table.select("token_id", token_text(F.col("token")).alias("_spelled")))
    exploded = _by_key(df.select(*keys, ids), keys).select(*keys, F.posexplode_outer(ids).alias("at", "token_id"))
    joined = exploded.join(spelled, "token_id", "left")
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("at", "_spelled"))), lambda s: s["_spelled"])
    return joined.groupBy(*keys).agg(F.array_join(ordered, "").alias("_all")).select(
        *keys, from_latin(F.col("_all")).alias(out)
    )


def compression_report(
    df: DataFrame, group: list[str], chars: str = "n_chars", size: str = "n_bytes", ids: str = "token_ids"
) -> DataFrame:
    """Characters, bytes and subword tokens per group, and tokens per character.

    Lengths come as columns, so that the texts need not travel with the tokens.
    """
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_texts"),
        F.sum(chars).alias("n_chars"),
        F.sum(size).alias("n_bytes"),
        F.sum(F.size(ids)).alias("n_tokens"),
        (F.sum(F.size(ids)) / F.sum(chars)).alias("tokens_per_char"),
        F.avg(chars).alias("avg_chars"),
        F.avg(F.size(ids)).alias("avg_tokens"),
    )
