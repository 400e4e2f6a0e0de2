"""Vocabularies: load, extend, or count one from a corpus."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import CHAT_TOKENS, END_OF_TEXT, SUBWORD_SPLIT, pieces

BASE_SIZE = 50_257  # fixed value: size of the published byte-level vocabulary
N_BYTES = 256
BROADCAST_ROWS = 1_000_000  # a larger vocabulary is joined by shuffling instead
WIDE_ID_SIZE = 65_536  # a larger vocabulary needs 32-bit ids on disk


@dataclass(frozen=True)
class Vocabulary:
    """Token table ``(token_id, token BINARY, is_special)`` plus its few scalars.

    ``size`` is an upper bound on ids, known without a job, so it also bounds whatever
    is broadcast.
    """

    table: DataFrame
    size: int
    eos_id: int
    pattern: str = SUBWORD_SPLIT
    specials: dict[str, int] = field(default_factory=dict)

    @property
    def broadcastable(self) -> bool:
        return self.size <= BROADCAST_ROWS

    def small(self, df: DataFrame) -> DataFrame:
        """Hint a table with at most one row per id, if ids are few enough."""
        return F.broadcast(df) if self.broadcastable else df

    def special(self, name: str) -> int:
        """Id of a chat token by its role name."""
        return self.specials[CHAT_TOKENS[name]]


def special_rows(spark: SparkSession, specials: dict[str, int]) -> DataFrame:
    rows = [(i, t.encode(), True) for t, i in specials.items()]
    return spark.createDataFrame(rows, "token_id int, token binary, is_special boolean")


def byte_rows(spark: SparkSession) -> DataFrame:
    """Ids 0..255: the single bytes."""
    return spark.range(N_BYTES).select(
        F.col("id").cast("int").alias("token_id"),
        F.unhex(F.lpad(F.hex("id"), 2, "0")).alias("token"),
        F.lit(False).alias("is_special"),
    )


def byte_vocabulary(spark: SparkSession) -> Vocabulary:
    """The 256 bytes and an end-of-text id."""
    specials = {END_OF_TEXT: N_BYTES}
    table = byte_rows(spark).unionByName(special_rows(spark, specials))
    return Vocabulary(table, N_BYTES + 1, N_BYTES, specials=specials)


def extend(vocab: Vocabulary, tokens: list[str] | None = None) -> Vocabulary:
    """Append special tokens (the four chat tokens by default) after the base ids."""
    names = list(CHAT_TOKENS.values()) if tokens is None else tokens
    added = {t: vocab.size + i for i, t in enumerate(names) if t not in vocab.specials}
    spark = vocab.table.sparkSession
    return replace(
        vocab,
        table=vocab.table.unionByName(special_rows(spark, added)),
        size=vocab.size + len(added),
        specials={**vocab.specials, **added},
    )


def count_pieces(df: DataFrame, text: str = "text", pattern: str = SUBWORD_SPLIT) -> DataFrame:
    """How often each piece occurs; combined map-side, so hot pieces shuffle once per task."""
    return (
        df.select(F.explode(pieces(F.col(text), pattern)).alias("piece"))
        .groupBy("piece")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def frequent_pieces(counts: DataFrame, room: int) -> DataFrame:
    """The ``room`` most frequent pieces of two bytes or more, numbered after the bytes."""
    top = counts.filter(F.octet_length("piece") > 1).orderBy(F.desc("n"), "piece").limit(room)
    ranked = top.agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "piece"))).alias("all"))
    return ranked.select(F.posexplode("all").alias("at", "entry")).select(
        (F.col("at") + N_BYTES).cast("int").alias("token_id"),
        F.encode("entry.piece", "UTF-8").alias("token"),
        F.lit(False).alias("is_special"),
    )


def piece_vocabulary(
    df: DataFrame, size: int, text: str = "text", pattern: str = SUBWORD_SPLIT
) -> Vocabulary:
    """Bytes, then the most frequent whole pieces, then end of text as the last id.

    A stand-in where no vocabulary file is at hand. Pieces outside it fall back to bytes,
    so every text can be encoded and decoded.
    """
    specials = {END_OF_TEXT: size - 1}
    spark = df.sparkSession
    table = (
        byte_rows(spark)
        .unionByName(frequent_pieces(count_pieces(df, text, pattern), size - 1 - N_BYTES))
        .unionByName(special_rows(spark, specials))
    )
    return Vocabulary(table, size, size - 1, pattern, specials)


def printable_byte_alphabet() -> dict[str, str]:
    """Printable stand-in character -> two hex digits, as byte-level vocabulary files spell bytes.

    Bytes that print stand for themselves; the others take the code points from 256 on.
    """
    prints = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    hidden = [b for b in range(N_BYTES) if b not in set(prints)]
    spelled = {chr(b): b for b in prints} | {chr(N_BYTES + i): b for i, b in enumerate(hidden)}
    return {c: f"{b:02X}" for c, b in spelled.items()}


def _spelled_bytes(token: Column) -> Column:
    entries = [F.lit(x) for pair in printable_byte_alphabet().items() for x in pair]
    alphabet = F.create_map(*entries)
    characters = F.filter(F.split(token, ""), lambda c: c != "")
    return F.unhex(F.array_join(F.transform(characters, lambda c: alphabet[c]), ""))


def read_vocab(
    spark: SparkSession,
    path: str,
    layout: str = "json",
    size: int = BASE_SIZE,
    specials: dict[str, int] | None = None,
) -> Vocabulary:
    """Load a byte-level vocabulary file.

    ``json``: one object, spelled token -> id. ``ranks``: lines of base64 token and rank;
    the special tokens are not in such a file. The default special is end of text as the
    last id. The file is counted once: ids beyond ``size``, or one of a special, are an
    error, as ``size`` bounds what is broadcast.
    """
    specials = {END_OF_TEXT: size - 1} if specials is None else specials
    if layout == "json":
        whole = spark.read.text(path, wholetext=True)
        entries = whole.select(F.explode(F.from_json("value", "map<string,int>")).alias("spelled", "token_id"))
        plain = entries.filter(~F.col("spelled").isin(*specials)).select(
            "token_id", _spelled_bytes(F.col("spelled")).alias("token")
        )
    elif layout == "ranks":
        parts = F.split("value", " ")
        plain = spark.read.text(path).filter("value <> ''").select(
            parts[1].cast("int").alias("token_id"), F.unbase64(parts[0]).alias("token")
        )
    else:
        raise ValueError(f"unknown vocabulary layout: {layout}")
    n, last, clash = plain.agg(
        F.count(F.lit(1)), F.max("token_id"), F.count_if(F.col("token_id").isin(*specials.values()))
    ).first()
    if n + len(specials) > size or (last or 0) >= size or clash:
        raise ValueError(f"{path}: {n} tokens up to id {last}, {clash} of them with a special id, do not fit a size of {size}")
    table = plain.withColumn("is_special", F.lit(False)).unionByName(special_rows(spark, specials))
    return Vocabulary(table, size, specials[END_OF_TEXT], SUBWORD_SPLIT, specials)


def write_vocab(vocab: Vocabulary, path: str) -> None:
    """Save the plain tokens as lines of base64 token and rank."""
    lines = vocab.table.filter(~F.col("is_special")).select(
        F.concat_ws(" ", F.base64("token"), F.col("token_id").cast("string")).alias("value")
    )
    lines.write.mode("overwrite").text(path)


def token_text(token: Column) -> Column:
    """Token bytes as the Latin-1 spelling that joins and concatenates byte for byte."""
    return F.decode(token, "ISO-8859-1")

