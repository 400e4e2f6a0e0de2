"""Row-wise operators over a growing folder of files.

Encoding and tensor shaping keep no state across rows, so they take a streaming
DataFrame as it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.functions.arrays import ints
from corpusloom.functions.text import missing
from corpusloom.operators.chat import frame_mask, framed
from corpusloom.operators.examples import to_tensors
from corpusloom.operators.prepare import chat_sides, drop_long
from corpusloom.operators.tokenize import tokenize
from corpusloom.operators.vocabulary import Vocabulary


def instruction_tensors(rows: DataFrame, style: str, vocab: Vocabulary, keep: list[str], seq_length: int) -> DataFrame:
    """Instruction rows to ``x, y`` without any grouping: both turns are framed in the row."""
    user, assistant = chat_sides(rows, style)
    sides = rows.select(*keep, user.alias("user"), assistant.alias("assistant")).filter(
        ~missing(F.col("user")) & ~missing(F.col("assistant"))
    )
    coded = tokenize(tokenize(sides, vocab, "user", "user_ids"), vocab, "assistant", "assistant_ids")
    ids, masks = [], []
    for role in ("user", "assistant"):
        coded = coded.withColumn(f"{role}_role", F.lit(role))
        ids.append(framed(vocab, f"{role}_role", f"{role}_ids"))
        masks.append(frame_mask(f"{role}_role", f"{role}_ids"))
    examples = coded.select(
        *keep,
        ints(F.concat(*ids, F.array(F.lit(vocab.eos_id)))).alias("token_ids"),
        ints(F.concat(*masks, F.array(F.lit(0)))).alias("loss_mask"),
    )
    return to_tensors(drop_long(examples, seq_length), seq_length)


def follow_instructions(
    spark: SparkSession,
    source: str,
    schema: str,
    style: str,
    vocab: Vocabulary,
    keep: list[str],
    seq_length: int,
    sink: str,
    checkpoint: str,
) -> StreamingQuery:
    """Encode every file that has arrived in ``source`` (JSON) and append it to ``sink``."""
    rows = spark.readStream.schema(schema).json(source)
    tensors = instruction_tensors(rows, style, vocab, keep, seq_length)
    return (
        tensors.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
