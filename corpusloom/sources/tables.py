"""Parquet token streams and JSON lines of fine-tuning examples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

STREAM_SCHEMA = "split string, chunk_id bigint, start_pos bigint, n_tokens bigint, tokens array<int>"
EXAMPLE_SCHEMA = "token_ids array<int>, loss_mask array<int>"


def write_stream(stream: DataFrame, path: str) -> None:
    """A folder per split, chunks in order inside each file, so chunk ranges prune well."""
    ordered = stream.repartitionByRange("split", "chunk_id").sortWithinPartitions("split", "chunk_id")
    ordered.write.mode("overwrite").partitionBy("split").parquet(path)


def read_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STREAM_SCHEMA).parquet(path)


def write_examples(examples: DataFrame, path: str) -> None:
    """One object with ``token_ids`` and ``loss_mask`` per line."""
    examples.select("token_ids", "loss_mask").write.mode("overwrite").json(path)


def read_examples(spark: SparkSession, path: str, keep_place: bool = False) -> DataFrame:
    """Examples back, with the schema given; optionally with a key from file and line."""
    table = spark.read.schema(EXAMPLE_SCHEMA).json(path)
    if not keep_place:
        return table
    return table.selectExpr(
        "concat_ws(':', _metadata.file_name, _metadata.file_block_start,"
        " monotonically_increasing_id() & 8589934591) AS example_id",
        "token_ids",
        "loss_mask",
    )
