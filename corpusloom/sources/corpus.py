"""Corpora, instruction sets and prompts as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The prompts of the evaluation and of the samples while training.
EVALUATION_PROMPTS = (
    "The meaning of life is",
    "In a distant galaxy,",
    "The best way to learn programming is",
    "Once upon a time, there was a",
    "Artificial intelligence will",
    "The capital of France is",
)
TRAINING_PROMPTS = (
    "The meaning of life is",
    "In a distant galaxy, scientists discovered",
)

INSTRUCTION_SCHEMAS = {
    "dolly": "instruction string, context string, response string",
    "alpaca": "instruction string, input string, output string",
}
FILE_FORMATS = ("parquet", "json", "csv", "text", "orc")


def read_corpus(
    spark: SparkSession,
    path: str | list[str],
    file_format: str = "parquet",
    text: str = "text",
    doc_id: str | None = None,
    keep: tuple[str, ...] = (),
    schema: str | None = None,
) -> DataFrame:
    """``doc_id``, ``text`` and the columns to keep; the scan reads nothing else.

    Without an id column the id is a hash of file, row and text. Parquet numbers the rows
    of a file; other formats count within an input split, so their ids hold as long as the
    files are split the same way.
    """
    if file_format not in FILE_FORMATS:
        raise ValueError(f"unknown file format: {file_format}")
    reader = spark.read.schema(schema) if schema else spark.read
    if file_format == "csv":
        reader = reader.option("header", True).option("multiLine", True).option("escape", '"')
    table = reader.format(file_format).load(path)
    source = "value" if file_format == "text" else text
    if doc_id:
        return table.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("text"), *keep)
    row = [F.col("_metadata.row_index")]
    if file_format != "parquet":
        row = [F.col("_metadata.file_block_start"), F.monotonically_increasing_id()]
    place = F.concat_ws(":", F.col("_metadata.file_path"), *[c.cast("string") for c in row])
    return table.select(
        F.sha2(F.concat_ws(":", place, F.col(source)), 256).alias("doc_id"), F.col(source).alias("text"), *keep
    )


def select_subset(df: DataFrame, subset: str | list[str] | None, column: str = "source") -> DataFrame:
    """One or several named subsets; none or an empty name means all of it."""
    if not subset:
        return df
    names = [subset] if isinstance(subset, str) else list(subset)
    return df.filter(F.col(column).isin(*names))


def _finished(spark: SparkSession, path: str) -> bool:
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def materialise(df: DataFrame, root: str, subset: str | None = None) -> DataFrame:
    """Write the raw corpus under ``raw/<subset or data>`` once; later calls reuse it.

    A folder without a success marker is an unfinished write and is written again.
    """
    spark = df.sparkSession
    path = f"{root}/raw/{subset or 'data'}"
    if not _finished(spark, path):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_instructions(spark: SparkSession, path: str, style: str, file_format: str = "json") -> DataFrame:
    """An instruction dataset with the fields of its layout; generic ones keep their own."""
    schema = INSTRUCTION_SCHEMAS.get(style)
    reader = spark.read.schema(schema) if schema and file_format == "json" else spark.read
    table = reader.format(file_format).load(path)
    return table.selectExpr(*[f.split()[0] for f in schema.split(", ")]) if schema else table


def prompt_table(spark: SparkSession, prompts: tuple[str, ...] = EVALUATION_PROMPTS) -> DataFrame:
    return spark.createDataFrame(list(enumerate(prompts)), "prompt_id int, prompt string")
