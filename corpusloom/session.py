"""Session defaults and the staging of intermediate tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Of an Arrow batch of rows on their way to Python, unless the session asks for less.
BATCH_BYTES = 4 << 20
_BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def local_session(cores: int | str = 8, partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("corpusloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    ``spark.checkpoint.dir`` wins, then a folder set with ``setCheckpointDir``. Only a
    local master may fall back to a temporary folder, because a cluster's executors
    could not read each other's files there.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="corpusloom-")
    context.setCheckpointDir(folder)
    return folder


def stage_path(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_folder(spark), "corpusloom", f"{name}-{uuid.uuid4().hex}")


def stage(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once and go on from the written table.

    Cuts the lineage with a table that outlives lost executors, so that an expensive
    input (tokenised text) is computed once however many passes follow, and the later
    passes still prune columns and push filters into the parquet scan.
    """
    spark = df.sparkSession
    target = path or stage_path(spark, name)
    df.write.mode("overwrite").parquet(target)
    return spark.read.schema(df.schema).parquet(target)


def bound_batches(spark: SparkSession) -> None:
    """From now on the session sends rows to Python in batches of at most ``BATCH_BYTES`` or one row.

    A task holds its batch several times over, as growing vectors outside the JVM's heap and as
    arrays in its worker, and neither gives all of that back. A lower limit is left as it is.
    """
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", spark.conf.get(_BATCH_LIMIT).strip().lower()).groups()
    if int(number) << 10 * "_kmgtp".index(unit or "_") > BATCH_BYTES:
        spark.conf.set(_BATCH_LIMIT, str(BATCH_BYTES))


def task_count(spark: SparkSession) -> int:
    """Tasks per shuffle, as the session is sized."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame) -> DataFrame:
    """Deal rows over the cores when the scan yields fewer tasks than there are cores.

    Text work is bound by the processor, and one small file is one task. A corpus of many
    files is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
