"""Versions of a model under one folder: what the log lists is saved, nothing else is.

A version is written to a folder of its own first, then one row is appended to the log, which
commits it: a run that dies in between leaves a folder that nobody reads. Latest and best are read
from the log, so no pointer can be half moved. Versions that retention gives up are first
listed as forgotten, then deleted, so that no reader is sent to a folder that is going.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.language_model import NgramModel, load_model, save_model
from corpusloom.sources.tokenbin import filesystem

KEEP = 3
LOG = "name string, number int, step int, val_loss double, config string"
LATEST, BEST = "latest", "best"


def _appended(spark: SparkSession, rows: list[tuple], schema: str, path: str) -> None:
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    fs, root = filesystem(path)
    there = fs.get_file_info(root).type.name == "Directory"
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


def versions(spark: SparkSession, root: str) -> DataFrame:
    """``name, number, step, val_loss, config`` of every version that can be loaded."""
    return _read(spark, f"{root}/log", LOG).join(_read(spark, f"{root}/forgotten", "name string"), "name", "left_anti")


def save_version(model: NgramModel, root: str, config: dict, keep: int = KEEP) -> str:
    """Save and commit a version; older ones go, but for the last ``keep`` and the best. Returns its name."""
    spark = model.counts.sparkSession
    number = 1 + (_read(spark, f"{root}/log", LOG).agg(F.max("number")).first()[0] or 0)
    name = f"v{number:06d}-{uuid.uuid4().hex[:8]}"
    save_model(model, f"{root}/{name}")
    _appended(spark, [(name, number, model.step, float(model.val_loss), json.dumps(config, sort_keys=True))], LOG, f"{root}/log")
    forget(spark, root, keep)
    return name


def forget(spark: SparkSession, root: str, keep: int) -> None:
    """Delete all versions but the last ``keep`` and the best."""
    listed = versions(spark, root).orderBy(F.desc("number"), F.desc("name")).collect()
    best = pick(spark, root, BEST)
    old = [r["name"] for r in listed[max(keep, 1) :] if r["name"] != best]
    if old:
        _appended(spark, [(name,) for name in old], "name string", f"{root}/forgotten")
        fs, folder = filesystem(root)
        for name in old:
            fs.delete_dir(f"{folder}/{name}")


def pick(spark: SparkSession, root: str, which: str) -> str | None:
    """The name of the latest or best version (of equal ones the earlier; a loss that is no number is worst)."""
    order = (F.desc("number"), F.desc("name")) if which == LATEST else (F.asc("val_loss"), F.asc("number"), F.asc("name"))
    row = versions(spark, root).orderBy(*order).first()
    return row["name"] if row else None


def load_version(spark: SparkSession, root: str, which: str = LATEST) -> tuple[NgramModel, dict]:
    """A version by name, or the latest or best one, with its configuration."""
    name = pick(spark, root, which) if which in (LATEST, BEST) else which
    row = versions(spark, root).filter(F.col("name") == name).first() if name else None
    if row is None:
        raise LookupError(f"no version {which} in {root}")
    return load_model(spark, f"{root}/{name}"), json.loads(row["config"])
