"""A model's rows in order of key, as one file on each executor that its workers read in blocks.

Rows are sorted by range and written as Parquet in the shared folder; ``addFile`` takes the
files to each executor. There one worker lays them out as records while the others wait. A
worker holds the first key of every block, and reads the few blocks of a key as it is asked for.
"""

from __future__ import annotations

import fcntl
import hashlib
import os
import uuid

import numpy as np
import pyarrow.parquet as pq
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from corpusloom.session import stage_path, task_count

RECORD = np.dtype([("key", "<i8"), ("id", "<i4"), ("hits", "<f8"), ("seen", "<f8"), ("lower", "<f8")])
BLOCK = 512  # records: 18 kB
READ_ROWS = 1 << 16


def publish(rows: DataFrame) -> list[str]:
    """Write the columns of ``RECORD`` in order of key, and send the files out; their names in order."""
    spark = rows.sparkSession
    path = stage_path(spark, "rows")
    ordered = rows.select(*RECORD.names).repartitionByRange(task_count(spark), "key").sortWithinPartitions("key", "id")
    ordered.write.parquet(path)
    files = sorted(spark.read.parquet(path).inputFiles(), key=os.path.basename)  # named by part
    for file in files:
        spark.sparkContext.addFile(file)
    return [os.path.basename(file) for file in files]


def _laid_out(folder: str, names: list[str]) -> str:
    own = os.path.join(folder, hashlib.md5(",".join(names).encode()).hexdigest())
    with open(f"{own}.lock", "w") as lock:
        fcntl.flock(lock, fcntl.LOCK_EX)
        if not os.path.exists(own):
            made, firsts, n = f"{own}-{uuid.uuid4().hex}", [np.zeros(0, np.int64)], 0
            with open(made, "wb") as out:
                for name in names:
                    for batch in pq.ParquetFile(os.path.join(folder, name)).iter_batches(READ_ROWS, columns=list(RECORD.names)):
                        records = np.empty(batch.num_rows, RECORD)
                        for field in RECORD.names:
                            records[field] = batch.column(batch.schema.get_field_index(field)).to_numpy()
                        records.tofile(out)
                        firsts.append(records["key"][-n % BLOCK :: BLOCK].copy())
                        n += len(records)
            np.save(f"{own}.npy", np.concatenate(firsts))
            os.rename(made, own)
    return own


class RowFile:
    """The records of a key: ``find``."""

    def __init__(self, names: list[str]):
        own = _laid_out(SparkFiles.getRootDirectory(), names)
        self.firsts = np.load(f"{own}.npy")
        self.file = os.open(own, os.O_RDONLY)

    def find(self, key: int) -> np.ndarray:
        first = max(int(self.firsts.searchsorted(key)) - 1, 0)
        end = int(self.firsts.searchsorted(key, "right"))
        size = BLOCK * RECORD.itemsize
        records = np.frombuffer(os.pread(self.file, max(end - first, 0) * size, first * size), RECORD)
        keys = records["key"]
        return records[keys.searchsorted(key) : keys.searchsorted(key, "right")]


_open: dict[tuple[str, ...], RowFile] = {}


def opened(names: list[str]) -> RowFile:
    """The rows of these files, opened once per worker."""
    key = tuple(names)
    if key not in _open:
        _open[key] = RowFile(names)
    return _open[key]
