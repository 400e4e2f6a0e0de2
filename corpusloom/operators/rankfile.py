"""Ranks of a vocabulary too large for a dictionary in every Python worker.

The tokens are sorted by the first eight bytes of their MD5 and written as Parquet in the
shared folder; ``addFile`` takes the files to each executor. There the first worker lays
them out as flat arrays, which all workers of the executor map into memory, so that they
share one copy. A look-up is a binary search by hash, then a comparison of the bytes, so
tokens or pieces of equal hash are told apart.
"""

from __future__ import annotations

import hashlib
import os
import uuid

import numpy as np
import pyarrow.parquet as pq
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import stage_path, task_count

KEY_BYTES = 8
MEMO_RANKS = 1_000_000  # looked-up strings remembered by one worker


def publish(tokens: DataFrame) -> list[str]:
    """Write ``token_id, token`` in order of hash, and send the files out; their names in order."""
    spark = tokens.sparkSession
    path = stage_path(spark, "ranks")
    key = F.substring(F.unhex(F.md5("token")), 1, KEY_BYTES)
    ordered = tokens.select(key.alias("key"), "token_id", "token")
    ordered = ordered.repartitionByRange(task_count(spark), "key").sortWithinPartitions("key", "token_id")
    ordered.write.parquet(path)
    files = sorted(spark.read.parquet(path).inputFiles(), key=os.path.basename)  # named by part
    for file in files:
        spark.sparkContext.addFile(file)
    return [os.path.basename(file) for file in files]


class RankFile:
    """What the encoder asks of a table of ranks: ``in``, ``[]``, ``get`` and ``len``."""

    def __init__(self, names: list[str]):
        folder = SparkFiles.getRootDirectory()
        own = os.path.join(folder, hashlib.md5(",".join(names).encode()).hexdigest())
        if not os.path.exists(own):
            self._lay_out([os.path.join(folder, n) for n in names], own)
        self.keys, self.ids, self.ends, self.bytes = (
            np.load(os.path.join(own, f"{part}.npy"), mmap_mode="r") for part in ("keys", "ids", "ends", "bytes")
        )
        self.memo: dict[bytes, int | None] = {}

    @staticmethod
    def _lay_out(files: list[str], own: str) -> None:
        keys, ids, sizes, spelled = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], []
        for file in files:
            table = pq.read_table(file)
            keys.append(np.frombuffer(b"".join(table.column("key").to_pylist()), ">u8").astype(np.uint64))
            ids.append(table.column("token_id").to_numpy().astype(np.int32))
            tokens = table.column("token").to_pylist()
            sizes.append(np.fromiter(map(len, tokens), np.int64, len(tokens)))
            spelled.append(b"".join(tokens))
        made = f"{own}-{uuid.uuid4().hex}"
        os.mkdir(made)
        ends = np.append(0, np.cumsum(np.concatenate(sizes)))
        # An empty file cannot be mapped, hence the byte behind the last token.
        parts = {"keys": np.concatenate(keys), "ids": np.concatenate(ids), "ends": ends, "bytes": np.frombuffer(b"".join(spelled) + b"\0", np.uint8)}
        for name, values in parts.items():
            np.save(os.path.join(made, f"{name}.npy"), values)
        try:
            os.rename(made, own)
        except OSError:  # another worker was first; its arrays are the same
            if not os.path.exists(own):
                raise

    def _find(self, token: bytes) -> int | None:
        key = np.uint64(int.from_bytes(hashlib.md5(token, usedforsecurity=False).digest()[:KEY_BYTES], "big"))
        at = int(self.keys.searchsorted(key))
        while at < len(self.keys) and self.keys[at] == key:
            if self.bytes[self.ends[at] : self.ends[at + 1]].tobytes() == token:
                return int(self.ids[at])
            at += 1
        return None

    def get(self, token: bytes, default=None):
        if token in self.memo:
            found = self.memo[token]
        else:
            if len(self.memo) >= MEMO_RANKS:
                self.memo.clear()
            found = self.memo[token] = self._find(token)
        return default if found is None else found

    def __contains__(self, token: bytes) -> bool:
        return self.get(token) is not None

    def __getitem__(self, token: bytes) -> int:
        found = self.get(token)
        if found is None:
            raise KeyError(token)
        return found

    def __len__(self) -> int:
        return len(self.ids)


_open: dict[tuple[str, ...], RankFile] = {}


def opened(names: list[str]) -> RankFile:
    """The ranks of these files, opened once per worker."""
    key = tuple(names)
    if key not in _open:
        _open[key] = RankFile(names)
    return _open[key]
