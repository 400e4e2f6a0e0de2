"""Flat token files as a Spark data source: ``format("tokenbin")``.

A shard is an 8-byte header and little-endian ids. A folder written from Spark holds one
run of shards per split and a manifest that lists the committed ones; files of failed
task attempts are not in it. Reading splits shards by token range, so one large file is
read by many tasks. The manifest alone plans a read; filters on split, position and chunk are pushed
down, and shards and ranges that they rule out are not opened.
"""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)

from corpusloom.operators.vocabulary import WIDE_ID_SIZE
from corpusloom.sources.tables import STREAM_SCHEMA

# Fixed values of the file format.
MAGIC = b"TLLM"
VERSION = 1
HEADER = struct.Struct("<4sHH")
NARROW, WIDE = 0, 1

MANIFEST = "_manifest.json"
TOKENS_PER_TASK = 16_000_000
CHUNK = 8192


def id_type(code: int) -> np.dtype:
    """Code 0 is 16-bit; any other code is read as 32-bit."""
    return np.dtype("<u2") if code == NARROW else np.dtype("<u4")


def header(code: int) -> bytes:
    return HEADER.pack(MAGIC, VERSION, code)


def parse_header(raw: bytes, name: str) -> int:
    if len(raw) < HEADER.size or raw[:4] != MAGIC:
        raise ValueError(f"{name}: not a token file")
    _, version, code = HEADER.unpack(raw[: HEADER.size])
    if version != VERSION:
        raise ValueError(f"{name}: unsupported version {version}")
    return code


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """Local paths and the URIs Arrow knows (hdfs, s3, gs, file)."""
    if "://" in path or path.startswith("file:"):
        if path.startswith("file:") and not path.startswith("file://"):
            path = "file://" + path[len("file:") :]
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


@dataclass
class TokenRange(InputPartition):
    path: str
    split: str
    first: int  # token index inside the shard
    count: int
    start_pos: int  # of the shard in the stream
    code: int


@dataclass
class ShardsWritten(WriterCommitMessage):
    shards: list[dict]


class TokenBinReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.chunk = int(options.get("chunk", CHUNK))
        per_task = int(options.get("tokensPerTask", TOKENS_PER_TASK))
        self.per_task = max(per_task // self.chunk, 1) * self.chunk

        self.splits: set[str] | None = None  # those asked for, if any are named
        self.low, self.high = 0, None  # first and last position of the rows asked for

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """A split named by a filter is settled here; bounds of positions only rule ranges out."""
        for asked in filters:
            column = asked.attribute if isinstance(asked, (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)) else None
            if column == ("split",) and isinstance(asked, (EqualTo, In)):
                named = {asked.value} if isinstance(asked, EqualTo) else set(asked.value)
                self.splits = named if self.splits is None else self.splits & named
                continue
            if column in (("start_pos",), ("chunk_id",)) and not isinstance(asked, In) and asked.value is not None:
                # A chunk's row begins inside the chunk.
                width = self.chunk if column == ("chunk_id",) else 1
                if isinstance(asked, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    self.low = max(self.low, asked.value * width)
                if isinstance(asked, (EqualTo, LessThan, LessThanOrEqual)):
                    last = asked.value * width + width - 1
                    self.high = last if self.high is None else min(self.high, last)
            yield asked

    def _shards(self, fs: pafs.FileSystem, root: str) -> Iterator[tuple[str, str, int, int, int]]:
        """(file, split, start, tokens, code) of every shard: from the manifest, or one stream per plain file."""
        if fs.get_file_info(root).type == pafs.FileType.File:
            names = [root]
        else:
            manifest = f"{root}/{MANIFEST}"
            if fs.get_file_info(manifest).type == pafs.FileType.File:
                with fs.open_input_stream(manifest) as f:
                    listed = json.loads(f.read())
                for s in listed["shards"]:
                    if self.splits is None or s["split"] in self.splits:
                        yield f"{root}/{s['file']}", s["split"], s["start_pos"], s["n_tokens"], s.get("code", listed["dtype"])
                return
            names = [f.path for f in fs.get_file_info(pafs.FileSelector(root)) if f.path.endswith(".bin")]
        for name in names:
            split = name.rsplit("/", 1)[-1].removesuffix(".bin")
            if self.splits is None or split in self.splits:
                with fs.open_input_file(name) as f:
                    size, code = f.size(), parse_header(f.read(HEADER.size), name)
                yield name, split, 0, (size - HEADER.size) // id_type(code).itemsize, code

    def partitions(self) -> list[TokenRange]:
        fs, root = filesystem(self.path)
        ranges = []
        for name, split, start, total, code in self._shards(fs, root):
            for first in range(0, total, self.per_task):
                count = min(self.per_task, total - first)
                if start + first + count > self.low and (self.high is None or start + first <= self.high):
                    ranges.append(TokenRange(name, split, first, count, start, code))
        return ranges or [TokenRange("", "", 0, 0, 0, 0)]

    def read(self, partition: TokenRange) -> Iterator[pa.RecordBatch]:
        if not partition.count:
            return
        fs, _ = filesystem(self.path)
        kind = id_type(partition.code)
        with fs.open_input_file(partition.path) as f:
            code, needed = parse_header(f.read(HEADER.size), partition.path), partition.first + partition.count
            if id_type(code) != kind or f.size() < HEADER.size + needed * kind.itemsize:
                raise ValueError(f"{partition.path}: not the shard that the manifest lists")
            f.seek(HEADER.size + partition.first * kind.itemsize)
            done = 0
            while done < partition.count:
                at = partition.start_pos + partition.first + done
                n = min(self.chunk - at % self.chunk, partition.count - done)
                ids = np.frombuffer(f.read(n * kind.itemsize), kind).astype(np.int32)
                yield pa.RecordBatch.from_pydict(
                    {
                        "split": pa.array([partition.split]),
                        "chunk_id": pa.array([at // self.chunk], pa.int64()),
                        "start_pos": pa.array([at], pa.int64()),
                        "n_tokens": pa.array([n], pa.int64()),
                        "tokens": pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), pa.array(ids)),
                    }
                )
                done += n


class TokenBinWriter(DataSourceArrowWriter):
    """Each task writes its rows, which arrive in stream order, as contiguous shards."""

    def __init__(self, options: dict, overwrite: bool):
        self.path = options["path"]
        wide = int(options.get("vocabSize", 0)) > WIDE_ID_SIZE
        self.code = WIDE if wide else NARROW
        self.overwrite = overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> ShardsWritten:
        fs, root = filesystem(self.path)
        fs.create_dir(root, recursive=True)
        kind, attempt, shards, out = id_type(self.code), uuid.uuid4().hex, [], None
        try:
            for batch in iterator:
                rows = zip(
                    batch.column("split").to_pylist(),
                    batch.column("start_pos").to_pylist(),
                    batch.column("tokens"),
                )
                for split, start, tokens in rows:
                    open_shard = shards[-1] if shards else None
                    follows = open_shard and open_shard["split"] == split and (
                        open_shard["start_pos"] + open_shard["n_tokens"] == start
                    )
                    if not follows:
                        if out:
                            out.close()
                        name = f"{split}-{start:020d}-{attempt}.bin"
                        out = fs.open_output_stream(f"{root}/{name}")
                        out.write(header(self.code))
                        shards.append({"file": name, "split": split, "start_pos": start, "n_tokens": 0, "code": self.code})
                    ids = tokens.values.to_numpy(zero_copy_only=False)
                    if len(ids) and (ids.min() < 0 or ids.max() > np.iinfo(kind).max):
                        raise ValueError(f"token id outside {kind}: set the vocabSize option")
                    out.write(ids.astype(kind).tobytes())
                    shards[-1]["n_tokens"] += len(ids)
        finally:
            if out:
                out.close()
        return ShardsWritten(shards)

    def _listed(self, fs: pafs.FileSystem, root: str) -> list[dict]:
        manifest = f"{root}/{MANIFEST}"
        if fs.get_file_info(manifest).type != pafs.FileType.File:
            return []
        with fs.open_input_stream(manifest) as f:
            return json.loads(f.read())["shards"]

    def commit(self, messages: list[ShardsWritten | None]) -> None:
        """List the shards of the successful attempts; the manifest makes them visible."""
        fs, root = filesystem(self.path)
        fs.create_dir(root, recursive=True)
        before = [] if self.overwrite else self._listed(fs, root)
        shards = before + [s for m in messages if m for s in m.shards]
        shards.sort(key=lambda s: (s["split"], s["start_pos"]))
        with fs.open_output_stream(f"{root}/{MANIFEST}") as f:
            f.write(json.dumps({"dtype": self.code, "shards": shards}).encode())

    def abort(self, messages: list[ShardsWritten | None]) -> None:
        fs, root = filesystem(self.path)
        for message in messages:
            for shard in message.shards if message else []:
                fs.delete_file(f"{root}/{shard['file']}")


class TokenBinSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tokenbin"

    def schema(self) -> str:
        return STREAM_SCHEMA

    def reader(self, schema) -> TokenBinReader:
        return TokenBinReader(self.options)

    def writer(self, schema, overwrite: bool) -> TokenBinWriter:
        return TokenBinWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Make ``format("tokenbin")`` known; its reader takes filters, which a session must allow."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TokenBinSource)


def write_token_bin(stream: DataFrame, path: str, vocab_size: int) -> None:
    """Write a stream as shards in stream order; ids take 16 bits while the vocabulary allows."""
    spark = stream.sparkSession
    register(spark)
    ordered = stream.repartitionByRange("split", "start_pos").sortWithinPartitions("split", "start_pos")
    ordered.write.format("tokenbin").mode("overwrite").option("vocabSize", vocab_size).save(path)


def read_token_bin(spark: SparkSession, path: str, chunk: int = CHUNK) -> DataFrame:
    """A token file, a folder of them, or a folder written by :func:`write_token_bin`."""
    register(spark)
    return spark.read.format("tokenbin").option("chunk", chunk).load(path)
