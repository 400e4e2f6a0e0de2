"""Arrow batches in, extra columns out: the frame around the operators' NumPy code.

Spark partitions the rows; a task sees one Arrow batch at a time, so memory is bounded by
the session's batch size and the longest text, not by the partition.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Bytes of text worked on at a time; a longer text is a chunk of its own. Its arrays take some fifty times that.
CHUNK = 1 << 18


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front until no column has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def add_columns(
    df: DataFrame,
    fields: list[T.StructField],
    work: Callable[[pa.RecordBatch], list],
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """Append to each row what ``work`` makes of its batch; ``drop`` leaves columns behind.

    Row-wise: no shuffle, rows keep their partitions. ``work`` gets a record batch with all
    columns of ``df`` and returns one sequence per field. It must be picklable.
    """
    kept = [f for f in df.schema.fields if f.name not in drop]
    schema = T.StructType(kept + fields)
    names = [f.name for f in kept]
    new_names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = work(batch)
            arrays = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays(
                arrays + [a if isinstance(a, pa.Array) else pa.array(a) for a in new], names + new_names
            )

    return df.mapInArrow(run, schema)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and where each begins (one entry more than texts); null is empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    starts = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[starts[0] : starts[-1]], starts - starts[0]


def text_chunks(texts: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, starts)`` for runs of whole texts of about ``size`` bytes."""
    data, starts = text_bytes(texts)
    first, n = 0, len(starts) - 1
    while first < n:
        end = int(np.searchsorted(starts, starts[first] + size, "right")) - 1
        end = min(n, max(first + 1, end))
        yield first, end, data[starts[first] : starts[end]], starts[first : end + 1] - starts[first]
        first = end
