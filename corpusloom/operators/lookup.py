"""Whole pieces to ids inside Arrow batches, without a Python object per piece."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE_PIECES = 1 << 19  # pieces worked on at a time; a longer text is a slice of its own


def row_slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of whole rows that hold about ``most`` items, or one row with more."""
    ends = np.cumsum(sizes)
    first = 0
    while first < len(sizes):
        before = ends[first - 1] if first else 0
        end = max(first + 1, int(np.searchsorted(ends, before + most, "right")))
        yield first, end
        first = end


def _string_bytes(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes, and the length of each string."""
    strings = strings.cast(pa.large_string())
    _, offsets, data = strings.buffers()
    at = np.frombuffer(offsets, np.int64)[strings.offset : strings.offset + len(strings) + 1] if len(strings) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], np.diff(at)


def looked_up(pieces: pa.Array, known: pa.Array, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces one after the other, and how many each piece has: one, or one a byte."""
    index = pc.index_in(pieces, value_set=known)
    hit = index.is_valid().to_numpy(zero_copy_only=False)
    raw, lengths = _string_bytes(pieces)
    sizes = np.where(hit, 1, lengths)
    out = np.empty(int(sizes.sum()), np.int32)
    spelled = np.repeat(~hit, sizes)
    out[spelled] = raw[np.repeat(~hit, lengths)]
    out[~spelled] = ids[index.drop_null().to_numpy()]
    return out, sizes


def _by_place(ids: np.ndarray, sizes: np.ndarray, places: list[int]) -> np.ndarray:
    """The ids of one row's pieces in order of place, equal places by their ids."""
    parts = np.split(ids, np.cumsum(sizes)[:-1])
    order = sorted(range(len(parts)), key=lambda i: (places[i], parts[i].tolist()))
    return np.concatenate([parts[i] for i in order])


def piece_finder(known: DataFrame):
    """An Arrow function: pieces, and their places unless they are in order -> array of ids.

    ``known`` holds ``piece, token_id`` and goes to the tasks as two arrays.
    """
    rows = known.dropna(subset=["piece"]).select("piece", "token_id").dropDuplicates(["piece"]).collect()
    shared = known.sparkSession.sparkContext.broadcast(([r["piece"] for r in rows], [r["token_id"] for r in rows]))

    def find(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        known = pa.array(shared.value[0], pa.string())
        ids = np.array(shared.value[1], np.int32)
        for column, places in batches:
            counts = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            made, lengths = [], []
            for first, end in row_slices(counts, SLICE_PIECES):
                out, sizes = looked_up(column.slice(first, end - first).flatten(), known, ids)
                at = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts[first:end])])]
                for row in np.flatnonzero(places.slice(first, end - first).is_valid().to_numpy(zero_copy_only=False)):
                    if at[row] < at[row + 1]:
                        own = slice(int(counts[first : first + row].sum()), int(counts[first : first + row + 1].sum()))
                        out[at[row] : at[row + 1]] = _by_place(out[at[row] : at[row + 1]], sizes[own], places[first + int(row)].as_py())
                made.append(out)
                lengths.append(np.diff(at))
            ends = np.concatenate([[0], *lengths]).cumsum().astype(np.int32)
            values = pa.array(np.concatenate([np.zeros(0, np.int32), *made]), pa.int32())
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)

    return F.arrow_udf(find, "array<int>")
