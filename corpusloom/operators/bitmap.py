"""A set of hashes as a bitmap of fixed size: what may be broadcast however large the set is.

A test may say yes to a hash outside the set, never no to one inside; uses that must be
exact check again where the rows meet.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 27  # 16 MB
_PARTS = 11  # built in 2**11 parts


def bitmap_of(hashes: DataFrame) -> np.ndarray:
    """The bitmap of the column ``h`` (64-bit hashes as bigint), by their leading bits.

    Each part is built in a task of its own from the distinct bits, pre-aggregated on the
    map side; the driver gets ``2**BITS`` bits in all.
    """
    shift = BITS - _PARTS
    bits = F.shiftrightunsigned("h", 64 - BITS).cast("int").alias("bit")
    distinct = hashes.select(bits).distinct().select(F.shiftright("bit", shift).alias("part"), "bit")

    def packed(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        flags = np.zeros(1 << shift, bool)
        flags[table.column("bit").to_numpy() - (part << shift)] = True
        return pa.table({"part": pa.array([part], pa.int32()), "bits": pa.array([np.packbits(flags).tobytes()], pa.binary())})

    out = np.zeros(1 << (BITS - 3), np.uint8)
    step = 1 << (shift - 3)
    for row in distinct.groupBy("part").applyInArrow(packed, "part int, bits binary").collect():
        out[row["part"] * step : (row["part"] + 1) * step] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return out


def within(bitmap):
    """A test of a bigint column against a broadcast bitmap; only that column goes to Python."""

    @F.arrow_udf("boolean")
    def test(h: pa.Array) -> pa.Array:
        return pa.array(contains(bitmap.value, h.to_numpy(zero_copy_only=False).view(np.uint64)))

    return test


def among(hashes: DataFrame):
    """A test of a bigint column against the column ``h`` of ``hashes``."""
    return within(hashes.sparkSession.sparkContext.broadcast(bitmap_of(hashes)))


def contains(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = hashes >> np.uint64(64 - BITS)
    return (bitmap[(bit >> np.uint64(3)).astype(np.int64)] >> (np.uint64(7) - (bit & np.uint64(7))).astype(np.uint8)) & 1 > 0
