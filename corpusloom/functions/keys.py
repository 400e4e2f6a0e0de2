"""Seeded hashes: the stand-in for a random generator.

Every "random" choice is a function of (seed, key), so it does not depend on
partitioning, and a task that is run again makes the same choice.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKET_DIGITS = 4  # 65,536 buckets: the bound on every per-bucket table
HASH_DIGITS = 15  # 60 bits, the most that fits a signed BIGINT in whole hex digits


def _text(part) -> Column:
    return part.cast("string") if isinstance(part, Column) else F.lit(str(part))


def joined(*parts) -> Column:
    """``a:b:c`` out of literals and columns."""
    return F.concat_ws(":", *[_text(p) for p in parts])


def order_key(seed, *key) -> Column:
    """A seeded order over unique keys; the key itself breaks hash ties."""
    return F.concat(F.md5(joined(seed, *key).cast("binary")), F.lit(":"), joined(*key))


def bucket_of(ordered: Column) -> Column:
    """The leading hash digits: buckets are contiguous and even in the seeded order."""
    return F.substring(ordered, 1, BUCKET_DIGITS)


def hash60(*parts) -> Column:
    """A 60-bit non-negative integer from the parts."""
    digest = F.md5(joined(*parts).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("bigint")


def uniform(*parts) -> Column:
    """A double in [0, 1) from the parts."""
    return hash60(*parts).cast("double") / F.lit(float(2**60))
