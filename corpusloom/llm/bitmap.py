"""The bitmap of hashes, which other operators share."""

from corpusloom.operators.bitmap import BITS, bitmap_of, contains, within

__all__ = ["BITS", "bitmap_of", "contains", "within"]
