"""Sets of hashes as bitmaps of a fixed size, so that they can be broadcast whatever the table's size.

A hash that is in the set always has its bit; one that isn't may share another's.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 24


def has(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which hashes have their bit set."""
    low = h & np.uint64((1 << BITS) - 1)
    return ((bits[low >> np.uint64(3)] >> (low & np.uint64(7)).astype(np.uint8)) & 1) > 0


def bitmap(hashes: DataFrame, column: str) -> np.ndarray:
    """Which of 2^24 hash ends are those of ``column``: 2 MB whatever their number."""
    place = F.col(column).bitwiseAND((1 << BITS) - 1) + 1  # the functions count places from one
    rows = hashes.select(F.bitmap_bucket_number(place).alias("k"), F.bitmap_bit_position(place).alias("at")).groupBy("k").agg(F.bitmap_construct_agg("at").alias("bits")).collect()
    out = np.zeros((1 << BITS) // 8, np.uint8)
    for r in rows:
        part = np.frombuffer(bytes(r["bits"]), np.uint8)
        begin = (r["k"] - 1) * 4096
        out[begin : begin + len(part)] |= part
    return out
