"""A bitmap of fixed size over 64-bit hashes, to drop rows early before an exact join.

Its size does not depend on the data.  With more keys it lets more rows through;
the join behind it stays exact.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 25


def bitmap(hashes: DataFrame, column: str = "hash", bits: int = BITS) -> np.ndarray:
    """The top ``bits`` bits of each hash, as a bitmap of ``2**bits`` bits; at most ``2**(bits-6)`` words are gathered."""
    slot = f"shiftrightunsigned({column}, {64 - bits})"
    words = hashes.select(F.expr(f"shiftrightunsigned({slot}, 6)").alias("word"), F.expr(f"shiftleft(1L, cast({slot} & 63 as int))").alias("bit"))
    table = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[np.asarray(table.column("word"))] = np.asarray(table.column("bits"))
    return out.view(np.uint64)


def held(words: np.ndarray, hashes: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Which hashes have their bit set."""
    slot = hashes >> np.uint64(64 - bits)
    return (words[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
