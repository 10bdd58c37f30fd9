"""Blocked Bloom filter: a key sets one bit in each of the eight 64-bit words of a single block.

It is built from 64-bit hashes by a grouped bitwise or, at most ``8 * MAX_BLOCKS`` numbers, whatever
the number of keys: only the share of false hits grows with them, never what the driver holds or is
broadcast (4 MB at most). An exact join has to follow.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BLOCKS = 1 << 16
BITS_PER_KEY = 16


def build(hashes: DataFrame, column: str = "hash") -> np.ndarray:
    """Blocks x 8 words; ``column`` holds 64-bit hashes of the keys."""
    n = hashes.count()
    blocks = 1
    while blocks < MAX_BLOCKS and blocks * 512 < n * BITS_PER_KEY:
        blocks *= 2
    h = F.col(column)
    bits = F.array(*[F.struct(F.lit(w).alias("word"), F.expr(
        f"shiftleft(1L, cast(shiftrightunsigned({column}, {6 * w}) & 63 as int))").alias("bit")) for w in range(8)])
    rows = hashes.select(F.shiftrightunsigned(h, 48).bitwiseAND(F.lit(blocks - 1)).alias("block"),
                         F.explode(bits).alias("x")).groupBy("block", "x.word").agg(F.bit_or("x.bit").alias("bits"))
    table = np.zeros((blocks, 8), np.int64)
    for block, word, value in rows.collect():  # at most 8 * MAX_BLOCKS rows
        table[block, word] = value
    return table


def may_hold(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each 64-bit hash may be among the keys; never false for a key."""
    h = hashes.view(np.uint64)
    block = table[(h >> np.uint64(48)).astype(np.int64) & (len(table) - 1)]
    found = np.ones(len(h), bool)
    for w in range(8):
        bit = (h >> np.uint64(6 * w)) & np.uint64(63)
        found &= (block[:, w].view(np.uint64) >> bit) & np.uint64(1) == 1
    return found
