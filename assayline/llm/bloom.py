"""Blocked Bloom filters of 64-bit keys, of a bounded size, built by tasks and probed in numpy.

A filter has blocks of 256 bits; a key sets eight bits of one block, one in each of its words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits per key, the most bytes of a filter, and the blocks that one task makes.
BITS, LIMIT, PIECE = 16, 32 << 20, 1 << 14

# Odd multipliers, one per bit of a key.
_SALT = np.array([0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31], np.uint32)


def _blocks(keys: np.ndarray, n: int) -> np.ndarray:
    return (((keys >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


def _bits(keys: np.ndarray, i: int) -> np.ndarray:
    return (keys.astype(np.uint32) * _SALT[i]) >> np.uint32(27)


def fits(n: int, limit: int = LIMIT) -> bool:
    """Whether so many keys leave a filter of the largest size half its bits per key."""
    return n * BITS <= 2 * 8 * limit


def built(keys: DataFrame, n: int, limit: int = LIMIT) -> np.ndarray:
    """The words of the filter of ``n`` keys (column ``value``, long), at most ``limit`` bytes, on the driver."""
    blocks = max(1, min(limit // 32, -(-n * BITS // 256)))

    def build(group, rows):
        at = group[0].as_py()
        own = rows.column("value").to_numpy().view(np.uint64)
        held = np.zeros((min(PIECE, blocks - at * PIECE), 8), np.uint32)
        block = _blocks(own, blocks) - at * PIECE
        for i in range(8):
            np.bitwise_or.at(held, (block, i), np.uint32(1) << _bits(own, i))
        return pa.table({"piece": pa.array([at], pa.int64()), "bits": pa.array([held.tobytes()], pa.binary())})

    block = F.shiftright(F.shiftrightunsigned("value", 32) * F.lit(blocks).cast("long"), 32)
    pieces = keys.select("value", F.expr(f"{PIECE}L").alias("size"), block.alias("block")).selectExpr("value", "block div size as piece")
    words = np.zeros((blocks, 8), np.uint32)
    for r in pieces.groupBy("piece").applyInArrow(build, "piece bigint, bits binary").collect():
        part = np.frombuffer(r.bits, np.uint32).reshape(-1, 8)
        words[r.piece * PIECE : r.piece * PIECE + len(part)] = part
    return words


def known(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys the filter may hold."""
    keys = keys.view(np.uint64)
    at, block = np.arange(len(keys)), _blocks(keys, len(words))
    for i in range(8):
        hit = (words[block, i] >> _bits(keys[at], i)) & np.uint32(1) == 1
        at, block = at[hit], block[hit]
    found = np.zeros(len(keys), bool)
    found[at] = True
    return found
