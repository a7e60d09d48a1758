"""Membership in large key sets: a filter sized by its keys, then an exact join.

A filter is a split-block Bloom filter: a key's hash names one block of 256 bits
and one bit in each of its eight words.  Its size follows the number of keys
(``BITS`` bits a key, so about one of 260 other keys passes, at any number), and it
is built by an aggregate over blocks, natively.  Tests read one column of hashes
through Arrow; what passes goes to the exact join, so results never depend on the
filter.  Above ``MAX_BYTES`` there is no filter, and all rows go to the join.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS, MAX_BYTES, WORDS = 16, 256 << 20, 8
#: Odd multipliers of a split-block filter's eight words, as Parquet's format has them: fixed values.
_SALT = (0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31)


def hashed(*columns: str) -> Column:
    """The hash of a key of one column or several; null where the first is null, since null is no key."""
    return F.when(F.col(columns[0]).isNotNull(), F.xxhash64(*columns))


def blocks_for(keys: int, bits: int = BITS) -> int:
    return max(1, math.ceil(keys * bits / 256))


class Membership:
    """Which hashes may belong to the set: all of its own, and few others."""

    def __init__(self, words: np.ndarray):
        self.words = words  # (blocks, 8) of 32 bits

    @classmethod
    def empty(cls, keys: int, bits: int = BITS) -> Membership:
        return cls(np.zeros((blocks_for(keys, bits), WORDS), np.uint32))

    def place(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(block, eight masks) of each hash."""
        h = hashes.view(np.uint64)
        block = ((h >> np.uint64(32)) * np.uint64(len(self.words)) >> np.uint64(32)).astype(np.int64)
        low = (h & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        bit = (low[:, None] * np.array(_SALT, np.uint32)) >> np.uint32(27)
        return block, np.uint32(1) << bit

    def add(self, hashes: np.ndarray) -> None:
        block, masks = self.place(hashes)
        order = np.argsort(block)
        first = np.flatnonzero(np.diff(block[order], prepend=-1))
        if first.size:
            self.words[block[order[first]]] |= np.bitwise_or.reduceat(masks[order], first, axis=0)

    def may_have(self, hashes: np.ndarray, step: int = 1 << 16) -> np.ndarray:
        out = np.empty(len(hashes), bool)
        for s in range(0, len(hashes), step):
            block, masks = self.place(hashes[s : s + step])
            out[s : s + step] = ((self.words[block] & masks) == masks).all(1)
        return out


def _words(blocks: int) -> list[Column]:
    """The block of a hash ``h`` and its eight masks, as ``Membership.place`` has them."""
    high, low = F.shiftrightunsigned("h", 32), F.col("h").bitwiseAND(0xFFFFFFFF)
    block = F.shiftrightunsigned(high * F.lit(blocks), 32).alias("block")
    # the product of two 32-bit numbers modulo 2 ** 32, from parts that fit a long
    product = lambda salt: (((F.shiftrightunsigned(low, 16) * salt).bitwiseAND(0xFFFF) * 65536) + low.bitwiseAND(0xFFFF) * salt).bitwiseAND(0xFFFFFFFF)
    masks = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(product(s), 27).cast("int")).alias(f"m{k}") for k, s in enumerate(_SALT)]
    return [block, *masks]


def membership(keys: DataFrame, *columns: str, count: int | None = None, bits: int = BITS, max_bytes: int = MAX_BYTES) -> Membership | None:
    """The filter of the keys in ``columns``; None where it would be larger than ``max_bytes``.  ``count`` saves counting them."""
    count = keys.count() if count is None else count
    blocks = blocks_for(count, bits)
    if blocks * WORDS * 4 > max_bytes or blocks >= 1 << 31:
        return None
    placed = keys.select(hashed(*columns).alias("h")).where("h is not null").select(*_words(blocks))
    rows = placed.groupBy("block").agg(*(F.bit_or(f"m{k}").alias(f"m{k}") for k in range(WORDS))).toArrow()  # the filter's own size
    found = Membership(np.zeros((blocks, WORDS), np.uint32))
    at = rows.column("block").to_numpy()
    for k in range(WORDS):
        found.words[at, k] = rows.column(f"m{k}").to_numpy().astype(np.uint32)
    return found


def may_belong(df: DataFrame, sought: Membership, *columns: str) -> Column:
    """Whether a row's key may belong to the set; false for null keys."""
    sent = df.sparkSession.sparkContext.broadcast(sought.words)

    @F.pandas_udf("boolean")
    def test(h: pd.Series) -> pd.Series:
        return pd.Series(Membership(sent.value).may_have(h.to_numpy(np.int64)))

    key = hashed(*columns)
    return key.isNotNull() & test(F.coalesce(key, F.lit(0).cast("long")))


def within(df: DataFrame, keys: DataFrame, on: list[str], **size) -> DataFrame:
    """The rows of ``df`` whose key is among ``keys``; only those that pass the filter are dealt out for the join."""
    sought = membership(keys, *on, **size)
    rows = df if sought is None else df.where(may_belong(df, sought, *on))
    return rows.join(keys.select(*on).distinct(), on, "left_semi")


def unseen(df: DataFrame, seen: DataFrame, on: list[str], **size) -> DataFrame:
    """The rows of ``df`` whose key is not among ``seen``, those with a null key included.

    A row that the filter stops stays where it is; only the others are joined.
    """
    sought = membership(seen, *on, **size)
    keys = seen.select(*on).distinct()
    if sought is None:
        return df.join(keys, on, "left_anti")
    flagged = df.withColumn("__maybe", may_belong(df, sought, *on))
    new = flagged.where(~F.col("__maybe")).drop("__maybe")
    return new.unionByName(flagged.where("__maybe").drop("__maybe").join(keys, on, "left_anti")).select(df.columns)
