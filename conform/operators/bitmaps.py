"""Bitmaps of a fixed size over any number of keys, in DataFrame functions."""

from __future__ import annotations

import struct

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 20  # 128 KB


def key_hash(*cols: str | Column) -> Column:
    return F.xxhash64(*cols)


def bitmap(df: DataFrame, hashed: Column, bits: int = BITS) -> bytes:
    """A bit per residue of the hashes; an action. Tasks merge their words first, so ``bits`` / 64 words at most reach the driver.

    A key that is there is always found. One that is not passes with a chance of about keys / ``bits``, so
    a bitmap thins rows before an exact test and decides nothing itself.
    """
    at = F.pmod(hashed, F.lit(bits))
    word, bit = (at / 64).cast("int").alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int")).alias("bit")
    words = {r["word"]: r["bits"] for r in df.select(word, bit).groupBy("word").agg(F.bit_or("bit").alias("bits")).collect()}
    return struct.pack(f"<{bits // 64}q", *[words.get(i, 0) for i in range(bits // 64)])


def maybe_in(packed: bytes, hashed: Column) -> Column:
    """Whether the bitmap may hold a hash; it is a literal of the plan. NULL for NULL."""
    at = F.pmod(hashed, F.lit(len(packed) * 8))
    byte = F.conv(F.hex(F.substring(F.lit(packed), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
