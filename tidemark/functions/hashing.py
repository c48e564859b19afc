"""Bit offset of the distinct-visitor bitmap.

The original keeps one bit per hashed user id in a 2^29-bit map per window and
counts the bits it sets.  The hash is the polynomial ``h = h * seed + char``
over the id's characters in 32-bit arithmetic, then masked to the low bits.
Reducing modulo 2^bits at every step keeps exactly those low bits, so the same
offset comes out of 64-bit arithmetic without overflow.  The expression is a
Spark higher-order function (JVM side, no Python).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.constants import BITMAP_LOG2_BITS, BITMAP_SEED


def bitmap_offset(value: Column, log2_bits: int = BITMAP_LOG2_BITS,
                  seed: int = BITMAP_SEED) -> Column:
    """Offset in ``[0, 2^log2_bits)`` of ``value`` rendered as a string."""
    modulus = F.lit(1 << log2_bits).cast("bigint")
    chars = F.transform(F.split(value.cast("string"), ""), lambda ch: F.ascii(ch).cast("bigint"))
    return F.aggregate(chars, F.lit(0).cast("bigint"),
                       lambda acc, ch: F.pmod(acc * F.lit(seed) + ch, modulus))
