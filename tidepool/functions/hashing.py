"""Key -> partition routing by the 128-bit MD5 of the key, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_mod(key: Column, n: int) -> Column:
    """int(md5(key), 16) % n, computed exactly in 64-bit arithmetic.

    The 32 hex digits are read as four 32-bit chunks and folded Horner-style, reducing mod n at every
    step: (r * 2^32 + chunk) % n stays below 2^63 for any n < 2^31.
    """
    if not 0 < n < 2 ** 31:
        raise ValueError("n must be in [1, 2^31)")
    h = F.md5(key.cast("string"))
    r = F.lit(0).cast("bigint")
    for i in range(4):
        chunk = F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("bigint")
        r = (r * F.lit(2 ** 32) + chunk) % F.lit(n)
    return r.cast("int")


def keyless_partition(n: int, *cols: Column) -> Column:
    """Partition for messages without a key: a seeded hash of the row (repeatable, unlike a random pick)."""
    return F.pmod(F.xxhash64(*cols), F.lit(n)).cast("int")
