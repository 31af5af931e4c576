"""Deduplication and sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def drop_metadata(df: DataFrame) -> DataFrame:
    """Drop bookkeeping columns (names starting with '_')."""
    return df.select(*[c for c in df.columns if not c.startswith("_")])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first by ``order``.

    ``row_number() == 1`` lets the planner put a partial WindowGroupLimit before the shuffle, so each
    map task already reduces every key to one row (a hot key ships one row per task, not all of them).
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def sample_fraction(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """Repeatable Bernoulli sample: a row is kept when a seeded hash of its key falls below the fraction.

    The hash is the first 32 bits of md5("seed:key"), uniform in [0, 2^32): it depends on the key only, so
    the sample survives task retries and re-reads identically (and any engine with md5 can reproduce it).
    """
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    prefix = F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")
    return df.where(prefix < F.lit(int(round(fraction * (1 << 32)))))


def sample_n(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly min(n, |df|) rows: the n smallest md5(seed:key) values (ties by key), one TakeOrderedAndProject."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")
