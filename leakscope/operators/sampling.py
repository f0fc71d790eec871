"""Repeatable random picks: a seeded digest of the key replaces a random number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _digest(keys: list[str], seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(key).cast("string") for key in keys]))


def one_in(df: DataFrame, keys: list[str], n: int, seed: int = 0) -> DataFrame:
    """About one row in ``n``, chosen by key; needs no shuffle."""
    number = F.conv(F.substring(_digest(keys, seed), 1, 8), 16, 10).cast("bigint")
    return df.where(number % n == 0)


def random_top(df: DataFrame, keys: list[str], n: int, seed: int = 0) -> DataFrame:
    """``n`` rows in random order (for a small, fixed ``n``)."""
    return df.orderBy(_digest(keys, seed), *keys).limit(n)
