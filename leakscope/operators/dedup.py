"""Keep one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_one(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """One row per key, the first in ``order``.

    Spark applies the limit of one row per key before the shuffle as well as
    after it, so each task sends at most one row per key however many copies a
    key has, and columns that nobody reads are pruned.
    """
    ranked = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")
