"""Rows that stand for, or turn into, several equal rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Most copies one row yields before its chunks are dealt over the tasks.
CHUNK = 65_536


def append_copies(df: DataFrame, wanted: str, number: str | None = None) -> DataFrame:
    """``df`` plus a second copy of the wanted rows, in one scan of ``df``; ``number`` is 1 on these, else 0."""
    copied = df.selectExpr("*", f"explode(if({wanted}, array(0, 1), array(0))) AS _copy")
    return copied.withColumnRenamed("_copy", number) if number else copied.drop("_copy")


def expand_copies(df: DataFrame, copies: str, number: str = "_copy") -> DataFrame:
    """Each row ``copies`` times, with a running ``number`` in place of ``copies``.

    Every row is first cut into chunks of up to ``CHUNK`` copies, which Spark
    rebalances over the tasks, so that no task and no array ever holds all
    copies of a hot row. The number makes copies distinct, so that a sort on it
    last can split them as well.
    """
    kept = [column for column in df.columns if column != copies]
    chunks = df.withColumn("_start", F.expr(f"explode(sequence(0L, {copies} - 1, {CHUNK}L))")).hint("rebalance")
    last = f"least(_start + {CHUNK}, {copies})"
    return chunks.select(*kept, F.expr(f"explode(sequence(_start + 1, {last}))").alias(number))
