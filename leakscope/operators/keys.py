"""Surrogate numbers: a dictionary of business keys, and positions of rows without one."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leakscope.sources.storage import cut

_ROW_BITS = 33  # monotonically_increasing_id keeps the row position in its low 33 bits


def _with_offsets(placed: DataFrame) -> DataFrame:
    """Written rows with ``_place`` in sort order, plus ``_number``: 1, 2, 3, ….

    Each partition's rows get their position plus the row count of the partitions before, a table with one row for each
    written partition, which bounds the broadcast side.
    """
    parted = placed.withColumn("_part", F.shiftright("_place", _ROW_BITS))
    sizes = parted.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    in_part = F.col("_place").bitwiseAND(F.lit(2**_ROW_BITS - 1))
    return parted.join(F.broadcast(offsets), "_part").withColumn("_number", F.col("_before") + in_part + 1)


def number_keys(keys: DataFrame, known: DataFrame | None = None) -> tuple[DataFrame, str | None]:
    """(key, number) of all business keys, and the least key that ``keys(key)`` has more than once.

    Keys of ``known(key, number)`` keep their numbers; new ones get the next numbers in key order, so a first load
    numbers 1, 2, 3, … by key. Two different keys never share a number, whatever they look like. Only distinct keys
    are shuffled and sorted, never the rows that have them. NULL has no number.
    """
    counted = cut(keys.where("key IS NOT NULL").groupBy("key").agg(F.count(F.lit(1)).alias("copies")), "keys")
    repeated = counted.where("copies > 1").agg(F.min("key")).first()[0]
    fresh = counted.select("key")
    if known is not None:
        fresh = fresh.join(known.select("key"), "key", "left_anti")
    placed = cut(fresh.orderBy("key").withColumn("_place", F.monotonically_increasing_id()), "keys-sorted")
    numbered = _with_offsets(placed).select("key", F.col("_number").alias("number"))
    if known is not None:
        last = F.coalesce(known.agg(F.max("number")).scalar(), F.lit(0))
        numbered = known.select("key", "number").unionByName(numbered.withColumn("number", F.col("number") + last))
    return numbered, repeated


def number_rows(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Adds ``name``: 1, 2, 3, … in the total order of ``order`` (NULLs first).

    ``order`` names all columns, so rows that tie are equal and any numbering
    among them is the same result. The sort is Spark's distributed range sort; the
    position in the stored scan breaks ties, so even a value that fills a third of
    the table is spread over many range partitions.
    """
    stored = cut(df, f"{name}-rows")
    place = F.monotonically_increasing_id()
    ordered = (
        stored.withColumn("_scan", place)
        .orderBy(*[F.col(column).asc_nulls_first() for column in order], "_scan")
        .drop("_scan")
        .withColumn("_place", place)
    )
    numbered = _with_offsets(cut(ordered, f"{name}-sorted"))
    return numbered.select(F.col("_number").alias(name), *df.columns)
