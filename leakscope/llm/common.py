"""What several operators share: documents, intermediate tables, word expressions, running totals."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leakscope.sources.storage import shared_folder

#: Words of white-space separated text; words of letters, digits and all non-ASCII characters.
WORD = r"[^\x20\x09-\x0D]+"
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when the query inside ends; else they stay until the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the folder that all executors share and go on from the written table."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"
    with _shuffles_freed(spark):
        df.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written._cut_path = path
    return written


def drop(*written: DataFrame) -> None:
    """Delete tables that ``cut`` wrote; nothing lazy that reads them may be used afterwards."""
    for df in written:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._cut_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def split(df: DataFrame, content: Column, keys: DataFrame, bits: int) -> tuple[DataFrame, DataFrame]:
    """Rows whose content may be one of ``keys(content)``, and rows that surely have none; null is none.

    ``bits``: of the map that tells them; a full map costs time, no results.
    """
    words = (keys.select(F.expr(f"pmod(content, {bits}) div 64").alias("__word"),
                         F.expr("shiftleft(1L, int(pmod(content, 64)))").alias("__bit"))
             .groupBy("__word").agg(F.bit_or("__bit").alias("__bits")))  # bits / 64 rows at most
    marked = df.withColumn("__at", content).join(
        F.broadcast(words), F.expr(f"pmod(__at, {bits}) div 64") == F.col("__word"), "left")
    may_be = F.expr("coalesce(getbit(__bits, int(pmod(__at, 64))) = 1, false)")
    return tuple(marked.where(x).drop("__at", "__word", "__bits") for x in (may_be, ~may_be))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, nothing else."""
    return F.translate(text, _UPPER, _LOWER)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0))


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Documents whose id is not in ``gone(doc_id)``; ids may be null, other columns may have any name."""
    gone = gone.select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["__gone"]), "left_anti")


def running_total(df: DataFrame, order: list[str], amount: str, total: str, label: str) -> DataFrame:
    """``df`` with the running sum of ``amount`` over all rows, in the order of the columns ``order``.

    The rows are dealt by range into partitions of about equal numbers and written once. The sums of the partitions,
    one row for each, give every partition its start; only a partition is summed row by row. The order must be total
    but for interchangeable rows.
    """
    ranged = cut(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), label)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (ranged.groupBy("__part").agg(F.sum(amount).alias("__sum"))
              .select("__part", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__start")))
    inside = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = ranged.join(F.broadcast(starts), "__part")  # as many rows as there are partitions
    return joined.withColumn(total, F.sum(amount).over(inside) + F.col("__start")).drop("__part", "__start")
