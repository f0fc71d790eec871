"""Stored layers (staged, core, mart) and cut points.

Full refresh: a load writes all tables of a layer into a folder of its own and
then publishes that folder by creating one file, which either is there or not.
Readers take the last published folder, so they see a load as a whole or not at
all, and what they have opened stays as it was. Tables are plain Parquet; claims
and payments have a folder for each month of their date (``schemas.MONTHS``), a
column more than the declared ones. They are not bucketed by claim: a bucketed join has no shuffle, so a claim that holds
a third of the rows would be read by one task and adaptive execution could not
split it.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from contextvars import ContextVar
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leakscope.sources import schemas

LAYERS = ("staged", "core", "mart")



def shared_folder(spark: SparkSession) -> str:
    """Folder all executors see, named by ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    named = spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="leakscope-"))
    return spark.sparkContext.getCheckpointDir()


_MADE: ContextVar[list[str] | None] = ContextVar("_MADE", default=None)


@contextmanager
def temporary_cuts(spark: SparkSession) -> Iterator[None]:
    """Deletes what :func:`cut` writes inside; nothing lazy that reads it may be used afterwards."""
    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield
    finally:
        _MADE.reset(token)
        for path in made:
            folder, files = _path(spark, path)
            files.delete(folder, True)


def cut(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written table.

    The lineage ends at stored files: lost executors never cause a recompute,
    and every later read sees the same rows in the same file order.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/leakscope/{label}-{uuid.uuid4().hex}"
    made = _MADE.get()
    if made is not None:
        made.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _by_month(name: str, frame: DataFrame) -> DataFrame:
    """Rows with their month, a month's rows together and in order of their date.

    Adaptive execution deals a large month over several tasks and several small ones to one, so there are about as
    many files as the sizes ask for.
    """
    month, date = schemas.MONTHS[name]
    with_month = frame.withColumn(month, F.trunc(date, "MM"))
    return with_month.hint("rebalance", F.col(month)).sortWithinPartitions(month, date)


def from_day(frame: DataFrame, column: str, day: date) -> DataFrame:
    """Rows whose date is not before ``day``; of a table laid out by its month, earlier months are not even listed."""
    kept = frame.where(F.col(column) >= F.lit(day))
    for month, of in schemas.MONTHS.values():
        if of == column and month in frame.columns:
            kept = kept.where(F.col(month) >= F.lit(day.replace(day=1)))
    return kept


def _schemas(layer: str) -> dict:
    found = dict({"staged": schemas.STAGED, "core": schemas.CORE, "mart": schemas.MART}[layer])
    for name, (month, _) in schemas.MONTHS.items():
        if name in found:
            found[name] = T.StructType([*found[name], T.StructField(month, T.DateType())])
    return found


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def published(spark: SparkSession, base: str, layer: str) -> list[str]:
    """Folders of the published versions of a layer, the last one last."""
    marks, files = _path(spark, f"{base}/{layer}/_published")
    if not files.exists(marks):
        return []
    names = sorted(found.getPath().getName() for found in files.listStatus(marks))
    return [f"{base}/{layer}/{name.split('.', 1)[1]}" for name in names]


class Version:
    """One load of a layer, written apart from the ones before and published at its end."""

    def __init__(self, spark: SparkSession, base: str, layer: str):
        self.spark, self.base, self.layer = spark, base, layer
        self._before = published(spark, base, layer)
        self._folder = f"v-{uuid.uuid4().hex}"

    def write(self, name: str, frame: DataFrame, number: str | None = None) -> DataFrame:
        """Write a table and go on from what is written.

        ``number`` names a column that gets a number of the row's place: unique, with gaps. It is given by the task that
        writes the row, after all shuffles, so a task that runs twice can't give a number to two rows.
        """
        path = f"{self.base}/{self.layer}/{self._folder}/{name}"
        months = schemas.MONTHS.get(name, ())[:1]
        laid_out = _by_month(name, frame) if months else frame
        if number:
            laid_out = laid_out.withColumn(number, F.monotonically_increasing_id() + 1)
        laid_out.write.partitionBy(*months).parquet(path)
        return self.spark.read.schema(laid_out.schema).parquet(path)

    def previous(self, name: str, schema) -> DataFrame | None:
        """A table of the version before, if there is one."""
        return self.spark.read.schema(schema).parquet(f"{self._before[-1]}/{name}") if self._before else None

    def publish(self) -> dict[str, DataFrame]:
        """Make this the version that readers see, by creating one file; returns its tables."""
        mark, files = _path(
            self.spark, f"{self.base}/{self.layer}/_published/{len(self._before) + 1:09d}.{self._folder}")
        files.mkdirs(mark.getParent())
        files.createNewFile(mark)
        return _read(self.spark, f"{self.base}/{self.layer}/{self._folder}", self.layer)


def _read(spark: SparkSession, folder: str, layer: str) -> dict[str, DataFrame]:
    return {name: spark.read.schema(schema).parquet(f"{folder}/{name}") for name, schema in _schemas(layer).items()}


def write_layer(spark: SparkSession, frames: Mapping[str, DataFrame], base: str, layer: str) -> dict[str, DataFrame]:
    """Write all tables of a layer as a new version under ``base/layer``."""
    version = Version(spark, base, layer)
    for name, frame in frames.items():
        version.write(name, frame)
    return version.publish()


def read_layer(spark: SparkSession, base: str, layer: str) -> dict[str, DataFrame]:
    """Tables of the last published version of a layer, with their declared schemas."""
    found = published(spark, base, layer)
    if not found:
        raise FileNotFoundError(f"nothing was published under {base}/{layer}")
    return _read(spark, found[-1], layer)


def drop_versions(spark: SparkSession, base: str, layer: str, keep: int = 2) -> None:
    """Delete all but the last ``keep`` published versions; nothing may still read the others."""
    for old in published(spark, base, layer)[:-keep]:
        marks, files = _path(spark, f"{base}/{layer}/_published")
        for found in files.listStatus(marks):
            if found.getPath().getName().split(".", 1)[1] == old.rsplit("/", 1)[1]:
                files.delete(found.getPath(), False)
        folder, files = _path(spark, old)
        files.delete(folder, True)


def register_layer(spark: SparkSession, base: str, layer: str) -> None:
    """Catalog views ``layer.table`` over the last published version of each table.

    To be called after a load; every statement that starts later, in any session, reads the new version.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    for name, table in read_layer(spark, base, layer).items():
        columns = ", ".join(f"CAST(`{field.name}` AS {field.dataType.simpleString()}) AS `{field.name}`"
                            for field in table.schema)
        path = published(spark, base, layer)[-1]
        spark.sql(f"CREATE OR REPLACE VIEW {layer}.{name} AS SELECT {columns} FROM parquet.`{path}/{name}`")
