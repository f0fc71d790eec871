"""Session settings the jobs are designed for.

All of them are ordinary Spark settings; the jobs give the same results
without them. A cluster sets its own shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

CLUSTER_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Start with many shuffle partitions, let AQE merge the small ones and
    # split the hot ones, also where the split costs one more shuffle.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # The JVM never compiles methods of over 8000 bytes; cleaning a whole table in one stage would run interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

LOCAL_SETTINGS = {
    **CLUSTER_SETTINGS,
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m",
    "spark.driver.memory": "8g",
}


def local_session(cores: int, name: str = "leakscope", **extra: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    settings = {**LOCAL_SETTINGS, "spark.sql.shuffle.partitions": str(cores), **extra}
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
