"""Session and table access shared by the queries, the benchmark and the tests."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lectern")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LECTERN_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Whether Spark deletes an execution's shuffle files at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpointed(df: DataFrame, by_size: bool = False) -> DataFrame:
    """df written to the folder that the cluster names in spark.checkpoint.dir, and read back; a folder of its own in a single process (tests), an error on a cluster.

    The files are compressed columns, of which later steps read those that they use: df.checkpoint() writes whole rows, and
    keeps the shuffle files behind them until the driver collects garbage. Here they go when the table is written.

    Spark takes the size of the files for that of the rows, which is many times as much, and would send a table of millions
    of rows to all tasks through the driver. So its joins, and those of what is selected, exploded or grouped of it, are by sorting;
    by_size: Spark may choose, where the other side has whole texts that should stay where they are.
    """
    spark, sc = df.sparkSession, df.sparkSession.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="lectern-"))
        found = sc.getCheckpointDir()
    path = f"{found}/lectern/{sc.applicationId}/step-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    found = spark.read.schema(df.schema).parquet(path)
    return found if by_size else sorted_joins(found)


def sorted_joins(df: DataFrame) -> DataFrame:
    """df, joined by sorting whatever size Spark expects of it: where a union, semi join or anti join of kept tables is joined, they no longer say so themselves."""
    return df.hint("merge")
