"""Shared folder, tables kept in it, and expressions that several operators use."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space, as the contracts of all operators have it: what bytes.split() splits on.
SPACE = r"[\x20\x09-\x0D]+"


#: Whether Spark deletes an execution's shuffle files at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, what the context was given,
    or for a single process (tests) a folder of its own; on a cluster that is an error."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="lectern-"))
        found = sc.getCheckpointDir()
    return found


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/lectern/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def kept(df: DataFrame, label: str) -> DataFrame:
    """df written to the shared folder and read back: lineage ends here, and a lost executor loses nothing.

    The shuffle files behind it, which nothing needs once it is written, are deleted then.
    """
    spark, path = df.sparkSession, new_path(df.sparkSession, label)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def dropped(df: DataFrame) -> None:
    """Delete the kept table df, from which nothing is read any more."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        _delete(df.sparkSession, path)


def discard(spark: SparkSession) -> None:
    """Delete all tables that this application has kept; none of its DataFrames can be read afterwards."""
    _delete(spark, f"{shared_dir(spark)}/lectern/{spark.sparkContext.applicationId}")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once a row, however often body names it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE, -1), lambda w: w != "")


#: Keys of many rows that are sent to all tasks, at most (some MB); a key has many rows from LEAST on.
SENT, LEAST = 100_000, 1024


def joined(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """left with the columns of right joined by key, whatever share of left has one key.

    right is a kept table with one row a key and in n how many rows of left have it. Rows of keys
    with many rows stay where they are: those keys, at most SENT as each has over a SENT-th of all
    rows, go to all tasks. The others are shuffled.
    """
    rows, top = right.agg(F.sum("n"), F.max("n")).first()
    most = max(LEAST, (rows or 0) // SENT)
    light = right.filter(F.col("n") <= most).drop("n")
    if (top or 0) <= most:
        return left.join(light, key)
    heavy = right.filter(F.col("n") > most).drop("n")
    return left.join(F.broadcast(heavy), key).unionByName(left.join(F.broadcast(heavy.select(key)), key, "left_anti").join(light, key))


def fresh(columns: list[str], name: str) -> str:
    """name, lengthened until no column begins with it."""
    while any(c.lower().startswith(name.lower()) for c in columns):
        name += "_"
    return name
