"""Writers: JSON lines, CSV, Markdown tables from small aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path, ignoreNullFields=True)


def csv_index(df: DataFrame, path: str, one_file: bool = False) -> None:
    """one_file is for indexes that people read; Spark's _SUCCESS marks a whole write."""
    (df.coalesce(1) if one_file else df).write.mode("overwrite").csv(path, header=True)


def by_unit(df: DataFrame, path: str, unit: str) -> None:
    df.repartition(unit).write.mode("overwrite").partitionBy(unit).parquet(path)


def markdown(df: DataFrame, most: int = 1000) -> str:
    """A Markdown table of an aggregate; more than `most` rows are an error and not cut off."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows are no report")
    line = lambda cells: "| " + " | ".join("" if c is None else str(c) for c in cells) + " |"
    return "\n".join([line(df.columns), line("---" for _ in df.columns), *map(line, rows)])


def batches(df: DataFrame, order: list[str], size: int, path: str) -> None:
    """Rows in files of `size`, numbered in order; numbering is by range partition and offset, not in one task."""
    sorted_ = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__p", F.spark_partition_id())
    path_sorted = path + "/_sorted"
    sorted_.write.mode("overwrite").parquet(path_sorted)
    from pyspark.sql import Window

    t = df.sparkSession.read.parquet(path_sorted)
    n = t.groupBy("__p").count()
    offset = n.select("__p", (F.sum("count").over(Window.orderBy("__p")) - F.col("count")).alias("__offset"))
    at = F.row_number().over(Window.partitionBy("__p").orderBy(*order)) - 1 + F.col("__offset")
    t.join(F.broadcast(offset), "__p").withColumn("batch", F.floor(at / size)).drop("__p", "__offset").write.mode("overwrite").partitionBy("batch").parquet(path + "/batches")
