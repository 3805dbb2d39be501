"""One row, or a few, of each group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top(df: DataFrame, by: list[str], order: list, n: int = 1) -> DataFrame:
    """The first n rows of each group; order must decide all ties."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= n).drop("__n")


def majority(df: DataFrame, by: list[str], category: str, weight: Column, order: str) -> DataFrame:
    """The category with the largest weight in each group, that seen first among equals, and whether there was a tie."""
    sums = df.groupBy(*by, category).agg(F.sum(weight).cast("long").alias("weight"), F.min(order).alias("__first"))
    ranked = sums.withColumn("tied", F.count(F.lit(1)).over(Window.partitionBy(*by, "weight")) > 1)
    return top(ranked, by, [F.desc("weight"), "__first"]).drop("__first")


def upper_median(df: DataFrame, by: list[str], value: str, ties: list[str] | None = None) -> DataFrame:
    """The row at place n // 2 from 0: never between two values."""
    w = Window.partitionBy(*by).orderBy(value, *(ties or []))
    placed = df.withColumn("__n", F.row_number().over(w) - 1).withColumn("__all", F.count(F.lit(1)).over(Window.partitionBy(*by)))
    return placed.filter(F.col("__n") == F.floor(F.col("__all") / 2)).drop("__n", "__all")


def even_sample(df: DataFrame, by: list[str], order: list[str], k: int) -> DataFrame:
    """Rows at places floor(j * n / k), j = 0 to k-1; a row once, with the first j that picks it."""
    w = Window.partitionBy(*by).orderBy(*order)
    placed = df.withColumn("__n", F.row_number().over(w) - 1).withColumn("__all", F.count(F.lit(1)).over(Window.partitionBy(*by)))
    picked = placed.withColumn("pick", F.explode(F.sequence(F.lit(0), F.lit(k - 1)))).filter(F.col("__n") == F.floor(F.col("pick") * F.col("__all") / k))
    return picked.groupBy(*df.columns).agg(F.min("pick").cast("long").alias("pick"))


def hash_sample(df: DataFrame, by: list[str], key: str, n: int, seed: str) -> DataFrame:
    """n rows of each group in the order of a hash of seed and key."""
    return top(df.withColumn("sample_key", F.sha2(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")), 256)), by, ["sample_key"], n)
