"""Rows in order, cut into runs: islands, runs of equal values, merged intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(df: DataFrame, by: list[str], order: list[str], starts: Column, name: str = "island") -> DataFrame:
    """Number the runs of each group from 1; starts: true where a row begins a new one (null: it does)."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(name, F.sum(F.when(F.coalesce(starts, F.lit(True)), 1).otherwise(0)).over(w).cast("long"))


def gap_islands(df: DataFrame, by: list[str], order: str, gap: Column | float, ties: list[str] | None = None, name: str = "island") -> DataFrame:
    """A new island where order is more than gap past the row before."""
    keys = [order, *(ties or [])]
    before = F.lag(order).over(Window.partitionBy(*by).orderBy(*keys))
    return islands(df, by, keys, F.col(order) - before > gap, name)


def value_runs(df: DataFrame, by: list[str], order: list[str], value: str, name: str = "run") -> DataFrame:
    """A new run where value differs from the row before."""
    before = F.lag(value).over(Window.partitionBy(*by).orderBy(*order))
    first = F.row_number().over(Window.partitionBy(*by).orderBy(*order)) == 1
    return islands(df, by, order, first | ~F.col(value).eqNullSafe(before), name)


def merge_intervals(df: DataFrame, by: list[str], start: str, end: str, gap: float = 0) -> DataFrame:
    """by, start, end and n of the unions of intervals that overlap or lie at most gap apart."""
    w = Window.partitionBy(*by).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    cut = islands(df, by, [start, end], F.col(start) > reach + gap, "__island")
    return cut.groupBy(*by, "__island").agg(F.min(start).alias(start), F.max(end).alias(end), F.count(F.lit(1)).alias("n")).drop("__island")
