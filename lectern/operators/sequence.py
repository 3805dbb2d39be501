"""Numbers in order: gaps, violations, state carried forward, the next row of a kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def missing_numbers(df: DataFrame, by: list[str], number: str, first: int = 1) -> DataFrame:
    """by and each number between first and the group's largest that the group lacks."""
    before = F.coalesce(F.lag(number).over(Window.partitionBy(*by).orderBy(number)), F.lit(first - 1))
    gaps = df.select(*by, number).distinct().withColumn("__before", before).filter(F.col(number) - F.col("__before") > 1)
    return gaps.select(*by, F.explode(F.sequence((F.col("__before") + 1).cast("long"), (F.col(number) - 1).cast("long"))).alias("missing"))


def with_previous(df: DataFrame, by: list[str], order: list[str], value: str, name: str) -> DataFrame:
    return df.withColumn(name, F.lag(value).over(Window.partitionBy(*by).orderBy(*order)))


def filled_forward(df: DataFrame, by: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """The last value that is not null, up to and with the row."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def next_of_kind(df: DataFrame, by: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """The first value that is not null after the row."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(1, Window.unboundedFollowing)
    return df.withColumn(name, F.first(value, ignorenulls=True).over(w))


def lost_ranges(df: DataFrame, by: list[str], physical: str, printed: str) -> DataFrame:
    """Rows whose printed number jumped by more than their physical number since the last printed one."""
    w = Window.partitionBy(*by).orderBy(physical).rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(F.col(printed).isNotNull(), F.struct(physical, printed)), ignorenulls=True).over(w)
    x = df.withColumn("__last", last)
    jump = (F.col(printed) - F.col("__last")[printed]) - (F.col(physical) - F.col("__last")[physical])
    return x.withColumn("lost", jump).filter("lost > 0").select(*by, physical, printed, (F.col("__last")[printed] + 1).alias("lost_from"), F.col("lost"))
