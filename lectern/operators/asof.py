"""Joins to the last row before, the nearest row, and the bucket a value falls in."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof(left: DataFrame, right: DataFrame, by: list[str], order: str, values: list[str], ties: str | None = None) -> DataFrame:
    """left with values of the last right row of its group at or before it; null if there is none.

    Both sides go through one window: no row is compared with more than its neighbours. ties: a
    right column that decides among right rows of the same order (the largest wins).
    """
    names = left.columns
    tie = F.col(ties) if ties else F.lit(0)
    a = left.withColumn("__right", F.lit(False))
    b = right.select(*by, order, F.lit(True).alias("__right"), tie.alias("__order"), F.struct(*values).alias("__value"))
    w = Window.partitionBy(*by).orderBy(F.col(order), F.col("__right").desc(), F.col("__order").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    both = a.unionByName(b, allowMissingColumns=True).withColumn("__last", F.last("__value", ignorenulls=True).over(w))
    return both.filter(~F.col("__right")).select(*names, *(F.col("__last")[v].alias(v) for v in values))


def nearest(left: DataFrame, right: DataFrame, by: list[str], order: str, value: str) -> DataFrame:
    """left with value and distance of the nearest right row on either side; the earlier of equals. order is a number."""
    names = left.columns
    a = left.withColumn("__right", F.lit(False))
    b = right.select(*by, order, F.lit(True).alias("__right"), F.col(value).alias("__v"), F.col(order).alias("__at"))
    w = Window.partitionBy(*by).orderBy(order, "__v")
    both = a.unionByName(b, allowMissingColumns=True)
    pair = F.when(F.col("__right"), F.struct("__at", "__v"))
    back = F.last(pair, ignorenulls=True).over(Window.partitionBy(*by).orderBy(F.col(order), F.col("__right").desc(), F.col("__v")).rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.first(pair, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    both = both.withColumn("__b", back).withColumn("__f", ahead).filter(~F.col("__right"))
    near_back = F.col(order) - F.col("__b.__at")
    near_ahead = F.col("__f.__at") - F.col(order)
    use_back = F.col("__f").isNull() | (F.col("__b").isNotNull() & (near_back <= near_ahead))
    return both.select(*names, F.when(use_back, F.col("__b.__v")).otherwise(F.col("__f.__v")).alias(value), F.when(use_back, near_back).otherwise(near_ahead).alias("distance"))


def bucket_bounds(keys: DataFrame, start: str, label: str) -> DataFrame:
    """label with [start, next start): the last bucket has no end. keys is a small dimension."""
    w = Window.orderBy(start)
    return keys.select(F.col(label), F.col(start), F.lead(start).over(w).alias("until"))
