"""Two or more accounts of the same thing, compared."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_failing(rules: list[tuple[Column, str]]) -> Column:
    """The message of the first rule whose condition holds; null if none does."""
    return F.coalesce(*(F.when(c, m) for c, m in rules))


def compare(left: DataFrame, right: DataFrame, keys: list[str], fields: list[str], names: tuple[str, str] = ("left", "right")) -> DataFrame:
    """Findings: keys on one side only, and fields that differ. One full join; equal rows give nothing."""
    a = left.select(*keys, F.struct(*fields).alias("__a"), F.lit(True).alias("__in_a"))
    b = right.select(*keys, F.struct(*fields).alias("__b"), F.lit(True).alias("__in_b"))
    both = a.join(b, keys, "full_outer")
    only = F.when(F.col("__in_b").isNull(), f"only in {names[0]}").when(F.col("__in_a").isNull(), f"only in {names[1]}")
    differ = [F.when(only.isNull() & ~F.col("__a")[f].eqNullSafe(F.col("__b")[f]), f"{f} differs") for f in fields]
    return both.select(*keys, F.explode(F.array_compact(F.array(only, *differ))).alias("finding"))


def coverage(expected: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """expected with how often each key was found and what that means."""
    n = found.groupBy(*keys).agg(F.count(F.lit(1)).alias("times"))
    x = expected.join(n, keys, "left").withColumn("times", F.coalesce("times", F.lit(0)))
    return x.withColumn("class", F.when(F.col("times") == 0, "missing").when(F.col("times") == 1, "once").otherwise("repeated"))


def symmetric_difference(left: DataFrame, right: DataFrame, keys: list[str], names: tuple[str, str]) -> DataFrame:
    a = left.select(*keys).distinct().join(right, keys, "left_anti").withColumn("side", F.lit(names[0]))
    return a.unionByName(right.select(*keys).distinct().join(left, keys, "left_anti").withColumn("side", F.lit(names[1])))


def recounted(figures: list[tuple[str, DataFrame, DataFrame]]) -> DataFrame:
    """what, printed, counted, ok from pairs of one-row, one-column frames."""
    rows = [p.select(F.lit(what).alias("what"), p[p.columns[0]].cast("long").alias("printed")).crossJoin(c.select(c[c.columns[0]].cast("long").alias("counted"))) for what, p, c in figures]  # one row each
    return reduce(DataFrame.unionByName, rows).withColumn("ok", F.col("printed").eqNullSafe(F.col("counted")))
