"""Joins on overlap. Each interval is listed under every bucket it touches, so that the join is an
equi-join on group and bucket; a pair counts in the bucket where the later of the two starts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def overlap_join(left: DataFrame, right: DataFrame, by: list[str], a: tuple[str, str], b: tuple[str, str], width: int) -> DataFrame:
    """Pairs of a group whose intervals [start, end] share a point; columns besides by must differ. width: of a bucket."""
    buckets = lambda s, e: F.explode(F.sequence(F.floor(F.col(s) / width), F.floor(F.col(e) / width)))
    x, y = left.withColumn("__bucket", buckets(*a)), right.withColumn("__bucket", buckets(*b))
    return (
        x.join(y, [*by, "__bucket"])
        .filter((F.col(a[0]) <= F.col(b[1])) & (F.col(b[0]) <= F.col(a[1])))
        .filter(F.col("__bucket") == F.floor(F.greatest(a[0], b[0]) / width))
        .drop("__bucket")
    )


def overlap_share(a: tuple[str, str], b: tuple[str, str]):
    """Length of the common part over the length of a."""
    return F.greatest(F.lit(0), F.least(a[1], b[1]) - F.greatest(a[0], b[0])) / (F.col(a[1]) - F.col(a[0]))
