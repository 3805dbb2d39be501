"""Reachability over an edge table, round by round; rounds end when nothing new is found."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.session import checkpointed


def closure(edges: DataFrame, src: str = "src", dst: str = "dst", most: int | None = None) -> DataFrame:
    """src, dst, depth of all connected pairs, with the shortest depth. most: raise if there are pairs further apart.

    Only pairs found in the last round are joined again. Each round is checkpointed, so plans stay
    short and a lost executor costs a round at most.
    """
    new = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).distinct().withColumn("depth", F.lit(1).cast("long"))
    step = new.select(F.col("src").alias("__mid"), F.col("dst").alias("__next"))
    found = new = checkpointed(new)
    for depth in count(2):
        reached = new.join(step, new["dst"] == step["__mid"]).select("src", F.col("__next").alias("dst")).distinct()
        new = reached.join(found, ["src", "dst"], "left_anti").withColumn("depth", F.lit(depth).cast("long"))
        new = checkpointed(new)
        if not new.limit(1).count():
            return found
        if most is not None and depth > most:
            raise ValueError(f"there are pairs more than {most} edges apart")
        found = checkpointed(found.unionByName(new))
