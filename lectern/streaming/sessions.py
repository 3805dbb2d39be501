"""Extension beyond the batch inventory: session counts over an event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def session_counts(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """user_id, start, end and n of each session; rows later than `late` behind the watermark are left out."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    s = timed.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return s.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
