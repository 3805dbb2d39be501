"""Items assembled from the lines of orders, and that every line is in one item or has a reason."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators import assembly as A
from lectern.plans.closures import parts
from lectern.session import checkpointed, table

#: Height of context that an item has room for.
ROOM = 70


def question(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """leaves and needs of all orders: a line in three needs an earlier line, one in eleven is out of scope, one in thirteen has other marks in its scheme."""
    x = checkpointed(parts(spark, sf_dir))
    marks = (1 + F.col("n") % 5).cast("long")
    leaves = x.select(
        "doc", "label", "letter", "ord", F.when(F.col("p") % 11 != 0, (F.col("s") % 4).cast("int")).alias("topic"), marks.alias("marks"),
        (marks + (F.col("p") % 13 == 0).cast("long")).alias("scheme"), (20 + F.col("n")).cast("long").alias("height"),
    )
    needs = x.filter("s % 3 = 0 AND p % of < i").select("doc", "label", (F.col("p") % F.col("of")).alias("at"))
    return leaves, needs.join(x.select("doc", F.col("i").cast("long").alias("at"), F.col("label").alias("on")), ["doc", "at"]).select("doc", "label", "on")


def item_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The item and topic of each line, or why it is in none."""
    leaves, needs = question(spark, sf_dir)
    return A.assembled(leaves, needs, ROOM)


def item_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each order: how many there are, how many lines the assembly does not have exactly once, and how many have both an item and a reason or neither."""
    found = item_assembly(spark, sf_dir).withColumnsRenamed({"doc": "l_orderkey"})
    once = found.groupBy("l_orderkey", "ord").agg(F.count(F.lit(1)).alias("times"), F.sum((F.col("item").isNull() == F.col("reason").isNull()).cast("long")).alias("unclear"))
    seen = once.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("times") > 1).cast("long")).alias("repeated"), F.sum("unclear").alias("unclear"))
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines"))
    x = lines.join(seen, "l_orderkey", "left")
    return x.select("l_orderkey", "lines", (F.col("lines") - F.coalesce("n", F.lit(0)) + F.coalesce("repeated", F.lit(0))).alias("not_once"), F.coalesce("unclear", F.lit(0)).alias("unclear"))


QUERIES = {f.__name__: f for f in (item_assembly, item_coverage)}

ORACLES = {"item_coverage": "SELECT l_orderkey, count(*) AS lines, 0::BIGINT AS not_once, 0::BIGINT AS unclear FROM lineitem GROUP BY 1"}
