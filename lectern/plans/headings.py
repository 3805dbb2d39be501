"""Headings of items in booklets: a customer's orders printed under numbers and references, some unread, misread or split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.operators import headings as H
from lectern.session import table

REF = r"^MJ\d{2}/P\d+/Q\d+$"


def booklet_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a booklet per customer, five orders to a page: headings, lines that begin with a number, and references far from the left."""
    k = F.col("o_orderkey")
    x = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey").withColumn("i", F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")))
    ref = F.format_string("MJ%02d/P%d/Q%d", k % 100, k % 7, k % 11 + 1)
    number = F.format_string("%d%s", F.col("i") + F.when(k % 13 == 0, 40).otherwise(0), F.when(k % 2 == 0, ".").otherwise(""))
    y, x0 = ((F.col("i") - 1) % 5 * 100 + 50).cast("double"), (40 + k % 10).cast("double")
    line = lambda x0, y0, text: F.struct(x0.alias("x0"), y0.alias("y0"), (x0 + 15).alias("x1"), (y0 + 10).alias("y1"), text.alias("text"))
    split = (k % 7 == 0) & (k % 11 != 0)
    heading = F.when(k % 11 == 0, ref).when(split, number).otherwise(F.concat_ws(" ", number, ref))
    drawn = F.array(line(x0, y, heading), F.when(split, line(x0 + 20, y + 14, ref)), line(F.lit(90.0), y + 40, F.lit("12 units of stock")), line(F.lit(200.0), y + 60, ref))
    x = x.select(F.col("o_custkey").alias("doc_id"), (F.floor((F.col("i") - 1) / 5) + 1).cast("int").alias("page"), F.explode(F.filter(drawn, lambda d: d.isNotNull())).alias("d"))
    return x.select("doc_id", "page", "d.*")


def numbered_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The headings of booklets with their numbers as read and as completed."""
    return H.completed(H.heading_lines(booklet_lines(spark, sf_dir), "doc_id", REF), "doc_id", ["page", "y0"])


QUERIES = {"numbered_headings": numbered_headings}

ORACLES = {
    "numbered_headings": """
        WITH o AS (SELECT o_custkey AS doc_id, o_orderkey AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i FROM orders),
        p AS (SELECT *, CASE WHEN k % 11 = 0 THEN NULL WHEN k % 13 = 0 THEN 40 ELSE 0 END AS off FROM o),
        v AS (SELECT *, count(*) FILTER (off = 0) OVER near - count(*) FILTER (off = 40) OVER near AS lead, count(off) OVER near AS votes FROM p
              WINDOW near AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
        r AS (SELECT *, CASE WHEN lead > 0 THEN 0 WHEN lead < 0 THEN 40 END AS won FROM v)
        SELECT doc_id, ((i - 1) // 5 + 1)::INT AS page, ((i - 1) % 5 * 100 + 50)::DOUBLE AS y0, printf('MJ%02d/P%d/Q%d', k % 100, k % 7, k % 11 + 1) AS ref, i + off AS read,
               i + coalesce(won, off) AS n, CASE WHEN won IS NULL THEN 'unsure' WHEN off IS NULL THEN 'inferred' WHEN off = won THEN 'kept' ELSE 'repaired' END AS outcome FROM r""",
}
