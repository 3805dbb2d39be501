"""Boxes in two dimensions: lines of orders as rectangles, rules and pieces of text on pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.operators import rects as R
from lectern.session import table

LINE = ("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice")


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rectangle per line on the sheet of its supplier and year; one in fifty is large."""
    li = table(spark, sf_dir, "lineitem")
    p, q = F.col("l_partkey"), F.col("l_quantity").cast("long")
    order = F.row_number().over(Window.partitionBy("l_suppkey").orderBy("l_orderkey", *LINE)).cast("long")
    x0, y0 = (F.col("l_orderkey") * 37 % 5000).cast("double"), (p * 101 % 7000).cast("double")
    wide = F.when(p % 50 == 0, q * 20).otherwise(q)
    return li.select("l_suppkey", order.alias("n"), x0.alias("x0"), y0.alias("y0"), (x0 + wide).alias("x1"), (y0 + F.col("l_linenumber") * 9).alias("y1"))


def rectangle_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a supplier's boxes that share a point, each once, and the area they share."""
    x = boxes(spark, sf_dir)
    of = lambda k: x.select("l_suppkey", F.col("n").alias(k), *(F.col(c).alias(f"{k}_{c}") for c in R.SIDES))
    a, b = (tuple(f"{k}_{c}" for c in R.SIDES) for k in "ab")
    pairs = R.rectangle_join(of("a"), of("b"), ["l_suppkey"], a, b, 32.0).filter("a < b")
    side = lambda low, high: F.least(f"a_{high}", f"b_{high}") - F.greatest(f"a_{low}", f"b_{low}")
    return pairs.select("l_suppkey", "a", "b", (side("x0", "x1") * side("y0", "y1")).alias("area"))


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules of a page per order: a rule across at the top of each line's strip, uprights over some, and boxes."""
    w = Window.partitionBy("l_orderkey").orderBy(*LINE)
    x = table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE).withColumn("i", F.row_number().over(w))
    q, p = F.col("l_quantity").cast("int"), F.col("l_partkey")
    y = (F.col("i") * 40 + q % 30).cast("double")
    rect = lambda x0, y0, x1, y1: F.struct(*(c.cast("double").alias(k) for k, c in zip(R.SIDES, (F.lit(x0), y0, F.lit(x1), y1), strict=True)))
    drawn = F.array(
        rect(40, y, 500, y + 1), F.when(p % 3 > 0, rect(60, y - 1, 61, y + 20 + q)), F.when(p % 7 == 0, rect(50, y + 3, 400, y + 13 + q)), F.when(p % 5 == 0, rect(40, y + 5, 200, y + 6)),
    )
    return x.select(F.col("l_orderkey").alias("doc_id"), F.lit(1).alias("page"), F.explode(F.filter(drawn, lambda r: r.isNotNull())).alias("r")).select("doc_id", "page", "r.*")


def ruled_table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ruled tables and the boxes on the pages of orders."""
    return R.ruled_rows(rules(spark, sf_dir))


def pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of text on a page per order, tilted, of several heights, some beside each other."""
    w = Window.partitionBy("l_orderkey").orderBy(*LINE)
    x = table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE).withColumn("i", F.row_number().over(w))
    q, p = F.col("l_quantity").cast("int"), F.col("l_partkey")
    y0 = (60 + F.floor(F.col("i") / 3) * 12 + p % 7).cast("double")
    x0 = (F.col("i") % 3 * 100 + q).cast("double")
    return x.select(F.col("l_orderkey").alias("doc_id"), F.lit(1).alias("page"), x0.alias("x0"), y0.alias("y0"), (x0 + 40 + p % 90).alias("x1"), (y0 + 7 + q % 6).alias("y1"))


def tilted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visual lines of tilted pieces."""
    return R.overlap_lines(pieces(spark, sf_dir))


QUERIES = {f.__name__: f for f in (rectangle_overlaps, ruled_table_rows, tilted_lines)}

_W = f"PARTITION BY l_orderkey ORDER BY {', '.join(LINE)}"
ORACLES = {
    "rectangle_overlaps": f"""
        WITH x AS (SELECT l_suppkey, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, {", ".join(LINE)}) AS n, (l_orderkey * 37 % 5000)::DOUBLE AS x0, (l_partkey * 101 % 7000)::DOUBLE AS y0,
                     CASE WHEN l_partkey % 50 = 0 THEN 20 ELSE 1 END * l_quantity::BIGINT AS w, l_linenumber * 9 AS h FROM lineitem)
        SELECT a.l_suppkey, a.n AS a, b.n AS b, (least(a.x0 + a.w, b.x0 + b.w) - greatest(a.x0, b.x0)) * (least(a.y0 + a.h, b.y0 + b.h) - greatest(a.y0, b.y0)) AS area
        FROM x a JOIN x b ON a.l_suppkey = b.l_suppkey AND a.n < b.n AND a.x0 <= b.x0 + b.w AND b.x0 <= a.x0 + a.w AND a.y0 <= b.y0 + b.h AND b.y0 <= a.y0 + a.h""",
    "ruled_table_rows": f"""
        WITH l AS (SELECT l_orderkey AS d, (row_number() OVER ({_W}) * 40 + l_quantity::INT % 30)::DOUBLE AS y, l_quantity::INT AS q, l_partkey AS p FROM lineitem),
        h AS (SELECT d, y0, lead(y0) OVER (PARTITION BY d ORDER BY y0) AS y1 FROM (SELECT DISTINCT d, y + 0.5 AS y0 FROM l)),
        v AS (SELECT d, y - 1 AS v0, y + 20 + q AS v1 FROM l WHERE p % 3 > 0 AND 21 + q > 8)
        SELECT DISTINCT d AS doc_id, 1 AS page, y0, y1 FROM (
          SELECT d, y0, y1 FROM h WHERE y1 - y0 > 8 AND y1 - y0 < 400 AND EXISTS (SELECT 1 FROM v WHERE v.d = h.d AND v0 <= y0 + 2 AND v1 >= y1 - 2)
          UNION ALL SELECT d, y + 3, y + 13 + q FROM l WHERE p % 7 = 0 AND 10 + q > 10)""",
}
