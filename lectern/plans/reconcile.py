"""Accounts of the same things compared: headers with details, sources with sources, figures with recounts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.operators import reconcile as R
from lectern.session import table


def cents(c: str):
    return F.round(F.col(c) * 100).cast("long")


def recon_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line count against the highest line number, order by order; orders without lines appear."""
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.count("l_linenumber").alias("n_lines"), F.max("l_linenumber").cast("long").alias("max_line"))
    )
    joined = table(spark, sf_dir, "orders").select("o_orderkey").join(lines, "o_orderkey", "left")
    n = F.coalesce("n_lines", F.lit(0))
    return joined.select(
        "o_orderkey",
        n.alias("n_lines"),
        F.coalesce("max_line", F.lit(0)).alias("max_line"),
        F.when(n == 0, "no lines").when(n != F.col("max_line"), "line numbers not dense").otherwise("ok").alias("status"),
    )


def first_failing_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each order the first rule that it breaks."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"), F.max("l_linenumber").alias("m"), F.sum(cents("l_extendedprice")).alias("total"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_acctbal")
    x = table(spark, sf_dir, "orders").join(customers, "o_custkey", "left").join(lines, "o_orderkey", "left")
    reason = R.first_failing(
        [
            (F.col("c_acctbal").isNull(), "no customer"),
            (F.col("n").isNull(), "no lines"),
            (F.col("n") != F.col("m"), "lines not dense"),
            (F.col("total") > cents("o_totalprice"), "lines above total"),
            (F.col("c_acctbal") < 0, "customer in debt"),
        ]
    )
    return x.select("o_orderkey", F.coalesce(reason, F.lit("ok")).alias("reason"))


def full_outer_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and labels: keys on one side only, and a mark that differs."""
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.col("n_chars") % 2).cast("int").alias("mark"))
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").cast("int").alias("mark"))
    return R.compare(docs, labels, ["doc_id"], ["mark"], ("documents", "labels"))


def coverage_exactly_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return R.coverage(docs, table(spark, sf_dir, "labels"), ["doc_id"])


def anti_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without orders, and orders without customers."""
    c, o = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"))
    return R.symmetric_difference(c, o, ["k"], ("customer", "orders"))


def explained_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences of line totals and order totals, with a reason where there is one."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(cents("l_extendedprice")).alias("line_cents"), F.max("l_returnflag").alias("flag"))
    reasons = lines.filter("flag = 'R'").select("o_orderkey", F.lit("has returns").alias("reason"))
    x = table(spark, sf_dir, "orders").join(lines, "o_orderkey").withColumn("difference", F.col("line_cents") - cents("o_totalprice"))
    return x.filter("difference <> 0").join(reasons, "o_orderkey", "left").select("o_orderkey", "difference", F.coalesce("reason", F.lit("unexplained")).alias("reason"))


def figure_recount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Printed character counts against counted ones, where they differ or agree."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.col("n_chars").alias("printed"), F.length("text").cast("long").alias("counted")).withColumn("ok", F.col("printed").eqNullSafe(F.col("counted")))


def report_recount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three figures of a report against recounts."""
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return R.recounted(
        [
            ("orders", o.agg(F.count(F.lit(1))), li.agg(F.countDistinct("l_orderkey"))),
            ("customers", table(spark, sf_dir, "customer").agg(F.count(F.lit(1))), o.agg(F.countDistinct("o_custkey"))),
            ("parts", table(spark, sf_dir, "part").agg(F.count(F.lit(1))), li.agg(F.countDistinct("l_partkey"))),
        ]
    )


def judged_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks by outcome: PASS without findings, FAIL with some, NOT RUN if nothing was judged."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    x = d.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    g = x.groupBy("source").agg(F.count("quality").alias("judged"), F.count_if(F.col("quality") == 0).alias("findings"))
    return g.withColumn("outcome", F.when(F.col("judged") == 0, "NOT RUN").when(F.col("findings") == 0, "PASS").otherwise("FAIL"))


def unambiguous_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without orders take over the one order-less supplier of their nation, if each is alone there."""
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti")
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_suppkey").alias("s_suppkey")), "s_suppkey", "left_anti")
    alone = lambda df, k, n: df.select(F.col(n).alias("nation"), k).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("nation"))).filter("n = 1").drop("n")
    return alone(c, "c_custkey", "c_nationkey").join(alone(s, "s_suppkey", "s_nationkey"), "nation").select("nation", "c_custkey", "s_suppkey")


def tolerant_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers whose first and last order totals agree within 50 or 2 %."""
    o = table(spark, sf_dir, "orders")
    g = o.groupBy("o_custkey").agg(F.min_by(cents("o_totalprice"), "o_orderkey").alias("a"), F.max_by(cents("o_totalprice"), "o_orderkey").alias("b"))
    return g.withColumn("close", F.abs(F.col("a") - F.col("b")) * 50 <= F.greatest(F.lit(5000 * 50), F.col("b")))


def positional_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two orders of the lines of an order compared place by place."""
    w = lambda c: F.row_number().over(Window.partitionBy("l_orderkey").orderBy(c, "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity")).cast("long")
    li = table(spark, sf_dir, "lineitem")
    a = li.select("l_orderkey", w("l_linenumber").alias("place"), F.col("l_linenumber").cast("long").alias("printed"))
    b = li.select("l_orderkey", w("l_shipdate").alias("place"), F.col("l_linenumber").cast("long").alias("found"))
    return a.join(b, ["l_orderkey", "place"], "full_outer").filter(~F.col("printed").eqNullSafe(F.col("found")))


QUERIES = {f.__name__: f for f in (recon_order_lines, first_failing_rule, full_outer_compare, coverage_exactly_once, anti_semi, explained_diff, figure_recount, report_recount, judged_rollup, unambiguous_repair, tolerant_equality, positional_diff)}

_LINES = "SELECT l_orderkey, count(*) AS n, max(l_linenumber) AS m, sum(round(l_extendedprice * 100)::BIGINT) AS total, max(l_returnflag) AS flag FROM lineitem GROUP BY 1"
ORACLES = {
    "recon_order_lines": """
        SELECT o_orderkey, coalesce(n, 0)::BIGINT AS n_lines, coalesce(m, 0)::BIGINT AS max_line,
               CASE WHEN coalesce(n, 0) = 0 THEN 'no lines' WHEN n <> m THEN 'line numbers not dense' ELSE 'ok' END AS status
        FROM orders LEFT JOIN (SELECT l_orderkey, count(l_linenumber) AS n, max(l_linenumber) AS m FROM lineitem GROUP BY 1)
             ON o_orderkey = l_orderkey""",
    "first_failing_rule": f"""
        SELECT o_orderkey, CASE WHEN c_acctbal IS NULL THEN 'no customer' WHEN n IS NULL THEN 'no lines' WHEN n <> m THEN 'lines not dense'
               WHEN total > round(o_totalprice * 100)::BIGINT THEN 'lines above total' WHEN c_acctbal < 0 THEN 'customer in debt' ELSE 'ok' END AS reason
        FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN ({_LINES}) ON l_orderkey = o_orderkey""",
    "full_outer_compare": """
        SELECT coalesce(d.doc_id, l.doc_id) AS doc_id,
               CASE WHEN l.doc_id IS NULL THEN 'only in documents' WHEN d.doc_id IS NULL THEN 'only in labels' ELSE 'mark differs' END AS finding
        FROM (SELECT doc_id, (n_chars % 2)::INT AS mark FROM documents) d FULL JOIN (SELECT doc_id, max(quality)::INT AS mark FROM labels GROUP BY 1) l ON d.doc_id = l.doc_id
        WHERE d.doc_id IS NULL OR l.doc_id IS NULL OR d.mark IS DISTINCT FROM l.mark""",
    "coverage_exactly_once": """
        SELECT doc_id, coalesce(n, 0)::BIGINT AS times, CASE WHEN n IS NULL THEN 'missing' WHEN n = 1 THEN 'once' ELSE 'repeated' END AS class
        FROM documents LEFT JOIN (SELECT doc_id, count(*) AS n FROM labels GROUP BY 1) USING (doc_id)""",
    "anti_semi": """
        SELECT c_custkey AS k, 'customer' AS side FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
        UNION ALL SELECT DISTINCT o_custkey, 'orders' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)""",
    "explained_diff": f"""
        SELECT o_orderkey, (total - round(o_totalprice * 100)::BIGINT)::BIGINT AS difference, CASE WHEN flag = 'R' THEN 'has returns' ELSE 'unexplained' END AS reason
        FROM orders JOIN ({_LINES}) ON l_orderkey = o_orderkey WHERE total <> round(o_totalprice * 100)::BIGINT""",
    "figure_recount": "SELECT doc_id, n_chars AS printed, length(text)::BIGINT AS counted, n_chars IS NOT DISTINCT FROM length(text) AS ok FROM documents",
    "report_recount": """
        SELECT *, printed = counted AS ok FROM (
          SELECT 'orders' AS what, (SELECT count(*) FROM orders) AS printed, (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS counted
          UNION ALL SELECT 'customers', (SELECT count(*) FROM customer), (SELECT count(DISTINCT o_custkey) FROM orders)
          UNION ALL SELECT 'parts', (SELECT count(*) FROM part), (SELECT count(DISTINCT l_partkey) FROM lineitem))""",
    "judged_rollup": """
        SELECT source, count(quality) AS judged, count(*) FILTER (quality = 0) AS findings,
               CASE WHEN count(quality) = 0 THEN 'NOT RUN' WHEN count(*) FILTER (quality = 0) = 0 THEN 'PASS' ELSE 'FAIL' END AS outcome
        FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source""",
    "unambiguous_repair": """
        WITH c AS (SELECT c_nationkey AS nation, min(c_custkey) AS c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) GROUP BY 1 HAVING count(*) = 1),
             s AS (SELECT s_nationkey AS nation, min(s_suppkey) AS s_suppkey FROM supplier WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_returnflag = 'R') GROUP BY 1 HAVING count(*) = 1)
        SELECT nation, c_custkey, s_suppkey FROM c JOIN s USING (nation)""",
    "tolerant_equality": """
        SELECT *, abs(a - b) * 50 <= greatest(250000, b) AS close FROM (
          SELECT o_custkey, arg_min(round(o_totalprice * 100)::BIGINT, o_orderkey) AS a, arg_max(round(o_totalprice * 100)::BIGINT, o_orderkey) AS b FROM orders GROUP BY 1)""",
    "positional_diff": """
        WITH x AS (SELECT l_orderkey, l_linenumber::BIGINT AS n,
                     row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity) AS p,
                     row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity) AS q FROM lineitem)
        SELECT a.l_orderkey, a.p AS place, a.n AS printed, b.n AS found FROM x a JOIN x b ON a.l_orderkey = b.l_orderkey AND a.p = b.q WHERE a.n <> b.n""",
}
