"""Audit queries: pairings, substitutes, tolerances, contracts, findings by severity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.plans.reconcile import cents
from lectern.session import table


def twin_existence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with a note whether another part has the same brand and size."""
    p = table(spark, sf_dir, "part")
    n = p.groupBy("p_brand", "p_size").agg(F.count(F.lit(1)).alias("n"))
    return p.join(n, ["p_brand", "p_size"]).select("p_partkey", (F.col("n") > 1).alias("has_twin"))


def answer_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions and answers of a conversation paired by number; those without a partner on either side."""
    c = table(spark, sf_dir, "conversations")
    w = Window.partitionBy("conv_id", "role").orderBy("turn")
    c = c.withColumn("n", F.row_number().over(w).cast("long"))
    q = c.filter("role = 'user'").select("conv_id", "n", F.col("turn").alias("question"))
    a = c.filter("role <> 'user'").select("conv_id", "n", F.col("turn").alias("answer"))
    both = q.join(a, ["conv_id", "n"], "full_outer")
    return both.withColumn("class", F.when(F.col("answer").isNull(), "no answer").when(F.col("question").isNull(), "no question").otherwise("paired"))


def alternative_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open lines' quantity of an order where all lines' quantity is odd and the open lines' even, else all."""
    q = F.col("l_quantity").cast("long")
    g = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum(q).alias("every"), F.coalesce(F.sum(F.when(F.col("l_linestatus") == "O", q)), F.lit(0)).alias("open"))
    first = (F.col("every") % 2 == 1) & (F.col("open") % 2 == 0) & (F.col("open") > 0)
    return g.select("l_orderkey", F.when(first, F.col("open")).otherwise(F.col("every")).alias("marks"), first.alias("replaced"))


def verified_substitute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals, replaced by the sum of lines where that is within a tenth of them."""
    li = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(cents("l_extendedprice")).alias("line_cents"))
    x = table(spark, sf_dir, "orders").select("o_orderkey", cents("o_totalprice").alias("printed")).join(li, "o_orderkey", "left")
    near = F.coalesce(F.abs(F.col("line_cents") - F.col("printed")) * 10 <= F.col("printed"), F.lit(False))
    return x.select("o_orderkey", F.when(near, F.col("line_cents")).otherwise(F.col("printed")).alias("total"), near.alias("replaced"))


def truncated_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Printed titles that end in dots match what they begin; others must be equal."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.when(F.col("p_size") % 3 == 0, F.concat(F.substring("p_name", 1, 6), F.lit("..."))).when(F.col("p_size") % 3 == 1, F.col("p_name")).otherwise(F.concat(F.col("p_name"), F.lit("!"))).alias("printed"))
    cut = F.regexp_replace("printed", r"\.\.\.$", "")
    ok = F.when(F.endswith("printed", F.lit("...")), F.startswith("p_name", cut)).otherwise(F.col("printed") == F.col("p_name"))
    return p.select("p_partkey", "printed", ok.alias("ok"))


def interval_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price intervals of lines that are not the catalogued one of their part within 300 at either end.

    A line's runs from its price in units by as much as its quantity, a part's from its price by its size.
    """
    q = F.col("l_quantity").cast("long")
    low = F.floor(F.col("l_extendedprice")).cast("long")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", low.alias("low"), (low + q).alias("high"))
    start = F.floor(F.col("p_retailprice")).cast("long")
    known = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), start.alias("from"), (start + F.col("p_size")).alias("to"))
    same = (F.abs(F.col("low") - F.col("from")) <= 300) & (F.abs(F.col("high") - F.col("to")) <= 300)
    return li.join(known, "l_partkey", "left").filter(~F.coalesce(same, F.lit(False))).select("l_orderkey", "l_linenumber", "l_partkey", "low", "high", "from", "to")


def listing_both_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources listed with a label and sources that have documents, both ways."""
    d = table(spark, sf_dir, "documents")
    listed = d.join(table(spark, sf_dir, "labels").filter("toxic = 1"), "doc_id").groupBy("source").agg(F.count(F.lit(1)).alias("listed"))
    there = d.groupBy("source").agg(F.count(F.lit(1)).alias("there"))
    return there.join(listed, "source", "full_outer").select("source", F.coalesce("there", F.lit(0)).alias("there"), F.coalesce("listed", F.lit(0)).alias("listed"))


def output_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables whose columns are not those that they should be, name and order."""
    wanted = {
        "region": "r_regionkey,r_name", "nation": "n_nationkey,n_name,n_regionkey", "labels": "doc_id,quality,toxic",
        "benchmark": "item_id,text", "pages": "page_id,url,html", "conversations": "conv_id,turn,role,text",
    }
    one = [spark.range(1).select(F.lit(t).alias("name"), F.lit(",".join(table(spark, sf_dir, t).columns)).alias("found"), F.lit(c).alias("wanted")) for t, c in wanted.items()]
    return reduce(DataFrame.unionByName, one).withColumn("ok", F.col("found") == F.col("wanted"))


def findings_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of three checks in one register, with severity."""
    o, c, d = (table(spark, sf_dir, t) for t in ("orders", "customer", "documents"))
    row = lambda df, check, severity, ref: df.select(F.lit(check).alias("check"), F.lit(severity).alias("severity"), F.concat_ws(":", F.lit(check), F.col(ref).cast("string")).alias("ref"))
    return (
        row(c.filter("c_acctbal < 0"), "debt", "major", "c_custkey")
        .unionByName(row(o.filter("o_totalprice > 400000"), "large", "minor", "o_orderkey"))
        .unionByName(row(d.filter("n_chars < 40"), "short", "minor", "doc_id"))
    )


def not_newest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a customer that are newer than the one printed before them, printed by key."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    x = table(spark, sf_dir, "orders").withColumn("before", F.lag("o_orderdate").over(w)).filter("o_orderdate > before")
    return x.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first"))


def finest_common_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders compared with their lines at the finest level that both have: lines if numbers agree, else the order."""
    li = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_set("l_linenumber")).alias("a"), F.count(F.lit(1)).alias("n"))
    level = F.when((F.size("a") == F.col("n")) & (F.col("a") == F.sequence(F.lit(1), F.size("a"))), "line").otherwise("order")
    return li.select("l_orderkey", level.alias("level"))


def split_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order numbered anew without holes, with how far each moved."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice")
    x = table(spark, sf_dir, "lineitem").withColumn("place", F.row_number().over(w).cast("long"))
    return x.select("l_orderkey", "place", (F.col("l_linenumber") - F.col("place")).cast("long").alias("moved"))


QUERIES = {f.__name__: f for f in (twin_existence, answer_pairing, alternative_choice, verified_substitute, truncated_prefix, interval_equality, listing_both_ways, output_contract, findings_register, not_newest_first, finest_common_level, split_positions)}

ORACLES = {
    "twin_existence": "SELECT p_partkey, count(*) OVER (PARTITION BY p_brand, p_size) > 1 AS has_twin FROM part",
    "answer_pairing": """
        WITH c AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS n FROM conversations)
        SELECT coalesce(q.conv_id, a.conv_id) AS conv_id, coalesce(q.n, a.n) AS n, q.turn AS question, a.turn AS answer,
               CASE WHEN a.turn IS NULL THEN 'no answer' WHEN q.turn IS NULL THEN 'no question' ELSE 'paired' END AS class
        FROM (SELECT * FROM c WHERE role = 'user') q FULL JOIN (SELECT * FROM c WHERE role <> 'user') a ON q.conv_id = a.conv_id AND q.n = a.n""",
    "alternative_choice": """
        SELECT l_orderkey, CASE WHEN e % 2 = 1 AND o % 2 = 0 AND o > 0 THEN o ELSE e END AS marks, e % 2 = 1 AND o % 2 = 0 AND o > 0 AS replaced FROM (
          SELECT l_orderkey, sum(l_quantity::BIGINT)::BIGINT AS e, coalesce(sum(l_quantity::BIGINT) FILTER (l_linestatus = 'O'), 0)::BIGINT AS o FROM lineitem GROUP BY 1)""",
    "verified_substitute": """
        SELECT o_orderkey, CASE WHEN near THEN l ELSE p END AS total, near AS replaced FROM (
          SELECT *, coalesce(abs(l - p) * 10 <= p, false) AS near FROM (
            SELECT o_orderkey, round(o_totalprice * 100)::BIGINT AS p, l FROM orders LEFT JOIN (SELECT l_orderkey, sum(round(l_extendedprice * 100)::BIGINT)::BIGINT AS l FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey))""",
    "truncated_prefix": """
        SELECT p_partkey, printed, CASE WHEN ends_with(printed, '...') THEN starts_with(p_name, printed[1:-4]) ELSE printed = p_name END AS ok FROM (
          SELECT *, CASE p_size % 3 WHEN 0 THEN p_name[1:6] || '...' WHEN 1 THEN p_name ELSE p_name || '!' END AS printed FROM part)""",
    "interval_equality": """
        SELECT l_orderkey, l_linenumber, l_partkey, low, high, "from", "to" FROM (SELECT *, floor(l_extendedprice)::BIGINT AS low, floor(l_extendedprice)::BIGINT + l_quantity::BIGINT AS high FROM lineitem)
        LEFT JOIN (SELECT p_partkey, floor(p_retailprice)::BIGINT AS "from", floor(p_retailprice)::BIGINT + p_size AS "to" FROM part) ON p_partkey = l_partkey
        WHERE NOT coalesce(abs(low - "from") <= 300 AND abs(high - "to") <= 300, false)""",
    "listing_both_ways": """
        SELECT source, count(DISTINCT d.doc_id) AS there, count(l.doc_id) AS listed FROM documents d LEFT JOIN (SELECT * FROM labels WHERE toxic = 1) l USING (doc_id) GROUP BY 1""",
    "output_contract": " UNION ALL ".join(
        f"SELECT '{t}' AS name, '{c}' AS found, '{c}' AS wanted, true AS ok"
        for t, c in (("region", "r_regionkey,r_name"), ("nation", "n_nationkey,n_name,n_regionkey"), ("labels", "doc_id,quality,toxic"), ("benchmark", "item_id,text"), ("pages", "page_id,url,html"), ("conversations", "conv_id,turn,role,text"))
    ),
    "findings_register": """
        SELECT 'debt' AS check, 'major' AS severity, 'debt:' || c_custkey AS ref FROM customer WHERE c_acctbal < 0
        UNION ALL SELECT 'large', 'minor', 'large:' || o_orderkey FROM orders WHERE o_totalprice > 400000
        UNION ALL SELECT 'short', 'minor', 'short:' || doc_id FROM documents WHERE n_chars < 40""",
    "not_newest_first": """
        SELECT o_custkey, count(*) AS n, min(o_orderkey) AS first FROM (SELECT *, lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS b FROM orders) WHERE o_orderdate > b GROUP BY 1""",
    "finest_common_level": """
        SELECT l_orderkey, CASE WHEN count(DISTINCT l_linenumber) = count(*) AND min(l_linenumber) = 1 AND max(l_linenumber) = count(*) THEN 'line' ELSE 'order' END AS level FROM lineitem GROUP BY 1""",
    "split_positions": """
        SELECT l_orderkey, place, (l_linenumber - place)::BIGINT AS moved FROM (
          SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice) AS place FROM lineitem)""",
}
