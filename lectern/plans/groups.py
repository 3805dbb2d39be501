"""Roll-ups, majorities, medians, modes, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.operators import rank
from lectern.operators.textmatch import ordered_concat
from lectern.plans.reconcile import cents
from lectern.session import table


def rollup_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances by nation, region and overall."""
    r, n = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    dim = n.join(r, n["n_regionkey"] == r["r_regionkey"]).select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")
    x = table(spark, sf_dir, "customer").join(dim, "c_nationkey")
    return x.rollup("r_name", "n_name").agg(F.count(F.lit(1)).alias("customers"), F.sum(cents("c_acctbal")).alias("balance_cents"))


def decimal_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum(cents("l_extendedprice")).alias("total_cents"))


def majority_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The priority with most money per customer; of equals the one seen first."""
    return rank.majority(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderpriority", cents("o_totalprice"), "o_orderkey")


def map_of_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums per order and flag, held as a map and read out again."""
    g = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.sum(cents("l_extendedprice")).alias("v"))
    m = g.groupBy("l_orderkey").agg(F.map_from_entries(F.collect_list(F.struct("l_returnflag", "v"))).alias("m"))
    return m.select("l_orderkey", F.explode("m").alias("flag", "total_cents"))


def conditional_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = ["click", "error", "purchase", "signup", "view"]
    return table(spark, sf_dir, "events").groupBy("user_id").agg(*(F.count_if(F.col("event_type") == k).alias(k) for k in kinds))


def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").groupBy("quality", "toxic").agg(F.count(F.lit(1)).alias("n"))


def thin_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations with fewer than 4 suppliers, those with none too."""
    n, s = table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier")
    return n.join(s, n["n_nationkey"] == s["s_nationkey"], "left").groupBy("n_name").agg(F.count("s_suppkey").alias("suppliers")).filter("suppliers < 4")


def upper_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank.upper_median(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], "o_totalprice", ["o_orderkey"])


def mode_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The commonest quantity per part; of equals that of the lowest order."""
    g = table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_quantity").agg(F.count(F.lit(1)).alias("n"), F.min("l_orderkey").alias("first"))
    return rank.top(g, ["l_partkey"], [F.desc("n"), "first", "l_quantity"]).select("l_partkey", "l_quantity", "n")


def newest_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max(F.struct("o_orderdate", "o_orderkey", "o_orderstatus")).alias("x"))
    return g.select("o_custkey", "x.o_orderkey", "x.o_orderstatus")


def distinct_and_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct parts, lines and money per supplier, and the same overall: distinct counts are recounted and not added."""
    return table(spark, sf_dir, "lineitem").rollup("l_suppkey").agg(F.countDistinct("l_partkey").alias("parts"), F.count(F.lit(1)).alias("lines"), F.sum(cents("l_extendedprice")).alias("total_cents"))


def reason_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.substring("o_orderpriority", 1, 1)
    c = F.when(k.isin("1", "2"), "soon").when(k == "3", "normal").otherwise("later")
    return table(spark, sf_dir, "orders").groupBy(c.alias("class"), "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


def drop_grand_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose last line equals the sum of the others, as a printed total would; with that line left out."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice")
    q = F.col("l_quantity").cast("long")
    x = table(spark, sf_dir, "lineitem").withColumns({"last": F.lead("l_linenumber").over(w).isNull(), "q": q, "total": F.sum(q).over(Window.partitionBy("l_orderkey"))})
    g = x.groupBy("l_orderkey").agg(F.max("total").alias("total"), F.max(F.when(F.col("last"), F.col("q"))).alias("last"), F.count(F.lit(1)).alias("n"))
    printed = (F.col("n") > 1) & (F.col("last") * 2 == F.col("total"))
    return g.select("l_orderkey", printed.alias("dropped"), F.when(printed, F.col("total") - F.col("last")).otherwise(F.col("total")).alias("marks"))


def extents(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "lineitem").groupBy("l_suppkey")
    return g.agg(F.min("l_quantity").alias("low"), F.max("l_quantity").alias("high"), F.every(F.col("l_discount") < 0.05).alias("all_cheap"), F.some(F.col("l_discount") == 0).alias("any_full"))


def all_sorted_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "events").groupBy("user_id").agg(F.array_join(F.sort_array(F.collect_set("event_type")), ",").alias("kinds"))
    return g


def even_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank.even_sample(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"], ["o_orderkey"], 5)


def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten customers of each segment in the order of a seeded hash."""
    x = table(spark, sf_dir, "customer").select("c_mktsegment", "c_custkey")
    return rank.hash_sample(x, ["c_mktsegment"], "c_custkey", 10, "seed-7")


def ordered_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered_concat(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderkey", F.col("o_orderstatus"))


def top_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report of the 25 largest orders."""
    return table(spark, sf_dir, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25).select("o_orderkey", "o_totalprice")


def set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part and supplier pairs of open and of finished lines: in both, in one, with repetitions left over."""
    li = table(spark, sf_dir, "lineitem")
    a, b = (li.filter(F.col("l_linestatus") == s).select("l_partkey", "l_suppkey") for s in ("O", "F"))
    kinds = {"both": a.intersect(b), "only open": a.subtract(b), "either": a.union(b).distinct(), "more open": a.exceptAll(b)}
    out = None
    for name, df in kinds.items():
        n = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("kind"), "n")
        out = n if out is None else out.unionByName(n)
    return out


QUERIES = {f.__name__: f for f in (rollup_levels, decimal_totals, majority_category, map_of_sums, conditional_pivot, confusion_matrix, thin_groups, upper_median, mode_first_seen, newest_per_group, distinct_and_sum, reason_histogram, drop_grand_total, extents, all_sorted_sets, even_sample, hash_sample, ordered_texts, top_orders, set_operations)}

ORACLES = {
    "rollup_levels": """
        SELECT r_name, n_name, count(*) AS customers, sum(round(c_acctbal * 100)::BIGINT)::BIGINT AS balance_cents
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)""",
    "decimal_totals": "SELECT l_orderkey, sum(round(l_extendedprice * 100)::BIGINT)::BIGINT AS total_cents FROM lineitem GROUP BY 1",
    "majority_category": """
        SELECT o_custkey, o_orderpriority, weight, tied FROM (
          SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY weight DESC, f) AS n, count(*) OVER (PARTITION BY o_custkey, weight) > 1 AS tied FROM (
            SELECT o_custkey, o_orderpriority, sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS weight, min(o_orderkey) AS f FROM orders GROUP BY 1, 2)) WHERE n = 1""",
    "map_of_sums": "SELECT l_orderkey, l_returnflag AS flag, sum(round(l_extendedprice * 100)::BIGINT)::BIGINT AS total_cents FROM lineitem GROUP BY 1, 2",
    "conditional_pivot": "SELECT user_id, " + ", ".join(f"count(*) FILTER (event_type = '{k}') AS {k}" for k in ("click", "error", "purchase", "signup", "view")) + " FROM events GROUP BY 1",
    "confusion_matrix": "SELECT quality, toxic, count(*) AS n FROM labels GROUP BY 1, 2",
    "thin_groups": "SELECT n_name, count(s_suppkey) AS suppliers FROM nation LEFT JOIN supplier ON n_nationkey = s_nationkey GROUP BY 1 HAVING count(s_suppkey) < 4",
    "upper_median": """
        SELECT o_custkey, o_orderkey, o_totalprice FROM (
          SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) - 1 AS n, count(*) OVER (PARTITION BY o_custkey) AS c FROM orders) WHERE n = c // 2""",
    "mode_first_seen": """
        SELECT l_partkey, l_quantity, n FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY n DESC, f, l_quantity) AS r FROM (
          SELECT l_partkey, l_quantity, count(*) AS n, min(l_orderkey) AS f FROM lineitem GROUP BY 1, 2)) WHERE r = 1""",
    "newest_per_group": """
        SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC, o_orderstatus DESC) AS n FROM orders) WHERE n = 1""",
    "distinct_and_sum": """
        SELECT l_suppkey, count(DISTINCT l_partkey) AS parts, count(*) AS lines, sum(round(l_extendedprice * 100)::BIGINT)::BIGINT AS total_cents FROM lineitem GROUP BY ROLLUP (l_suppkey)""",
    "reason_histogram": """
        SELECT CASE WHEN o_orderpriority[1] IN ('1', '2') THEN 'soon' WHEN o_orderpriority[1] = '3' THEN 'normal' ELSE 'later' END AS class, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2""",
    "drop_grand_total": """
        WITH x AS (SELECT l_orderkey, l_quantity::BIGINT AS q, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_shipdate DESC, l_quantity DESC, l_extendedprice DESC) AS r FROM lineitem),
             g AS (SELECT l_orderkey, sum(q)::BIGINT AS total, max(q) FILTER (r = 1) AS last, count(*) AS n FROM x GROUP BY 1)
        SELECT l_orderkey, n > 1 AND last * 2 = total AS dropped, CASE WHEN n > 1 AND last * 2 = total THEN total - last ELSE total END AS marks FROM g""",
    "extents": "SELECT l_suppkey, min(l_quantity) AS low, max(l_quantity) AS high, bool_and(l_discount < 0.05) AS all_cheap, bool_or(l_discount = 0) AS any_full FROM lineitem GROUP BY 1",
    "all_sorted_sets": "SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS kinds FROM events GROUP BY 1",
    "even_sample": """
        SELECT o_custkey, o_orderkey, min(j)::BIGINT AS pick FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS n, count(*) OVER (PARTITION BY o_custkey) AS c FROM orders), range(5) t(j)
        WHERE n = j * c // 5 GROUP BY 1, 2""",
    "hash_sample": """
        SELECT c_mktsegment, c_custkey, k AS sample_key FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY k) AS n FROM (SELECT *, sha256('seed-7:' || c_custkey) AS k FROM customer)) WHERE n <= 10""",
    "ordered_texts": "SELECT o_custkey, string_agg(o_orderstatus, ',' ORDER BY o_orderkey) AS texts FROM orders GROUP BY 1",
    "top_orders": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25",
    "set_operations": """
        WITH a AS (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_linestatus = 'O'), b AS (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_linestatus = 'F')
        SELECT 'both' AS kind, count(*) AS n FROM (FROM a INTERSECT FROM b) UNION ALL SELECT 'only open', count(*) FROM (FROM a EXCEPT FROM b)
        UNION ALL SELECT 'either', count(*) FROM (FROM a UNION FROM b) UNION ALL SELECT 'more open', count(*) FROM (FROM a EXCEPT ALL FROM b)""",
}
