"""Rows in order: islands, intervals, gaps, the row before, the nearest row, reachability."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.operators import asof as A
from lectern.operators import closure as C
from lectern.operators import islands as I
from lectern.operators import kernels as K
from lectern.operators import ranges, sequence
from lectern.plans.reconcile import cents
from lectern.session import table


def timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their second."""
    return table(spark, sf_dir, "events").withColumn("sec", F.unix_seconds(F.col("ts").cast("timestamp")))


def sessions_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions: a user's events less than half an hour apart."""
    x = I.gap_islands(timed(spark, sf_dir), ["user_id"], "sec", 1800, ["event_id"])
    return x.groupBy("user_id", "island").agg(F.min("sec").alias("start"), F.max("sec").alias("end"), F.count(F.lit(1)).alias("n"))


def topic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of equal event types of a user, two events or more."""
    x = I.value_runs(timed(spark, sf_dir), ["user_id"], ["sec", "event_id"], "event_type")
    return x.groupBy("user_id", "run", "event_type").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")


def interval_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line boxes [quantity, quantity + size] of a supplier, merged where they lie 2 apart or less."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", (F.col("l_orderkey") % 500 * 10).alias("low"), (F.col("l_orderkey") % 500 * 10 + F.col("l_quantity").cast("long") % 9).alias("high"))
    return I.merge_intervals(li, ["l_suppkey"], "low", "high", 2)


def sequence_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.missing_numbers(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_linenumber")


def sequence_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the distinct line numbers of an order are 1 to n."""
    g = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_set("l_linenumber")).alias("s"))
    return g.select("l_orderkey", (F.col("s") == F.sequence(F.lit(1), F.size("s"))).alias("dense"))


def next_of_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each view with the user's next purchase."""
    x = sequence.next_of_kind(timed(spark, sf_dir), ["user_id"], ["sec", "event_id"], F.when(F.col("event_type") == "purchase", F.col("event_id")), "purchase")
    return x.filter("event_type = 'view'").select("event_id", "purchase")


def previous_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turn before of the same role, and the number of turns between."""
    x = sequence.with_previous(table(spark, sf_dir, "conversations"), ["conv_id", "role"], ["turn"], "turn", "previous")
    return x.select("conv_id", "turn", "previous", (F.col("turn") - F.col("previous")).alias("apart"))


def fill_forward_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user's last signup at each event."""
    x = sequence.filled_forward(timed(spark, sf_dir), ["user_id"], ["sec", "event_id"], F.when(F.col("event_type") == "signup", F.col("event_id")), "signup")
    return x.select("event_id", "signup")


def order_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose value is below that of the user's event before."""
    x = sequence.with_previous(timed(spark, sf_dir), ["user_id"], ["sec", "event_id"], "value", "before")
    return x.filter("value < before").select("event_id", "value", "before")


def asof_last_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase with the user's last error at or before it."""
    e = timed(spark, sf_dir)
    left = e.filter("event_type = 'purchase'").select("user_id", "sec", "event_id")
    right = e.filter("event_type = 'error'").select("user_id", "sec", F.col("event_id").alias("error_id"))
    return A.asof(left, right, ["user_id"], "sec", ["error_id"], "error_id").select("event_id", "error_id")


def nearest_two_sided(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase with the seconds to the user's nearest error on either side."""
    e = timed(spark, sf_dir)
    left = e.filter("event_type = 'purchase'").select("user_id", "sec", "event_id")
    right = e.filter("event_type = 'error'").select("user_id", "sec", F.col("event_id").alias("error_id"))
    return A.nearest(left, right, ["user_id"], "sec", "error_id").select("event_id", "distance")


def range_bucket_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by price band; bands start at powers of ten and are a table of six rows."""
    starts = spark.range(6).select(F.col("id").alias("band"), F.pow(F.lit(10), F.col("id")).cast("long").alias("start"))
    bands = A.bucket_bounds(starts, "start", "band")
    o = table(spark, sf_dir, "orders").select(cents("o_totalprice").alias("c"))
    whole = F.floor(F.col("c") / 100)
    x = o.join(F.broadcast(bands), (whole >= F.col("start")) & (F.col("until").isNull() | (whole < F.col("until"))))
    return x.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.sum("c").alias("total_cents"))


def range_join_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views followed within five minutes by a click of the same user; joined by user and bucket of time."""
    e = timed(spark, sf_dir)
    views = e.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("view_id"), F.col("sec").alias("a0"), (F.col("sec") + 300).alias("a1"))
    clicks = e.filter("event_type = 'click'").select("user_id", F.col("event_id").alias("click_id"), F.col("sec").alias("b0"), F.col("sec").alias("b1"))
    return ranges.overlap_join(views, clicks, ["user_id"], ("a0", "a1"), ("b0", "b1"), 600).select("view_id", "click_id")


def rect_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line boxes of an order that overlap, each pair once: how much of the first lies in the second, in thousandths.

    Line numbers repeat within an order, so lines are told apart by their place in it.
    """
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice")
    li = table(spark, sf_dir, "lineitem").withColumn("place", F.row_number().over(w).cast("long")).select("l_orderkey", "place", "l_partkey", (F.col("l_partkey") % 40).alias("x"), (F.col("l_partkey") % 40 + F.col("l_quantity").cast("long") + 1).alias("y"))
    a = li.select("l_orderkey", F.col("place").alias("a"), F.col("l_partkey").alias("ap"), F.col("x").alias("a0"), F.col("y").alias("a1"))
    b = li.select("l_orderkey", F.col("place").alias("b"), F.col("l_partkey").alias("bp"), F.col("x").alias("b0"), F.col("y").alias("b1"))
    pairs = ranges.overlap_join(a, b, ["l_orderkey"], ("a0", "a1"), ("b0", "b1"), 64).filter("a < b")
    return pairs.select("l_orderkey", "a", "b", "ap", "bp", F.floor(1000 * ranges.overlap_share(("a0", "a1"), ("b0", "b1"))).cast("long").alias("share"))


def lost_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers taken as printed pages: where they jump further than the lines do."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", F.row_number().over(w).cast("long").alias("place"), F.col("l_linenumber").cast("long").alias("printed"))
    return sequence.lost_ranges(li, ["l_orderkey"], "place", "printed").select("l_orderkey", "place", "printed", "lost_from", "lost")


def recursive_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers reached from a customer over edges k -> 3k + 1 below the highest key, to any depth."""
    c = table(spark, sf_dir, "customer")
    top = c.agg(F.max("c_custkey").alias("top"))
    edges = c.select(F.col("c_custkey").alias("src"), (F.col("c_custkey") * 3 + 1).alias("dst")).crossJoin(F.broadcast(top)).filter("dst <= top")  # one row
    return C.closure(edges)


def lis_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers read with errors, aligned by their longest increasing subsequence."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_partkey").alias("at"), F.col("l_linenumber").cast("long").alias("n"))
    return K.align_numbers(li, "l_orderkey", "at", "n")


def page_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of a source packed on pages by height, runs of one language kept together."""
    d = table(spark, sf_dir, "documents").select("source", "doc_id", (F.col("n_chars") % 400 + 10).cast("double").alias("height"), "lang")
    return K.page_flow(d, "source", "doc_id", "height", "lang", 800.0, 4.0)


QUERIES = {f.__name__: f for f in (sessions_islands, topic_runs, interval_merge, sequence_gaps, sequence_check, next_of_kind, previous_item, fill_forward_state, order_violations, asof_last_before, nearest_two_sided, range_bucket_lookup, range_join_window, rect_overlap, lost_ranges, recursive_closure, lis_alignment, page_packing)}

_E = "(SELECT *, floor(epoch(ts))::BIGINT AS sec FROM events)"
_U = "PARTITION BY user_id ORDER BY sec, event_id"
ORACLES = {
    "sessions_islands": f"""
        SELECT user_id, island, min(sec) AS start, max(sec) AS "end", count(*) AS n FROM (
          SELECT *, sum(f) OVER ({_U})::BIGINT AS island FROM (SELECT *, CASE WHEN sec - lag(sec) OVER ({_U}) <= 1800 THEN 0 ELSE 1 END AS f FROM {_E})) GROUP BY 1, 2""",
    "topic_runs": f"""
        SELECT user_id, run, event_type, count(*) AS n FROM (
          SELECT *, sum(f) OVER ({_U})::BIGINT AS run FROM (SELECT *, CASE WHEN event_type = lag(event_type) OVER ({_U}) THEN 0 ELSE 1 END AS f FROM {_E})) GROUP BY 1, 2, 3 HAVING count(*) >= 2""",
    "interval_merge": """
        WITH x AS (SELECT l_suppkey, l_orderkey % 500 * 10 AS low, l_orderkey % 500 * 10 + l_quantity::BIGINT % 9 AS high FROM lineitem),
             f AS (SELECT *, CASE WHEN low <= max(high) OVER (PARTITION BY l_suppkey ORDER BY low, high ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 2 THEN 0 ELSE 1 END AS f FROM x),
             g AS (SELECT *, sum(f) OVER (PARTITION BY l_suppkey ORDER BY low, high) AS g FROM f)
        SELECT l_suppkey, min(low) AS low, max(high) AS high, count(*) AS n FROM g GROUP BY l_suppkey, g""",
    "sequence_gaps": """
        SELECT DISTINCT o.l_orderkey, r.n AS missing FROM (SELECT l_orderkey, max(l_linenumber) AS m FROM lineitem GROUP BY 1) o, range(1, 100) r(n)
        WHERE r.n < m AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.l_orderkey AND l.l_linenumber = r.n)""",
    "sequence_check": "SELECT l_orderkey, count(DISTINCT l_linenumber) = max(l_linenumber) AND min(l_linenumber) = 1 AS dense FROM lineitem GROUP BY 1",
    "next_of_kind": f"""
        SELECT event_id, purchase FROM (SELECT *, first_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER ({_U} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS purchase FROM {_E}) WHERE event_type = 'view'""",
    "previous_item": "SELECT conv_id, turn, lag(turn) OVER w AS previous, turn - lag(turn) OVER w AS apart FROM conversations WINDOW w AS (PARTITION BY conv_id, role ORDER BY turn)",
    "fill_forward_state": f"SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER ({_U} ROWS UNBOUNDED PRECEDING) AS signup FROM {_E}",
    "order_violations": f"SELECT event_id, value, before FROM (SELECT *, lag(value) OVER ({_U}) AS before FROM {_E}) WHERE value < before",
    "asof_last_before": f"""
        SELECT p.event_id, (SELECT arg_max(e.event_id, (e.sec, e.event_id)) FROM {_E} e WHERE e.event_type = 'error' AND e.user_id = p.user_id AND e.sec <= p.sec) AS error_id
        FROM {_E} p WHERE p.event_type = 'purchase'""",
    "nearest_two_sided": f"""
        SELECT p.event_id, min(abs(e.sec - p.sec)) AS distance FROM {_E} p LEFT JOIN {_E} e ON e.event_type = 'error' AND e.user_id = p.user_id WHERE p.event_type = 'purchase' GROUP BY 1""",
    "range_bucket_lookup": """
        SELECT band, count(*) AS n, sum(c)::BIGINT AS total_cents FROM (SELECT round(o_totalprice * 100)::BIGINT AS c FROM orders) JOIN
          (SELECT i AS band, (10 ** i)::BIGINT AS lo, CASE WHEN i < 5 THEN (10 ** (i + 1))::BIGINT END AS hi FROM range(6) t(i)) ON c // 100 >= lo AND (hi IS NULL OR c // 100 < hi) GROUP BY 1""",
    "range_join_window": f"""
        SELECT v.event_id AS view_id, c.event_id AS click_id FROM {_E} v JOIN {_E} c ON v.user_id = c.user_id AND v.event_type = 'view' AND c.event_type = 'click' AND c.sec BETWEEN v.sec AND v.sec + 300""",
    "rect_overlap": """
        WITH x AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice) AS n, l_partkey AS p, l_partkey % 40 AS x, l_partkey % 40 + l_quantity::BIGINT + 1 AS y FROM lineitem)
        SELECT a.l_orderkey, a.n AS a, b.n AS b, a.p AS ap, b.p AS bp, (1000 * greatest(0, least(a.y, b.y) - greatest(a.x, b.x)) // (a.y - a.x))::BIGINT AS share
        FROM x a JOIN x b ON a.l_orderkey = b.l_orderkey AND a.n < b.n AND a.x <= b.y AND b.x <= a.y""",
    "lost_ranges": """
        WITH x AS (SELECT l_orderkey, l_linenumber::BIGINT AS printed, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice) AS place FROM lineitem)
        SELECT * FROM (SELECT l_orderkey, place, printed, lag(printed) OVER w + 1 AS lost_from, printed - lag(printed) OVER w - 1 AS lost FROM x WINDOW w AS (PARTITION BY l_orderkey ORDER BY place)) WHERE lost > 0""",
    "recursive_closure": """
        WITH RECURSIVE e AS (SELECT c_custkey AS src, c_custkey * 3 + 1 AS dst FROM customer WHERE c_custkey * 3 + 1 <= (SELECT max(c_custkey) FROM customer)),
          r AS (SELECT src, dst, 1::BIGINT AS depth FROM e UNION SELECT r.src, e.dst, r.depth + 1 FROM r JOIN e ON r.dst = e.src)
        SELECT src, dst, min(depth) AS depth FROM r GROUP BY 1, 2""",
}
