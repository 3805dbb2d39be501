"""Marks read and counted once, places in units, lookups in tiers, and texts compared without their form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.session import table

LINE = ("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice")


def marks_read(printed: Column, total: Column) -> Column:
    """A row's marks: what '[max N]' says, else the total column, else the sum of the numbers printed; null without any."""
    most = F.regexp_extract(printed, r"\[max ([0-9]+)\]", 1)
    numbers = F.regexp_extract_all(printed, F.lit("([0-9]+)"), F.lit(1))
    summed = F.aggregate(numbers, F.lit(0).cast("long"), lambda s, x: s + x.cast("long"))
    return F.coalesce(F.when(most != "", most.cast("long")), total, F.when(F.size(numbers) > 0, summed))


def row_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks of printed rows: sums, some with a maximum, some empty beside a total, some empty without."""
    kind, n = F.col("p_size") % 4, F.col("p_size").cast("string")
    printed = F.when(kind == 0, F.concat(n, F.lit("+2 [max 4]"))).when(kind == 1, F.concat(n, F.lit("+1+1"))).when(kind == 2, n).otherwise("")
    total = F.when((kind == 3) & (F.col("p_partkey") % 2 == 0), F.col("p_partkey") % 10)
    p = table(spark, sf_dir, "part").select("p_partkey", printed.alias("printed"), total.alias("total"))
    return p.withColumn("marks", marks_read(F.col("printed"), F.col("total")))


def max_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities of an order and flag: once where all lines have the same, else added up."""
    q = F.col("l_quantity").cast("long")
    g = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.min(q).alias("low"), F.max(q).alias("high"), F.sum(q).alias("all"))
    once = F.col("low") == F.col("high")
    return g.select("l_orderkey", "l_returnflag", once.alias("once"), F.when(once, F.col("low")).otherwise(F.col("all")).alias("marks"))


def repeat_suppression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a customer, those with priority and status of the order before not counted."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    now = F.struct("o_orderpriority", "o_orderstatus")
    x = table(spark, sf_dir, "orders").select("o_custkey", F.coalesce(F.lag(now).over(w) == now, F.lit(False)).alias("again"))
    return x.groupBy("o_custkey").agg(F.count_if(~F.col("again")).alias("counted"), F.count_if("again").alias("repeats"))


def after_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a user after their first purchase, and those not before it; all users, none where nothing was bought."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    first = e.filter("event_type = 'purchase'").groupBy("user_id").agg(F.min("event_id").alias("first"))
    return e.join(first, "user_id", "left").groupBy("user_id").agg(F.count_if(F.col("event_id") > F.col("first")).alias("after"), F.count_if(F.col("event_id") >= F.col("first")).alias("not_before"))


def continuity_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers that were not printed, filled from the one before by one; of several in a row only the first."""
    printed = F.when(F.col("l_partkey") % 5 != 0, F.col("l_linenumber"))
    w = Window.partitionBy("l_orderkey").orderBy(*LINE)
    x = table(spark, sf_dir, "lineitem").withColumn("printed", printed)
    return x.select("l_orderkey", F.row_number().over(w).cast("long").alias("place"), "printed", F.coalesce("printed", F.lag("printed").over(w) + 1).alias("filled"))


def unit_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far each order of a customer is from the first of its priority, in orders."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    o = o.withColumn("place", F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")).cast("long"))
    return o.select("o_orderkey", (F.col("place") - F.min("place").over(Window.partitionBy("o_custkey", "o_orderpriority"))).alias("places"))


def no_shared_word(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns with the one before them, and whether no word is in both."""
    words = F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), "[^a-z]+"), lambda x: x != "")
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", words.alias("words"))
    before = c.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("words").alias("before"))
    return c.join(before, ["conv_id", "turn"]).select("conv_id", "turn", (~F.arrays_overlap("words", "before")).alias("apart"))


def normalised_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of turns that are equal but for case and what is no letter or digit, counted."""
    plain = F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), "[^a-z0-9]", "")
    g = table(spark, sf_dir, "conversations").groupBy(F.md5(plain.cast("binary")).alias("digest"))
    return g.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.coalesce("text", F.lit(""))).alias("forms"), F.min("conv_id").alias("first")).filter("n > 1")


def stripped_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines without the numbers, letters and roman numerals that they begin with."""
    letter = F.substring(F.lit("abcdefgh"), (F.col("p_size") % 8 + 1).cast("int"), F.lit(1))
    printed = F.concat(F.col("p_size").cast("string"), F.lit(" ("), letter, F.when(F.col("p_partkey") % 2 == 0, ") (iv) ").otherwise(") "), F.col("p_name"))
    p = table(spark, sf_dir, "part").select("p_partkey", printed.alias("printed"))
    return p.withColumn("rest", F.regexp_replace("printed", r"^(?:[0-9]+\s+|\([a-z]\)\s*|\([ivx]+\)\s*)+", ""))


def first_last_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first and the last part shipped of each order."""
    at = F.struct("l_shipdate", "l_linenumber", "l_partkey")
    g = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min(at).alias("first"), F.max(at).alias("last"))
    return g.select("l_orderkey", F.col("first.l_partkey").alias("first"), F.col("last.l_partkey").alias("last"))


def catalogue_extents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths that the catalogue gives for the texts of a source against those there are."""
    there = F.length(F.coalesce("text", F.lit("")))
    d = table(spark, sf_dir, "documents").select("source", "n_chars", there.cast("long").alias("there"))
    return d.groupBy("source").agg(
        F.min("n_chars").alias("low"), F.max("n_chars").alias("high"), F.min("there").alias("low_there"), F.max("there").alias("high_there"),
        F.count_if(F.col("n_chars") != F.col("there")).alias("wrong"),
    )


def edge_crossings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines drawn across an edge of their supplier's clip, by 4 or more on both sides."""
    at = (F.col("l_partkey") % 600).cast("long")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", at.alias("x0"), (at + F.col("l_quantity").cast("long")).alias("x1"))
    start = (F.col("s_nationkey") * 20).cast("long")
    clips = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.explode(F.array(start, start + 60)).alias("edge"))
    return li.join(clips, "l_suppkey").filter((F.col("x0") <= F.col("edge") - 4) & (F.col("x1") >= F.col("edge") + 4)).select("l_orderkey", "l_linenumber", "edge")


def must_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's nation by name; a customer whose nation is unknown is an error and not a gap."""
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    x = table(spark, sf_dir, "customer").join(n, "c_nationkey", "left")
    missing = F.raise_error(F.concat(F.lit("no nation for customer "), F.col("c_custkey").cast("string"))).cast("string")
    return x.select("c_custkey", F.when(F.col("n_name").isNull(), missing).otherwise(F.col("n_name")).alias("nation"))


def tiered_follow_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of odd size and the part of the next size that follows each: by brand and name, else by brand and first letter."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name", "p_size", F.substring("p_name", 1, 1).alias("letter"))
    later = p.withColumn("p_size", F.col("p_size") - 1)
    exact = later.groupBy("p_brand", "p_size", "p_name").agg(F.min("p_partkey").alias("exact"))
    near = later.groupBy("p_brand", "p_size", "letter").agg(F.min("p_partkey").alias("near"))
    x = p.filter("p_size % 2 = 1").join(exact, ["p_brand", "p_size", "p_name"], "left").join(near, ["p_brand", "p_size", "letter"], "left")
    tier = F.when(F.col("exact").isNotNull(), "exact").when(F.col("near").isNotNull(), "letter").otherwise("none")
    return x.select("p_partkey", F.coalesce("exact", "near").alias("follows"), tier.alias("tier"))


QUERIES = {f.__name__: f for f in (row_marks, max_once, repeat_suppression, after_reference, continuity_fill, unit_offset, no_shared_word, normalised_equality, stripped_labels, first_last_features, catalogue_extents, edge_crossings, must_match, tiered_follow_up)}

ORACLES = {
    "row_marks": r"""
        SELECT *, coalesce(try_cast(nullif(regexp_extract(printed, '\[max ([0-9]+)\]', 1), '') AS BIGINT), total,
                           list_sum(list_transform(regexp_extract_all(printed, '[0-9]+'), lambda x: x::BIGINT))::BIGINT) AS marks FROM (
          SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN p_size || '+2 [max 4]' WHEN 1 THEN p_size || '+1+1' WHEN 2 THEN p_size::VARCHAR ELSE '' END AS printed,
                 CASE WHEN p_size % 4 = 3 AND p_partkey % 2 = 0 THEN p_partkey % 10 END AS total FROM part)""",
    "max_once": """
        SELECT l_orderkey, l_returnflag, count(DISTINCT l_quantity::BIGINT) = 1 AS once,
               CASE WHEN count(DISTINCT l_quantity::BIGINT) = 1 THEN any_value(l_quantity::BIGINT) ELSE sum(l_quantity::BIGINT)::BIGINT END AS marks FROM lineitem GROUP BY 1, 2""",
    "repeat_suppression": """
        SELECT o_custkey, count(*) FILTER (NOT again) AS counted, count(*) FILTER (again) AS repeats FROM (
          SELECT o_custkey, coalesce(lag(o_orderpriority) OVER w = o_orderpriority AND lag(o_orderstatus) OVER w = o_orderstatus, false) AS again
          FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)) GROUP BY 1""",
    "after_reference": """
        SELECT user_id, count(*) FILTER (event_id > f) AS after, count(*) FILTER (event_id >= f) AS not_before FROM (
          SELECT *, min(event_id) FILTER (event_type = 'purchase') OVER (PARTITION BY user_id) AS f FROM events) GROUP BY 1""",
    "continuity_fill": """
        SELECT l_orderkey, row_number() OVER w AS place, printed, coalesce(printed, lag(printed) OVER w + 1) AS filled
        FROM (SELECT *, CASE WHEN l_partkey % 5 <> 0 THEN l_linenumber END AS printed FROM lineitem)
        WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice)""",
    "unit_offset": """
        SELECT o_orderkey, place - min(place) OVER (PARTITION BY o_custkey, o_orderpriority) AS places FROM (
          SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS place FROM orders)""",
    "no_shared_word": """
        WITH c AS (SELECT conv_id, turn, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^a-z]+'), lambda x: x <> '') AS w FROM conversations)
        SELECT a.conv_id, a.turn, NOT list_has_any(a.w, b.w) AS apart FROM c a JOIN c b ON a.conv_id = b.conv_id AND a.turn = b.turn + 1""",
    "normalised_equality": """
        SELECT md5(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]', '', 'g')) AS digest, count(*) AS n, count(DISTINCT coalesce(text, '')) AS forms, min(conv_id) AS first
        FROM conversations GROUP BY 1 HAVING count(*) > 1""",
    "stripped_labels": r"""
        SELECT *, regexp_replace(printed, '^(?:[0-9]+\s+|\([a-z]\)\s*|\([ivx]+\)\s*)+', '') AS rest FROM (
          SELECT p_partkey, p_size || ' (' || substr('abcdefgh', p_size % 8 + 1, 1) || CASE WHEN p_partkey % 2 = 0 THEN ') (iv) ' ELSE ') ' END || p_name AS printed FROM part)""",
    "first_last_features": """
        SELECT l_orderkey, first(l_partkey ORDER BY l_shipdate, l_linenumber, l_partkey) AS first,
               last(l_partkey ORDER BY l_shipdate, l_linenumber, l_partkey) AS last FROM lineitem GROUP BY 1""",
    "catalogue_extents": """
        SELECT source, min(n_chars) AS low, max(n_chars) AS high, min(t) AS low_there, max(t) AS high_there, count(*) FILTER (n_chars <> t) AS wrong
        FROM (SELECT *, length(coalesce(text, '')) AS t FROM documents) GROUP BY 1""",
    "edge_crossings": """
        SELECT l_orderkey, l_linenumber, edge FROM lineitem JOIN (SELECT s_suppkey, unnest([s_nationkey * 20, s_nationkey * 20 + 60])::BIGINT AS edge FROM supplier) ON s_suppkey = l_suppkey
        WHERE l_partkey % 600 <= edge - 4 AND l_partkey % 600 + l_quantity::BIGINT >= edge + 4""",
    "must_match": "SELECT c_custkey, n_name AS nation FROM customer JOIN nation ON n_nationkey = c_nationkey",
    "tiered_follow_up": """
        SELECT p_partkey, coalesce(e, l) AS follows, CASE WHEN e IS NOT NULL THEN 'exact' WHEN l IS NOT NULL THEN 'letter' ELSE 'none' END AS tier FROM (
          SELECT p_partkey,
            (SELECT min(q.p_partkey) FROM part q WHERE q.p_brand = p.p_brand AND q.p_size = p.p_size + 1 AND q.p_name = p.p_name) AS e,
            (SELECT min(q.p_partkey) FROM part q WHERE q.p_brand = p.p_brand AND q.p_size = p.p_size + 1 AND q.p_name[1] = p.p_name[1]) AS l
          FROM part p WHERE p_size % 2 = 1)""",
}
