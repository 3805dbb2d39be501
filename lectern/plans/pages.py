"""Words on pages, repaired readings, and labels that are prefixes of one another, over tables made from the given ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import labels as L
from lectern.operators import layout
from lectern.session import table

FOOTER = "^foot"


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of orders as words of a page: a document for seven orders, a page for each of its line numbers."""
    li = table(spark, sf_dir, "lineitem")
    q, k = F.col("l_quantity").cast("int"), F.col("l_partkey")
    return li.select(
        F.floor(F.col("l_orderkey") / 7).alias("doc_id"), F.col("l_linenumber").alias("page"), (k % 600).cast("double").alias("x0"), (k % 800).cast("double").alias("y0"),
        (k % 600 + 20).cast("double").alias("x1"), (k % 800 + q % 12).cast("double").alias("y1"),
        F.concat(F.when(q % 10 == 0, "foot").when(q % 10 == 1, "Appendix").otherwise("word"), k.cast("string")).alias("text"),
    )


def page_furniture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words inside the type area, tall enough, above the page's first footer word."""
    return layout.without_furniture(words(spark, sf_dir), (40.0, 50.0, 560.0, 780.0), FOOTER)


def page_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words above the first heading of an appendix on their page."""
    return layout.cut_off(words(spark, sf_dir), "^Appendix")


def page_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scale of each document by the upper median of its footers' places."""
    return layout.scales(words(spark, sf_dir), FOOTER, 300.0)


def ocr_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with letters for digits put right; some of them are numbers then."""
    wrong = F.translate(F.col("p_partkey").cast("string"), "0158", "OISB")
    p = table(spark, sf_dir, "part").select("p_partkey", wrong.alias("reading"), "p_name")
    return p.select("p_partkey", "reading", L.digits_repaired(F.col("reading")).alias("repaired"), L.digits_repaired(F.col("p_name")).alias("name"))


def singular_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct words of documents with their singular and how many documents have them."""
    w = F.array_distinct(F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), "[^a-z]+"), lambda x: x != ""))
    x = table(spark, sf_dir, "documents").select(F.explode(w).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return x.select("word", L.singular(F.col("word")).alias("singular"), "n")


def dot_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles with leaders of dots to their numbers, and without."""
    dots = F.repeat(F.lit("."), (F.col("p_size") % 9).cast("int"))
    p = table(spark, sf_dir, "part").select("p_partkey", F.concat("p_name", dots, F.col("p_size").cast("string")).alias("printed"))
    return p.select("p_partkey", L.without_dot_runs(F.col("printed")).alias("title"))


def three_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of documents, labels and pages side by side: who has them, and whether all do."""
    one = lambda name, key, c: table(spark, sf_dir, name).groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias(c))
    x = one("documents", "doc_id", "documents").join(one("labels", "doc_id", "labels"), "key", "full_outer").join(one("pages", "page_id", "pages"), "key", "full_outer")
    counts = [F.coalesce(F.col(c), F.lit(0)) for c in ("documents", "labels", "pages")]
    held = sum((F.when(c > 0, 1).otherwise(0) for c in counts), F.lit(0))
    return x.select("key", *(c.alias(n) for c, n in zip(counts, ("documents", "labels", "pages"), strict=True)), F.when(held == 3, "all").when(held == 2, "two").otherwise("one").alias("held"))


def coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.concat_ws(".", k % 5 + 1, k % 7 + 1, k % 11 + 1).alias("code"))


def listed_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of one, two or three levels that the parts list."""
    k = F.col("p_partkey")
    depth = F.when(k % 3 == 0, F.concat_ws(".", k % 5 + 1)).when(k % 3 == 1, F.concat_ws(".", k % 5 + 1, k % 7 + 1)).otherwise(F.concat_ws(".", k % 5 + 1, k % 7 + 1, k % 13 + 1))
    return table(spark, sf_dir, "part").filter("p_partkey % 17 < 6").select(depth.alias("listed")).distinct()


def ancestors(code):
    """A code and all codes above it."""
    parts = F.split(code, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "."))


def prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each coded order with the deepest listed code that is it or lies above it; joined by equality with a code's ancestors."""
    x = coded(spark, sf_dir).select("o_orderkey", "code", F.explode(ancestors(F.col("code"))).alias("listed"))
    hit = x.join(F.broadcast(listed_codes(spark, sf_dir)), "listed")  # 5 + 35 + 455 codes at most
    best = hit.groupBy("o_orderkey").agg(F.max(F.struct(F.length("listed"), "listed")).alias("b"))
    return coded(spark, sf_dir).join(best.select("o_orderkey", "b.listed"), "o_orderkey", "left")


def group_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed codes expanded to the leaves below them that orders have."""
    leaves = coded(spark, sf_dir).select("code").distinct().select(F.col("code").alias("leaf"), F.explode(ancestors(F.col("code"))).alias("listed"))
    return leaves.join(listed_codes(spark, sf_dir), "listed").select("listed", "leaf")


def pruned_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed codes without those that a listed code above them covers, in order of their levels as numbers."""
    c = listed_codes(spark, sf_dir)
    above = c.select("listed", F.explode(F.filter(ancestors(F.col("listed")), lambda a: a != F.col("listed"))).alias("above"))
    covered = above.join(c.select(F.col("listed").alias("above")), "above", "left_semi").select("listed").distinct()
    return c.join(covered, "listed", "left_anti")


QUERIES = {f.__name__: f for f in (page_furniture, page_cutoff, page_scale, ocr_digits, singular_words, dot_runs, three_way, prefix_join, group_expansion, pruned_codes)}

_WORDS = """(SELECT l_orderkey // 7 AS doc_id, l_linenumber AS page, (l_partkey % 600)::DOUBLE AS x0, (l_partkey % 800)::DOUBLE AS y0, (l_partkey % 600 + 20)::DOUBLE AS x1,
   (l_partkey % 800 + l_quantity::INT % 12)::DOUBLE AS y1, (CASE l_quantity::INT % 10 WHEN 0 THEN 'foot' WHEN 1 THEN 'Appendix' ELSE 'word' END) || l_partkey AS text FROM lineitem)"""
_CODED = "(SELECT o_orderkey, (o_orderkey % 5 + 1) || '.' || (o_orderkey % 7 + 1) || '.' || (o_orderkey % 11 + 1) AS code FROM orders)"
_LISTED = """(SELECT DISTINCT CASE p_partkey % 3 WHEN 0 THEN (p_partkey % 5 + 1)::VARCHAR WHEN 1 THEN (p_partkey % 5 + 1) || '.' || (p_partkey % 7 + 1)
   ELSE (p_partkey % 5 + 1) || '.' || (p_partkey % 7 + 1) || '.' || (p_partkey % 13 + 1) END AS listed FROM part WHERE p_partkey % 17 < 6)"""
ORACLES = {
    "page_furniture": f"""
        SELECT doc_id, page, x0, y0, x1, y1, text FROM (SELECT *, min(CASE WHEN text LIKE 'foot%' THEN y0 END) OVER (PARTITION BY doc_id, page) - 0.5 AS foot FROM {_WORDS})
        WHERE x0 >= 40 AND x1 <= 560 AND y0 >= 50 AND y1 <= least(780, coalesce(foot, 780)) AND y1 - y0 >= 6.5""",
    "page_cutoff": f"""
        SELECT doc_id, page, x0, y0, x1, y1, text FROM (SELECT *, min(CASE WHEN text LIKE 'Appendix%' THEN y0 END) OVER (PARTITION BY doc_id, page) AS heading FROM {_WORDS}) WHERE heading IS NULL OR y0 < heading""",
    "page_scale": f"""
        SELECT doc_id, CASE WHEN abs(k - 1) <= 0.03 THEN 1.0 ELSE k END AS k FROM (
          SELECT doc_id, x0 / 300 AS k, row_number() OVER (PARTITION BY doc_id ORDER BY x0) - 1 AS i, count(*) OVER (PARTITION BY doc_id) AS n FROM {_WORDS} WHERE text LIKE 'foot%') WHERE i = n // 2""",
    "ocr_digits": "SELECT p_partkey, translate(p_partkey::VARCHAR, '0158', 'OISB') AS reading, p_partkey::VARCHAR AS repaired, translate(p_name, 'OolISB', '001158') AS name FROM part",
    "singular_words": """
        SELECT word, CASE WHEN word LIKE '%ies' THEN word[:-4] || 'y' WHEN regexp_matches(word, '(ss|x|ch|sh)es$') THEN word[:-3] WHEN regexp_matches(word, '[^s]s$') THEN word[:-2] ELSE word END AS singular, count(*) AS n
        FROM (SELECT unnest(list_distinct(regexp_extract_all(lower(coalesce(text, '')), '[a-z]+'))) AS word FROM documents) GROUP BY 1, 2""",
    "dot_runs": "SELECT p_partkey, CASE WHEN p_size % 9 >= 5 THEN p_name || p_size ELSE p_name || repeat('.', p_size % 9) || p_size END AS title FROM part",
    "three_way": """
        SELECT key, sum(d)::BIGINT AS documents, sum(l)::BIGINT AS labels, sum(p)::BIGINT AS pages,
               CASE (sum(d) > 0)::INT + (sum(l) > 0)::INT + (sum(p) > 0)::INT WHEN 3 THEN 'all' WHEN 2 THEN 'two' ELSE 'one' END AS held
        FROM (SELECT doc_id AS key, 1 AS d, 0 AS l, 0 AS p FROM documents UNION ALL SELECT doc_id, 0, 1, 0 FROM labels UNION ALL SELECT page_id, 0, 0, 1 FROM pages) GROUP BY key""",
    "prefix_join": f"""
        SELECT o_orderkey, code, (SELECT arg_max(listed, length(listed)) FROM {_LISTED} WHERE listed = code OR starts_with(code, listed || '.')) AS listed FROM {_CODED}""",
    "group_expansion": f"SELECT listed, leaf FROM {_LISTED} JOIN (SELECT DISTINCT code AS leaf FROM {_CODED}) ON leaf = listed OR starts_with(leaf, listed || '.')",
    "pruned_codes": f"SELECT listed FROM {_LISTED} a WHERE NOT EXISTS (SELECT 1 FROM {_LISTED} b WHERE starts_with(a.listed, b.listed || '.'))",
}
