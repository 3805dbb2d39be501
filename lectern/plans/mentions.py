"""What texts name: identifiers and labels in sentences about the lines of an order, and nouns that point back in documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators import mentions as M
from lectern.plans.boxes import LINE
from lectern.session import table


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text per order, a sentence a line: calls, files, quotes, remarks, and lists of labels."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand")
    x = table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE).join(part, "l_partkey")
    p, q = F.col("l_partkey"), F.col("l_quantity").cast("int")
    name, brand, noun = F.replace(F.initcap("p_name"), F.lit(" "), F.lit("")), F.replace(F.upper("p_brand"), F.lit("#"), F.lit("_")), F.substring_index("p_name", " ", -1)
    letter = lambda i: F.chr(F.lit(65 + 2 * i) + p % 20)
    last = lambda i: F.concat(F.when(p % 2 == 0, " and ").otherwise(" or "), letter(i))
    listed = F.concat(letter(0), F.when(p % 3 == 0, "").when(p % 3 == 1, last(1)).otherwise(F.concat(F.lit(", "), letter(1), last(2))))
    said = (
        F.when(q % 5 == 0, F.format_string("Call %s() with data%d.txt.", name, p % 9))
        .when(q % 5 == 1, F.format_string('%s holds the %s here, not "BRAND_X".', brand, name))
        .when(q % 5 == 2, F.format_string("If %s do // TMP_%d is a remark", name, p))
        .when(q % 5 == 3, F.format_string("In %ss %s there is a change.", noun, listed))
        .otherwise(F.format_string("To the %s %s we add.", noun, listed))
    )
    x = x.select("l_orderkey", F.struct(*LINE, said.alias("said")).alias("s"))
    return x.groupBy(F.col("l_orderkey").alias("doc_id")).agg(F.concat_ws("\n", F.array_sort(F.collect_list("s")).said).alias("text"))


def identifiers_used(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifiers in the sentences of an order; names of parts that begin with r are none."""
    stops = table(spark, sf_dir, "part").filter("p_name LIKE 'r%'").select(F.replace(F.col("p_name"), F.lit(" "), F.lit("")).alias("word")).distinct()
    return M.identifiers(sentences(spark, sf_dir), "doc_id", "text", stops)


def definition_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels that the sentences of an order define, of nouns with an i in them."""
    nouns = table(spark, sf_dir, "part").select(F.substring_index("p_name", " ", -1).alias("noun")).filter("noun LIKE '%i%'").distinct()
    return M.defined_labels(sentences(spark, sf_dir), "doc_id", "text", nouns)


def scenario_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nouns that point back in documents. Nouns, modifiers and cues are words of benchmark items, told apart by their length and last letter."""
    words = F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), 0))
    w = table(spark, sf_dir, "benchmark").select(words.alias("word")).distinct()
    nouns = w.filter("length(word) >= 4").select(M.singular(F.col("word")).alias("noun")).distinct()
    kind = F.when(F.length("word") == 2, "before").when(F.length("word") == 3, "after").when(F.col("word").endswith("e"), "modifier")
    return M.anaphora(table(spark, sf_dir, "documents"), "doc_id", "text", nouns, w.select(kind.alias("kind"), "word"))


QUERIES = {f.__name__: f for f in (identifiers_used, definition_labels, scenario_mentions)}

_LINES = """l AS (SELECT l_orderkey AS doc_id, l_partkey AS p, l_quantity::INT % 5 AS k, string_split(p_name, ' ') AS n, replace(upper(p_brand), '#', '_') AS brand FROM lineitem JOIN part ON p_partkey = l_partkey)"""
_SINGULAR = "CASE WHEN {0} LIKE '%ies' THEN left({0}, length({0}) - 3) || 'y' WHEN {0} LIKE '%sses' OR {0} LIKE '%xes' THEN left({0}, length({0}) - 2) WHEN {0} LIKE '%s' AND {0} NOT LIKE '%ss' THEN left({0}, length({0}) - 1) ELSE {0} END"
ORACLES = {
    "identifiers_used": rf"""
        WITH {_LINES}, c AS (SELECT *, list_aggregate(list_transform(n, lambda w: upper(w[1]) || w[2:]), 'string_agg', '') AS name FROM l)
        SELECT DISTINCT doc_id, word FROM (SELECT doc_id, name AS word FROM c WHERE k < 3 AND name NOT LIKE 'R%'
          UNION ALL SELECT doc_id, 'data' || p % 9 || '.txt' FROM c WHERE k = 0 UNION ALL SELECT doc_id, brand FROM c WHERE k = 1)""",
    "definition_labels": rf"""
        WITH {_LINES} SELECT DISTINCT doc_id, n[-1] AS noun, chr((65 + p % 20 + 2 * i)::INT) AS label FROM l, range(3) r(i) WHERE k >= 3 AND i <= p % 3 AND n[-1] LIKE '%i%'""",
    "scenario_mentions": rf"""
        WITH b AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '\p{{L}}+')) AS w FROM benchmark),
        d AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '\p{{L}}+')) AS w, generate_subscripts(regexp_extract_all(lower(text), '\p{{L}}+'), 1) - 1 AS n FROM documents),
        x AS (SELECT *, lag(w) OVER o AS w0, lead(w) OVER o AS w1, lead(w, 2) OVER o AS w2, lead(w, 3) OVER o AS w3 FROM d WINDOW o AS (PARTITION BY doc_id ORDER BY n)),
        y AS (SELECT *, length(w1) >= 4 AND w1 LIKE '%e' AND w1 IN (SELECT w FROM b) AS m FROM x WHERE w IN ('the', 'this', 'these', 'that', 'those')),
        z AS (SELECT doc_id, n, w0, CASE WHEN m THEN w2 ELSE w1 END AS s, CASE WHEN m THEN w3 ELSE w2 END AS a FROM y)
        SELECT doc_id, n, {_SINGULAR.format("s")} AS noun FROM z WHERE {_SINGULAR.format("s")} IN (SELECT {_SINGULAR.format("w")} FROM b WHERE length(w) >= 4)
          AND (w0 IS NULL OR w0 NOT IN (SELECT w FROM b WHERE length(w) = 2)) AND (a IS NULL OR a NOT IN (SELECT w FROM b WHERE length(w) = 3))""",
}
