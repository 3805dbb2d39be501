"""Texts: hashes and copies, words and weights, matches, labels, pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.functions import labels as L
from lectern.operators import rank
from lectern.operators import textmatch as T
from lectern.session import table


def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("hash"))


def keep_first_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lowest doc_id of each text; grouped by hash, so a text that many documents share is reduced in each task."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("hash"))
    return d.groupBy("hash").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"))


def duplicate_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that several sources hold, with the sources."""
    d = table(spark, sf_dir, "documents").select("source", F.sha2("text", 256).alias("hash")).distinct()
    g = d.groupBy("hash").agg(F.array_join(F.sort_array(F.collect_list("source")), ",").alias("sources"), F.count(F.lit(1)).alias("n"))
    return g.filter("n > 1")


def idf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ln(N / df) + 0.2 of each word of the documents, to six places."""
    d = table(spark, sf_dir, "documents")
    w = T.idf(T.word_counts(d, "doc_id", "text"), "doc_id", d.count())
    return w.select("word", "df", F.round("idf", 6).alias("idf"))


def idf_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each benchmark item's language: that whose vocabulary covers most of its weight."""
    d = table(spark, sf_dir, "documents")
    by_lang = T.word_counts(d, "lang", "text").select("lang", "word")
    weight = T.idf(T.word_counts(d, "doc_id", "text"), "doc_id", d.count())
    item = T.word_counts(table(spark, sf_dir, "benchmark"), "item_id", "text")
    micro = F.round(F.col("idf") * 1_000_000).cast("long")
    s = item.join(weight, "word").join(by_lang, "word").groupBy("item_id", "lang").agg(F.sum(micro).alias("score"))
    return rank.top(s, ["item_id"], [F.desc("score"), "lang"])


def best_token_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document that shares most words of four letters or more with each item."""
    a = T.word_counts(table(spark, sf_dir, "benchmark"), "item_id", "text", 4)
    b = T.word_counts(table(spark, sf_dir, "documents"), "doc_id", "text", 4)
    return T.best_match(T.shared_words(a, b, "item_id", "doc_id").select("item_id", "doc_id", "shared"), "item_id", "doc_id", "shared")


def multiset_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold 97 % of an item's words, repetitions counted."""
    a = T.word_counts(table(spark, sf_dir, "benchmark"), "item_id", "text")
    return T.covered(a, table(spark, sf_dir, "documents"), "item_id", "doc_id", "text", 97)


def stem_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of an answer's longer words whose first five letters stand in the turn before, in thousandths."""
    c = table(spark, sf_dir, "conversations")
    before = F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn"))
    x = c.select("conv_id", "turn", F.lower(before).alias("before"), F.array_distinct(T.word_list(F.col("text"), 4)).alias("w")).filter("before IS NOT NULL AND size(w) > 0")
    hits = F.size(F.filter("w", lambda w: F.contains(F.col("before"), F.substring(w, 1, 5))))
    return x.select("conv_id", "turn", F.floor(1000 * hits / F.size("w")).cast("long").alias("share"))


def first_definition_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first conversation and turn of each word."""
    x = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.explode(F.array_distinct(T.word_list(F.col("text"), 6))).alias("word"))
    return x.groupBy("word").agg(F.min(F.struct("conv_id", "turn")).alias("x")).select("word", "x.conv_id", "x.turn")


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    n = lambda p: F.size(F.regexp_extract_all("text", F.lit(p), F.lit(0))).cast("long")
    return d.select("doc_id", n("[A-Z][a-z]+").alias("names"), n("[0-9]+").alias("numbers"), n("[a-z]+@[a-z0-9.]+").alias("addresses"))


def label_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order references written and read back."""
    o = table(spark, sf_dir, "orders")
    ref = F.concat_ws("/", F.col("o_orderstatus"), F.concat(F.lit("Q"), F.col("o_orderkey")), F.substring("o_orderpriority", 1, 1))
    m = lambda i: F.regexp_extract("ref", r"^([A-Z])/Q([0-9]+)/([0-9])$", i)
    return o.select(ref.alias("ref")).select("ref", m(1).alias("status"), m(2).cast("long").alias("number"), m(3).alias("level"))


def label_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels with a bracket missing, repaired, shortened and made whole again."""
    li = table(spark, sf_dir, "lineitem")
    letter, roman = F.expr("substring('abcdefgh', l_linenumber, 1)"), F.expr("element_at(array('i', 'ii', 'iii', 'iv', 'v'), cast(l_partkey % 5 + 1 AS INT))")
    broken = F.concat(F.lit("4("), letter, F.lit("("), roman, F.lit(")"))
    x = li.select("l_orderkey", "l_linenumber", "l_partkey", broken.alias("broken")).withColumn("label", L.repaired(F.col("broken")))
    tail = F.regexp_replace("label", "^[0-9]+", "")
    return x.select("l_orderkey", "l_linenumber", "l_partkey", "label", L.encoded(tail).alias("code"), L.decoded(L.encoded(tail)).alias("back"), L.parent(F.col("label")).alias("parent"))


def fuzzy_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of one nation whose keys differ by one digit changed, put in or left out.

    Keys meet in one group for what is left when a digit is taken out, so that no two meet that are not near:
    with the digit's place those of one length, ten at most, and without it the key that is this and those one digit longer.
    """
    c = table(spark, sf_dir, "customer").select("c_nationkey", F.col("c_custkey").alias("k"), F.col("c_custkey").cast("string").alias("s"))
    less = lambda i: F.concat(F.substr(F.col("s"), F.lit(1), i - 1), F.substr(F.col("s"), i + 1))
    cut = F.transform(F.sequence(F.lit(1), F.length("s")), lambda i: F.struct(F.concat(F.lit("-"), i, F.lit(":"), less(i)).alias("form"), F.lit(False).alias("whole")))
    drop = F.transform(F.sequence(F.lit(1), F.length("s")), lambda i: F.struct(less(i).alias("form"), F.lit(False).alias("whole")))
    own = F.array(F.struct(F.col("s").alias("form"), F.lit(True).alias("whole")))
    forms = c.select("c_nationkey", "k", F.explode(F.concat(cut, drop, own)).alias("f")).select("c_nationkey", "k", "f.*").filter("c_nationkey IS NOT NULL")
    met = forms.groupBy("c_nationkey", "form").agg(F.collect_set(F.when(F.col("whole"), F.col("k"))).alias("one"), F.array_sort(F.collect_set(F.when(~F.col("whole"), F.col("k")))).alias("more"))
    pair = lambda a, b: F.struct(a.alias("a"), b.alias("b"))
    after = lambda a, i: F.slice("more", i + 2, F.greatest(F.size("more") - i - 1, F.lit(0)))
    same = F.flatten(F.transform("more", lambda a, i: F.transform(after(a, i), lambda b: pair(a, b))))
    longer = F.flatten(F.transform("one", lambda a: F.transform("more", lambda b: pair(a, b))))
    placed = F.col("form").contains(":")
    return met.filter(F.size("more") > 0).select(F.explode(F.when(placed, same).otherwise(longer)).alias("p")).select("p.*").distinct()


def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages without scripts, styles, comments and tags, white space collapsed."""
    t = F.regexp_replace("html", r"(?s)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->", " ")
    t = F.trim(F.regexp_replace(F.regexp_replace(t, "<[^>]*>", " "), "[ \t\r\n]+", " "))
    return table(spark, sf_dir, "pages").select("page_id", t.alias("text"))


def head_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 24 and last 16 words of texts of more than 40."""
    return table(spark, sf_dir, "documents").select("doc_id", L.head_and_tail(F.col("text"), 40).alias("shown"))


def page_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages by kind."""
    n = F.length(F.regexp_replace("html", "<[^>]*>|\\s", ""))
    links = F.regexp_count("html", F.lit("<a "))
    kind = F.when(n == 0, "blank").when(links * 100 > n, "index").when(F.contains("html", F.lit("<table")), "data").otherwise("text")
    return table(spark, sf_dir, "pages").select("page_id", kind.alias("kind"))


QUERIES = {f.__name__: f for f in (content_hash, keep_first_dedupe, duplicate_locations, idf_weights, idf_classify, best_token_match, multiset_coverage, stem_containment, first_definition_site, token_counts, label_codec, label_forms, fuzzy_number, json_props, html_text, head_tail, page_classes)}


def _words(t: str, key: str, least: int = 1) -> str:
    return f"(SELECT {key}, word, count(*) AS n FROM (SELECT {key}, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS word FROM {t}) WHERE length(word) >= {least} GROUP BY ALL)"


ORACLES = {
    "content_hash": "SELECT doc_id, sha256(text) AS hash FROM documents",
    "keep_first_dedupe": "SELECT sha256(text) AS hash, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY 1",
    "duplicate_locations": """
        SELECT hash, string_agg(source, ',' ORDER BY source) AS sources, count(*) AS n FROM (SELECT DISTINCT source, sha256(text) AS hash FROM documents) GROUP BY 1 HAVING count(*) > 1""",
    "idf_weights": f"SELECT word, count(*) AS df, round(ln((SELECT count(*) FROM documents)::DOUBLE / count(*)) + 0.2, 6) AS idf FROM {_words('documents', 'doc_id')} GROUP BY 1",
    "idf_classify": f"""
        WITH w AS (SELECT word, round((ln((SELECT count(*) FROM documents)::DOUBLE / count(*)) + 0.2) * 1000000)::BIGINT AS m FROM {_words('documents', 'doc_id')} GROUP BY 1),
             s AS (SELECT item_id, lang, sum(m)::BIGINT AS score FROM {_words('benchmark', 'item_id')} JOIN w USING (word) JOIN (SELECT DISTINCT lang, word FROM {_words('documents', 'lang')}) USING (word) GROUP BY 1, 2)
        SELECT item_id, lang, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, lang) AS r FROM s) WHERE r = 1""",
    "best_token_match": f"""
        SELECT item_id, doc_id, shared FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY shared DESC, doc_id) AS r FROM (
          SELECT item_id, doc_id, count(*) AS shared FROM {_words('benchmark', 'item_id', 4)} a JOIN {_words('documents', 'doc_id', 4)} b USING (word) GROUP BY 1, 2)) WHERE r = 1""",
    "multiset_coverage": f"""
        WITH a AS {_words('benchmark', 'item_id')}, b AS {_words('documents', 'doc_id')}
        SELECT item_id, doc_id, common, size FROM (SELECT item_id, doc_id, sum(least(a.n, b.n))::BIGINT AS common FROM a JOIN b USING (word) GROUP BY 1, 2)
          JOIN (SELECT item_id, sum(n)::BIGINT AS size FROM a GROUP BY 1) USING (item_id) WHERE 100 * common >= 97 * size""",
    "stem_containment": """
        WITH x AS (SELECT conv_id, turn, lower(lag(text) OVER (PARTITION BY conv_id ORDER BY turn)) AS before, list_distinct(list_filter(regexp_extract_all(lower(text), '[a-z0-9]+'), lambda w: length(w) >= 4)) AS w FROM conversations)
        SELECT conv_id, turn, (1000 * len(list_filter(w, lambda v: contains(before, v[1:5]))) // len(w))::BIGINT AS share FROM x WHERE before IS NOT NULL AND len(w) > 0""",
    "first_definition_site": """
        WITH x AS (SELECT conv_id, turn, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS word FROM conversations)
        SELECT word, conv_id, turn FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY conv_id, turn) AS r FROM x WHERE length(word) >= 6) WHERE r = 1""",
    "token_counts": """
        SELECT doc_id, len(regexp_extract_all(text, '[A-Z][a-z]+'))::BIGINT AS names, len(regexp_extract_all(text, '[0-9]+'))::BIGINT AS numbers, len(regexp_extract_all(text, '[a-z]+@[a-z0-9.]+'))::BIGINT AS addresses FROM documents""",
    "label_codec": "SELECT o_orderstatus || '/Q' || o_orderkey || '/' || o_orderpriority[1] AS ref, o_orderstatus AS status, o_orderkey AS number, o_orderpriority[1] AS level FROM orders",
    "label_forms": """
        WITH x AS (SELECT *, 'abcdefgh'[l_linenumber] AS l, ['i', 'ii', 'iii', 'iv', 'v'][l_partkey % 5 + 1] AS r FROM lineitem)
        SELECT l_orderkey, l_linenumber, l_partkey, '4(' || l || ')(' || r || ')' AS label, l || '.' || r AS code, '(' || l || ')(' || r || ')' AS back, '4(' || l || ')' AS parent FROM x""",
    "fuzzy_number": """
        SELECT CASE WHEN length(x.c_custkey::VARCHAR) < length(y.c_custkey::VARCHAR) OR x.c_custkey < y.c_custkey THEN x.c_custkey ELSE y.c_custkey END AS a,
               CASE WHEN length(x.c_custkey::VARCHAR) < length(y.c_custkey::VARCHAR) OR x.c_custkey < y.c_custkey THEN y.c_custkey ELSE x.c_custkey END AS b
        FROM customer x JOIN customer y ON x.c_nationkey = y.c_nationkey AND x.c_custkey < y.c_custkey AND levenshtein(x.c_custkey::VARCHAR, y.c_custkey::VARCHAR) = 1""",
    "json_props": "SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events",
    "html_text": r"""
        SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'), '[ \t\r\n]+', ' ', 'g')) AS text FROM pages""",
    "head_tail": r"""
        SELECT doc_id, CASE WHEN len(w) <= 40 THEN array_to_string(w, ' ') ELSE array_to_string(w[1:24], ' ') || ' ... ' || array_to_string(w[-16:], ' ') END AS shown
        FROM (SELECT doc_id, string_split_regex(trim(text), '\s+') AS w FROM documents)""",
    "page_classes": r"""
        SELECT page_id, CASE WHEN n = 0 THEN 'blank' WHEN links * 100 > n THEN 'index' WHEN contains(html, '<table') THEN 'data' ELSE 'text' END AS kind
        FROM (SELECT *, length(regexp_replace(html, '<[^>]*>|\s', '', 'g')) AS n, len(regexp_extract_all(html, '<a ')) AS links FROM pages)""",
}
