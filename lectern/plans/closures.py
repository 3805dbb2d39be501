"""References between the parts of a question: what an item needs to be understood, and what a name means where it is used."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.functions.labels import encoded, references
from lectern.operators import context as C
from lectern.session import checkpointed, table

LINE = ("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice")
NAMES = ("P", "Q", "R", "S")
EXHIBITS = 3


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order as a question: two lines a letter, a roman each; a last line alone is a letter without romans. doc, i, label, ord, p, s and n of its line."""
    w = Window.partitionBy("l_orderkey").orderBy(*LINE)
    x = table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE).withColumn("i", F.row_number().over(w) - 1).withColumn("of", F.count(F.lit(1)).over(Window.partitionBy("l_orderkey")))
    letter = F.chr(97 + F.floor(F.col("i") / 2))
    alone = (F.col("i") == F.col("of") - 1) & (F.col("i") % 2 == 0)
    label = F.when(alone, letter).when(F.col("i") % 2 == 0, F.concat(letter, F.lit(".i"))).otherwise(F.concat(letter, F.lit(".ii")))
    return x.select(F.col("l_orderkey").alias("doc"), "i", "of", letter.alias("letter"), label.alias("label"), (2 * F.col("i") + 1).cast("int").alias("ord"), F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"), F.col("l_quantity").cast("long").alias("n"))


def name_of(c: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, NAMES)), (c % len(NAMES) + 1).cast("int"))


def texts(lines: DataFrame) -> DataFrame:
    """doc, src and the text of each part, with its references."""
    other = F.col("p") % F.col("of")
    letter = F.chr(97 + F.floor(other / 2))
    target = F.when(F.col("s") % 4 == 0, F.concat(F.lit("("), letter, F.lit(")"))).otherwise(F.concat(F.lit("("), letter, F.lit(")("), F.when(other % 2 == 0, "i").otherwise("ii"), F.lit(")")))
    said = F.concat_ws(
        " ",
        F.when(F.col("p") % 3 == 0, F.concat(F.lit("Go on from part "), target, F.lit("."))),
        F.when(F.col("p") % 4 == 1, F.concat(F.lit("See Table "), (F.col("s") % EXHIBITS + 1).cast("string"), F.lit("."))),
        F.when(F.col("s") % 5 == 2, "Use your answer."),
        F.when(F.col("s") % 3 == 0, F.concat(F.lit("Why does compound "), name_of(F.col("p")), F.lit(" react?"))),
    )
    return lines.select("doc", F.col("label").alias("src"), said.alias("text"))


def question(lines: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """units, parts and edges of all questions; the edges are read out of the texts."""
    first = F.col("i") % 2 == 0
    intro = lines.filter(first & F.col("label").contains(".")).select("doc", F.col("letter").alias("label"), (F.col("ord") - 1).alias("ord"), (F.col("n") % 2 == 0).alias("intro"))
    every = lines.select("doc", "label", "ord", F.lit(False).alias("intro")).unionByName(intro)
    said = texts(lines)
    # an introduction names what it is about
    said = said.unionByName(lines.filter(first & F.col("label").contains(".") & (F.col("n") % 2 == 0)).select("doc", F.concat("letter", F.lit(C.INTRO)).alias("src"), F.concat(F.lit("See Table "), (F.col("p") % EXHIBITS + 1).cast("string"), F.lit(".")).alias("text")))
    r = said.select("doc", "src", references(F.col("text")).alias("r"), F.regexp_extract_all("text", F.lit(r"\bcompound ([A-Z])\b"), F.lit(1)).alias("names"))
    explode = lambda kind, c: r.select("doc", "src", F.lit(kind).alias("kind"), F.posexplode(c).alias("n", "name"))
    exhibits, refs, names = explode("exhibit", "r.exhibits"), explode("part", "r.parts"), explode("label", "names")
    own = r.filter("r.own_answer").select("doc", "src", F.lit("own").alias("kind"), F.lit(0).alias("n"), F.lit("").alias("name"), F.lit(None).cast("string").alias("dst"), F.lit(False).alias("alone"))
    printed = lines.filter(F.col("i") < 2 * EXHIBITS - 1).filter(first).select("doc", F.concat(F.lit("Table "), (F.col("i") / 2 + 1).cast("int").cast("string")).alias("name"), F.col("label").alias("dst"), (F.col("i") == 2).alias("alone"))
    defined = lines.filter("n % 3 = 1").groupBy("doc", name_of(F.col("s")).alias("name")).agg(F.min_by("label", "ord").alias("dst"))
    edges = exhibits.join(printed, ["doc", "name"], "left").withColumn("alone", F.coalesce("alone", F.lit(False))).select("doc", "src", "kind", "n", "name", "dst", "alone")
    edges = edges.unionByName(refs.select("doc", "src", "kind", "n", "name", encoded(F.col("name")).alias("dst"), F.lit(False).alias("alone")))
    edges = edges.unionByName(names.join(defined, ["doc", "name"]).select("doc", "src", "kind", "n", "name", "dst", F.lit(False).alias("alone"))).unionByName(own)
    # whole letters are items in even orders, single parts in odd ones
    units = lines.select("doc", F.when(F.col("doc") % 2 == 0, F.col("letter")).otherwise(F.col("label")).alias("label")).distinct()
    return units.select(F.concat_ws("/", F.col("doc").cast("string"), "label").alias("task"), "doc", "label"), every, edges


def context_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each item needs besides itself, why first and after how many references; items that refer to a table which is not there."""
    return C.context(*map(checkpointed, question(checkpointed(parts(spark, sf_dir)))))


def reference_scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each use of a compound's name with the definition it means: in what holds it, else the last before, else the first after; null: none."""
    lines = parts(spark, sf_dir)
    uses = lines.filter("s % 3 = 0").select("doc", "ord", "label", name_of(F.col("p")).alias("name"))
    at = F.when(F.col("n") % 2 == 0, F.col("letter")).otherwise(F.col("label"))
    definitions = lines.filter("n % 3 = 1").select("doc", "ord", at.alias("label"), name_of(F.col("s")).alias("name"))
    return C.scoped(uses, definitions).select("doc", "ord", "label", "name", "scope", "at", F.col("at_ord").cast("long").alias("at_ord"))




def self_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A finding per use of a name that its item does not make clear; an item shows a letter and the letter that one of its lines refers to."""
    lines = checkpointed(parts(spark, sf_dir))
    task = F.concat_ws("/", F.col("doc").cast("string"), "letter")
    referred = F.when(F.col("p") % 3 == 0, F.chr(97 + F.floor(F.col("p") % F.col("of") / 2)))
    shown = lines.select(task.alias("task"), F.explode(F.array("letter", referred)).alias("site")).filter("site IS NOT NULL")
    meant = reference_scopes(spark, sf_dir).withColumn("task", F.concat_ws("/", F.col("doc").cast("string"), F.substring("label", 1, 1)))
    return C.unshown(meant, shown).select("task", "ord", "label", "name", "scope", "at", "fault")


QUERIES = {f.__name__: f for f in (context_closure, reference_scopes, self_containment)}

_LINES = f"""
    l0 AS (SELECT l_orderkey AS doc, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY l_orderkey) AS m, l_partkey AS p, l_suppkey AS s, l_quantity::BIGINT AS n
           FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY {", ".join(LINE)})),
    l AS (SELECT *, chr((97 + i // 2)::INT) AS letter, chr((97 + i // 2)::INT) || CASE WHEN i = m - 1 AND i % 2 = 0 THEN '' WHEN i % 2 = 0 THEN '.i' ELSE '.ii' END AS label, (2 * i + 1)::INT AS ord FROM l0)"""
_NAME = "['P', 'Q', 'R', 'S'][({} % 4 + 1)::INT]"
_SCOPES = f"""
        WITH {_LINES},
        u AS (SELECT DISTINCT doc, ord, label, {_NAME.format("p")} AS name FROM l WHERE s % 3 = 0),
        d AS (SELECT doc, ord AS at_ord, CASE WHEN n % 2 = 0 THEN letter ELSE label END AS "at", {_NAME.format("s")} AS name FROM l WHERE n % 3 = 1),
        x AS (SELECT u.*, "at", at_ord, CASE WHEN u.label = "at" OR starts_with(u.label, "at" || '.') THEN 0 WHEN at_ord <= ord THEN 1 ELSE 2 END AS tier FROM u LEFT JOIN d USING (doc, name)),
        r AS (SELECT *, row_number() OVER (PARTITION BY doc, ord, label, name ORDER BY tier, CASE WHEN tier = 0 THEN -length("at") END, CASE WHEN tier = 2 THEN at_ord ELSE -at_ord END, CASE WHEN tier = 2 THEN "at" END, "at" DESC) AS k FROM x),
        f AS (SELECT doc, ord, label, name, CASE WHEN "at" IS NULL THEN NULL WHEN tier = 0 THEN 'enclosing' WHEN tier = 1 THEN 'before' ELSE 'after' END AS scope, "at", at_ord::BIGINT AS at_ord FROM r WHERE k = 1)"""
ORACLES = {
    "reference_scopes": f"{_SCOPES} SELECT * FROM f",
    "self_containment": f"""{_SCOPES}
        SELECT doc || '/' || label[1] AS task, ord, label, name, scope, "at", CASE WHEN "at" IS NULL THEN 'undefined' WHEN scope = 'after' THEN 'forward' ELSE 'not shown' END AS fault
        FROM f WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.doc = f.doc AND l.letter = f.label[1] AND (l.letter = f."at"[1] OR l.p % 3 = 0 AND chr((97 + l.p % l.m // 2)::INT) = f."at"[1]))""",
}
