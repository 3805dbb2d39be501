"""Mixing sources to target weights by budgets that run down a tree.

The tree's levels are columns (domain, language, source); every node has a weight among its
siblings. The token budget goes down from the root: a node's budget is dealt to its children by
weight, a child that cannot use its share (its tokens times `epochs`) keeps what it can use, and
the shortage goes to its siblings; only what a whole subtree cannot use is left to the subtree's own
siblings, one level up. Each leaf then passes over its documents in seeded epochs: whole epochs
while the budget lasts, then the prefix of one more epoch, in an order drawn from seed, epoch and
doc_id. A document's copies follow from its leaf's epochs and the last key of the prefix, so that
documents themselves are never sorted or shuffled.

Budgets are whole tokens, rounded down: fewer tokens than the tree has nodes may stay unused.
Documents of one leaf and one doc_id share their key and are in the prefix together or not at all.

Defined results: null level columns are the node `none`; a null doc_id is the empty string; null and
empty texts have no tokens and come along with whole epochs and with the prefix that reaches their
key; a weight of 0 gives nothing; a budget above all that there is gives every document `epochs`
copies; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm._common import fresh, kept, words

#: Up to so many leaves (some MB) travel to all tasks; more are joined by shuffle.
SENT = 50_000


@dataclass(frozen=True)
class Level:
    """name: the output column; column: SQL over the documents; weights by node, whole numbers."""

    name: str
    column: str
    weights: dict[str, int] = field(default_factory=dict)
    other: int = 1

    def weight(self) -> Column:
        w = F.lit(self.other)
        for k, v in self.weights.items():
            w = F.when(F.col(self.name) == k, v).otherwise(w)
        return w.cast("long")


TREE = (
    Level("domain", "CASE try_cast(regexp_extract(source, '([0-9]+)$', 1) AS INT) % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'books' WHEN 2 THEN 'reference' END", {"web": 5, "books": 3, "reference": 2}),
    Level("lang", "lang", {"en": 6, "de": 2}),
    Level("source", "source"),
)


def _dealt(nodes: DataFrame, parents: DataFrame, parent: list[str], name: str) -> DataFrame:
    """nodes(parent..., name, cap, weight) with what each gets of its parent's budget.

    In order of cap over weight the first children are full: child k is full if its share of what
    the children before it leave, among the weights from it on, is at least its cap.
    """
    big = lambda c: c.cast("decimal(25,0)")
    order = Window.partitionBy(*parent).orderBy((F.col("cap") / F.col("weight")), name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    everyone = Window.partitionBy(*parent)
    left = F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    x = (
        nodes.filter("weight > 0").join(parents.select(*parent, "budget"), parent)
        .withColumn("full", big(F.col("cap")) * big(F.sum("weight").over(after)) <= big(left) * big(F.col("weight")))
        .withColumn("rest", F.col("budget") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(everyone))
        .withColumn("among", F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(everyone))
    )
    share = F.floor(F.try_divide(big(F.col("rest")) * big(F.col("weight")), big(F.col("among")))).cast("long")
    return x.select(*parent, name, F.when(F.col("full"), F.col("cap")).otherwise(share).alias("budget"))


def budgets(leaves: DataFrame, tree: tuple[Level, ...], budget: int, epochs: int) -> DataFrame:
    """leaves(levels..., tokens) with the budget of each; a budget of all tokens times epochs is the most."""
    names = [x.name for x in tree]
    parents = leaves.agg(F.least(F.lit(budget), F.sum("tokens") * epochs).alias("budget")).select(F.lit("root").alias("__root"), "budget")
    for i, level in enumerate(tree):
        nodes = (
            leaves.groupBy(*names[: i + 1]).agg((F.sum("tokens") * epochs).alias("cap"))
            .withColumn("weight", level.weight()).withColumn("__root", F.lit("root"))
        )
        parents = _dealt(nodes, parents, ["__root", *names[:i]], level.name)
    return leaves.join(parents.drop("__root"), names, "left").withColumn("budget", F.coalesce("budget", F.lit(0)))


def _key(seed: int, epoch: Column, name: str = "__id") -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col(name), F.lit(""))))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= SENT else df


def leaf_plans(docs: DataFrame, tree: tuple[Level, ...], share: tuple[int, int], epochs: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """A row of doc_id, levels and n_tokens per document, and per leaf its budget, whole epochs and last key."""
    names = [x.name for x in tree]
    rows = docs.select(
        "doc_id",
        F.col("doc_id").cast("string").alias("__id"),
        *(F.coalesce(F.expr(x.column), F.lit("none")).alias(x.name) for x in tree),
        F.size(words(F.col("text"))).cast("long").alias("n_tokens"),
    )
    rows = kept(rows, "tokens")
    leaves = kept(rows.groupBy(*names).agg(F.sum("n_tokens").alias("tokens")), "leaves")
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    planned = budgets(leaves, tree, total * share[0] // share[1], epochs)
    whole = F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(0)
    planned = kept(planned.withColumn("whole", whole).withColumn("rest", F.when(F.col("tokens") > 0, F.col("budget") % F.col("tokens")).otherwise(0)), "planned")
    keyed = (
        rows.join(_small(planned.filter("rest > 0").select(*names, "whole", "rest")), names)
        .withColumn("__key", _key(seed, F.col("whole")))
        .groupBy(*names, "rest", "__key")
        .agg(F.sum("n_tokens").alias("n"))
        .withColumn("__part", F.substring("__key", 1, 3))
    )
    keyed = kept(keyed, "keyed")
    # prefix sums in two steps: over the 4096 parts of a leaf's key range, then within a part
    by_part = keyed.groupBy(*names, "__part").agg(F.sum("n").alias("m"))
    below = Window.partitionBy(*names).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    by_part = by_part.select(*names, "__part", F.coalesce(F.sum("m").over(below), F.lit(0)).alias("below"))
    within = Window.partitionBy(*names, "__part").orderBy("__key").rowsBetween(Window.unboundedPreceding, 0)
    last = (
        keyed.join(by_part, [*names, "__part"])
        .withColumn("upto", F.col("below") + F.sum("n").over(within))
        .filter("upto <= rest")
        .groupBy(*names)
        .agg(F.max("__key").alias("last"))
    )
    out = planned.join(last, names, "left").select(*names, *(F.col(c).alias(f"__{c}") for c in ("budget", "whole", "last")))
    return rows, kept(out, "plans")


def copies(seed: int, p: str = "__") -> Column:
    whole = F.col(f"{p}whole")
    return (whole + F.when(_key(seed, whole, f"{p}id") <= F.col(f"{p}last"), 1).otherwise(0)).cast("int")


def mixed(docs: DataFrame, tree: tuple[Level, ...] = TREE, share: tuple[int, int] = (3, 5), epochs: int = 2, seed: int = 17) -> DataFrame:
    """doc_id, levels, n_tokens, leaf_budget and copies of each row of documents(doc_id, text, ...).

    share: the token budget as a fraction of all tokens.
    """
    names = [x.name for x in tree]
    rows, plans = leaf_plans(docs, tree, share, epochs, seed)
    return rows.join(_small(plans), names).select("doc_id", *names, "n_tokens", F.col("__budget").alias("leaf_budget"), copies(seed).alias("copies"))


def resampled(docs: DataFrame, tree: tuple[Level, ...] = TREE, share: tuple[int, int] = (3, 5), epochs: int = 2, seed: int = 17) -> DataFrame:
    """The rows of docs with all their columns, each as often as mixed() says."""
    _, plans = leaf_plans(docs, tree, share, epochs, seed)
    p = fresh(docs.columns, "__mix")
    plans = plans.select(*(F.col(x.name).alias(f"{p}_{x.name}") for x in tree), *(F.col(f"__{c}").alias(p + c) for c in ("whole", "last")))
    marked = docs.withColumns({f"{p}_{x.name}": F.coalesce(F.expr(x.column), F.lit("none")) for x in tree} | {f"{p}id": F.col("doc_id").cast("string")})
    found = marked.join(_small(plans), [f"{p}_{x.name}" for x in tree]).withColumn(f"{p}copies", copies(seed, p)).filter(F.col(f"{p}copies") > 0)
    return found.select(*docs.columns, F.explode(F.sequence(F.lit(1), f"{p}copies")).alias(f"{p}copy")).drop(f"{p}copy")


def op1_budget_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _deal_sql(nodes: str, parents: str, parent: str, name: str) -> str:
    """DuckDB's form of _dealt."""
    by = f"PARTITION BY {parent}"
    order = f"{by} ORDER BY cap / weight, {name}"
    return f"""
        SELECT {parent}, {name}, CASE WHEN is_full THEN cap ELSE (rest::HUGEINT * weight // among)::BIGINT END AS budget FROM (
          SELECT *, budget - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ({by}) AS rest, sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({by}) AS among FROM (
            SELECT *, cap::HUGEINT * sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
                      <= (budget - coalesce(sum(cap) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::HUGEINT * weight AS is_full
            FROM (SELECT * FROM {nodes}) JOIN {parents} USING ({parent})))"""


ORACLES = {
    "op1_budget_tree": rf"""
        WITH d AS (SELECT doc_id, coalesce(CASE try_cast(regexp_extract(source, '([0-9]+)$', 1) AS INT) % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'books' WHEN 2 THEN 'reference' END, 'none') AS domain,
                          coalesce(lang, 'none') AS lang, coalesce(source, 'none') AS source,
                          len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens FROM documents),
        leaves AS (SELECT 'root' AS r, domain, lang, source, sum(n_tokens)::BIGINT AS tokens FROM d GROUP BY ALL),
        b0 AS (SELECT 'root' AS r, least(sum(tokens) * 3 // 5, sum(tokens) * 2)::BIGINT AS budget FROM leaves),
        n1 AS (SELECT r, domain, sum(tokens)::BIGINT * 2 AS cap, CASE domain WHEN 'web' THEN 5 WHEN 'books' THEN 3 WHEN 'reference' THEN 2 ELSE 1 END AS weight FROM leaves GROUP BY ALL),
        b1 AS ({_deal_sql("n1", "b0", "r", "domain")}),
        n2 AS (SELECT r, domain, lang, sum(tokens)::BIGINT * 2 AS cap, CASE lang WHEN 'en' THEN 6 WHEN 'de' THEN 2 ELSE 1 END AS weight FROM leaves GROUP BY ALL),
        b2 AS ({_deal_sql("n2", "b1", "r, domain", "lang")}),
        n3 AS (SELECT r, domain, lang, source, tokens * 2 AS cap, 1 AS weight FROM leaves),
        b3 AS ({_deal_sql("n3", "b2", "r, domain, lang", "source")}),
        p AS (SELECT domain, lang, source, budget, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS whole, CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest
              FROM leaves JOIN b3 USING (domain, lang, source)),
        k AS (SELECT d.*, budget, whole, rest, md5('17:' || whole || ':' || coalesce(doc_id::VARCHAR, '')) AS key FROM d JOIN p USING (domain, lang, source)),
        u AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM k)
        SELECT doc_id, domain, lang, source, n_tokens, budget::BIGINT AS leaf_budget, (whole + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END)::INT AS copies FROM u""",
}
