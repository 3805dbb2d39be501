"""Three readings of the same orders compared field by field, and listed codes in the order of their levels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators import compare as C
from lectern.plans.pages import _LISTED, pruned_codes
from lectern.session import table

FIELDS = ("lines", "last", "quantity")


def readings(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Lines of each order: all of them, those that did not come back, and by distinct number and status, which repeats some orders."""
    li = table(spark, sf_dir, "lineitem")
    sums = (F.count(F.lit(1)).alias("lines"), F.max("l_linenumber").alias("last"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"))
    by_status = li.filter("l_linenumber > 1").groupBy("l_orderkey", (F.col("l_orderkey") % 10 + F.when(F.col("l_orderkey") % 10 == 0, F.col("l_linenumber") % 2).otherwise(0)).alias("part"))
    return {"all": li.groupBy("l_orderkey").agg(*sums), "sold": li.filter("l_returnflag <> 'R'").groupBy("l_orderkey").agg(*sums), "split": by_status.agg(*sums)}


def three_way_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that a reading lacks or has twice, and each field that readings differ in, with what each says."""
    return C.findings(readings(spark, sf_dir), ["l_orderkey"], list(FIELDS))


def ordered_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes that no listed code above them covers, in the order of their levels as numbers; rank sorts as they do."""
    levels = F.transform(F.split("listed", r"\."), lambda x: F.lpad(x, 4, "0"))
    return pruned_codes(spark, sf_dir).select("listed", F.array_join(levels, ".").alias("rank")).orderBy("rank")


QUERIES = {f.__name__: f for f in (three_way_findings, ordered_codes)}

_SUMS = "count(*) AS lines, max(l_linenumber) AS last, sum(l_quantity::BIGINT)::BIGINT AS quantity"
_SAID = "concat_ws('; ', CASE WHEN n_a > 0 THEN 'all=' || coalesce({f}_a, 'null') END, CASE WHEN n_s > 0 THEN 'sold=' || coalesce({f}_s, 'null') END, CASE WHEN n_p > 0 THEN 'split=' || coalesce({f}_p, 'null') END)"


def _differs(f: str) -> str:
    values = ", ".join(f"CASE WHEN n_{x} > 0 THEN coalesce({f}_{x}, 'null') END" for x in "asp")
    return f"SELECT l_orderkey, 'differs' AS finding, '{f}' AS field, {_SAID.format(f=f)} AS said FROM g WHERE len(list_distinct(list_filter([{values}], lambda v: v IS NOT NULL))) > 1"


def _least(x: str, of: str) -> str:
    """What a reading says of a field: of several rows those of the least, all fields as text."""
    return ", ".join(f"(min(({', '.join(FIELDS_TEXT)})) FILTER (of = '{of}'))[{i}] AS {f}_{x}" for i, f in enumerate(FIELDS, 1))


FIELDS_TEXT = [f"{f}::VARCHAR" for f in FIELDS]
_OF = {"a": "all", "s": "sold", "p": "split"}
ORACLES = {
    "three_way_findings": f"""
        WITH u AS (
          SELECT 'all' AS of, l_orderkey, {_SUMS} FROM lineitem GROUP BY ALL
          UNION ALL SELECT 'sold', l_orderkey, {_SUMS} FROM lineitem WHERE l_returnflag <> 'R' GROUP BY ALL
          UNION ALL SELECT 'split', l_orderkey, lines, last, quantity FROM (SELECT l_orderkey, CASE WHEN l_orderkey % 10 = 0 THEN l_linenumber % 2 ELSE 0 END AS part, {_SUMS} FROM lineitem WHERE l_linenumber > 1 GROUP BY ALL)),
        g AS (SELECT l_orderkey, {", ".join(f"count(*) FILTER (of = '{of}') AS n_{x}" for x, of in _OF.items())}, {", ".join(_least(x, of) for x, of in _OF.items())} FROM u GROUP BY l_orderkey)
        SELECT l_orderkey, 'missing' AS finding, NULL::VARCHAR AS field, concat_ws('; ', CASE WHEN n_a = 0 THEN 'all' END, CASE WHEN n_s = 0 THEN 'sold' END, CASE WHEN n_p = 0 THEN 'split' END) AS said FROM g WHERE n_a = 0 OR n_s = 0 OR n_p = 0
        UNION ALL SELECT l_orderkey, 'repeated', NULL, concat_ws('; ', CASE WHEN n_a > 1 THEN 'all=' || n_a END, CASE WHEN n_s > 1 THEN 'sold=' || n_s END, CASE WHEN n_p > 1 THEN 'split=' || n_p END) FROM g WHERE n_a > 1 OR n_s > 1 OR n_p > 1
        UNION ALL {" UNION ALL ".join(map(_differs, FIELDS))}""",
    "ordered_codes": f"""
        SELECT listed, array_to_string(list_transform(string_split(listed, '.'), lambda x: lpad(x, 4, '0')), '.') AS rank FROM {_LISTED} a
        WHERE NOT EXISTS (SELECT 1 FROM {_LISTED} b WHERE starts_with(a.listed, b.listed || '.')) ORDER BY rank""",
}
