"""Several tables of the same things compared field by field."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def findings(tables: dict[str, DataFrame], keys: list[str], fields: list[str]) -> DataFrame:
    """keys, finding, field and said of what tables (by name) do not agree on.

    Findings: missing (a table has no row of the key; said names those tables), repeated (one has several; said counts them) and differs
    (tables that have the key give a field different values; said gives each one's, of several rows the least). Null is a value
    like others. Rows are reduced by key in one shuffle, whatever the number of tables; a key that many rows have is counted before it.
    """
    of, names = "__of", list(tables)
    rows = None
    for name, df in tables.items():
        x = df.select(*keys, F.lit(name).alias(of), F.struct(*(F.col(f).cast("string").alias(f) for f in fields)).alias("__v"))
        rows = x if rows is None else rows.unionByName(x)
    is_ = lambda n: F.col(of) == n
    g = rows.groupBy(*keys).agg(*(F.count_if(is_(n)).alias(f"__n_{n}") for n in names), *(F.min(F.when(is_(n), F.col("__v"))).alias(f"__v_{n}") for n in names))
    count = {n: F.col(f"__n_{n}") for n in names}
    row = lambda finding, field, said: F.struct(F.lit(finding).alias("finding"), F.lit(field).cast("string").alias("field"), said.alias("said"))
    without = F.concat_ws("; ", *(F.when(count[n] == 0, F.lit(n)) for n in names))
    several = F.concat_ws("; ", *(F.when(count[n] > 1, F.concat(F.lit(f"{n}="), count[n].cast("string"))) for n in names))
    found = [F.when(without != "", row("missing", None, without)), F.when(several != "", row("repeated", None, several))]
    for f in fields:
        value = lambda n, f=f: F.col(f"__v_{n}")[f]
        values = F.filter(F.array(*(F.when(count[n] > 0, F.struct(value(n).alias("v"))) for n in names)), lambda v: v.isNotNull())
        said = F.concat_ws("; ", *(F.when(count[n] > 0, F.concat(F.lit(f"{n}="), F.coalesce(value(n), F.lit("null")))) for n in names))
        found.append(F.when(F.size(F.array_distinct(values)) > 1, row("differs", f, said)))
    return g.select(*keys, F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("x")).select(*keys, "x.*")
