"""Shards by a Feistel permutation of global row numbers.

Rows are numbered 0 to n-1, the numbers are permuted by a keyed Feistel network over an m by m
square with m = ceil(sqrt(n)), and a value of n or more is enciphered again until it is below n
(cycle walking), which makes it a permutation of exactly 0 to n-1. Place p lies in shard p mod k
at slot p div k, so shard sizes differ by one at most, slots have no gaps, and whoever knows a
row's number can compute its place without looking at any other row.

Defined results: rows that are equal in all columns are interchangeable, and each gets a place of
its own; nulls are values like any other; an empty table gives an empty result.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm._common import kept, let

ROUNDS = 6
CHUNK = 1 << 16


def numbered(rows: DataFrame, name: str = "row_number", buckets: int = 4096) -> tuple[DataFrame, int]:
    """rows with a global number from 0, and how many there are.

    The order is by bucket and hash of the whole row, so it is reproducible whatever the
    partitioning. Equal rows are counted before the shuffle and numbered as a run, so that any
    number of them costs one row until the end. No task sees more than a bucket, and the only
    single-task step is over the table of buckets, whose length is a parameter.
    """
    cols = rows.columns
    key = F.xxhash64(*cols) if cols else F.lit(0).cast("long")
    counted = kept(
        rows.groupBy(*cols)
        .agg(F.count(F.lit(1)).alias("__copies"))
        .withColumn("__key", key)
        .withColumn("__bucket", F.pmod("__key", F.lit(buckets)).cast("int")),
        "counted",
    )
    sizes = counted.groupBy("__bucket").agg(F.sum("__copies").alias("__size"))
    total = sizes.agg(F.sum("__size")).first()[0] or 0
    offsets = sizes.select(
        "__bucket",
        (F.sum("__size").over(Window.orderBy("__bucket")) - F.col("__size")).alias("__offset"),
    )
    before = Window.partitionBy("__bucket").orderBy("__key", *cols).rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        counted.withColumn("__before", F.coalesce(F.sum("__copies").over(before), F.lit(0)))
        .join(F.broadcast(offsets), "__bucket")  # as many rows as there are buckets
        .select(*cols, (F.col("__offset") + F.col("__before")).alias("__first"), "__copies")
    )
    chunk = F.explode(F.expr(f"sequence(0L, (__copies - 1) div {CHUNK})"))
    inner = F.explode(F.expr(f"sequence(0L, least({CHUNK - 1}L, __copies - 1 - __chunk * {CHUNK}))"))
    return (
        runs.select("*", chunk.alias("__chunk"))
        .select("*", inner.alias("__inner"))
        .select(*cols, (F.col("__first") + F.col("__chunk") * CHUNK + F.col("__inner")).alias(name)),
        total,
    )


def _enciphered(x: Column, m: int, seed: int) -> Column:
    """One pass of the network over 0 to m*m-1."""
    halves = F.struct(F.call_function("div", x, F.lit(m).cast("long")).alias("l"), F.pmod(x, F.lit(m)).alias("r"))
    step = lambda s, i: F.struct(
        s["r"].alias("l"),
        F.pmod(s["l"] + F.pmod(F.xxhash64(s["r"], F.lit(seed).cast("long"), i), F.lit(m)), F.lit(m)).alias("r"),
    )
    rounds = F.array(*(F.lit(i).cast("long") for i in range(ROUNDS)))
    return F.aggregate(rounds, halves, step, lambda s: s["l"] * F.lit(m) + s["r"])


def side(n: int) -> int:
    """The side of the smallest square that holds n numbers, as a long."""
    return isqrt(n - 1) + 1 if n > 0 else 1


def walks(spark: SparkSession, n: int, seed: int) -> int:
    """The longest walk that any row needs.

    Only values from n to m*m-1 (2*sqrt(n) of them at most) are ever enciphered again, so those
    alone are followed, twice as far each time, until each has come below n or back to its start
    (a cycle that no row enters).
    """
    m, most = side(n), 8
    while n < m * m:
        step = lambda s, _: F.when(s["end"], s).otherwise(
            let(
                _enciphered(s["x"], m, seed),
                lambda y: F.struct(y.alias("x"), (s["k"] + 1).alias("k"), ((y < n) | (y == F.col("id"))).alias("end")),
            )
        )
        start = F.struct(F.col("id").alias("x"), F.lit(0).alias("k"), F.lit(False).alias("end"))
        walk = F.aggregate(F.sequence(F.lit(1), F.lit(most)), start, step)
        done = spark.range(n, m * m).select(walk.alias("w")).agg(F.max(F.when(F.col("w.x") < n, F.col("w.k"))), F.every("w.end")).first()
        if done[1]:
            return done[0] or 0
        most *= 2
    return 0


def permuted(x: Column, n: int, seed: int, steps: int) -> Column:
    """The place of row number x among n."""
    m = side(n)
    first = _enciphered(x, m, seed)
    if not steps:
        return first
    again = lambda y, _: F.when(y < n, y).otherwise(_enciphered(y, m, seed))
    return let(first, lambda y: F.aggregate(F.sequence(F.lit(1), F.lit(steps)), y, again))


def feistel_shards(rows: DataFrame, shards: int = 24, seed: int = 20240607) -> DataFrame:
    """rows with row_number, place, shard and slot."""
    if shards < 1:
        raise ValueError("shards must be 1 or more")
    found, n = numbered(rows)
    place = permuted(F.col("row_number"), n, seed, walks(rows.sparkSession, n, seed)) if n else F.lit(0).cast("long")
    return found.withColumn("place", place).withColumns(
        {"shard": F.pmod("place", F.lit(shards)).cast("int"), "slot": F.expr(f"place div {shards}")}
    )


def shard_documents(docs: DataFrame, shards: int = 24, seed: int = 20240607) -> DataFrame:
    """Sizes, checksums and places of documents(doc_id, text), by the law `rows`.

    A null text has no bytes. Columns besides doc_id and text play no part.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    return feistel_shards(rows, shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number"
    )


def op10_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
