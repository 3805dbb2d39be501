"""SimHash near-duplicates found with vantage-point trees.

Each text becomes a 64-bit fingerprint; fingerprints that differ in `radius` bits or fewer are
linked, and linked documents form groups. A vantage-point tree, built on the driver from a bounded
sample of fingerprints, deals all distinct fingerprints out to its leaves. A node with vantage v
and distance mu sends to its inner side what lies within mu + radius of v and to its outer side
what lies beyond mu. By the triangle inequality two fingerprints within radius of one another,
one on each side of mu, both lie within mu + radius; so every linked pair meets whole in some leaf,
and only the strip between mu and mu + radius is on both sides. A leaf goes on splitting in the
same way in memory, compares exactly what is left, and emits a star per group and not its pairs.

Sizes: only distinct fingerprints travel (8 bytes each), so exact copies cost one row. On random
fingerprints a level multiplies rows by about 1.2 and divides leaves by about 1.7; rows shuffled
so grow as the number of fingerprints to the power 1.35, not as its square.

Defined results: null and empty texts, and texts without words, have fingerprint zero, linked like
any other; a null doc_id takes part and is never a component_id unless its group has no other;
equal rows stay rows of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm._common import fresh, joined, kept

SEED, SHINGLE, RADIUS = 42, 3, 2
SAMPLE, LEAF = 16_384, 8_192
#: Sets of this size or less are compared pair by pair; larger ones that no vantage splits are probed by neighbours.
DIRECT, PROBED = 1_024, 131_072


def hashes(text: str | None, n: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    w = (text or "").encode().lower().split()
    if not w:
        return np.empty(0, np.uint64)
    shingles = map(b" ".join, zip(*(w[i:] for i in range(n)), strict=False)) if len(w) >= n else [b" ".join(w)]
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), np.uint64, max(1, len(w) - n + 1))


def fingerprint(h: np.ndarray) -> int:
    """A bit is 1 if it is set in over half of h."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 8192):
        part = np.ascontiguousarray(h[i : i + 8192].astype("<u8")).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def distance(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint (a signed long) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.fromiter((fingerprint(hashes(t)) for t in b.column(1).to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found.view(np.int64))], ["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, T.StructType([docs.schema["doc_id"], T.StructField("fingerprint", T.LongType())]))


def vantage(points: np.ndarray, radius: int) -> tuple[np.uint64, int, np.ndarray] | None:
    """Of eight points the one whose median has the thinnest strip; None if no split is worth it."""
    best = None
    for v in points[:: max(1, len(points) // 8)][:8]:
        d = distance(points, v)
        mu = int(np.sort(d)[(len(d) - 1) // 2])
        for m in (mu, mu - 1):
            inner, outer = np.count_nonzero(d <= m + radius), np.count_nonzero(d > m)
            if best is None or max(inner, outer) < best[0]:
                best = (max(inner, outer), v, m, d)
    return best[1:] if best and best[0] <= 0.9 * len(points) else None


class Router:
    """A vantage-point tree whose leaves are numbered; nodes: (vantage, mu, inner, outer), leaves below zero."""

    def __init__(self, sample: np.ndarray, total: int, radius: int = RADIUS, leaf: int = LEAF):
        self.nodes: list[tuple] = []
        self.leaves, self.radius = 0, radius
        self.root = self._grow(sample, total / max(1, len(sample)) if len(sample) else 0, leaf)

    def _grow(self, points: np.ndarray, each: float, leaf: int) -> int:
        split = vantage(points, self.radius) if len(points) * each > leaf and len(points) >= 16 else None
        if split is None:
            self.leaves += 1
            return -self.leaves
        v, mu, d = split
        self.nodes.append(())
        at = len(self.nodes) - 1
        self.nodes[at] = (v, mu, self._grow(points[d <= mu + self.radius], each, leaf), self._grow(points[d > mu], each, leaf))
        return at

    def route(self, points: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        todo = [(self.root, points)]
        while todo:
            at, p = todo.pop()
            if not len(p):
                continue
            if at < 0:
                yield -at - 1, p
                continue
            v, mu, inner, outer = self.nodes[at]
            d = distance(p, v)
            todo += [(inner, p[d <= mu + self.radius]), (outer, p[d > mu])]


class Groups:
    """Union by smallest index over arrays of pairs."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def root(self, x: np.ndarray) -> np.ndarray:
        while True:
            up = self.of[x]
            if np.array_equal(up, x):
                return x
            x = self.of[up]

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.root(a), self.root(b)
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.of, np.maximum(a, b), np.minimum(a, b))


def grouped(points: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each of the distinct sorted points the index of its group's first."""
    groups, todo = Groups(len(points)), [np.arange(len(points))]
    while todo:
        at = todo.pop()
        p = points[at]
        split = vantage(p, radius) if len(p) > DIRECT else None
        if split:
            _, mu, d = split
            todo += [at[d <= mu + radius], at[d > mu]]
        elif len(p) <= PROBED:
            rows = max(1, (1 << 21) // max(1, len(p)))
            for i in range(0, len(p), rows):
                a, b = np.nonzero(distance(p[i : i + rows, None], p[None, i:]) <= radius)
                later = b > a
                groups.join(at[a[later] + i], at[b[later] + i])
        else:
            for mask in neighbour_masks(radius):
                q = p ^ mask
                k = np.searchsorted(p, q)
                k[k == len(p)] = 0
                hit = (p[k] == q) & (q > p)
                groups.join(at[hit], at[k[hit]])
    return groups.root(np.arange(len(points)))


def neighbour_masks(radius: int) -> Iterator[np.uint64]:
    """All words of 1 to radius set bits."""
    from itertools import combinations

    for r in range(1, radius + 1):
        for bits in combinations(range(64), r):
            yield np.uint64(sum(1 << b for b in bits))


def stars(distinct: DataFrame, radius: int = RADIUS, leaf: int = LEAF) -> DataFrame:
    """Edges (a, b), a <> b, between fingerprints such that linked ones are connected.

    distinct: one column, fingerprint. The sample behind the tree is the SAMPLE fingerprints of
    lowest hash; it decides how evenly leaves fill and nothing else.
    """
    total = distinct.count()
    sample = distinct.orderBy(F.xxhash64("fingerprint"), "fingerprint").limit(SAMPLE).toArrow().column(0).to_numpy()
    router = Router(sample.astype(np.int64).view(np.uint64), total, radius, leaf)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for number, p in router.route(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(p), number, np.int32)), pa.array(p.view(np.int64))], ["leaf", "fingerprint"])

    def link(t: pa.Table) -> pa.Table:
        p = np.unique(t.column("fingerprint").to_numpy().view(np.uint64))
        first = grouped(p, radius)
        away = np.flatnonzero(first != np.arange(len(p)))
        return pa.table({"a": p[away].view(np.int64), "b": p[first[away]].view(np.int64)})

    return distinct.mapInArrow(deal, "leaf int, fingerprint long").groupBy("leaf").applyInArrow(link, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of edges(a, b): root is the smallest node that it is connected to.

    Alternating large and small stars, each a grouped minimum joined back, until all edges point
    to nodes that point nowhere. Nothing but counts comes to the driver.
    """
    a, b = F.col("a"), F.col("b")
    now = kept(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct(), "edges")
    while True:
        several = now.groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count()
        if not several and not now.select(F.col("b").alias("a")).distinct().join(now.select("a"), "a", "left_semi").limit(1).count():
            return now.select(a.alias("node"), b.alias("root")).unionByName(now.select(b.alias("node"), b.alias("root")).distinct())
        both = now.unionByName(now.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"), F.count_if(b > a).alias("n"))
        large = joined(both.filter("b > a"), kept(least.filter("n > 0"), "least"), "a").select(b.alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = kept(large, "large")
        least = kept(large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")), "least")
        small = joined(large, least, "a").select(F.when(b == F.col("m"), a).otherwise(b).alias("a"), F.col("m").alias("b"))
        now = kept(small.filter("a <> b").distinct(), "small")


def groups(found: DataFrame, radius: int = RADIUS, leaf: int = LEAF) -> DataFrame:
    """fingerprint, root (the group's smallest fingerprint), component_id and n, its rows, of each fingerprint in found(doc_id, fingerprint)."""
    distinct = kept(found.groupBy("fingerprint").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "distinct")
    roots = components(stars(distinct.select("fingerprint"), radius, leaf))
    rooted = kept(distinct.join(roots, distinct["fingerprint"] == roots["node"]).select("fingerprint", "first", "root"), "rooted")
    least = kept(rooted.groupBy("root").agg(F.min("first").alias("component"), F.count(F.lit(1)).alias("n")), "least")
    linked = joined(rooted, least, "root").select("fingerprint", "root", "component")
    return distinct.join(linked, "fingerprint", "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root"), F.coalesce("component", "first").alias("component_id"), "n"
    )


def near_duplicates(docs: DataFrame, radius: int = RADIUS, leaf: int = LEAF) -> DataFrame:
    """doc_id, fingerprint (a signed long) and component_id, the smallest doc_id of the group, of each row."""
    found = kept(fingerprints(docs), "fingerprints")
    return joined(found, kept(groups(found, radius, leaf).drop("root"), "groups"), "fingerprint").select("doc_id", "fingerprint", "component_id")


def deduplicated(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row of docs per group, with all its columns: that of the smallest doc_id, null last.

    What goes is looked up by doc_id and fingerprint, so the table of dropped keys and not the
    texts decides how the join runs. Rows that agree in both keys are told apart only where there
    are such rows among those that stay.
    """
    text_at, name = docs.columns.index("text"), fresh(docs.columns, "__fingerprint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.fromiter((fingerprint(hashes(t)) for t in b.column(text_at).to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found.view(np.int64))], [*b.schema.names, name])

    marked = kept(docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])), "marked")
    found = marked.select("doc_id", F.col(name).alias("fingerprint"))
    of = groups(found, radius).select(F.col("fingerprint").alias("node"), "root")
    return one_a_group(marked, found.select("doc_id", F.col("fingerprint").alias("key"), F.col("fingerprint").alias("node")), of, name)


def one_a_group(marked: DataFrame, found: DataFrame, of: DataFrame, name: str) -> DataFrame:
    """One row of marked per root of of(node, root), without the column name, which holds the key.

    found: doc_id, key and node of the rows of marked; rows of one key have one node. Each join has a
    row a key on both sides, so that no node or group of many rows meets in one task.
    """
    found = found.withColumnRenamed("doc_id", "id")
    order = F.struct(F.col("id").isNull().alias("unknown"), "id", "key")
    first = found.groupBy("node").agg(F.min(order).alias("first"))
    stays = kept(first.join(of, "node").groupBy("root").agg(F.min("first").alias("first")).select("first.id", "first.key"), "stays")
    keys = kept(found.groupBy("id", "key").agg(F.count(F.lit(1)).alias("n")), "keys")
    stays_too = keys["id"].eqNullSafe(stays["id"]) & (keys["key"] == stays["key"])
    gone = kept(keys.join(stays, stays_too, "left_anti"), "gone")
    several = kept(keys.filter("n > 1").join(stays, stays_too, "left_semi"), "several")
    same = lambda k: marked["doc_id"].eqNullSafe(k["id"]) & (marked[name] == k["key"])
    out = marked.join(gone, same(gone), "left_anti")
    if several.limit(1).count():
        alone = out.join(several, same(several), "left_anti")
        out = alone.unionByName(out.join(several, same(several), "left_semi").dropDuplicates(["doc_id", name]))
    return out.drop(name)


def op4_simhash_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
