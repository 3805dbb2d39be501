"""Exact k-means over integer vectors, with ball trees that are built once and read each round.

Every task builds metric trees of its own over TREE vectors at a time and writes them, a row a tree.
A node has the radius of a ball round its vectors, their count and their integer sum (and the sum of
their squares). In a round a node whose centre is at distance d from its nearest centroid a keeps
the centroids b with d(b) - radius <= d(a) + radius: by the triangle inequality none of the others is
nearest to any of its vectors. A ball with one centroid left goes to it whole, by its count and sum;
otherwise its two children are looked at with the centroids left, and in a leaf each vector is
compared exactly. Rounding only widens the bound. So a round reads the trees and gives at most one
count and sum a task, centroid and component; the driver sees those totals and the centroids.

Numbers are exact: distances of components up to NARROW are whole numbers that a double holds, and
larger components, which any finite float may give, are Python's integers in trees of their own.

Defined results: null arrays and arrays of another length, or with a null, NaN or infinite component,
are left out; fewer vectors than centroids give as many centroids as vectors; equal rows are vectors
of their own, equal hashes are ordered by vector; a null vec_id counts as empty text in the hash;
distances beyond a long are given as the largest long; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm._common import kept

COMPONENTS, SCALE, CENTROIDS, ROUNDS, SEED = 64, 1024, 8, 10, 3
#: Vectors of a tree and of a leaf.
TREE, LEAF = 1024, 32
#: Up to here squares of differences, summed over the components, stay below 2 ** 53.
NARROW = 1 << 20
LONGEST = (1 << 63) - 1
#: Totals travel in parts of so many bits, which add up in longs whatever their size.
PART = 32

NODE = np.dtype([("start", "<i4"), ("end", "<i4"), ("right", "<i4"), ("radius", "<f8"), ("squares", "<i8")])


@dataclass
class Tree:
    """Nodes in preorder: the left child follows its parent, right is 0 in a leaf. Wide trees hold Python's integers and one leaf."""

    points: np.ndarray
    nodes: np.ndarray
    sums: np.ndarray

    @property
    def wide(self) -> bool:
        return self.points.dtype == object


def integers(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of each component; as Python's integers where a component is beyond NARROW."""
    f = np.floor(float(scale) * x.astype(np.float64)) if np.abs(x, dtype=np.float64).max(initial=0) < 1e300 / scale else None
    if f is not None and np.abs(f).max(initial=0) <= NARROW:
        return f.astype(np.int64)
    exact = lambda v: scale * v.as_integer_ratio()[0] // v.as_integer_ratio()[1]
    return np.array([[exact(float(v)) for v in row] for row in x], dtype=object).reshape(x.shape)


def planted(points: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, Tree]:
    """The order in which a tree holds the points, and the tree."""
    if points.dtype == object:
        return np.arange(len(points)), Tree(points, np.array([(0, len(points), 0, np.inf, 0)], NODE), np.zeros((1, points.shape[1]), np.int64))
    order, nodes, sums = np.arange(len(points)), [], []

    def grow(start: int, end: int) -> None:
        p = points[order[start:end]]
        total = p.sum(axis=0)
        away = ((p - total / len(p)) ** 2).sum(axis=1)
        at = len(nodes)
        nodes.append((start, end, 0, float(np.sqrt(away.max())), int((p * p).sum())))
        sums.append(total)
        if end - start <= leaf or (p == p[0]).all():
            return
        one = p[away.argmax()]
        other = p[((p - one) ** 2).sum(axis=1).argmax()]
        order[start:end] = order[start:end][np.argsort(p @ (other - one), kind="stable")]
        middle = (start + end) // 2
        grow(start, middle)
        nodes[at] = (*nodes[at][:2], len(nodes), *nodes[at][3:])
        grow(middle, end)

    grow(0, len(points))
    return order, Tree(points[order], np.array(nodes, NODE), np.array(sums, np.int64))


def squared(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, a row a point."""
    if points.dtype == object or np.abs(centroids).max(initial=0) > NARROW:
        return np.array([((points.astype(object) - c) ** 2).sum(axis=1) for c in centroids.astype(object)], dtype=object).T
    p, c = points.astype(np.float64), centroids.astype(np.float64)
    return ((p * p).sum(axis=1)[:, None] - 2 * (p @ c.T) + (c * c).sum(axis=1)).astype(np.int64)


def nearest(distances: np.ndarray) -> np.ndarray:
    """The place of each row's least number, the first of equal ones."""
    return np.array([min(range(len(r)), key=r.__getitem__) for r in distances], np.int64) if distances.dtype == object else distances.argmin(axis=1)


def filtered(tree: Tree, centroids: np.ndarray) -> Iterator[tuple[int, int, int, np.ndarray | None]]:
    """node, start, end and either a centroid, to which a whole ball goes, or -1 and the centroid of each point of a leaf."""
    if tree.wide:
        yield 0, 0, len(tree.points), -1, nearest(squared(tree.points, centroids))
        return
    c = centroids.astype(np.float64)
    lengths = np.sqrt((c * c).sum(axis=1))
    counts = tree.nodes["end"] - tree.nodes["start"]
    centres = tree.sums / counts[:, None]
    todo = [(0, np.arange(len(c)))]
    while todo:
        at, left = todo.pop()
        start, end, right, radius, _ = tree.nodes[at]
        d = np.sqrt(((c[left] - centres[at]) ** 2).sum(axis=1))
        slack = 1e-9 * (1 + radius + np.sqrt((centres[at] ** 2).sum()) + lengths[left].max())
        left = left[d - radius <= d.min() + radius + slack]
        if len(left) == 1:
            yield at, start, end, int(left[0]), None
        elif right:
            todo += [(int(right), left), (at + 1, left)]
        else:
            yield at, start, end, -1, left[nearest(squared(tree.points[start:end], centroids[left]))]


def totals(tree: Tree, centroids: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, int]]:
    """cluster, count, sum and sum of squared distances, in pieces."""
    for at, start, end, whole, each in filtered(tree, centroids):
        if whole >= 0:
            n, total, squares = int(end - start), tree.sums[at].astype(object), int(tree.nodes["squares"][at])
            c = centroids[whole].astype(object)
            yield whole, n, total, squares - 2 * int((c * total).sum()) + n * int((c * c).sum())
            continue
        for k in np.unique(each):
            p = tree.points[start:end][each == k]
            yield int(k), len(p), p.sum(axis=0).astype(object), int(sum(squared(p, centroids[k : k + 1])[:, 0].tolist()))


def written(ids: pa.Array, tree: Tree) -> dict:
    wide = [",".join(map(str, p)) for p in tree.points] if tree.wide else None
    return {"ids": ids, "points": b"" if tree.wide else tree.points.astype("<i8").tobytes(), "wide": wide, "nodes": tree.nodes.tobytes(), "sums": tree.sums.astype("<i8").tobytes()}


def read(points: bytes, wide: list[str] | None, nodes: bytes, sums: bytes, width: int) -> Tree:
    if wide is not None:
        p = np.array([[int(x) for x in w.split(",")] for w in wide], dtype=object)
    else:
        p = np.frombuffer(points, "<i8").reshape(-1, width)
    return Tree(p, np.frombuffer(nodes, NODE), np.frombuffer(sums, "<i8").reshape(-1, width))


def usable(vectors: DataFrame, width: int = COMPONENTS) -> DataFrame:
    """vec_id and embedding of the vectors that take part."""
    finite = F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).filter((F.size("embedding") == width) & finite)


def forest(vectors: DataFrame, width: int, scale: int) -> DataFrame:
    """The trees of usable vectors, a row each."""
    kind = vectors.schema["vec_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, TREE):
                part = b.slice(i, TREE)
                x = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                large = np.abs(x).max(axis=1) * scale > NARROW - 1
                for places in (np.flatnonzero(~large), np.flatnonzero(large)):
                    if len(places):
                        order, tree = planted(integers(x[places], scale))
                        ids = part.column(0).take(pa.array(places[order]))
                        row = written(ids, tree)
                        yield pa.RecordBatch.from_arrays(
                            [pa.ListArray.from_arrays([0, len(ids)], ids), *(pa.array([row[c]], t) for c, t in (("points", pa.binary()), ("wide", pa.list_(pa.string())), ("nodes", pa.binary()), ("sums", pa.binary())))],
                            ["ids", "points", "wide", "nodes", "sums"],
                        )

    schema = T.StructType([T.StructField("ids", T.ArrayType(kind)), *T.StructType.fromDDL("points binary, wide array<string>, nodes binary, sums binary")])
    return kept(vectors.mapInArrow(run, schema), "trees")


def starts(vectors: DataFrame, k: int, seed: int, scale: int) -> np.ndarray:
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.orderBy(key, "embedding").limit(k).select("embedding").collect()
    return integers(np.array([r[0] for r in rows]), scale).astype(object)


def summed(trees: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int], int]]:
    """Count, sum and sum of squared distances of each cluster that has vectors."""
    width = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for b in batches:
            for row in zip(*(b.column(i).to_pylist() for i in range(b.num_columns)), strict=True):
                for k, n, total, squares in totals(read(*row, width), centroids):
                    x = found.setdefault(k, [0, np.zeros(width, object), 0])
                    x[0], x[1], x[2] = x[0] + n, x[1] + total, x[2] + squares
        rows = []
        for k, (n, total, squares) in found.items():
            for place, x in enumerate([n, squares, *total]):
                sign, x, part = (-1 if x < 0 else 1), abs(int(x)), 0
                while x:
                    rows.append((k, place, part, sign * (x & ((1 << PART) - 1))))
                    x, part = x >> PART, part + 1
        columns = list(zip(*rows, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)], ["cluster", "place", "part", "total"])

    parts = trees.select("points", "wide", "nodes", "sums").mapInArrow(run, "cluster int, place int, part int, total long")
    out: dict[int, list[int]] = {}
    for r in parts.groupBy("cluster", "place", "part").agg(F.sum("total").alias("total")).collect():
        out.setdefault(r.cluster, [0] * (width + 2))[r.place] += r.total << (PART * r.part)
    return {k: (x[0], x[2:], x[1]) for k, x in out.items()}


def clustered(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, width: int = COMPONENTS, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid (its components) of each usable row of vectors(vec_id, embedding)."""
    vectors = usable(vectors, width)
    kind = vectors.schema["vec_id"]
    names = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]
    schema = T.StructType([kind, *T.StructType.fromDDL("cluster int, distance long, cluster_inertia long, inertia long, centroid array<string>")])
    centroids = starts(vectors, k, seed, scale)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], schema)
    trees = forest(vectors, width, scale)
    for _ in range(rounds):
        for c, (n, total, _squares) in summed(trees, centroids).items():
            centroids[c] = [x // n for x in total]
    inertias = {c: squares for c, (_, _, squares) in summed(trees, centroids).items()}
    within, overall = {c: min(x, LONGEST) for c, x in inertias.items()}, min(sum(inertias.values()), LONGEST)
    components = [[str(x) for x in c] for c in centroids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, row in enumerate(zip(*(b.column(j).to_pylist() for j in range(1, b.num_columns)), strict=True)):
                tree = read(*row, width)
                label, away = np.empty(len(tree.points), np.int32), np.empty(len(tree.points), np.int64)
                for _, start, end, whole, each in filtered(tree, centroids):
                    label[start:end] = whole if each is None else each
                for c in np.unique(label):
                    at = label == c
                    away[at] = [min(x, LONGEST) for x in squared(tree.points[at], centroids[c : c + 1])[:, 0].tolist()]
                of = [*map(int, label)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[i].values, pa.array(label), pa.array(away), pa.array([within[c] for c in of], pa.int64()), pa.array([overall] * len(of), pa.int64()), pa.array([components[c] for c in of], pa.list_(pa.string()))],
                    names,
                )

    return trees.select("ids", "points", "wide", "nodes", "sums").mapInArrow(run, schema)


def op13_ball_tree_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = clustered(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2(F.array_join("centroid", ","), 256).alias("centroid_sha256"))


def _rounds_sql(k: int, rounds: int) -> str:
    """Each round as two tables: the nearest centroid of each vector, then the centroids."""
    away = "list_sum(list_transform(v, lambda x, i: (x - c[i]) * (x - c[i])))::BIGINT"
    out = []
    for r in range(rounds + 1):
        out.append(f"a{r} AS MATERIALIZED (SELECT id, any_value(v) AS v, arg_min(k, (d, k)) AS k, min(d) AS d FROM (SELECT id, v, k, {away} AS d FROM v, c{r}) GROUP BY id)")
        if r < rounds:
            mean = f"SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM (SELECT k, i, sum(v[i])::BIGINT AS s, count(*)::BIGINT AS n FROM a{r}, range(1, {COMPONENTS + 1}) t(i) GROUP BY k, i) GROUP BY k"
            out.append(f"c{r + 1} AS MATERIALIZED (SELECT c{r}.k, coalesce(m.c, c{r}.c) AS c FROM c{r} LEFT JOIN ({mean}) m ON m.k = c{r}.k)")
    return ",\n        ".join(out)


ORACLES = {
    "op13_ball_tree_centroids": f"""
        WITH u AS (SELECT vec_id, embedding FROM embeddings WHERE len(embedding) = {COMPONENTS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {COMPONENTS}),
        v AS MATERIALIZED (SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v, embedding FROM u),
        c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY h, embedding) - 1)::INT AS k, v AS c FROM
              (SELECT v, embedding, sha256('{SEED}:' || coalesce(vec_id::VARCHAR, '')) AS h FROM v ORDER BY h, embedding LIMIT {CENTROIDS})),
        {_rounds_sql(CENTROIDS, ROUNDS)}
        SELECT v.vec_id, a.k AS cluster, a.d AS distance, sum(a.d) OVER (PARTITION BY a.k)::BIGINT AS cluster_inertia, sum(a.d) OVER ()::BIGINT AS inertia,
               sha256(array_to_string(c.c, ',')) AS centroid_sha256
        FROM a{ROUNDS} a JOIN v USING (id) JOIN c{ROUNDS} c ON c.k = a.k""",
}
