import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import Row

from lectern.llm import balltree as b

SF = "/root/testdata/sf0.001"


def brute(rows, k=8, rounds=10, width=64):
    """(vec_id, cluster, distance, inertia of the cluster, of all, components) with Python's integers."""
    kept = [(i, e) for i, e in rows if e is not None and len(e) == width and all(x is not None and math.isfinite(x) for x in e)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    whole = lambda e: [math.floor(1024 * x) if abs(x) < 1e15 else 1024 * int(x) for x in e]
    kept, c = [(i, whole(e)) for i, e in kept], [whole(e) for _, e in first]
    away = lambda p, q: sum((x - y) ** 2 for x, y in zip(p, q, strict=True))
    for r in range(rounds + 1):
        at = [min((away(p, q), j) for j, q in enumerate(c)) for _, p in kept]
        if r < rounds:
            for j in range(len(c)):
                own = [p for (_, p), (_, x) in zip(kept, at, strict=True) if x == j]
                if own:
                    c[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    within = [sum(d for d, x in at if x == j) for j in range(len(c))]
    cut = lambda x: min(x, 2**63 - 1)
    return [(i, j, cut(d), cut(within[j]), cut(sum(within)), [str(x) for x in c[j]]) for (i, _), (d, j) in zip(kept, at, strict=True)]


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=str)


def test_query_equals_sql(spark):
    want = duckdb.sql(b.ORACLES["op13_ball_tree_centroids"].replace("FROM embeddings", f"FROM '{SF}/embeddings.parquet'")).fetchall()
    assert ordered(b.op13_ball_tree_centroids(spark, SF).collect()) == ordered(want)


def test_equals_brute_force_with_ties_copies_and_odd_rows(spark):
    r = random.Random(5)
    rows = [(i, [float(r.randint(-2, 2)) for _ in range(3)]) for i in range(60)]
    rows += [(i, [0.5, 0.5, 0.5]) for i in range(60, 1500)]  # one vector with most rows
    rows += [(i, [r.gauss(0, 3) for _ in range(3)]) for i in range(1500, 1900)]
    rows += [(7, [1.0, 1.0, 1.0]), (7, [1.0, 1.0, 1.0]), (None, [0.1, -0.1, 9.0])]
    odd = [(2000, None), (2001, []), (2002, [1.0, 2.0]), (2003, [1.0, None, 2.0]), (2004, [1.0, float("nan"), 2.0]), (2005, [float("-inf"), 0.0, 0.0])]
    df = spark.createDataFrame([Row(vec_id=i, embedding=e, cluster=1, distance="x") for i, e in rows + odd], "vec_id long, embedding array<double>, cluster int, distance string").repartition(3)
    got = b.clustered(df, k=5, rounds=6, width=3)
    assert ordered(got.collect()) == ordered(brute(rows + odd, 5, 6, 3))


def test_components_beyond_a_long(spark):
    rows = [(1, [1e38, -3e38, 0.0]), (2, [3.0, 4.0, 5.0]), (3, [1e4, 2e5, -7e5]), (4, [0.001, 0.0, -0.001]), (5, [1e38, -3e38, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert ordered(b.clustered(df, k=3, rounds=4, width=3).collect()) == ordered(brute(rows, 3, 4, 3))


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [("a", [1.0, 2.0]), ("b", [5.0, 6.0])]
    df = spark.createDataFrame(rows, "vec_id string, embedding array<float>")
    assert ordered(b.clustered(df, width=2).collect()) == ordered(brute(rows, width=2))
    assert b.clustered(df.limit(0), width=2).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_balls_go_whole_only_where_all_their_vectors_would(seed):
    g = np.random.default_rng(seed)
    points = (g.normal(0, 20, (700, 4)) + 4000 * g.integers(0, 3, (700, 1))).astype(np.int64)
    order, tree = b.planted(points, leaf=8)
    centroids = np.array([[0] * 4, [4000] * 4, [8000] * 4, [8005] * 4], dtype=object)
    found, whole = np.full(700, -1), 0
    for _, start, end, one, each in b.filtered(tree, centroids):
        found[order[start:end]] = one if each is None else each
        whole += (end - start) * (each is None)
    assert (found == b.nearest(b.squared(points, centroids))).all()
    assert whole > 0
    assert sum(x[1] for x in b.totals(tree, centroids)) == 700
