import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lectern.llm import simhash as s


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    sh = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(rows):
    of = list(range(len(rows)))
    fps = [brute_fingerprint(t) for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                old, new = of[i], of[j]
                of = [new if x == old else x for x in of]
    least = {}
    for (d, _), g in zip(rows, of, strict=True):
        least[g] = min(least.get(g, d), d)
    return sorted((d, f"{f:016x}", least[g]) for (d, _), f, g in zip(rows, fps, of, strict=True))


@pytest.mark.parametrize("leaf", [8192, 40])
def test_groups_equal_brute_force(spark, leaf):
    r = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(r.choices(words, k=r.randint(1, 60)))) for i in range(120)]
    for i in range(120, 200):
        w = r.choice(rows)[1].split()
        w[r.randrange(len(w))] = r.choice(["X", "y", "É"])
        rows.append((i, " ".join(w) if i % 3 else r.choice(rows)[1].upper()))
    rows += [(300, ""), (301, None), (302, " \n"), (303, "a"), (303, "a"), (299, "x y " * 20000)]
    docs = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, fingerprint int")
    got = s.near_duplicates(docs, leaf=leaf).collect()
    assert sorted((r.doc_id, f"{r.fingerprint % 2**64:016x}", r.component_id) for r in got) == brute_groups(rows)
    if leaf < 100:
        sample = np.array([int(f, 16) for _, f, _ in brute_groups(rows)], np.uint64)
        assert s.Router(np.unique(sample), len(np.unique(sample)), leaf=leaf).leaves > 3


def test_dense_ball_and_probing():
    r = np.random.default_rng(1)
    base = r.integers(0, 2**63, 40, dtype=np.uint64)
    points = np.unique(np.concatenate([base ^ np.uint64((1 << i) | (1 << j)) for i in range(6) for j in range(64)]))
    plain = np.unique(s.grouped(points))
    old, s.PROBED, s.DIRECT = (s.PROBED, s.DIRECT), 16, 16
    try:
        assert np.array_equal(np.unique(s.grouped(points)), plain)
    finally:
        s.PROBED, s.DIRECT = old


def test_components_of_a_chain(spark):
    n = 40
    edges = spark.range(n - 1).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {tuple(x) for x in s.components(edges).collect()} == {(i, 0) for i in range(n)}
    assert s.components(edges.limit(0)).count() == 0


def test_empty(spark):
    assert s.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
