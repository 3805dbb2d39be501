import struct
import zlib
from math import isqrt

import pytest
import xxhash
from pyspark.sql import functions as F

from lectern.llm import sharding


def encipher(x, m, seed):
    left, right = divmod(x, m)
    for i in range(sharding.ROUNDS):
        h = 42
        for v in (right, seed, i):
            h = xxhash.xxh64_intdigest(struct.pack("<q", v), seed=h)
        h -= (h >> 63) << 64
        left, right = right, (left + h % m) % m
    return left * m + right


@pytest.mark.parametrize("n", [1, 2, 3, 5, 24, 101, 1000])
def test_permutation_equals_brute_force(spark, n):
    steps = sharding.walks(spark, n, 7)
    got = {r[0]: r[1] for r in spark.range(n).select("id", sharding.permuted(F.col("id"), n, 7, steps)).collect()}
    m = isqrt(n - 1) + 1
    for x in range(n):
        y = encipher(x, m, 7)
        while y >= n:
            y = encipher(y, m, 7)
        assert got[x] == y
    assert sorted(got.values()) == list(range(n))


ROWS = [(i, f"text {i}", "en") for i in range(60)] + [(None, None, None)] * 3 + [(5, "text 5", "en")] * 40 + [(7, "", "de"), (8, "é" * 30000, "fr")]


def test_shards_and_slots(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, slot string")
    got = sharding.shard_documents(docs, 24).collect()
    assert len(got) == len(ROWS)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    want = sorted((i if i is not None else -1, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in ROWS)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.size, r.text_crc32) for r in got) == want
    again = sharding.shard_documents(docs.repartition(7), 24).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_empty(spark):
    got = sharding.shard_documents(spark.createDataFrame([], "doc_id long, text string"))
    assert got.count() == 0 and "slot" in got.columns
