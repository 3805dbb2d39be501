import pytest

from lectern.operators.closure import closure


def test_closure_of_a_long_chain(spark):
    n = 36
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)], "src int, dst int").coalesce(1)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        got = {(r.src, r.dst, r.depth) for r in closure(edges).collect()}
        assert got == {(a, b, b - a) for a in range(n) for b in range(a + 1, n + 1)}
        short = edges.filter("src < 3")
        assert closure(short, most=3).count() == 6
        with pytest.raises(ValueError, match="more than 2 edges"):
            closure(short, most=2)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
