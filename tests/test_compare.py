"""Findings of tables that lack, repeat or contradict, nulls included."""

from lectern.operators import compare as C
from lectern.plans import compare as P


def test_findings(spark):
    make = lambda rows: spark.createDataFrame(rows, "k string, x int, y string")
    found = C.findings({"a": make([("1", 1, "p"), ("2", 1, None), (None, 4, "q")]), "b": make([("1", 2, "p"), ("2", 1, None), ("3", 5, "r"), ("3", 6, "r")])}, ["k"], ["x", "y"])
    got = sorted((tuple(r) for r in found.collect()), key=str)
    assert got == sorted([
        ("1", "differs", "x", "a=1; b=2"), ("3", "missing", None, "a"), ("3", "repeated", None, "b=2"), (None, "missing", None, "b"),
    ], key=str)
    assert C.findings({"a": make([]), "b": make([])}, ["k"], ["x"]).count() == 0


def test_codes_come_in_the_order_of_their_numbers(spark):
    listed = [r.listed for r in P.ordered_codes(spark, "/root/testdata/sf0.001").collect()]
    assert listed == sorted(listed, key=lambda c: [int(x) for x in c.split(".")]) and len(listed) > 3
