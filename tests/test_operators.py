"""Operators on small cases worked out by hand, and kernels against slow forms."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lectern.functions import labels as L
from lectern.operators import islands, kernels, ranges, sequence
from lectern.operators import reconcile as R
from lectern.operators.closure import closure


def column(spark, f, values):
    return [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").orderBy("i").select(f(F.col("v"))).collect()]


def test_labels(spark):
    assert column(spark, L.repaired, ["4(a(i)", "5f)", "2c(i)", "3(c)(ii)", "Answer"]) == ["4(a)(i)", "5(f)", "2(c)(i)", "3(c)(ii)", "Answer"]
    assert column(spark, L.encoded, ["(a)(i)", "(b)", "", "(ii)"]) == ["a.i", "b", "Q", "ii"]
    assert column(spark, lambda v: L.decoded(L.encoded(v)), ["(a)(i)", "(b)", ""]) == ["(a)(i)", "(b)", ""]
    assert column(spark, L.digits_repaired, ["2O/l1"]) == ["20/11"]
    assert column(spark, L.singular, ["robots", "libraries", "classes", "boxes", "class"]) == ["robot", "library", "class", "box", "class"]
    assert column(spark, L.without_dot_runs, ["x ......... y ... z"]) == ["x  y ... z"]
    assert column(spark, L.normalised, ["a – b  c”;"]) == ['a - b c"']
    assert column(spark, lambda v: L.head_and_tail(v, 5), ["1 2 3 4 5 6 7 8", "1 2", None]) == ["1 2 3 ... 7 8", "1 2", None]


def test_near_numbers(spark):
    rows = [(41, 11, True), (7, 17, True), (12, 21, False), (5, 5, False)]
    df = spark.createDataFrame(rows, "a int, b int, want boolean")
    assert df.filter(L.near_numbers(F.col("a"), F.col("b")) != F.col("want")).count() == 0
    assert all(kernels.near(a, b) == w for a, b, w in rows)


def test_references_and_points(spark):
    text = "Use your answer to part (a)(ii) and Table 2.1; see Fig. 3, Table 2.1 and equation 4."
    r = spark.createDataFrame([(text,)], "t string").select(L.references(F.col("t")).alias("r")).first().r
    assert (r.parts, r.exhibits, r.numbers, r.own_answer) == (["(a)(ii)"], ["Fig. 3", "Table 2.1"], ["4"], True)
    df = spark.createDataFrame([([2, 1, 1],), ([1, 1],), ([3, 1, 1],), ([],)], "m array<int>")
    assert [x[0] for x in df.select(L.points_without_total(F.col("m"))).collect()] == [[2], [1, 1], [3, 1, 1], []]


def test_intervals(spark):
    df = spark.createDataFrame([(1, 10.0, 20.0), (1, 20.4, 30.0), (1, 31.0, 40.0), (2, 0.0, 9.0), (2, 1.0, 2.0), (2, 3.0, 4.0)], "p int, a double, b double")
    assert sorted(map(tuple, islands.merge_intervals(df, ["p"], "a", "b", 0.5).collect())) == [(1, 10.0, 30.0, 2), (1, 31.0, 40.0, 1), (2, 0.0, 9.0, 3)]
    left = spark.createDataFrame([(1, 0, 250), (1, 300, 310)], "g int, a0 int, a1 int")
    right = spark.createDataFrame([(1, 200, 305), (1, 251, 299), (2, 0, 999)], "g int, b0 int, b1 int")
    assert sorted(map(tuple, ranges.overlap_join(left, right, ["g"], ("a0", "a1"), ("b0", "b1"), 100).collect())) == [(1, 0, 250, 200, 305), (1, 300, 310, 200, 305)]


def test_sequences(spark):
    df = spark.createDataFrame([(1, 2), (1, 5), (1, 5), (2, 1), (2, 2)], "k int, n int")
    assert sorted(map(tuple, sequence.missing_numbers(df, ["k"], "n").collect())) == [(1, 1), (1, 3), (1, 4)]
    pages = spark.createDataFrame([(1, 1, 1), (1, 2, None), (1, 3, 3), (1, 4, 9)], "b int, page int, printed int")
    assert [tuple(r) for r in sequence.lost_ranges(pages, ["b"], "page", "printed").collect()] == [(1, 4, 9, 4, 5)]


def test_compare(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "y", 1), (3, "z", 1)], "k int, v string, w int")
    b = spark.createDataFrame([(1, "x", None), (2, "n", 2), (4, "q", 0)], "k int, v string, w int")
    assert sorted(map(tuple, R.compare(a, b, ["k"], ["v", "w"], ("a", "b")).collect())) == [(2, "v differs"), (2, "w differs"), (3, "only in a"), (4, "only in b")]


def test_closure_with_cycles(spark):
    edges = [(1, 2), (2, 3), (3, 1), (3, 4), (5, 6)]
    got = {(r.src, r.dst): r.depth for r in closure(spark.createDataFrame(edges, "src int, dst int")).collect()}
    assert got == {(1, 2): 1, (1, 3): 2, (1, 1): 3, (1, 4): 3, (2, 3): 1, (2, 1): 2, (2, 4): 2, (2, 2): 3, (3, 1): 1, (3, 4): 1, (3, 2): 2, (3, 3): 3, (5, 6): 1}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 30), max_size=14))
def test_increasing(numbers):
    keep = kernels.increasing(numbers)
    assert keep == sorted(keep) and all(numbers[a] < numbers[b] for a, b in zip(keep, keep[1:], strict=False))
    assert len(keep) == kernels.longest_length(numbers)


def test_alignment():
    assert kernels.aligned([9, 10, 41, 12, 13]) == [(9, "kept"), (10, "kept"), (11, "repaired"), (12, "kept"), (13, "kept")]
    assert [o for _, o in kernels.aligned([9, 10, 41, 12])] == ["kept", "kept", "kept", "rejected"]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.floats(1, 50), st.integers(0, 3)), max_size=20))
def test_packing(blocks):
    heights, groups = [h for h, _ in blocks], [g for _, g in blocks]
    pages = kernels.packed(heights, groups, 60.0, 1.0)
    assert pages == sorted(pages)
    for p in set(pages):
        on = [h for h, q in zip(heights, pages, strict=True) if q == p]
        assert sum(on) + len(on) - 1 <= 60.0 + 1e-9


def tree(r):
    lines, want = [], []
    for q in range(1, r.randint(2, 5)):
        lines.append(f"{q} question")
        want.append((q, "", ""))
        for a in range(r.randint(0, 4)):
            letter = chr(97 + a)
            romans = r.randint(0, 3)
            if romans:
                lines.append(f"({letter}) (i) text")
                want.append((q, letter, "i"))
                for k in range(1, romans):
                    lines.append(f"({kernels.ROMANS[k]}) text (9) 99")
                    want.append((q, letter, kernels.ROMANS[k]))
            else:
                lines.append(f"({letter}) text")
                want.append((q, letter, ""))
            if r.random() < 0.5:
                lines.append("99 not a question")
                want.append(want[-1])
    return lines, want


@pytest.mark.parametrize("seed", range(20))
def test_outline_reads_what_was_written(seed):
    lines, want = tree(random.Random(seed))
    assert kernels.outline(lines) == want


def test_outline_by_document(spark):
    rows = [(d, i, x) for d in (1, 2) for i, x in enumerate(tree(random.Random(d))[0])]
    got = kernels.parse_outline(spark.createDataFrame(rows, "doc int, n int, line string"), "doc", "n", "line").orderBy("doc", "n").collect()
    assert [(r.q, r.letter, r.roman) for r in got] == tree(random.Random(1))[1] + tree(random.Random(2))[1]


def test_merged_blocks():
    of = kernels.merged_blocks({"b": {"a"}, "c": {"b"}, "e": {"d"}}, {"a": 5, "b": 6, "c": 3, "d": 1, "e": 1}, 10)
    assert of["a"] == of["b"] == of["c"] and of["d"] != of["e"]
