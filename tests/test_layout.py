import numpy as np

from lectern.operators import layout as L
from lectern.operators import raster as R

WORDS = "doc_id string, page int, x0 double, y0 double, x1 double, y1 double, text string"


def words(spark, rows):
    return spark.createDataFrame([(d, p, float(x), float(y), float(x) + 5, float(y) + 10, t) for d, p, x, y, t in rows], WORDS)


def texts(df):
    return sorted(r.text for r in df.collect())


def test_furniture_and_cut_off(spark):
    w = words(spark, [("a", 1, 50, 100, "body"), ("a", 1, 50, 10, "header"), ("a", 1, 50, 700, "©2020"), ("a", 1, 50, 695, "near"), ("a", 2, 50, 695, "low"), ("a", 1, 50, 300, "Appendix"), ("a", 1, 60, 400, "after")])
    assert texts(L.without_furniture(w, (40, 50, 550, 780), "^©")) == ["Appendix", "after", "body", "low"]
    assert texts(L.cut_off(w, "^Appendix$")) == ["body", "header", "low"]


def test_scale(spark):
    w = words(spark, [("a", i, 51, 700, "foot") for i in range(3)] + [("b", i, x, 700, "foot") for i, x in enumerate((45, 45, 50, 45))] + [("b", 9, 90, 0, "x")])
    assert {(r.doc_id, round(r.k, 3)) for r in L.scales(w, "^foot$", 50.0).collect()} == {("a", 1.0), ("b", 0.9)}
    assert L.rescaled(w, L.scales(w, "^foot$", 50.0)).filter("text = 'x'").first().x0 == 100.0


def test_lines(spark):
    w = words(spark, [("a", 1, 30, 100, "two"), ("a", 1, 10, 101, "one"), ("a", 1, 10, 104, "three"), ("a", 1, 20, 106, "four"), ("a", 1, 30.2, 100.2, "two")])
    assert texts(L.lines(L.deduplicated(w))) == ["one two", "three four"]
    assert texts(L.lines_from_first(L.deduplicated(w))) == ["one two", "three four"]
    slope = words(spark, [("a", 1, 10 * i, 100 + 2 * i, f"w{i}") for i in range(5)])
    assert texts(L.lines(slope)) == ["w0 w1 w2 w3 w4"] and texts(L.lines_from_first(slope)) == ["w0 w1", "w2 w3", "w4"]


def test_marks_gaps_kinds(spark):
    line = spark.createDataFrame([("a", 1, 1, 0.0, "x [2 ] y [13]"), ("a", 1, 2, 1.0, "......"), ("a", 1, 3, 2.0, "it is ..... there"), ("a", 2, 1, 0.0, "Data Section"), ("a", 3, 1, 0.0, "more"), ("a", 4, 1, 0.0, " ")], "doc_id string, page int, line int, y0 double, text string")
    assert sorted((r.line, r.place, r.value) for r in L.mark_events(line).collect()) == [(1, 0, 2), (1, 1, 13)]
    assert sorted((r.line, r.kind) for r in L.answer_gaps(line).collect()) == [(2, "answer line"), (3, "gap")]
    kinds = {r.page: r.kind for r in L.page_kinds(line, {"data": "^Data"}, ("data",)).collect()}
    assert kinds == {1: "text", 2: "data", 3: "data", 4: "blank"}


def test_spans(spark):
    starts = spark.createDataFrame([("a", "1", 1, 100.0), ("a", "2", 2, 300.0)], "doc_id string, ref string, page int, y double")
    pages = spark.createDataFrame([("a", p, 50.0, 780.0) for p in (1, 2, 3)], "doc_id string, page int, top double, bottom double")
    got = sorted((r.ref, r.page, r.y0, r.y1) for r in L.spans(starts, pages).collect())
    assert got == [("1", 1, 100.0, 780.0), ("1", 2, 50.0, 300.0), ("2", 2, 300.0, 780.0), ("2", 3, 50.0, 780.0)]


def test_raster(spark):
    page = np.full((60, 200), 255, np.uint8)
    page[10:15, 20:60] = 0
    page[17:20, 20:60] = 0
    page[40:42, 10:190:6] = 0
    assert R.ink_rows(page.copy()) == [(10, 20), (40, 42)]
    assert R.ink_rows(page.copy(), white=((0, 0, 30, 200),)) == [(40, 42)]
    assert R.dotted(page[40:42]) and not R.dotted(page[10:15])
    moved = np.roll(page, 1, 0)
    assert R.difference(page, moved) == 0 and R.difference(page, np.full_like(page, 255)) == int((page < 160).sum())
    df = spark.createDataFrame([(1, 60, 200, bytearray(page.tobytes()))], "p int, height int, width int, pixels binary")
    assert sorted(tuple(r) for r in R.by_page(df, ["p"], R.ink_rows).collect()) == [(1, 10, 20), (1, 40, 42)]
