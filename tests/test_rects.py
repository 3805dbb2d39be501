"""Rectangles against all pairs, ruled rows against all rules, visual lines against one piece after the other."""

import random
from collections import Counter, defaultdict

from lectern.operators import rects as R
from lectern.plans import boxes as P

SF = "/root/testdata/sf0.001"
BOX = "g int, {k} int, {k}_x0 double, {k}_y0 double, {k}_x1 double, {k}_y1 double"


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_all_sizes_negative_places_and_touching_edges(spark):
    r = random.Random(3)

    def made(n):
        out = []
        for i in range(n):
            x, y, s = r.randint(-300, 300), r.randint(-300, 300), r.choice([0, 1, 5, 16, 64, 500])
            out.append((r.randint(0, 1), i, float(x), float(y), float(x + r.randint(0, s)), float(y + r.randint(0, s))))
        return out

    a, b = made(150), made(200)
    want = sorted((p[1], q[1]) for p in a for q in b if p[0] == q[0] and p[2] <= q[4] and q[2] <= p[4] and p[3] <= q[5] and q[3] <= p[5])
    odd = [(0, 999, None, 0.0, 1.0, 1.0), (0, 998, float("nan"), 0.0, 1.0, 1.0), (0, 997, 5.0, 0.0, 1.0, 1.0), (0, 996, 0.0, 0.0, float("inf"), 1.0)]
    found = R.rectangle_join(spark.createDataFrame(a + odd, BOX.format(k="a")), spark.createDataFrame(b, BOX.format(k="b")), ["g"], *(tuple(f"{k}_{c}" for c in R.SIDES) for k in "ab"), 16.0)
    got = rows(found, "a", "b")
    assert got == want and max(Counter(got).values()) == 1


def test_a_rectangle_is_listed_four_times_a_level_at_most(spark):
    x = spark.createDataFrame([(0, 1, 0.0, 0.0, 1e9, 3.0), (0, 2, 15.9, 15.9, 31.8, 31.8)], BOX.format(k="a"))
    levels = spark.createDataFrame([([0, 3, 27],)], "__levels array<int>")
    listed = R._listed(x, levels, 16.0, tuple(f"a_{c}" for c in R.SIDES), "own").groupBy("a", "__level").count().collect()
    assert max(c["count"] for c in listed) <= 4


def lined(pieces, back=3):
    out = []
    for c, y0, y1, x0, x1 in sorted(((y0 + y1) / 2, y0, y1, x0, x1) for x0, y0, x1, y1 in pieces):
        for o in out[-back:]:
            h, oh = y1 - y0, o[3] - o[0]
            shared = min(o[3], y1) - max(o[0], y0)
            if shared > 0.55 * min(h, oh) and abs(c - (o[0] + o[3]) / 2) < 0.5 * max(h, oh) and min(o[2], x1) - max(o[1], x0) < 2:
                o[:] = [min(o[0], y0), min(o[1], x0), max(o[2], x1), max(o[3], y1), o[4] + 1]
                break
        else:
            out.append([y0, x0, x1, y1, 1])
    return sorted(map(tuple, out))


def test_lines_of_the_query_one_piece_after_the_other(spark):
    by = defaultdict(list)
    for d, *box in rows(P.pieces(spark, SF), "doc_id", *R.SIDES):
        by[d].append(box)
    want = sorted((d, i + 1, *line) for d, p in by.items() for i, line in enumerate(lined(p)))
    got = rows(P.tilted_lines(spark, SF), "doc_id", "line", "y0", "x0", "x1", "y1", "n")
    assert got == want
    assert {w[6] for w in want} >= {1, 2, 3}


def test_ruled_rows_of_random_pages(spark):
    r = random.Random(8)
    rules = []
    for d in range(60):
        for _ in range(r.randint(0, 14)):
            y = float(r.randint(0, 300))
            rules.append(r.choice([(d, 1, 0.0, y, 300.0, y + 1), (d, 1, 0.0, y, 1.0, y + r.randint(5, 150)), (d, 1, 0.0, y, 250.0, y + r.randint(5, 60)), (d, 1, 0.0, y, 100.0, y + 1)]))
    want = set()
    for d in range(60):
        own = [x[2:] for x in rules if x[0] == d]
        want |= {(d, y0, y1) for x0, y0, x1, y1 in own if x1 - x0 > 200 and 10 < y1 - y0 < 400}
        across = sorted({(y0 + y1) / 2 for x0, y0, x1, y1 in own if x1 - x0 > 200 and y1 - y0 <= 2})
        up = [(y0, y1) for x0, y0, x1, y1 in own if y1 - y0 > 8 and x1 - x0 <= 2]
        want |= {(d, a, b) for a, b in zip(across, across[1:], strict=False) if 8 < b - a < 400 and any(v0 <= a + 2 and v1 >= b - 2 for v0, v1 in up)}
    assert rows(R.ruled_rows(spark.createDataFrame(rules, "doc_id int, page int, x0 double, y0 double, x1 double, y1 double")), "doc_id", "y0", "y1") == sorted(want)


def test_rectangles_are_listed_two_or_three_times(spark, monkeypatch):
    """Small rectangles, and a few long ones, are listed two or three times each and meet as they do pair by pair."""
    r, rows = random.Random(5), []
    for i in range(800):
        x, y, w = r.randrange(3000), r.randrange(3000), r.randrange(1, 50)
        rows.append((1, i, float(x), float(y), float(x + (w * 20 if i % 50 == 0 else w)), float(y + r.randrange(9, 63))))
    listed, plain = [], R._listed
    monkeypatch.setattr(R, "_listed", lambda *more: (lambda x: listed.append(x.count()) or x)(plain(*more)))
    of = lambda k: spark.createDataFrame(rows, f"g int, {k} int, {k}0 double, {k}1 double, {k}2 double, {k}3 double")
    found = R.rectangle_join(of("a"), of("b"), ["g"], *(tuple(f"{k}{i}" for i in range(4)) for k in "ab"), 32.0).collect()
    want = {(a[1], b[1]) for a in rows for b in rows if a[2] <= b[4] and b[2] <= a[4] and a[3] <= b[5] and b[3] <= a[5]}
    assert len(found) == len(want) and {(x.a, x.b) for x in found} == want
    assert sum(listed) < 2.5 * 2 * len(rows), listed
