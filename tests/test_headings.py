"""Headings with planted faults: how many numbers come back, and what is no heading."""

import random

from lectern.operators import headings as H
from lectern.plans.headings import REF

LINES = "doc long, page int, x0 double, y0 double, x1 double, y1 double, text string, ref string"


def test_recall(spark):
    r, rows, want = random.Random(3), [], {}
    for doc in range(30):
        for n in range(1, 21):
            page, y, ref = (n - 1) // 4, (n - 1) % 4 * 100.0, f"MJ{n:02d}/P1/Q{doc + 1}"
            want[doc, ref] = n
            fault = r.random()
            if fault < 0.1:
                rows.append((doc, page, 42.0, y, 60.0, y + 10, ref, "clash"))
            elif fault < 0.2:
                rows += [(doc, page, 40.0, y, 50.0, y + 10, f"{n}:", None), (doc, page, 60.0, y + 13, 90.0, y + 23, ref, None)]
            else:
                rows.append((doc, page, 40.0, y, 90.0, y + 10, f"{n + 60 if fault < 0.28 else n}. {ref}", None))
            rows.append((doc, page, 80.0, y + 40, 200.0, y + 50, f"{n} of the {ref}", None))
    found = H.completed(H.heading_lines(spark.createDataFrame(rows, LINES), "doc", REF), "doc", ["page", "y0"]).collect()
    assert {(f.doc, f.ref) for f in found} == set(want) and len(found) == len(want)
    right = sum(f.n == want[f.doc, f.ref] for f in found)
    assert right >= 0.97 * len(want)


def test_nulls_and_empty(spark):
    rows = [(1, 1, None, None, None, None, None, None), (1, 1, 5.0, 5.0, 9.0, 9.0, "", None), (None, None, 5.0, 5.0, 9.0, 9.0, "3. MJ01/P1/Q1", None)]
    found = H.completed(H.heading_lines(spark.createDataFrame(rows, LINES), "doc", REF), "doc", ["page", "y0"]).collect()
    assert [(f.doc, f.read, f.n, f.outcome) for f in found] == [(None, 3, 3, "kept")]
    assert H.heading_lines(spark.createDataFrame([], LINES), "doc", REF).count() == 0
