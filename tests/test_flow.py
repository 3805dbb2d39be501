"""Page flow on generated bands: nothing that fits a page is torn, and the audit finds what was planted."""

import random

import pytest

from lectern.operators import flow
from lectern.plans import flow as plans

ROOM, HEAD, BETWEEN = 200.0, 20.0, 6.0
BANDS = "unit long, item long, i long, page int, y0 double, y1 double, figure int, mark_only boolean, colon boolean, bullet boolean, caption boolean, leads int, extra string"


def random_bands(seed, units=40):
    r, rows = random.Random(seed), []
    for unit in range(units):
        for item in range(r.randint(1, 6)):
            y, page = 0.0, 0
            for i in range(r.randint(1, 9)):
                if r.random() < 0.2:
                    y, page = 0.0, page + 1
                y += r.choice([0, 4, 10, 50])
                h = r.choice([8, 12, 25, 40, 70, 500])
                figure = r.choice([None, i // 2])
                mark = figure is None and r.random() < 0.2
                rows.append((unit, unit * 10 + item, i, page, y, y + h, figure, mark, r.random() < 0.3, r.random() < 0.1, not mark and r.random() < 0.3, 0 if mark else r.randint(0, 2), None))
                y += h
    return rows


@pytest.fixture(scope="module")
def placed(spark):
    bands = spark.createDataFrame(random_bands(5), BANDS)
    return flow.flowed(flow.linked(bands, "unit", "item", ["item", "i"]), "unit", "item", ROOM, HEAD, BETWEEN, depth=99).cache()


def test_nothing_torn(placed):
    found = {r.finding for r in flow.audited(placed, "unit", "item", ROOM, HEAD).collect()}
    assert all(f.startswith("unused") for f in found), found


def test_pages_in_order(placed):
    rows, last = sorted(placed.collect(), key=lambda r: (r.unit, r.ord)), None
    assert len(rows) == len(random_bands(5))
    for r in rows:
        assert r.top >= 0 and r.bottom <= ROOM and (r.head_top is None or r.top == r.head_top + HEAD)
        if last and last.unit == r.unit:
            assert r.page in (last.page, last.page + 1)
            assert r.page > last.page or r.top >= last.bottom
        else:
            assert r.page == 1
        last = r


@pytest.mark.parametrize(
    "change,finding",
    [({"bottom": 230.0}, "margin"), ({"scale": 1.1}, "enlarged"), ({"bottom": 60.0}, "overlap"), ({"head_page": 0}, "orphan heading"), ({"link": "figure", "page": 0}, "split figure"), ({"link": "introduces", "page": 0}, "orphan introduction"), ({"link": "label", "page": 0}, "orphan caption"), ({"link": "leads", "page": 0}, "orphan lead")],
)
def test_planted(spark, change, finding):
    names = ("unit", "ord", "item", "gap", "link", "page", "head_page", "head_top", "top", "bottom", "scale")
    first = dict(zip(names, (1, 1, 7, 0.0, None, 1, 1, 0.0, 20.0, 40.0, 1.0), strict=True)) | change
    second = dict(zip(names, (1, 2, 7, 4.0, None, 1, None, None, 44.0, 120.0, 1.0), strict=True))
    schema = "unit long, ord int, item long, gap double, link string, page int, head_page int, head_top double, top double, bottom double, scale double"
    df = spark.createDataFrame([tuple(r[n] for n in names) for r in (first, second)], schema)
    assert finding in {r.finding for r in flow.audited(df, "unit", "item", ROOM, HEAD).collect()}


def test_nulls_and_empty(spark):
    rows = [(1, 1, 0, None, None, None, None, None, None, None, None, None, "x"), (1, 1, 1, 0, 5.0, 25.0, None, None, None, None, None, None, "x"), (1, None, 2, 0, 5.0, 25.0, 1, False, True, False, True, 2, None)]
    for some in (rows, []):
        x = flow.linked(spark.createDataFrame(some, BANDS), "unit", "item", ["item", "i"])
        out = flow.flowed(x, "unit", "item", ROOM, HEAD, BETWEEN)
        assert out.count() == len(some)
        flow.audited(out, "unit", "item", ROOM, HEAD).collect()


def chain_height(i, rows, room):
    total, figure, after = rows[i][2], rows[i][4], 0
    for k in range(i, len(rows) - 1):
        _, gap, height, _, of, mark = rows[k + 1]
        if rows[k][3] is None or (of is not None and figure not in (None, of)):
            break
        if of is not None:
            figure = of
        elif figure is not None:
            after += 1
            if after > 1 and not mark:
                break
        if total + gap + height > room and k > i:
            break
        total += gap + height
    return total


def core_height(i, rows, depth):
    total, firm = rows[i][2], rows[i][4] is not None
    for k in range(i, len(rows) - 1):
        _, gap, height, _, _, mark = rows[k + 1]
        link, inside = rows[k][3], rows[k][4] is not None
        if not (link == "figure" or (inside and link == "mark") or (not inside and link in flow.FIRM and depth)):
            break
        total, firm, depth = total + gap + height, True, depth - (not inside)
        if inside and link == "mark":
            break
    return total, firm


def step_by_step(rows, room, head, between, depth):
    """A unit's bands (item, gap, height, link, figure, mark_only) one after the other, each with its look-ahead."""
    tall = room - head
    rows = [(item, gap, min(height, tall), link, figure, bool(mark)) for item, gap, height, link, figure, mark in rows]
    page, used, out = 1, 0.0, []
    for i, (item, gap, height, *_) in enumerate(rows):
        first = i == 0 or rows[i - 1][0] != item
        link = None if first else rows[i - 1][3]
        above = head if first else 0.0
        gap = (between if first else gap) if used else 0.0
        left = room - used - gap - above
        turn = height > left
        if used and not turn and link != "figure":
            core, firm = core_height(i, rows, depth)
            turn = left < core <= tall and (firm or link is None)
            turn = turn or (link is None and left < chain_height(i, rows, tall) <= tall)
        if turn and used:
            page, used, gap = page + 1, 0.0, 0.0
        top = used + gap + above
        out.append((page, page if first else None, used + gap if first else None, top, top + height))
        used = top + height
    return out


LINKED = "unit string, ord int, item string, gap double, height double, link string, figure string, mark_only boolean"


@pytest.mark.parametrize("depth,batch", [(0, 10_000), (1, 3), (3, 7), (3, 10_000), (99, 50)])
def test_placed_as_step_by_step(spark, depth, batch):
    """Links of all kinds in all places, heights of zero, units and items that are null and units longer than a batch."""
    r, units = random.Random(depth), {}
    for u in [None, *(f"u{n}" for n in range(60))]:
        item = None
        for _ in range(r.choice([1, 2, 9, 30, 80])):
            item = r.choice([item, item, item, None, f"i{r.randint(0, 3)}"])
            link = r.choice([None, "figure", "mark", "label", "introduces", "caption", "leads", "beside"])
            units.setdefault(u, []).append((item, r.choice([0.0, 4.0, 7.3]), r.choice([0.0, 8.1, 12.0, 40.7, 110.0, 500.0]), link, r.choice([None, None, "a", "b"]), r.choice([None, False, True])))
    df = spark.createDataFrame([(u, n, *row) for u, rows in units.items() for n, row in enumerate(rows)], LINKED)
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(size)
    spark.conf.set(size, str(batch))
    try:
        found = {(x.unit, x.ord): x for x in flow.flowed(df, "unit", "item", ROOM, HEAD, BETWEEN, depth).collect()}
    finally:
        spark.conf.set(size, old)
    assert len(found) == df.count()
    for u, rows in units.items():
        for n, (row, want) in enumerate(zip(rows, step_by_step(rows, ROOM, HEAD, BETWEEN, depth), strict=True)):
            x = found[u, n]
            assert (x.page, x.head_page, x.head_top, x.top, x.bottom) == want, (u, n)
            assert (x.item, x.gap, x.link, x.scale) == (row[0], row[1], row[3], min(1.0, (ROOM - HEAD) / row[2]) if row[2] else 1.0)


def test_linked_page_flow_sorts_twice(spark):
    """An order's lines once and a customer's bands once; nothing is dealt out more often than by order and by customer."""
    plan = plans.linked_page_flow(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 2
    assert plan.count("Exchange hashpartitioning") == 2


def test_long_unit_is_not_held_whole(monkeypatch):
    """A unit of many batches: each is placed up to its last band without a link, and goes on where the one before ended."""
    import pyarrow as pa

    r, n = random.Random(1), 5_000
    rows = [(i // 30, r.choice([0.0, 4.0]), r.choice([8.0, 40.0, 90.0]), r.choice([None, "figure", "mark", "leads"]), r.choice([None, 1, 2]), r.random() < 0.2) for i in range(n)]
    columns = [["u"] * n, list(range(n)), *map(list, zip(*rows, strict=True))]
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.string(), pa.int32(), pa.bool_()]
    whole = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["unit", "ord", "item", "gap", "height", "link", "figure", "mark_only"])
    runs, sizes = [], []

    class Rows:
        def __getattr__(self, _):
            return lambda *more: self

        def mapInArrow(self, run, schema):
            runs.append(run)

    placing = flow.placing
    monkeypatch.setattr(flow, "placing", lambda *a: (lambda f: lambda b: sizes.append(b.num_rows) or f(b))(placing(*a)))
    bands = Rows()
    bands.dtypes = [("unit", "string"), ("ord", "int"), ("item", "bigint")]
    flow.flowed(bands, "unit", "item", ROOM, HEAD, BETWEEN)
    found = pa.Table.from_batches(runs[0](whole.slice(i, 100) for i in range(0, n, 100))).to_pydict()
    want = step_by_step(rows, ROOM, HEAD, BETWEEN, 3)
    assert list(zip(*(found[c] for c in ("page", "head_page", "head_top", "top", "bottom")), strict=True)) == want
    assert sum(sizes) == n and max(sizes) < 250
