"""Bands set on pages: which stay together, where each lands, and what an audit of the pages finds.

A band is a strip of a source page. `linked` names why a band stays with the next of its item; `flowed` sets the bands of
a unit on pages, a batch of bands at a time in a task; `audited` reads placed bands by their neighbours, with windows alone.

Defined results: a band without a figure, flag or position has none of the links that ask for one; heights that are null
are 0; a unit without bands has no page; repeated bands are set one after the other.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from lectern.operators import kernels as K

# Distances in points.
GAP, TURN, CLOSE, FAR, SHORT, SLIM, TALL, TOP = 8, 4, 14, 60, 45, 18, 30, 130
#: Links of which neither side may be left alone on a page.
FIRM = ("figure", "label", "introduces", "caption", "leads")


def links(bands: DataFrame, item: str, w: WindowSpec) -> DataFrame:
    """bands (page, y0, y1, figure, mark_only, colon, bullet, caption, leads) with height, gap to the band before and link to the next; w holds a unit's or an item's bands in order."""
    here = ("page", "y0", "y1", "figure", "mark_only", "colon", "leads", item)
    ahead, behind = {f"_next_{c}": F.lead(c).over(w) for c in here}, {f"_before_{c}": F.lag(c).over(w) for c in ("page", "y1", item)}
    x = bands.withColumns(ahead | behind | {"_next": F.lead(F.lit(True)).over(w), "_before": F.lag(F.lit(True)).over(w)})
    n, b = (lambda c: F.col(f"_next_{c}")), (lambda c: F.col(f"_before_{c}"))
    flag = lambda c: F.coalesce(c if isinstance(c, Column) else F.col(c), F.lit(False))
    tall, tall_next, apart = F.col("y1") - F.col("y0"), n("y1") - n("y0"), n("y0") - F.col("y1")
    same, turned = F.col("page") == n("page"), n("page") == F.col("page") + 1
    within = lambda d: same & apart.between(0, d)
    line = F.col("figure").isNull() & ~flag("mark_only")
    opens = F.col("figure").isNull() & n("figure").isNotNull()
    link = (
        F.when(F.col("figure") == n("figure"), "figure")
        .when(flag(n("mark_only")), "mark")
        .when(line & opens & (tall < SHORT) & (within(FAR) | (turned & (n("y0") < TOP))), "label")
        .when(line & flag("colon") & (within(FAR) | turned), "introduces")
        .when(opens & flag("caption") & within(CLOSE), "caption")
        .when((F.col("leads") >= 2) & (n("leads") == F.col("leads") - 1) & within(CLOSE), "leads")
        .when(same & (apart <= CLOSE) & ~flag(n("colon")) & ~flag("bullet") & (((tall < SLIM) & (tall_next > TALL)) | ((tall > TALL) & (tall_next < SLIM))), "beside")
    )
    joins = lambda other: F.col(item).eqNullSafe(other(item))
    down = F.col("y0") - b("y1")
    gap = F.when(F.col("_before").isNull() | ~joins(b), 0.0).when((b("page") == F.col("page")) & (down >= 0), F.least(down, F.lit(float(GAP)))).otherwise(float(TURN))
    x = x.withColumns({"height": F.coalesce(tall, F.lit(0.0)), "gap": gap.cast("double"), "link": F.when(F.col("_next").isNotNull() & joins(n), link)})
    return x.drop("_next", "_before", *ahead, *behind)


def linked(bands: DataFrame, unit: str, item: str, order: list[str]) -> DataFrame:
    """bands with ord in the unit and what `links` adds."""
    w = Window.partitionBy(unit).orderBy(*order)
    return links(bands.withColumn("ord", F.row_number().over(w)), item, w)


def chain_heights(at: np.ndarray, height: np.ndarray, gap: np.ndarray, tied: np.ndarray, figure: np.ndarray, mark: np.ndarray, room: float) -> np.ndarray:
    """Of each band in at, it and those linked to it that fit a page: no further than one figure with one line or its marks, and the next band at least.

    All chains grow by a band at a time, and those that end fall out.
    """
    total = height[at]
    open_, of, after = np.arange(len(at)), figure[at], np.zeros(len(at), int)
    for grown in range(len(height)):
        k = at[open_] + grown
        on = tied[k]
        open_, of, after, k = open_[on], of[on], after[on], k[on] + 1
        if not len(open_):
            break
        next_of = figure[k]
        other = (next_of >= 0) & (of >= 0) & (of != next_of)
        after = after + ((next_of < 0) & (of >= 0))
        more = gap[k] + height[k]
        ends = other | ((next_of < 0) & (of >= 0) & (after > 1) & ~mark[k])
        if grown:
            ends |= total[open_] + gap[k] + height[k] > room
        of, on = np.where(next_of >= 0, next_of, of), ~ends
        open_, of, after = open_[on], of[on], after[on]
        total[open_] += more[on]
    return total


def core_heights(at: np.ndarray, height: np.ndarray, gap: np.ndarray, link: np.ndarray, inside: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each band in at, what is never split where it fits: a figure to its end and the mark after it, below `depth` lines that lead to it; and whether there is more than a line."""
    total, firm = height[at], inside[at]
    open_, left = np.arange(len(at)), np.full(len(at), depth)
    for grown in range(len(height)):
        k = at[open_] + grown
        marked = inside[k] & (link[k] == MARK)
        on = (link[k] == FIGURE) | marked | (~inside[k] & (link[k] >= FIGURE) & (left != 0))
        open_, k, marked = open_[on], k[on], marked[on]
        if not len(open_):
            break
        total[open_] = total[open_] + gap[k + 1] + height[k + 1]
        firm[open_] = True
        open_, left = open_[~marked], (left[on] - ~inside[k])[~marked]
    return total, firm


#: Links as numbers: none is 0, those of FIRM from FIGURE on.
LOOSE, MARK, FIGURE, LED = 1, 2, 3, 4


def link_codes(link: pa.Array) -> np.ndarray:
    found = link.dictionary_encode()
    names = [{"mark": MARK, "figure": FIGURE}.get(v, LED if v in FIRM else LOOSE) for v in found.dictionary.to_pylist()]
    return np.array([*names, 0])[K.codes(link)]


def placing(room: float, head: float, between: float, depth: int = 3) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    """Adds the page, heading's top, top, bottom and scale to bands (unit, ord, item, gap, height, link, figure, mark_only), batch after batch; but for the last, a batch ends with a band without a link.

    A band turns the page if more than what is left of it is needed: by the band, or by what must or should stay with it. That is known
    beforehand for all bands at once, and only the page and how much of it is used go from band to band.
    """
    tall, page, used, latest = room - head, 1, 0.0, None

    def placed(bands: pa.RecordBatch) -> pa.RecordBatch:
        nonlocal page, used, latest
        number = lambda c: bands.column(c).cast("double").fill_null(0).to_numpy(zero_copy_only=False)
        plain, gap, link, figure = number("height"), number("gap"), link_codes(bands.column("link")), K.codes(bands.column("figure"))
        mark = bands.column("mark_only").cast("bool").fill_null(False).to_numpy(zero_copy_only=False)
        height = np.where(tall < plain, tall, plain)
        opens, first = K.changes(bands.column(0)), K.changes(bands.column(2))
        ends = [tuple(bands.column(c)[at].as_py() for c in (0, 2)) for at in (0, -1)]
        if latest:
            opens[0], first[0] = ends[0][0] != latest[0], ends[0][1] != latest[1]
        first, latest = first | opens, ends[1]
        # a unit's last band is followed by none, whatever its link
        onward = np.where(np.append(opens[1:], True), 0, link)
        before = np.where(first, 0, np.append(0, link[:-1]))
        need = height.copy()
        at = np.flatnonzero(before != FIGURE)
        core, firm = core_heights(at, height, gap, onward, figure >= 0, depth)
        held = (core <= tall) & (firm | (before[at] == 0))
        need[at[held]] = np.maximum(need[at[held]], core[held])
        at = np.flatnonzero(before == 0)
        chain = chain_heights(at, height, gap, onward > 0, figure, mark, tall)
        held = chain <= tall
        need[at[held]] = np.maximum(need[at[held]], chain[held])
        pages, starts = [], []
        for unit, space, above, h, wanted in zip(opens.tolist(), np.where(first, between, gap).tolist(), np.where(first, head, 0.0).tolist(), height.tolist(), need.tolist(), strict=True):
            if unit:
                page, used = 1, 0.0
            if used and wanted > room - used - space - above:
                page, used = page + 1, 0.0
            start = used + space if used else used
            used = start + above + h
            pages.append(page)
            starts.append(start)
        on, start = np.array(pages, "int32"), np.array(starts, "float64")
        top = start + np.where(first, head, 0.0)
        scale = np.minimum(1.0, np.divide(tall, plain, out=np.ones(len(plain)), where=plain != 0))
        kept = [bands.column(c) for c in (0, 1, 2)] + [bands.column("gap"), bands.column("link")]
        made = [pa.array(on), pa.array(on, mask=~first), pa.array(start, mask=~first), pa.array(top), pa.array(top + height), pa.array(scale)]
        return pa.RecordBatch.from_arrays(kept + made, names=[*bands.schema.names[:3], "gap", "link", *ADDED])

    return placed


ADDED = {"page": "int", "head_page": "int", "head_top": "double", "top": "double", "bottom": "double", "scale": "double"}


def flowed(bands: DataFrame, unit: str, item: str, room: float, head: float, between: float, depth: int = 3, order: list[str] | None = None) -> DataFrame:
    """Linked bands with page, head_page and head_top (of an item's first band), top, bottom and scale; a unit is a book's chapter.

    order: columns in whose order, that of ord, the bands of a unit lie already, so that they are not sorted once more.
    """
    columns, kinds = ["ord", item, "gap", "height", "link", "figure", "mark_only"], dict(bands.dtypes)
    added = ", ".join(f"{c} {t}" for c, t in ADDED.items())
    schema = f"`{unit}` {kinds[unit]}, ord {kinds['ord']}, `{item}` {kinds[item]}, gap double, link string, {added}"
    # nothing looks beyond a band without a link
    return K.fold_columns(bands, unit, order or columns, columns, schema, lambda b: b.column("link").is_null().to_numpy(zero_copy_only=False), lambda: placing(room, head, between, depth))


def audited(placed: DataFrame, unit: str, item: str, room: float, head: float) -> DataFrame:
    """A row per finding on placed bands (ord, gap, link, page, head_page, head_top, top, bottom, scale): unit, page, ord, item, finding, size.

    Beyond the margin, enlarged, over the next band of the page or over a heading; a heading without its band; two bands with a firm link on two
    pages though all that hangs together fits one; and a page left with 45 % of it free, with the reason.
    """
    w, on_page = Window.partitionBy(unit).orderBy("ord"), Window.partitionBy(unit, "page").orderBy("top", "ord")
    height = F.col("bottom") - F.col("top")
    holds = {"firm": F.coalesce(F.col("_link").isin(*FIRM, "mark"), F.lit(False)), "any": F.col("_link").isNotNull()}
    x = placed.withColumn("_link", F.lag("link").over(w)).withColumns({f"_{run}": F.sum(F.when(held, 0).otherwise(1)).over(w) for run, held in holds.items()})
    # runs lie in the order of bands and the firm ones within the others, so that this is the same order and one sort serves all of these windows
    runs = Window.partitionBy(unit).orderBy("_any", "_firm", "ord")
    x = x.withColumn("_before", F.lag(F.struct("page", "bottom")).over(runs))
    for run, part in (("any", ("_any",)), ("firm", ("_any", "_firm"))):
        x = x.withColumn(f"_{run}_height", F.sum(height + F.when(holds[run], F.col("gap")).otherwise(0.0)).over(Window.partitionBy(unit, *part)))
    x = x.withColumn("_next", F.lead(F.struct("page", item, "_any_height")).over(runs)).withColumn("_below", F.lead("top").over(on_page))
    free = F.lit(room) - F.max("bottom").over(Window.partitionBy(unit, "page"))
    x = x.withColumn("_free", free)
    cut = (F.col("_next.page") > F.col("page")) & (F.col("_firm_height") <= room - head)
    kinds = F.when(F.col("link") == "figure", "split figure").when(F.col("link") == "introduces", "orphan introduction").when(F.col("link") == "leads", "orphan lead").when(F.col("link").isin("label", "caption"), "orphan caption")
    waste = F.when(~F.col("_next").getField(item).eqNullSafe(F.col(item)), "unused: next item").when(F.col("_next._any_height") > F.col("_free") - 12, "unused: kept together").otherwise("unused: other")
    finding = lambda when, what, size: F.when(when, F.struct((F.lit(what) if isinstance(what, str) else what).alias("finding"), size.cast("double").alias("size")))
    found = F.array(
        finding((F.col("top") < -0.6) | (F.col("bottom") > room + 0.6), "margin", F.col("bottom")),
        finding(F.col("scale") > 1.002, "enlarged", F.col("scale")),
        finding(F.col("_below") < F.col("bottom") - 0.8, "overlap", F.col("bottom") - F.col("_below")),
        finding((F.col("head_page") < F.col("page")) | (F.col("top") < F.col("head_top") - 2), "orphan heading", F.col("head_top")),
        finding((F.col("_before.page") == F.col("head_page")) & (F.col("_before.bottom") - 1 > F.col("head_top") + 4), "heading covered", F.col("_before.bottom") - F.col("head_top")),
        finding(cut & kinds.isNotNull(), kinds, F.col("_firm_height")),
        finding((F.col("_next.page") > F.col("page")) & (F.col("_free") > 0.45 * room), waste, F.col("_free")),
    )
    x = x.select(unit, "page", "ord", item, F.explode(F.filter(found, lambda f: f.isNotNull())).alias("f"))
    return x.select(unit, "page", "ord", item, "f.finding", "f.size")
