"""Page flow: the lines of a customer's orders as bands of a chapter, an order an item under a heading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.operators import flow as P
from lectern.plans.boxes import LINE
from lectern.session import checkpointed, table

ROOM, HEAD, BETWEEN = 720.0, 24.0, 10.0


def bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linked bands: four to a source page, some of them figures, marks, captions, lines with a colon or a lead, and some taller than a page."""
    q, p, i = F.col("l_quantity").cast("int"), F.col("l_partkey"), F.col("i")
    # dealt out as read, and not with what is computed for the windows
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE).repartition("l_orderkey")
    x = li.withColumn("h", F.when(p % 90 == 0, 800).when(p % 5 == 0, 12).when(p % 5 == 1, 40 + q * 3).otherwise(14 + q)).withColumn("size", F.col("h") + F.when(p % 2 == 0, p % 13).otherwise(q))
    # all windows of an order are the one by line, so that it is sorted once; on its page three lines at most stand above a line
    order = Window.partitionBy("l_orderkey").orderBy(*LINE)
    x = x.withColumns({"i": F.row_number().over(order) - 1} | {f"above_{k}": F.lag("size", k).over(order) for k in (1, 2, 3)})
    sizes = [F.col("size"), *(F.when(i % 4 >= k, F.col(f"above_{k}")) for k in (1, 2, 3))]
    foot = F.when(F.coalesce(*sizes).isNotNull(), sum(F.coalesce(s, F.lit(0)) for s in sizes)).cast("double")
    x = x.withColumns({"page": F.floor(i / 4).cast("int"), "figure": F.when(q % 3 == 0, F.floor(i / 2).cast("int"))})
    mark = (q % 7 == 1) & F.col("figure").isNull()
    x = x.withColumns({"y1": foot, "mark_only": mark, "colon": p % 6 == 0, "bullet": p % 11 == 0, "caption": (p % 4 == 1) & ~mark, "leads": F.when(mark, 0).otherwise(2 - p % 3)}).withColumn("y0", F.col("y1") - F.col("h"))
    x = P.links(x, "l_orderkey", order)
    x = x.join(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    x = x.select(F.col("o_custkey").alias("unit"), F.col("l_orderkey").alias("item"), "i", F.col("l_partkey").alias("p"), "height", "gap", "link", "figure", "mark_only")
    return x.withColumn("ord", F.row_number().over(Window.partitionBy("unit").orderBy("item", "i")))


def linked_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why each band stays with the next, its height and the gap above it."""
    return bands(spark, sf_dir).select("unit", "ord", "item", "height", "gap", "link")


def linked_page_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each band lands: figures whole, lines with what they lead to, headings with their first band, bands too tall made smaller."""
    return P.flowed(bands(spark, sf_dir), "unit", "item", ROOM, HEAD, BETWEEN, order=["item", "i"])


def stacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bands set one after the other with no regard for links, some drawn up by 3 or enlarged."""
    w = Window.partitionBy("unit").orderBy("ord")
    first = F.coalesce(F.lag("item").over(w) != F.col("item"), F.lit(True))
    x = bands(spark, sf_dir).withColumn("above", F.when(first, HEAD).otherwise(0.0))
    x = x.withColumn("at", F.sum(F.col("above") + F.col("gap") + F.col("height")).over(w) - F.col("height"))
    page = lambda c: (F.floor(c / ROOM) + 1).cast("int")
    heading = F.when(F.col("above") > 0, F.col("at") - HEAD)
    x = x.withColumns({"page": page(F.col("at")), "head_page": page(heading), "head_top": heading % ROOM, "top": F.col("at") % ROOM - F.when(F.col("p") % 17 == 0, 3).otherwise(0)})
    return x.withColumns({"bottom": F.col("top") + F.col("height"), "scale": F.when(F.col("p") % 50 == 0, 1.01).otherwise(1.0)})


def layout_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the audit finds on pages filled with no regard for links."""
    # kept, so that the sorts of the pages and those of the audit are not held by one task
    return P.audited(checkpointed(stacked(spark, sf_dir)), "unit", "item", ROOM, HEAD)


QUERIES = {f.__name__: f for f in (linked_bands, linked_page_flow, layout_findings)}

_BANDS = f"""
    l AS (SELECT l_orderkey AS item, o_custkey AS unit, l_partkey AS p, l_quantity::INT AS q, row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(LINE)}) - 1 AS i FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
    m AS (SELECT *, i // 4 AS page, CASE WHEN q % 3 = 0 THEN i // 2 END AS figure, q % 7 = 1 AND q % 3 <> 0 AS mark,
            (CASE WHEN p % 90 = 0 THEN 800 WHEN p % 5 = 0 THEN 12 WHEN p % 5 = 1 THEN 40 + q * 3 ELSE 14 + q END)::DOUBLE AS h, CASE WHEN p % 2 = 0 THEN p % 13 ELSE q END AS free FROM l),
    y AS (SELECT *, sum(h + free) OVER (PARTITION BY item, page ORDER BY i) AS y1, p % 6 = 0 AS colon, CASE WHEN mark THEN 0 ELSE 2 - p % 3 END AS leads FROM m),
    z AS (SELECT *, y1 - h AS y0, row_number() OVER u AS ord, lead(h) OVER o AS nh, lead(page) OVER o AS npage, lead(y1 - h) OVER o - y1 AS apart, lead(y1 - h) OVER o AS ny, lead(figure) OVER o AS nf,
            lead(mark) OVER o AS nm, lead(colon) OVER o AS nc, lead(leads) OVER o AS nl, lag(page) OVER o AS bpage, y1 - h - lag(y1) OVER o AS down
          FROM y WINDOW u AS (PARTITION BY unit ORDER BY item, i), o AS (PARTITION BY item ORDER BY i)),
    bands AS (SELECT unit, ord, item, p, h AS height, figure, mark, CASE WHEN bpage IS NULL THEN 0.0 WHEN bpage = page AND down >= 0 THEN least(down, 8) ELSE 4 END::DOUBLE AS gap,
            CASE WHEN nh IS NULL THEN NULL
                 WHEN figure = nf THEN 'figure'
                 WHEN nm THEN 'mark'
                 WHEN figure IS NULL AND NOT mark AND nf IS NOT NULL AND h < 45 AND (page = npage AND apart BETWEEN 0 AND 60 OR npage = page + 1 AND ny < 130) THEN 'label'
                 WHEN figure IS NULL AND NOT mark AND colon AND (page = npage AND apart BETWEEN 0 AND 60 OR npage = page + 1) THEN 'introduces'
                 WHEN figure IS NULL AND nf IS NOT NULL AND p % 4 = 1 AND NOT mark AND page = npage AND apart BETWEEN 0 AND 14 THEN 'caption'
                 WHEN leads >= 2 AND nl = leads - 1 AND page = npage AND apart BETWEEN 0 AND 14 THEN 'leads'
                 WHEN page = npage AND apart <= 14 AND NOT nc AND p % 11 <> 0 AND (h < 18 AND nh > 30 OR h > 30 AND nh < 18) THEN 'beside' END AS link FROM z)"""
_FIRM = ", ".join(f"'{k}'" for k in P.FIRM)
ORACLES = {
    "linked_bands": f"WITH {_BANDS} SELECT unit, ord, item, height, gap, link FROM bands",
    # chains and cores grow band by band from every start, and then the pages fill band by band in every unit
    "linked_page_flow": f"""
        WITH RECURSIVE {_BANDS},
        b AS MATERIALIZED (SELECT *, least(height, {ROOM - HEAD}) AS h, lag(item) OVER w IS DISTINCT FROM item AS first, lag(CASE WHEN lead_item = item THEN link END) OVER w AS tied
                           FROM (SELECT *, lead(item) OVER (PARTITION BY unit ORDER BY ord) AS lead_item FROM bands) WINDOW w AS (PARTITION BY unit ORDER BY ord)),
        chain AS (SELECT unit, ord AS start, ord AS k, h AS total, figure AS f, 0 AS after, link FROM b
                  UNION ALL
                  SELECT c.unit, start, b.ord, total + b.gap + b.h, coalesce(b.figure, f), after + (b.figure IS NULL AND f IS NOT NULL)::INT, b.link FROM chain c JOIN b ON b.unit = c.unit AND b.ord = c.k + 1
                  WHERE c.link IS NOT NULL AND (b.figure IS NULL OR f IS NULL OR b.figure = f) AND NOT (b.figure IS NULL AND f IS NOT NULL AND after >= 1 AND NOT b.mark)
                    AND NOT (total + b.gap + b.h > {ROOM - HEAD} AND k > start)),
        core AS (SELECT unit, ord AS start, ord AS k, h AS total, 3 AS depth, figure IS NOT NULL AS inside, figure IS NOT NULL AS firm, link, false AS closed FROM b
                 UNION ALL
                 SELECT c.unit, start, b.ord, total + b.gap + b.h, depth - (NOT inside)::INT, b.figure IS NOT NULL, true, b.link, c.inside AND c.link = 'mark' FROM core c JOIN b ON b.unit = c.unit AND b.ord = c.k + 1
                 WHERE NOT closed AND (c.link = 'figure' OR c.inside AND c.link = 'mark' OR NOT c.inside AND c.link IN ({_FIRM}) AND depth > 0)),
        k AS MATERIALIZED (SELECT b.*, c.total AS chain, o.total AS core, o.firm FROM b
              JOIN (SELECT unit, start, max_by(total, k) AS total FROM chain GROUP BY ALL) c ON c.unit = b.unit AND c.start = b.ord
              JOIN (SELECT unit, start, max_by(total, k) AS total, max_by(firm, k) AS firm FROM core GROUP BY ALL) o ON o.unit = b.unit AND o.start = b.ord),
        f AS (SELECT unit, ord, 1 AS page, {HEAD} + h AS used, 0.0::DOUBLE AS head_top, {HEAD}::DOUBLE AS top FROM k WHERE ord = 1
              UNION ALL
              SELECT unit, ord, CASE WHEN turn THEN page + 1 ELSE page END, CASE WHEN turn THEN 0 ELSE used + space END + above + h,
                     CASE WHEN first THEN CASE WHEN turn THEN 0 ELSE used + space END END, CASE WHEN turn THEN 0 ELSE used + space END + above
              FROM (SELECT *, h > room OR tied IS DISTINCT FROM 'figure' AND (core > room AND core <= {ROOM - HEAD} AND (firm OR tied IS NULL) OR tied IS NULL AND chain > room AND chain <= {ROOM - HEAD}) AS turn
                    FROM (SELECT k.*, f.page, f.used, CASE WHEN first THEN {BETWEEN} ELSE gap END AS space, CASE WHEN first THEN {HEAD} ELSE 0 END AS above,
                                 {ROOM} - f.used - CASE WHEN first THEN {BETWEEN} + {HEAD} ELSE gap END AS room FROM f JOIN k ON k.unit = f.unit AND k.ord = f.ord + 1)))
        SELECT unit, ord, item, gap, link, page, CASE WHEN head_top IS NOT NULL THEN page END AS head_page, head_top, top, used AS bottom, least(1.0, {ROOM - HEAD} / height) AS scale FROM f JOIN k USING (unit, ord)""",
    "layout_findings": f"""
        WITH {_BANDS},
        a AS (SELECT *, CASE WHEN lag(item) OVER (PARTITION BY unit ORDER BY ord) IS DISTINCT FROM item THEN {HEAD} ELSE 0 END AS above FROM bands),
        t AS (SELECT *, sum(above + gap + height) OVER (PARTITION BY unit ORDER BY ord) - height AS foot FROM a),
        s AS (SELECT *, (floor(foot / {ROOM}) + 1)::INT AS page, foot % {ROOM} - CASE WHEN p % 17 = 0 THEN 3 ELSE 0 END AS top, CASE WHEN above > 0 THEN floor((foot - {HEAD}) / {ROOM}) + 1 END AS head_page, CASE WHEN above > 0 THEN (foot - {HEAD}) % {ROOM} END AS head_top FROM t),
        r AS (SELECT *, top + height AS bottom, coalesce(lag(link) OVER w IN ({_FIRM}, 'mark'), false) AS f, lag(link) OVER w IS NOT NULL AS y FROM s WINDOW w AS (PARTITION BY unit ORDER BY ord)),
        g AS (SELECT *, sum((NOT f)::INT) OVER w AS fr, sum((NOT y)::INT) OVER w AS yr FROM r WINDOW w AS (PARTITION BY unit ORDER BY ord)),
        v AS (SELECT *, sum(height + CASE WHEN f THEN gap ELSE 0 END) OVER (PARTITION BY unit, fr) AS firm, sum(height + CASE WHEN y THEN gap ELSE 0 END) OVER (PARTITION BY unit, yr) AS run,
                {ROOM} - max(bottom) OVER (PARTITION BY unit, page) AS free, lead(top) OVER (PARTITION BY unit, page ORDER BY top, ord) AS below FROM g),
        n AS (SELECT *, lead(page) OVER w AS npage, lead(item) OVER w AS nitem, lead(run) OVER w AS nrun, lag(page) OVER w AS bpage, lag(bottom) OVER w AS bbottom FROM v WINDOW w AS (PARTITION BY unit ORDER BY ord)),
        found AS (SELECT *, 'margin' AS finding, bottom AS size FROM n WHERE top < -0.6 OR bottom > {ROOM} + 0.6
          UNION ALL SELECT *, 'enlarged', 1.01 FROM n WHERE p % 50 = 0
          UNION ALL SELECT *, 'overlap', bottom - below FROM n WHERE below < bottom - 0.8
          UNION ALL SELECT *, 'orphan heading', head_top FROM n WHERE head_page < page OR top < head_top - 2
          UNION ALL SELECT *, 'heading covered', bbottom - head_top FROM n WHERE bpage = head_page AND bbottom - 1 > head_top + 4
          UNION ALL SELECT *, CASE link WHEN 'figure' THEN 'split figure' WHEN 'introduces' THEN 'orphan introduction' WHEN 'leads' THEN 'orphan lead' ELSE 'orphan caption' END, firm FROM n
            WHERE npage > page AND link IN ({_FIRM}) AND firm <= {ROOM - HEAD}
          UNION ALL SELECT *, CASE WHEN nitem <> item THEN 'unused: next item' WHEN nrun > free - 12 THEN 'unused: kept together' ELSE 'unused: other' END, free FROM n WHERE npage > page AND free > 0.45 * {ROOM})
        SELECT unit, page, ord, item, finding, size::DOUBLE AS size FROM found""",
}
