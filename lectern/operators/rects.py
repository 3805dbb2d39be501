"""Rectangles that overlap, found by grids of several cell sizes, and rows of ruled tables.

A rectangle stands on the level whose cells are as large as it is or larger, and so touches four of them at most;
no level is used whose cells are less than AMPLE times as long as an average rectangle, so that most are listed once a level. It is also listed on the larger levels that occur, four cells each at most. A pair meets on the higher of its two
levels and counts in the one cell that holds the corner where the common part begins: nothing is listed without
bound, however large a rectangle is, and no pair is met twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.session import checkpointed

SIDES = ("x0", "y0", "x1", "y1")
AMPLE = 8


def _level(cell: float, sides: tuple[str, ...]) -> Column:
    x0, y0, x1, y1 = map(F.col, sides)
    long = F.greatest(x1 - x0, y1 - y0) / cell
    return F.when(long <= 1, 0).otherwise(F.ceil(F.log2(F.greatest(long, F.lit(1.0))))).cast("int")


def _listed(df: DataFrame, levels: DataFrame, cell: float, sides: tuple[str, ...], own: str) -> DataFrame:
    """df under each cell it touches, on its own level (the first of levels, if that is larger) and the larger ones of levels (one row: an array)."""
    at = lambda c: F.floor(F.col(c) / (cell * F.pow(F.lit(2.0), F.col("__level")))).cast("long")
    x = df.crossJoin(F.broadcast(levels))  # one row, a number a level
    x = x.withColumn(own, F.greatest(_level(cell, sides), F.array_min("__levels")))
    x = x.withColumn("__level", F.explode(F.filter("__levels", lambda k: k >= F.col(own)))).drop("__levels")
    x = x.withColumn("__x", F.explode(F.sequence(at(sides[0]), at(sides[2]))))
    return x.withColumn("__y", F.explode(F.sequence(at(sides[1]), at(sides[3]))))


def rectangle_join(left: DataFrame, right: DataFrame, by: list[str], a: tuple[str, ...] = SIDES, b: tuple[str, ...] = SIDES, cell: float = 64.0) -> DataFrame:
    """Pairs of a group whose rectangles share a point; a and b name x0, y0, x1 and y1, and columns besides by must differ.

    Rectangles with a null or NaN side, or whose sides are in the wrong order, have no pairs.
    """
    sound = lambda s: f"NOT isnan({s[0]}) AND NOT isnan({s[1]}) AND {s[0]} <= {s[2]} AND {s[1]} <= {s[3]} AND {s[2]} < double('infinity') AND {s[3]} < double('infinity') AND {s[0]} > double('-infinity') AND {s[1]} > double('-infinity')"
    left, right = left.filter(sound(a)), right.filter(sound(b))
    long = lambda df, s: df.select(_level(cell, s).alias("k"), F.greatest(F.col(s[2]) - F.col(s[0]), F.col(s[3]) - F.col(s[1])).alias("long"))
    lengths = long(left, a).unionByName(long(right, b)).groupBy("k").agg(F.sum("long").alias("long"), F.count(F.lit(1)).alias("n"))
    ample = F.ceil(F.log2(F.greatest(F.lit(1.0), AMPLE * F.sum("long") / F.sum("n") / cell))).cast("int")
    levels = lengths.agg(F.collect_set("k").alias("k"), ample.alias("least"))
    # AMPLE times the average may be more than the longest: then all stand on one level
    levels = checkpointed(levels.select(F.array_sort(F.array_distinct(F.transform("k", lambda k: F.greatest(k, F.col("least"))))).alias("__levels")))
    x, y = _listed(left, levels, cell, a, "__a"), _listed(right, levels, cell, b, "__b")
    pairs = x.join(y, [*by, "__level", "__x", "__y"]).filter(F.col("__level") == F.greatest("__a", "__b"))
    col = F.col
    pairs = pairs.filter((col(a[0]) <= col(b[2])) & (col(b[0]) <= col(a[2])) & (col(a[1]) <= col(b[3])) & (col(b[1]) <= col(a[3])))
    size = cell * F.pow(F.lit(2.0), F.col("__level"))
    corner = (F.floor(F.greatest(a[0], b[0]) / size) == F.col("__x")) & (F.floor(F.greatest(a[1], b[1]) / size) == F.col("__y"))
    return pairs.filter(corner).drop("__level", "__x", "__y", "__a", "__b")


def ruled_rows(rules: DataFrame) -> DataFrame:
    """doc_id, page, y0 and y1 of each row of a ruled table and of each box, once.

    rules(doc_id, page, x0, y0, x1, y1). A box is wider than 200 and 10 to 400 high; a row lies between two neighbouring
    rules wider than 200 that are 8 to 400 apart and that one upright rule joins, give or take 2.
    """
    page = ["doc_id", "page"]
    wide, high = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    boxes = rules.filter((wide > 200) & (high > 10) & (high < 400)).select(*page, "y0", "y1")
    across = rules.filter((wide > 200) & (high <= 2)).select(*page, F.round((F.col("y0") + F.col("y1")) / 2, 1).alias("y0")).distinct()
    strips = across.withColumn("y1", F.lead("y0").over(Window.partitionBy(*page).orderBy("y0"))).filter("y1 - y0 > 8 AND y1 - y0 < 400")
    upright = rules.filter((high > 8) & (wide <= 2)).select(*page, F.col("y0").alias("v0"), F.col("y1").alias("v1"))
    # the strips that an upright rule joins are those that begin from its upper end on and end by its lower end: in the order of
    # beginnings, a strip is joined if some rule that begins before it reaches its end, so the farthest end so far tells
    begins = strips.select(*page, (F.col("y0") + 2).alias("at"), F.lit(1).alias("last"), "y0", "y1", F.lit(None).cast("double").alias("v1"))
    both = begins.unionByName(upright.select(*page, F.col("v0").alias("at"), F.lit(0).alias("last"), F.lit(None).cast("double").alias("y0"), F.lit(None).cast("double").alias("y1"), "v1"))
    reach = F.max("v1").over(Window.partitionBy(*page).orderBy("at", "last").rowsBetween(Window.unboundedPreceding, 0))
    rows = both.withColumn("reach", reach).filter("y0 IS NOT NULL AND reach >= y1 - 2").select(*page, "y0", "y1")
    return boxes.unionByName(rows).select(*page, F.round("y0", 1).alias("y0"), F.round("y1", 1).alias("y1")).distinct()


def overlap_lines(pieces: DataFrame, back: int = 3) -> DataFrame:
    """doc_id, page, line, x0, y0, x1, y1 and n of visual lines made of pieces(doc_id, page, x0, y0, x1, y1).

    In the order of their centres, a piece joins the first of the last `back` lines of its page that it shares more than 0.55
    of the lesser height with, whose centre is nearer than half the greater height, and that it stands beside
    (their extents share less than 2); else it begins a line. Lines are numbered from the top.

    The lines of a page that may still grow are the last few, so what is folded is a page's pieces, in their order.
    """
    page = ["doc_id", "page"]
    item = F.struct(((F.col("y0") + F.col("y1")) / 2).alias("c"), "y0", "y1", "x0", "x1")
    line = "struct<y0:double,x0:double,x1:double,y1:double,n:int>"
    made = lambda y0, x0, x1, y1, n: F.struct(y0.alias("y0"), x0.alias("x0"), x1.alias("x1"), y1.alias("y1"), n.cast("int").alias("n"))
    start = F.struct(F.array().cast(f"array<{line}>").alias("open"), F.array().cast(f"array<{line}>").alias("done"))

    def fits(o: Column, w: Column) -> Column:
        h, oh = w["y1"] - w["y0"], o["y1"] - o["y0"]
        shared = F.least(o["y1"], w["y1"]) - F.greatest(o["y0"], w["y0"])
        beside = F.least(o["x1"], w["x1"]) - F.greatest(o["x0"], w["x0"]) < 2
        return (shared > 0.55 * F.least(h, oh)) & (F.abs(w["c"] - (o["y0"] + o["y1"]) / 2) < 0.5 * F.greatest(h, oh)) & beside

    def step(s: Column, w: Column) -> Column:
        at = F.array_position(F.transform(s["open"], lambda o: fits(o, w)), True)
        grown = F.transform(s["open"], lambda o, i: F.when(i + 1 == at, made(F.least(o["y0"], w["y0"]), F.least(o["x0"], w["x0"]), F.greatest(o["x1"], w["x1"]), F.greatest(o["y1"], w["y1"]), o["n"] + 1)).otherwise(o))
        more = F.concat(s["open"], F.array(made(w["y0"], w["x0"], w["x1"], w["y1"], F.lit(1))))
        full = (at == 0) & (F.size(s["open"]) >= back)
        opened = F.when(at > 0, grown).when(full, F.slice(more, 2, back)).otherwise(more)
        return F.struct(opened.alias("open"), F.when(full, F.concat(s["done"], F.slice(s["open"], 1, 1))).otherwise(s["done"]).alias("done"))

    folded = pieces.groupBy(*page).agg(F.array_sort(F.collect_list(item)).alias("w")).select(*page, F.aggregate("w", start, step, lambda s: F.array_sort(F.concat(s["done"], s["open"]))).alias("l"))
    return folded.select(*page, F.posexplode("l").alias("line", "l")).select(*page, (F.col("line") + 1).alias("line"), "l.x0", "l.y0", "l.x1", "l.y1", "l.n")
