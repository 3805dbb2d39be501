"""Tables of labels and marks read from words and rules on pages.

words(doc_id, page, x0, y0, x1, y1, text) and rules(doc_id, page, x0, y0, x1, y1). A table begins at a
line that has both a heading of the label column and one of the mark column; its columns are
bounded by the vertical rules that cross it. Labels come whole, as 3(b)(ii), or as tokens 3, (b),
(ii) of which those left out are carried on from the rows above, over pages. A row begins at the rule
above its label and ends at the next; one that is open at the end of a page goes on at the top of
the next page's first table, and a row of totals closes it.

All steps are windows and joins by document, page and table: no document is held in one place, and
a page's words are its only unbounded list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.session import checkpointed

PAGE = ("doc_id", "page")
TABLE = (*PAGE, "table")
LABEL = r"^(\d{1,2})((?:\([a-h]\))?)((?:\((?:ix|iv|v?i{1,3}|v|x)\))?)$"
NUMBER, LETTER, ROMAN = r"^(\d{1,2})$", r"^\(([a-h])\)$", r"^\(((?:ix|iv|v?i{1,3}|v|x))\)$"
TOTAL = r"^\[?Total:?$"


def heads(words: DataFrame, height: float = 842.0) -> DataFrame:
    """One row per table: where its heading ends, its label and mark headings and how far down it may reach."""
    named = words.filter(F.col("text").isin("Question", "Marks", "Mark", "Total", "Guidance", "Page"))
    left = named.filter("text = 'Question' AND x0 < 140").select(*PAGE, F.col("x0").alias("hx0"), F.col("x1").alias("hx1"), F.col("y0").alias("hy0"), F.col("y1").alias("hy1"))
    right = named.filter("text <> 'Question' AND text <> 'Page'").select(*PAGE, "text", "x0", "x1", "y0")
    # the total column counts before the rightmost of the mark columns
    mark = F.max(F.when((F.col("text") != "Guidance") & (F.col("x0") > 300), F.struct((F.col("text") == "Total").alias("total_col"), F.col("x0"), F.col("x1"))))
    found = left.join(right, [*PAGE]).filter("abs(y0 - hy0) < 3").groupBy(*PAGE, "hx0", "hx1", "hy0", "hy1").agg(mark.alias("m"), F.max(F.col("text") == "Guidance").alias("guidance"))
    foot = named.filter(f"text = 'Page' AND y0 > {height - 70}").groupBy(*PAGE).agg(F.min("y0").alias("foot"))
    down = Window.partitionBy(*PAGE).orderBy("hy0", "hx0")
    below = F.coalesce(F.lead("hy0").over(down) - 6, F.col("foot") - 4, F.lit(height - 50))
    return found.filter("m IS NOT NULL").join(foot, [*PAGE], "left").select(
        *PAGE, F.row_number().over(down).alias("table"), "hx0", "hx1", "hy1", F.col("m.total_col").alias("total_col"), F.col("m.x0").alias("mx0"), F.col("m.x1").alias("mx1"), "guidance", below.alias("below")
    )


def bounded(found: DataFrame, rules: DataFrame) -> DataFrame:
    """Tables with their columns and row rules: question_end, left, right, mark_end, bottom and tops (the rules that rows may begin at)."""
    r = rules.select(*PAGE, "x0", "y0", "x1", "y1")
    pair = found.join(r, [*PAGE], "left")
    upright = (F.col("x1") - F.col("x0") < 2) & (F.col("y1") - F.col("y0") > 4) & (F.col("y1") > F.col("hy1")) & (F.col("y0") < F.col("below"))
    across = (F.col("y1") - F.col("y0") < 2) & (F.col("x1") - F.col("x0") > 30) & (F.col("x0") < F.col("hx0") + 4) & (F.col("y0") > F.col("hy1")) & (F.col("y0") < F.col("below"))
    some = lambda condition, value: F.when(condition, value)
    bounds = pair.groupBy(*found.columns).agg(
        F.min(some(upright & (F.col("x0") > F.col("mx1") - 2), F.col("x0"))).alias("mark_rule"),
        F.min(some(upright & (F.col("x0") > F.col("hx0") + 5), F.col("x0"))).alias("label_rule"),
        F.min(some(upright & (F.col("x0") < F.col("hx0")), F.col("x0"))).alias("left_rule"),
        F.max(some(upright & (F.col("y1") <= F.col("below") + 1), F.col("y1"))).alias("bottom_rule"),
        F.sort_array(F.collect_set(some(across, F.round("y0", 1)))).alias("tops"),
    )
    return bounds.select(
        *TABLE, "hy1", "total_col", "guidance", "tops",
        (F.col("mx0") - 12).alias("mark_start"),
        F.least(F.col("mx1") + 12, F.coalesce(F.col("mark_rule") + 1, F.col("mx1") + 12)).alias("mark_end"),
        (F.col("mx1") - 1).alias("mark_right"),
        F.coalesce("label_rule", F.col("hx1") + 20).alias("label_end"),
        (F.coalesce("left_rule", F.col("hx0") - 15) - 2).alias("left"),
        F.coalesce("bottom_rule", "below").alias("bottom"),
    )


def label_lines(words: DataFrame, tables: DataFrame) -> DataFrame:
    """y and tokens, left to right, of each line of a label column, and of words that announce a total beside it."""
    inside = tables.select(*TABLE, "hy1", "bottom", "label_end", "left").join(words, [*PAGE]).filter("y0 > hy1 AND y0 < bottom")
    column = inside.filter("x1 <= label_end + 4 AND x0 >= left")
    w = Window.partitionBy(*TABLE).orderBy("y0", "x0", "text")
    new = F.coalesce(F.col("y0") - F.lag("y0").over(w) >= 3, F.lit(True)).cast("int")
    lines = column.withColumn("__new", new).withColumn("line", F.sum("__new").over(w))
    lines = lines.groupBy(*TABLE, "line").agg(F.min("y0").alias("y"), F.sort_array(F.collect_list(F.struct("x0", "text"))).alias("t")).select(*TABLE, "y", F.col("t.text").alias("tokens"))
    totals = inside.filter(F.col("text").rlike(TOTAL) & (F.col("y0") > F.col("hy1") + 2) & (F.col("x1") > F.col("label_end") + 4))
    return lines.unionByName(totals.select(*TABLE, F.col("y0").alias("y"), F.array(F.lit("Total")).alias("tokens")))


def labelled(lines: DataFrame) -> DataFrame:
    """TABLE, y, kind (label or total), q, letter and roman of each line that begins a row; tokens left out are those of the rows above."""
    first = F.col("tokens")[0]
    token = lambda pattern: F.element_at(F.filter("tokens", lambda t: t.rlike(pattern)), -1)
    parts = lambda i: F.nullif(F.regexp_replace(F.regexp_extract(first, LABEL, i), r"[()]", ""), F.lit(""))
    whole = first.rlike(LABEL) & first.contains("(")
    loose = ~whole & F.forall("tokens", lambda t: t.rlike(NUMBER) | t.rlike(LETTER) | t.rlike(ROMAN))
    bare = lambda c: F.translate(c, "()", "")
    one = lambda pattern: F.when(loose, bare(F.try_element_at(F.filter("tokens", lambda t: t.rlike(pattern)), F.lit(-1))))
    x = lines.select(*TABLE, "y", F.when(first == "Total", "total").when(whole, "whole").when(loose, "loose").alias("kind"), *(parts(i).alias(f"w{i}") for i in (1, 2, 3)), one(NUMBER).alias("n"), one(LETTER).alias("l"), one(ROMAN).alias("r"))
    x = x.filter("kind IS NOT NULL")
    order = ["page", "table", "y"]
    doc = Window.partitionBy("doc_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumn("numbers", F.count("n").over(doc))
    under = Window.partitionBy("doc_id", "numbers").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumns({"q": F.last("n", ignorenulls=True).over(under), "letters": F.count("l").over(under)})
    below = Window.partitionBy("doc_id", "numbers", "letters").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumns({"letter": F.last("l", ignorenulls=True).over(below), "roman": F.last("r", ignorenulls=True).over(below)})
    pick = lambda i, carried: F.when(F.col("kind") == "whole", F.col(f"w{i}")).when(F.col("kind") == "loose", F.col(carried))
    x = x.select(*TABLE, "y", F.when(F.col("kind") == "total", "total").otherwise("label").alias("kind"), pick(1, "q").cast("int").alias("q"), pick(2, "letter").alias("letter"), pick(3, "roman").alias("roman"))
    return x.filter("kind = 'total' OR q IS NOT NULL")


def segments(starts: DataFrame, tables: DataFrame) -> DataFrame:
    """The stretches of pages of each row: doc_id, row, q, letter, roman, page, table, top and end, with the columns of the table."""
    w = Window.partitionBy(*TABLE).orderBy("y", "kind")
    own = starts.join(tables, [*TABLE])
    above = F.array_max(F.filter("tops", lambda t: t <= F.col("y") + 1))
    top = F.coalesce(above, F.when(F.size("tops") == 0, F.col("y") - 3).otherwise(F.col("hy1") + 2))
    own = own.withColumn("top", top).withColumn("end", F.coalesce(F.lead("top").over(w), F.col("bottom")))
    first = own.groupBy(*TABLE).agg(F.min_by("top", F.struct("y", "kind")).alias("first_top"))
    under = F.coalesce(F.array_min("tops"), F.col("hy1") + 4)
    none = [F.lit(None).cast(k).alias(c) for c, k in (("q", "int"), ("letter", "string"), ("roman", "string"))]
    # what stands above the first label of a page's first table belongs to the row before it
    goes_on = tables.filter("table = 1").join(first, [*TABLE], "left").withColumn("end", F.coalesce("first_top", "bottom")).withColumn("top", under).filter("end - top > 8")
    goes_on = goes_on.withColumn("y", F.col("hy1")).select(*TABLE, "y", F.lit("on").alias("kind"), *none, "top", "end", *(c for c in tables.columns if c not in TABLE))
    every = own.select(goes_on.columns).unionByName(goes_on)
    doc = Window.partitionBy("doc_id").orderBy("page", "table", "y", "kind").rowsBetween(Window.unboundedPreceding, 0)
    every = every.withColumn("row", F.sum((F.col("kind") == "label").cast("int")).over(doc)).withColumn("open", F.last(F.when(F.col("kind") != "on", F.col("kind")), ignorenulls=True).over(doc))
    every = every.filter("open = 'label'")
    of = Window.partitionBy("doc_id", "row")
    named = {c: F.max(c).over(of) for c in ("q", "letter", "roman")}
    return every.withColumns(named).drop("open")


def _values(a: Column, total_col: Column, start: Column, end: Column, right: Column) -> Column:
    """The marks printed in a stretch; a: its words about the mark column in order."""
    number = lambda t, p: F.regexp_extract(t, p, 1).try_cast("int")
    within = F.filter(a, lambda v: (v["x0"] >= start - 1) & (v["x0"] <= end))
    follow = lambda w: F.get(F.filter(a, lambda v: (F.abs(v["y0"] - w["y0"]) < 2) & (v["x0"] > w["x0"])), F.lit(0))
    most = F.filter(F.transform(F.filter(a, lambda v: v["text"] == "[max"), lambda w: F.struct(number(follow(w)["text"], r"^(\d{1,2})\]$").alias("n"), w["y0"].alias("y0"))), lambda m: m["n"].isNotNull())
    later = F.transform(F.filter(within, lambda v: (v["y0"] > most[0]["y0"] + 2) & v["text"].rlike(r"^\[\d{1,2}\]$")), lambda v: number(v["text"], r"(\d+)"))
    column = F.transform(F.filter(a, lambda v: (v["x0"] > right) & (v["x0"] <= end) & v["text"].rlike(r"^\d{1,2}$")), lambda v: v["text"].cast("int"))
    added = lambda t: F.aggregate(F.transform(F.split(t, r"\+"), lambda x: x.try_cast("int")), F.lit(0), lambda s, x: s + x)
    sums = ~total_col
    value = lambda v: F.when(v["text"].rlike(r"^\d(\+\d)+$") & sums, added(v["text"])).when(total_col, number(v["text"], r"^\[(\d{1,2})\]$")).otherwise(number(v["text"], r"^\[?(\d{1,2})\]?$"))
    read = F.filter(F.transform(within, lambda v: F.struct(F.bround(v["y0"]).alias("line"), value(v).alias("n"))), lambda v: v["n"].isNotNull())
    # one value a line: the first
    once = F.filter(read, lambda v, i: (i == 0) | ~F.exists(F.slice(read, 1, F.greatest(i, F.lit(1))), lambda b: b["line"] == v["line"]))
    return F.when(F.size(most) > 0, F.concat(F.array(most[0]["n"]), later)).when(~total_col & (F.size(column) > 0), column).otherwise(F.transform(once, lambda v: v["n"]))


def scheme_rows(words: DataFrame, rules: DataFrame, height: float = 842.0) -> DataFrame:
    """doc_id, row, q, letter, roman, marks (as printed), points, dropped_total, mark_total, no_answer, guidance, total_col and pages of each row of all tables."""
    # both are small beside the words and read several times
    tables = checkpointed(bounded(heads(words, height), rules))
    parts = checkpointed(segments(checkpointed(labelled(label_lines(words, tables))), tables))
    near = parts.select("doc_id", "page", "row", "top", "end", "mark_start", "mark_end").join(words.select(*PAGE, "x0", "x1", "y0", "y1", "text"), [*PAGE])
    near = near.filter("y0 >= top - 2 AND y1 <= end + 2 AND x0 >= mark_start - 45 AND x0 <= mark_end")
    near = near.groupBy("doc_id", "row", "page", "top").agg(F.sort_array(F.collect_list(F.struct("y0", "x0", "text"))).alias("a"), F.max((F.col("text") == "N/A") & (F.col("x0") >= F.col("mark_start")) & (F.col("x1") <= F.col("mark_end"))).alias("none"))
    parts = parts.join(near, ["doc_id", "row", "page", "top"], "left")
    empty = F.array().cast("array<struct<y0:double,x0:double,text:string>>")
    parts = parts.withColumn("a", F.coalesce("a", empty)).withColumn("values", _values(F.col("a"), F.col("total_col"), F.col("mark_start"), F.col("mark_end"), F.col("mark_right")))
    ordered = F.sort_array(F.collect_list(F.struct("page", "top", "end", "values")))
    rows = parts.groupBy("doc_id", "row", "q", "letter", "roman").agg(
        ordered.alias("s"), F.coalesce(F.max("none"), F.lit(False)).alias("no_answer"), F.min_by("guidance", F.struct("page", "top")).alias("guidance"), F.min_by("total_col", F.struct("page", "top")).alias("total_col")
    )
    rows = rows.withColumn("printed", F.flatten(F.col("s.values")))
    return _settled(rows).select("doc_id", "row", "q", "letter", "roman", "printed", "marks", "points", "dropped_total", F.aggregate("marks", F.lit(0), lambda s, x: s + x).alias("mark_total"), "no_answer", "guidance", "total_col", F.transform("s", lambda x: x["page"]).alias("pages"))


def _settled(rows: DataFrame) -> DataFrame:
    """marks without points under their total and without a question's total under its last row."""
    sum_of = lambda c: F.aggregate(c, F.lit(0), lambda s, x: s + x)
    m = F.col("printed")
    rest = F.slice(m, 2, F.greatest(F.size(m) - 1, F.lit(0)))
    pointed = (F.size(m) >= 3) & (F.get(m, F.lit(0)) == sum_of(rest)) & F.forall(rest, lambda v: v == 1)
    x = rows.withColumn("points", F.when(pointed, rest)).withColumn("marks", F.when(pointed, F.slice(m, 1, 1)).otherwise(m))
    q = Window.partitionBy("doc_id", "q")
    n, last = F.count(F.lit(1)).over(q), F.row_number().over(q.orderBy(F.desc("row"))) == 1
    x = x.withColumns({"__n": n, "__last": last, "__all": F.sum(sum_of(F.col("marks"))).over(q)})
    size, end = F.size("marks"), F.try_element_at("marks", F.lit(-1))
    big = (F.col("__n") >= 3) & (end >= 5) & (size >= 2)
    drop = F.col("__last") & (F.col("total_col") | big) & ((size >= 2) | ((F.col("__n") > 1) & (size > 0))) & (2 * end == F.col("__all")) & (end > 0)
    drop = F.coalesce(drop, F.lit(False))
    x = x.withColumn("dropped_total", F.when(drop, end))
    return x.withColumn("marks", F.when(F.col("dropped_total").isNotNull(), F.slice("marks", 1, F.greatest(size - 1, F.lit(0)))).otherwise(F.col("marks"))).drop("__n", "__last", "__all")
