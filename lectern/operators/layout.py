"""Words on pages: furniture, cut-offs, scale, lines, marks and answer gaps.

A words table has doc_id, page, x0, y0, x1, y1, text and, where the text layer has them, block,
line and word. Windows are per page, pages being small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.operators.islands import islands

PAGE = ["doc_id", "page"]


def without_furniture(words: DataFrame, box: tuple[float, float, float, float], footer: str, least: float = 6.5) -> DataFrame:
    """Words inside box (x0, y0, x1, y1), as tall as least or taller, above the page's first footer word less half a point."""
    low, top, high, bottom = box
    foot = F.min(F.when(F.col("text").rlike(footer), F.col("y0"))).over(Window.partitionBy(*PAGE)) - 0.5
    inside = (F.col("x0") >= low) & (F.col("x1") <= high) & (F.col("y0") >= top) & (F.col("y1") <= F.least(F.lit(bottom), F.coalesce(foot, F.lit(bottom))))
    return words.withColumn("__inside", inside).filter(F.col("__inside") & (F.col("y1") - F.col("y0") >= least)).drop("__inside")


def cut_off(words: DataFrame, heading: str) -> DataFrame:
    """Words above the first word of the page that matches heading."""
    at = F.min(F.when(F.col("text").rlike(heading), F.col("y0"))).over(Window.partitionBy(*PAGE))
    return words.withColumn("__at", at).filter(F.col("__at").isNull() | (F.col("y0") < F.col("__at"))).drop("__at")


def scales(words: DataFrame, footer: str, expected: float, dead: float = 0.03) -> DataFrame:
    """doc_id and k, the upper median of footer x over what it should be; 1 within the dead band."""
    w = Window.partitionBy("doc_id").orderBy("__k")
    k = words.filter(F.col("text").rlike(footer)).select("doc_id", (F.col("x0") / expected).alias("__k"))
    k = k.withColumn("__n", F.row_number().over(w) - 1).withColumn("__all", F.count(F.lit(1)).over(Window.partitionBy("doc_id")))
    k = k.filter(F.col("__n") == F.floor(F.col("__all") / 2))
    return k.select("doc_id", F.when(F.abs(F.col("__k") - 1) <= dead, 1.0).otherwise(F.col("__k")).alias("k"))


def rescaled(words: DataFrame, factors: DataFrame) -> DataFrame:
    """Coordinates over the document's k; documents without one stay."""
    x = words.join(factors, "doc_id", "left").withColumn("k", F.coalesce("k", F.lit(1.0)))
    return x.withColumns({c: F.col(c) / F.col("k") for c in ("x0", "y0", "x1", "y1")}).drop("k")


def deduplicated(words: DataFrame) -> DataFrame:
    """Words at the same rounded place with the same text once; halves go to the even number."""
    w = Window.partitionBy(*PAGE, F.bround("x0"), F.bround("y0"), "text").orderBy("y0", "x0", "x1")
    return words.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def lines(words: DataFrame, gap: float = 2.5) -> DataFrame:
    """doc_id, page, line, y0, y1 and text of visual lines: a new line where the baseline drops by gap or more from the word before."""
    order = ["y1", "x0", "text"]
    before = F.lag("y1").over(Window.partitionBy(*PAGE).orderBy(*order))
    cut = islands(words, PAGE, order, F.col("y1") - before >= gap, "line")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "text"))), lambda w: w["text"]), " ")
    return cut.groupBy(*PAGE, "line").agg(F.min("y0").alias("y0"), F.max("y1").alias("y1"), text.alias("text"))


def lines_from_first(words: DataFrame, gap: float = 3.5) -> DataFrame:
    """As lines, but a line reaches gap from its first word's centre: an ordered fold over the page's words."""
    item = F.struct(((F.col("y0") + F.col("y1")) / 2).alias("c"), "x0", "text", "y0", "y1")
    start = F.struct(F.lit(None).cast("double").alias("first"), F.lit(0).alias("n"), F.array().cast("array<struct<line:int,x0:double,text:string,y0:double,y1:double>>").alias("out"))
    placed = lambda n, w: F.struct(n.alias("line"), w["x0"].alias("x0"), w["text"].alias("text"), w["y0"].alias("y0"), w["y1"].alias("y1"))

    def step(s: Column, w: Column) -> Column:
        new = s["first"].isNull() | (w["c"] - s["first"] >= gap)
        n = F.when(new, s["n"] + 1).otherwise(s["n"])
        return F.struct(F.when(new, w["c"]).otherwise(s["first"]).alias("first"), n.alias("n"), F.concat(s["out"], F.array(placed(n, w))).alias("out"))

    folded = words.groupBy(*PAGE).agg(F.array_sort(F.collect_list(item)).alias("w")).select(*PAGE, F.explode(F.aggregate("w", start, step, lambda s: s["out"])).alias("w")).select(*PAGE, "w.*")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "text"))), lambda w: w["text"]), " ")
    return folded.groupBy(*PAGE, "line").agg(F.min("y0").alias("y0"), F.max("y1").alias("y1"), text.alias("text"))


def page_kinds(line_table: DataFrame, patterns: dict[str, str], carried: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, page and kind: the first pattern that a page's text has; blank without text; a carried kind holds until another comes."""
    texts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda x: x["text"]), "\n")
    pages = line_table.groupBy(*PAGE).agg(texts.alias("t"))
    kind = F.coalesce(*(F.when(F.col("t").rlike(p), k) for k, p in patterns.items()), F.when(F.trim("t") == "", "blank"))
    last = F.last("__kind", ignorenulls=True).over(Window.partitionBy("doc_id").orderBy("page"))
    own = pages.withColumn("__kind", kind).withColumn("__last", last)
    keep = F.when(F.col("__last").isin(*carried), F.col("__last")) if carried else F.lit(None).cast("string")
    return own.select(*PAGE, F.coalesce("__kind", keep, F.lit("text")).alias("kind"))


def mark_events(line_table: DataFrame) -> DataFrame:
    """Each [n] of a line, also where the bracket was split off, with its place."""
    t = F.regexp_replace("text", r"\[\s*(\d+)\s+\]", "[$1]")
    return line_table.select(*PAGE, "line", "y0", F.posexplode(F.regexp_extract_all(t, F.lit(r"\[(\d+)\]"), F.lit(1))).alias("place", "value")).withColumn("value", F.col("value").cast("int"))


def answer_gaps(line_table: DataFrame, wide: int = 40) -> DataFrame:
    """Runs of five dots or more: an answer line if wide or alone on its line, else a gap in a sentence."""
    rest = F.trim(F.regexp_replace("text", "[.…]{5,}", ""))
    runs = line_table.select(*PAGE, "line", rest.alias("rest"), F.explode(F.regexp_extract_all("text", F.lit("[.…]{5,}"), F.lit(0))).alias("run"))
    kind = F.when((F.length("run") >= wide) | (F.col("rest") == ""), "answer line").otherwise("gap")
    return runs.select(*PAGE, "line", F.length("run").alias("length"), kind.alias("kind"))


def spans(starts: DataFrame, pages: DataFrame) -> DataFrame:
    """starts(doc_id, ref, page, y) as regions: from each start to the next, cut at page ends; pages(doc_id, page, top, bottom)."""
    w = Window.partitionBy("doc_id").orderBy("page", "y")
    x = starts.withColumns({"to_page": F.lead("page").over(w), "to_y": F.lead("y").over(w)})
    x = x.withColumnsRenamed({"page": "from_page", "y": "from_y"}).join(pages, "doc_id")
    here = x.filter((F.col("page") >= F.col("from_page")) & (F.col("to_page").isNull() | (F.col("page") <= F.col("to_page"))))
    y0 = F.when(F.col("page") == F.col("from_page"), F.greatest("top", "from_y")).otherwise(F.col("top"))
    y1 = F.when(F.col("page") == F.col("to_page"), F.least("bottom", "to_y")).otherwise(F.col("bottom"))
    return here.select("doc_id", "ref", "page", y0.alias("y0"), y1.alias("y1")).filter("y1 > y0")
