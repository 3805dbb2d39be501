"""Numbered headings in scanned lines: found by their place and reference, and their numbers completed by the sequence.

Lines without text or place are no headings; equal lines are taken one after the other; a document without lines has no headings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed values, in points: how far from the left column a number and a bare reference may stand, and how near a reference must follow its number.
NUMBER_DRIFT, BARE_DRIFT, BELOW, BESIDE = 22, 40, 12, 40
NUMBER = r"^(\d{1,3})[.,:;]?(?:\s+|$)"


def heading_lines(lines: DataFrame, doc: str, ref: str) -> DataFrame:
    """doc, page, y0, ref and read of each heading in lines (page, x0, y0, x1, y1, text); ref is the pattern of a whole reference.

    A number and a reference on a line or on two, or a reference alone near the left column, whose number was not read (null).
    """
    page = Window.partitionBy(doc, "page")
    w = page.orderBy("y0", "x0", "text")
    solid = F.min(F.when(F.col("text").rlike(r"^[\w(\[]") & (F.length("text") >= 4), F.col("x0"))).over(page)
    x = lines.select(doc, "page", "x0", "y0", "x1", "y1", F.trim("text").alias("text")).withColumn("_left", F.coalesce(solid, F.min("x0").over(page)))
    x = x.withColumns({"_next": F.lead(F.struct("text", "x0", "y0")).over(w), "read": F.regexp_extract("text", NUMBER, 1).try_cast("int"), "_rest": F.regexp_replace("text", NUMBER, "")})
    near = (F.col("_next.y0") - F.col("y1") < BELOW) & (F.col("_next.x0") < F.col("x1") + BESIDE)
    no = lambda c: F.coalesce(c, F.lit(False))
    split = no(F.col("read").isNotNull() & (F.col("_rest") == "") & F.col("_next.text").rlike(ref) & near)
    whole = no(F.col("read").isNotNull() & F.col("_rest").rlike(ref))
    x = x.withColumns({"_split": split, "_whole": whole}).withColumn("_taken", no(F.lag("_split").over(w)))
    bare = F.col("read").isNull() & no(F.col("text").rlike(ref)) & (F.col("x0") <= F.col("_left") + BARE_DRIFT)
    found = x.filter(~F.col("_taken") & (((F.col("_split") | F.col("_whole")) & (F.col("x0") <= F.col("_left") + NUMBER_DRIFT)) | bare))
    return found.select(doc, "page", "y0", F.when(F.col("_split"), F.col("_next.text")).otherwise(F.col("_rest")).alias("ref"), "read")


def completed(headings: DataFrame, doc: str, order: list[str], reach: int = 3) -> DataFrame:
    """headings with n and outcome, by a vote of the headings up to `reach` places away, each for the number that it and its place imply.

    kept: read, as most say; repaired: most say another number; inferred: not read; unsure: as many say one thing as another, or none was
    read, and n is as read. Where headings are missing from a booklet the vote changes with them.
    """
    w = Window.partitionBy(doc).orderBy(*order)
    x = headings.withColumn("_i", F.row_number().over(w)).withColumn("_off", F.col("read") - F.col("_i"))
    x = x.withColumn("_votes", F.collect_list("_off").over(w.rowsBetween(-reach, reach)))
    counted = F.transform(F.array_distinct("_votes"), lambda v: F.struct(F.size(F.filter("_votes", lambda u: u == v)).alias("votes"), v.alias("off")))
    x = x.withColumn("_counted", F.sort_array(counted, asc=False))
    first, second = F.try_element_at("_counted", F.lit(1)), F.try_element_at("_counted", F.lit(2))
    x = x.withColumn("_won", F.when(second.isNull() | (first["votes"] > second["votes"]), first["off"]))
    outcome = F.when(F.col("_won").isNull(), "unsure").when(F.col("_off").isNull(), "inferred").when(F.col("_off") == F.col("_won"), "kept").otherwise("repaired")
    x = x.withColumn("outcome", outcome).withColumn("n", F.when(F.col("outcome") == "unsure", F.col("read")).otherwise(F.col("_i") + F.col("_won")))
    return x.drop("_i", "_off", "_votes", "_counted", "_won")
