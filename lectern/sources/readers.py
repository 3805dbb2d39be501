"""Readers of the plain formats: tag lines, OCR tables, JSON, Markdown tables, key spaces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OCR = "level INT, page_num INT, block_num INT, par_num INT, line_num INT, word_num INT, left DOUBLE, top DOUBLE, width DOUBLE, height DOUBLE, conf DOUBLE, text STRING"


def tag_lines(spark: SparkSession, path: str) -> DataFrame:
    """`pid Qn: a.i=code b=code?` as pid, q, label, code and sure; blank and # lines are skipped."""
    lines = spark.read.text(path).filter(~F.col("value").rlike(r"^\s*(#|$)"))
    head = r"^\s*(\S+)\s+Q(\d+)\s*:"
    rest = F.split(F.trim(F.regexp_replace("value", head, "")), r"\s+")
    pairs = lines.filter(F.col("value").rlike(head)).select(
        F.regexp_extract("value", head, 1).alias("pid"), F.regexp_extract("value", head, 2).cast("int").alias("q"), F.explode(rest).alias("pair")
    )
    part = lambda i: F.split_part("pair", F.lit("="), F.lit(i))
    return pairs.filter(F.col("pair").contains("=")).select(
        "pid", "q", part(1).alias("label"), F.regexp_replace(part(2), r"\?$", "").alias("code"), (~part(2).endswith("?")).alias("sure")
    )


def ocr_words(spark: SparkSession, path: str, dpi: int = 300) -> DataFrame:
    """Words of an OCR table (TSV): level 5 and not blank, pixels turned into points."""
    t = spark.read.csv(path, sep="\t", header=True, quote="", schema=OCR).filter((F.col("level") == 5) & (F.trim("text") != ""))
    pt = lambda c: c * 72 / dpi
    return t.select(
        F.col("page_num").alias("page"), F.col("block_num").alias("block"), F.col("par_num").alias("par"), F.col("line_num").alias("line"), F.col("word_num").alias("word"),
        pt(F.col("left")).alias("x0"), pt(F.col("top")).alias("y0"), pt(F.col("left") + F.col("width")).alias("x1"), pt(F.col("top") + F.col("height")).alias("y1"), "conf", "text",
    )


def json_document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.json(path, schema=schema, multiLine=True)


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One object a line; a line that does not parse is in _corrupt_record."""
    return spark.read.json(path, schema=f"{schema}, _corrupt_record STRING", mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record")


def csv_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(path, schema=schema, header=True, enforceSchema=False)


def markdown_table(spark: SparkSession, path: str, section: str) -> DataFrame:
    """row and cells of the table under `## section`; the head and the rule below it are left out."""
    body = F.regexp_extract(F.concat(F.lit("\n"), "value", F.lit("\n## ")), rf"(?s)\n## \Q{section}\E[^\n]*\n(.*?)\n## ", 1)
    rows = F.filter(F.split(body, "\n"), lambda x: F.trim(x).startswith("|"))
    t = spark.read.text(path, wholetext=True).select(F.posexplode(rows).alias("row", "text")).filter("row > 1")
    inner = F.regexp_replace(F.trim("text"), r"^\||\|$", "")
    return t.select((F.col("row") - 2).alias("row"), F.transform(F.split(inner, r"\|"), lambda c: F.trim(c)).alias("cells"))


def key_space(spark: SparkSession, years: range, series: list[str], variants: list[int]) -> DataFrame:
    """All expected papers: pid is series, two-digit year and variant."""
    one = spark.range(1).select(F.explode(F.sequence(F.lit(years.start), F.lit(years.stop - 1))).alias("year"))
    one = one.select("year", F.explode(F.array(*map(F.lit, series))).alias("series"))
    one = one.select("year", "series", F.explode(F.array(*map(F.lit, variants))).alias("variant"))
    return one.select(F.format_string("%s%02d_%d", "series", F.col("year") % 100, "variant").alias("pid"), "year", "series", "variant")
