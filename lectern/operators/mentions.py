"""What a text names: identifiers, labels that it defines, and nouns that point back. Word lists are tables, joined by word.

Texts are read whole, where they lie; only what is found is joined, by words, with the tables of classes, stops and cues.
Null and empty texts name nothing; a word listed twice counts once; tables without rows find or stop nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Quoted text and remarks are no code; a call, words run together, capitals joined by lines, a file.
QUOTED, REMARK = "\"[^\"\\n]*\"|“[^”\\n]*”|‘[^’\\n]*’", "(?m)//.*$"
NAMES = r"\b[A-Za-z_]\w*(?=\(\))|\b(?:[A-Z][a-z0-9]+){2,}\b|\b[A-Z]{2,}(?:_[A-Z0-9]+)+\b|\b[A-Za-z]\w*\.(?:txt|TXT|dat|DAT|csv|CSV)\b"
LABELS = r"\b[a-z]+\s+(?:[A-Z](?:\s*,\s*|\s+(?:and|or|to)\s+))*[A-Z]\b"
POINTERS = ("the", "this", "these", "that", "those")


def singular(word: Column) -> Column:
    """Fixed rule: -ies to -y; -sses and -xes lose -es; another -s is lost, but not of -ss."""
    cut = lambda n: F.left(word, F.length(word) - n)
    return F.when(word.endswith("ies"), F.concat(cut(3), F.lit("y"))).when(word.endswith("sses") | word.endswith("xes"), cut(2)).when(word.endswith("s") & ~word.endswith("ss"), cut(1)).otherwise(word)


def identifiers(texts: DataFrame, key: str, text: str, stops: DataFrame) -> DataFrame:
    """key and word, once each: names of three characters or more outside quotes and remarks that stops(word) does not have in any case."""
    bare = F.regexp_replace(F.regexp_replace(text, QUOTED, " "), REMARK, " ")
    words = F.filter(F.array_distinct(F.regexp_extract_all(bare, F.lit(NAMES), 0)), lambda w: F.length(w) >= 3)
    found = texts.select(F.col(key), F.explode(words).alias("word")).distinct().withColumn("_upper", F.upper("word"))
    return found.join(stops.select(F.upper("word").alias("_upper")), "_upper", "left_anti").select(key, "word")


def defined_labels(texts: DataFrame, key: str, text: str, classes: DataFrame) -> DataFrame:
    """key, noun and label, once each: single capitals listed after a noun, singular or plural, of classes(noun)."""
    found = texts.select(F.col(key), F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit(LABELS), 0))).alias("m"))
    each = found.select(key, singular(F.regexp_extract("m", "^[a-z]+", 0)).alias("noun"), F.explode(F.regexp_extract_all("m", F.lit(r"\b[A-Z]\b"), 0)).alias("label"))
    return each.join(classes.select("noun"), "noun", "left_semi").select(key, "noun", "label").distinct()


def anaphora(texts: DataFrame, key: str, text: str, nouns: DataFrame, cues: DataFrame) -> DataFrame:
    """key, n (the pointer's word number from 0) and noun, in the singular: "the" or another pointer, a modifier or none, and one of nouns(noun).

    cues(kind, word) has the modifiers, and what rules a mention out: `before`, a word before the pointer, and `after`, a word after the noun.
    Words are runs of letters; case is ignored.
    """
    words = F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), 0)
    at = F.filter(F.sequence(F.lit(0), F.size("_words") - 1), lambda i: F.col("_words")[i].isin(*POINTERS))
    some = texts.select(F.col(key), words.alias("_words")).filter(F.size("_words") > 0)
    x = some.select(key, "_words", F.explode(at).alias("n"))
    word = lambda d: F.try_element_at("_words", F.col("n") + 1 + d) if d >= 0 else F.when(F.col("n") > 0, F.try_element_at("_words", F.greatest("n", F.lit(1))))
    x = x.select(key, "n", word(-1).alias("_before"), *(word(d).alias(f"_w{d}") for d in (1, 2, 3)))
    kind = lambda k, c: cues.filter(F.col("kind") == k).select(F.col("word").alias(c)).distinct()
    x = x.join(kind("modifier", "_w1").withColumn("_modified", F.lit(True)), "_w1", "left")
    x = x.withColumns({"_noun": F.when(F.col("_modified"), F.col("_w2")).otherwise(F.col("_w1")), "_after": F.when(F.col("_modified"), F.col("_w3")).otherwise(F.col("_w2"))})
    x = x.withColumn("noun", singular(F.col("_noun"))).join(nouns.select("noun"), "noun", "left_semi")
    x = x.join(kind("before", "_before"), "_before", "left_anti").join(kind("after", "_after"), "_after", "left_anti")
    return x.select(key, "n", "noun")
