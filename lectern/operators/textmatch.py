"""Texts as bags of words: weights, best matches, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.operators.rank import top
from lectern.session import checkpointed

WORD = "[a-z0-9]+"
#: Up to so many words (some MB) travel to all tasks.
SENT = 100_000


def word_list(text: Column, least: int = 1) -> Column:
    found = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    return F.filter(found, lambda w: F.length(w) >= least) if least > 1 else found


def word_counts(df: DataFrame, key: str, text: str, least: int = 1) -> DataFrame:
    """key, word and n; words are counted in each task before they are shuffled."""
    return df.select(key, F.explode(word_list(F.col(text), least)).alias("word")).groupBy(key, "word").agg(F.count(F.lit(1)).alias("n"))


def idf(counts: DataFrame, key: str, total: int, floor: float = 0.2) -> DataFrame:
    """word, df and ln(total / df) + floor from one row per key and word."""
    df = counts.groupBy("word").agg(F.count(key).alias("df"))
    return df.withColumn("idf", F.log(F.lit(float(total)) / F.col("df")) + floor)


def shared_words(left: DataFrame, right: DataFrame, a: str, b: str) -> DataFrame:
    """a, b, shared (distinct words) and common (with repetitions) of all pairs that share a word."""
    joined = left.withColumnRenamed("n", "__x").join(right.withColumnRenamed("n", "__y"), "word")
    return joined.groupBy(a, b).agg(F.count(F.lit(1)).alias("shared"), F.sum(F.least("__x", "__y")).alias("common"))


def best_match(pairs: DataFrame, query: str, candidate: str, score: str) -> DataFrame:
    """The candidate with the highest score for each query; the smallest candidate of equals."""
    return top(pairs, [query], [F.desc(score), candidate])


def coverage(left: DataFrame, pairs: DataFrame, a: str) -> DataFrame:
    """pairs with the share of a's words, repetitions counted, that b has too."""
    size = left.groupBy(a).agg(F.sum("n").alias("size"))
    return pairs.join(size, a).withColumn("coverage", F.col("common") / F.col("size"))


def covered(items: DataFrame, texts: DataFrame, a: str, b: str, text: str, percent: int) -> DataFrame:
    """a, b, common and size of the pairs in which texts(b, text) have percent of the size words of items(a, word, n), repetitions counted.

    A text lacks at most size * (100 - percent) / 100 words of such an item, so it has one of any words of the item that come
    to more than that. The rarest are taken, and words are counted only of the texts that have one.
    """
    vocabulary = items.select("word").distinct()
    words = texts.select(F.col(b).alias("__b"), F.explode(F.array_distinct(word_list(F.col(text)))).alias("word"))
    known = checkpointed(words.join(F.broadcast(vocabulary), "word", "left_semi") if vocabulary.count() <= SENT else words.join(vocabulary, "word", "left_semi"), by_size=True)
    rare = items.join(known.groupBy("word").agg(F.count(F.lit(1)).alias("__df")), "word", "left").fillna(0, "__df")
    rarest = Window.partitionBy(a).orderBy("__df", "word")
    rare = rare.withColumn("__before", F.sum("n").over(rarest) - F.col("n")).withColumn("__size", F.sum("n").over(Window.partitionBy(a)))
    rare = checkpointed(rare.filter(100 * F.col("__before") <= (100 - percent) * F.col("__size")).select(a, "word"), by_size=True)
    some = checkpointed(known.join(rare, "word").select(a, "__b").distinct(), by_size=True)
    found = some.select("__b").distinct()
    counts = word_counts(texts.join(found, F.col(b).eqNullSafe(F.col("__b")), "left_semi"), b, text)
    pairs = some.join(items.withColumnRenamed("n", "__x"), a).join(counts.withColumnsRenamed({b: "__of", "word": "__word", "n": "__y"}), F.col("__b").eqNullSafe(F.col("__of")) & (F.col("word") == F.col("__word")))
    pairs = pairs.groupBy(a, F.col("__b").alias(b)).agg(F.sum(F.least("__x", "__y")).alias("common"))
    return coverage(items, pairs, a).filter(100 * F.col("common") >= percent * F.col("size")).select(a, b, "common", "size")


def ordered_concat(df: DataFrame, by: list[str], order: str, text: Column, separator: str = ",") -> DataFrame:
    found = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), text.alias("t")))), lambda x: x["t"])
    return df.groupBy(*by).agg(F.array_join(found, separator).alias("texts"))


def first_seen(df: DataFrame, by: list[str], order: list[str], where: list[str]) -> DataFrame:
    """For each key the place of its first row."""
    return top(df, by, order).select(*by, *where)


def share_of_group(df: DataFrame, by: list[str], value: str) -> Column:
    return F.col(value) / F.sum(value).over(Window.partitionBy(*by))
