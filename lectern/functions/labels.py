"""Labels such as 4(a)(ii), their short form a.ii, references, and numbers read with errors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def repaired(label: Column) -> Column:
    """Missing brackets put back: 4(a(i) and 5f) become 4(a)(i) and 5(f); anything else stays."""
    inner = r"^(\d+)\(?([a-h])\)?\(?((?:ix|iv|v?i{1,3}|v|x)?)\)?$"
    m = lambda i: F.regexp_extract(label, inner, i)
    whole = F.concat(m(1), F.lit("("), m(2), F.lit(")"), F.when(m(3) != "", F.concat(F.lit("("), m(3), F.lit(")"))).otherwise(""))
    return F.when(label.rlike(inner), whole).otherwise(label)


def encoded(label: Column) -> Column:
    """(a)(i) as a.i; the empty label as Q."""
    inside = F.regexp_replace(F.regexp_replace(label, r"\)\(", "."), r"[()]", "")
    return F.when(label == "", "Q").otherwise(inside)


def decoded(code: Column) -> Column:
    return F.when(code == "Q", "").otherwise(F.concat(F.lit("("), F.regexp_replace(code, r"\.", ")("), F.lit(")")))


def parent(label: Column) -> Column:
    """The label one level up; '' for the top."""
    return F.regexp_replace(label, r"\([^()]*\)$", "")


def digits_repaired(text: Column) -> Column:
    """Letters that are read for digits put right."""
    return F.translate(text, "OolISB", "001158")


def near_numbers(a: Column, b: Column) -> Column:
    """One digit changed, put in or left out."""
    return F.levenshtein(a.cast("string"), b.cast("string")) == 1


def singular(word: Column) -> Column:
    return (
        F.when(word.rlike("ies$"), F.regexp_replace(word, "ies$", "y"))
        .when(word.rlike("(ss|x|ch|sh)es$"), F.regexp_replace(word, "es$", ""))
        .when(word.rlike("[^s]s$"), F.regexp_replace(word, "s$", ""))
        .otherwise(word)
    )


def normalised(text: Column) -> Column:
    """Dashes and quotes folded, white space collapsed, punctuation at the end gone."""
    t = F.regexp_replace(text, "[‐-―−]", "-")
    t = F.regexp_replace(F.regexp_replace(t, "[‘’]", "'"), "[“”]", '"')
    return F.regexp_replace(F.trim(F.regexp_replace(t, r"\s+", " ")), r"[.,;:]+$", "")


def without_dot_runs(text: Column) -> Column:
    return F.regexp_replace(text, "[.…]{5,}", "")


def head_and_tail(text: Column, n: int, head: float = 0.6) -> Column:
    """Texts of more than n words: their first and last words, with a mark between."""
    w = F.split(F.trim(text), r"\s+")
    first = int(n * head)
    cut = F.concat(F.slice(w, 1, first), F.array(F.lit("...")), F.slice(w, first - n, n - first))
    return F.array_join(F.when(F.size(w) <= n, w).otherwise(cut), " ")


def references(text: Column) -> Column:
    """Parts, tables and figures, and numbered references that a text mentions, and whether it asks for an own answer."""
    sets = lambda pattern, group=0: F.sort_array(F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(group))))
    return F.struct(
        sets(r"\bpart ((?:\([a-z]+\))+)", 1).alias("parts"),
        sets(r"\b(?:Table|Fig\.|Figure) \d+(?:\.\d+)?").alias("exhibits"),
        sets(r"\b(?:equation|step|reaction) (\d+)\b", 1).alias("numbers"),
        F.coalesce(text.rlike(r"(?i)\byour answer"), F.lit(False)).alias("own_answer"),
    )


def points_without_total(marks: Column) -> Column:
    """[n, 1, 1, ...] with n ones is a total and its points: the total alone counts."""
    rest = F.slice(marks, 2, F.greatest(F.size(marks) - 1, F.lit(0)))
    is_total = (F.size(marks) > 1) & (F.get(marks, 0) == F.aggregate(rest, F.lit(0), lambda a, x: a + x)) & F.forall(rest, lambda x: x == 1)
    return F.when(is_total & (F.get(marks, 0) > 1), F.slice(marks, 1, 1)).otherwise(marks)
