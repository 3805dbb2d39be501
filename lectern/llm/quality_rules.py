"""Quality rules as weak supervision: each rule votes good, votes bad or abstains, expectation-
maximisation over the corpus' vote patterns estimates how each rule votes on good and on bad
texts, and the posterior probability of good decides: no rule does alone. All of it is DataFrame expressions.

The counts that EM needs are per vote pattern: at most 3 ** number of rules rows, whatever the
corpus. EM runs over them as one expression; the driver gets the estimates only.

Defined results: a null or empty text has no words and fails the base rule; every other column may
be null; rows that are equal stay rows of their own; an empty table gives an empty result.
A window is told from others of its text by a 64-bit hash of its five words.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm._common import kept, let, words

WINDOW = 5
NOT_SPACE = r"[^\x20\x09-\x0D]"


def _windows(w: Column) -> Column:
    some = F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(WINDOW))))
    return F.when(F.size(w) >= WINDOW, some).otherwise(F.array().cast("array<bigint>"))


def _covered(windows: Column) -> Column:
    """Words covered by windows that occur twice or more; windows: one hash a position."""
    same = lambda s, e, k: F.coalesce(F.get(s, k)["h"] == e["h"], F.lit(False))
    marked = let(
        F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        lambda s: F.transform(s, lambda e, k: F.struct(e["i"].alias("i"), (same(s, e, k - 1) | same(s, e, k + 1)).alias("again"))),
    )
    places = F.array_sort(F.transform(F.filter(marked, lambda e: e["again"]), lambda e: e["i"]))
    return let(
        places,
        lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))),
            F.lit(0),
            lambda a, x: a + x,
        ),
    )


def repeated_words(w: Column) -> Column:
    """Words of w in WINDOW-word windows found twice or more; sorted only where there are any."""
    return let(
        _windows(w),
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_covered(h)),
    )


SYMBOLS = "#*$%&|<>"


def _without(text: Column, characters: str) -> Column:
    """How many of these characters text has."""
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def _only(text: Column, others: str) -> Column:
    return F.regexp_replace(text, others, "")


def signals(text: Column) -> Column:
    """A struct of the counts that rules look at."""
    some = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(some, "\n", -1), lambda x: x.rlike(NOT_SPACE))
    ends = lambda w: F.size(F.filter(w, lambda x: F.right(x, F.lit(1)).isin(".", "!", "?", "。")))
    symbols = _without(some, SYMBOLS)
    letters = F.struct(F.length(_only(some, r"\P{L}+")).cast("long").alias("n"), F.length(_only(some, r"\P{Lu}+")).cast("long").alias("capitals"))
    return let(
        F.struct(words(text).alias("w"), lines.alias("lines"), letters.alias("letters")),
        lambda x: F.struct(
            F.size(x["w"]).cast("long").alias("n_words"),
            F.length(F.array_join(x["w"], "")).cast("long").alias("word_chars"),
            symbols.alias("n_symbols"),
            (F.size(x["lines"]) - F.size(F.array_distinct(x["lines"]))).cast("long").alias("n_dup_lines"),
            repeated_words(x["w"]).cast("long").alias("n_repeat_words"),
            F.size(x["lines"]).cast("long").alias("n_lines"),
            ends(x["w"]).cast("long").alias("n_ends"),
            F.size(F.array_distinct(x["w"])).cast("long").alias("n_distinct"),
            F.when(symbols > 0, F.regexp_count(some, F.lit(f"[{SYMBOLS}]+"))).otherwise(0).cast("long").alias("n_runs"),
            x["letters"]["n"].alias("n_letters"),
            x["letters"]["capitals"].alias("n_capitals"),
            _without(some, "0123456789").alias("n_digits"),
        ),
    )


@dataclass(frozen=True)
class Rule:
    """bad and good: SQL conditions over the signals; neither: the rule abstains."""

    name: str
    bad: str
    good: str = "false"


#: Shares are compared in whole numbers, so that no rounding decides a vote.
RULES = (
    Rule("length", "n_words < 50", "n_words >= 50"),
    Rule("symbols", "100 * n_symbols > 5 * word_chars", "200 * n_symbols <= word_chars"),
    Rule("symbol_runs", "n_words >= 10 and 100 * n_runs > 10 * n_words", "100 * n_runs <= n_words"),
    Rule("capitals", "n_letters >= 20 and 100 * n_capitals > 40 * n_letters", "n_letters >= 20 and 100 * n_capitals <= 15 * n_letters"),
    Rule("word_length", "word_chars > 14 * n_words or 2 * word_chars < 5 * n_words", "word_chars between 4 * n_words and 9 * n_words"),
    Rule("repetition", "100 * n_repeat_words > 20 * n_words", "n_words >= 20 and 100 * n_repeat_words <= n_words"),
    Rule("lines", "n_dup_lines > 0", "n_lines >= 3"),
    Rule("sentences", "n_words >= 20 and (100 * n_ends < 2 * n_words or 100 * n_ends > 40 * n_words)", "n_words >= 20 and 100 * n_ends between 4 * n_words and 25 * n_words"),
    Rule("digits", "100 * n_digits > 20 * word_chars", "100 * n_digits <= 2 * word_chars"),
    Rule("diversity", "n_words >= 50 and 100 * n_distinct < 20 * n_words", "n_words >= 50 and 100 * n_distinct >= 40 * n_words"),
)


def vote(rule: Rule) -> Column:
    return F.expr(f"CASE WHEN {rule.bad} THEN -1 WHEN {rule.good} THEN 1 ELSE 0 END")


@dataclass(frozen=True)
class Estimate:
    """The share of good texts, and by rule how often a vote that it casts is `bad` on bad and on good texts."""

    share: float
    on_bad: tuple[float, ...]
    on_good: tuple[float, ...]

    def posterior(self, votes: list[str]) -> Column:
        """Probability of good from the vote columns."""
        z = F.lit(log(1 - self.share) - log(self.share))
        for name, b, g in zip(votes, self.on_bad, self.on_good, strict=True):
            z = z + F.when(F.col(name) == -1, log(b) - log(g)).when(F.col(name) == 1, log(1 - b) - log(1 - g)).otherwise(0.0)
        return 1 / (1 + F.exp(F.least(z, F.lit(700.0))))


#: Beforehand a vote is `bad` this often on bad and on good texts, with the weight of so many texts, whatever the corpus.
PRIOR_BAD, PRIOR_GOOD, PRIOR_WEIGHT = 0.5, 0.02, 10.0
#: A text starts as good with these probabilities by its number of votes for bad: none, one, more.
START = (0.98, 0.5, 0.05)
_START = f"element_at(array({', '.join(f'{x}D' for x in START)}), least(size(filter(p.votes, v -> v = -1)), 2) + 1)"
_Z = "aggregate(sequence(1, {rules}), ln((1 - s.share) / s.share), (z, j) -> z + CASE p.votes[j - 1] WHEN -1 THEN ln(s.b[j - 1] / s.g[j - 1]) WHEN 1 THEN ln((1 - s.b[j - 1]) / (1 - s.g[j - 1])) ELSE 0D END)"
#: Of the weight that rule j's votes have in a class, the part of its votes for bad.
_RATE = f"(aggregate(q, 0D, (x, e) -> x + if(e.votes[j] = -1, {{w}}, 0D)) + {PRIOR_WEIGHT}D * {{prior}}D) / (aggregate(q, 0D, (x, e) -> x + if(e.votes[j] <> 0, {{w}}, 0D)) + {PRIOR_WEIGHT}D)"
_MAXIMISED = f"""
named_struct(
  'share', (aggregate(q, 0D, (x, e) -> x + e.n * e.w) + 1) / (aggregate(q, 0D, (x, e) -> x + e.n) + 2),
  'b', transform(sequence(0, {{rules}} - 1), j -> {_RATE.format(w="e.n * (1 - e.w)", prior=PRIOR_BAD)}),
  'g', transform(sequence(0, {{rules}} - 1), j -> {_RATE.format(w="e.n * e.w", prior=PRIOR_GOOD)}))"""
_EM = f"""
aggregate(sequence(1, {{rounds}}),
  transform(array(transform(patterns, p -> named_struct('votes', p.votes, 'n', p.n, 'w', {_START}))), q -> {_MAXIMISED})[0],
  (s, i) -> transform(array(transform(patterns, p -> named_struct('votes', p.votes, 'n', p.n, 'w', 1 / (1 + exp(least({_Z}, 700D)))))), q -> {_MAXIMISED})[0])"""


def estimate(seen: DataFrame, votes: list[str], rounds: int = 60) -> Estimate | None:
    """EM over the vote patterns of seen; None if there are no rows.

    A text is good or bad; rules vote independently of one another given which. A rule that abstains
    says nothing. All rates are estimated and none is held: the prior weighs as much as
    PRIOR_WEIGHT texts. A rule is believed as far as others agree with it, so that of a rule
    that fires about as often where others vote for good, a single vote is outweighed.

    All rounds are one expression over the array of patterns, of which there are 3 ** len(votes)
    at most; only the estimates come to the driver.
    """
    patterns = (
        seen.groupBy(*votes)
        .agg(F.count(F.lit(1)).cast("double").alias("n"))
        .agg(F.array_sort(F.collect_list(F.struct("n", F.array(*votes).alias("votes")))).alias("patterns"))
        .filter(F.size("patterns") > 0)
    )
    found = kept(patterns, "patterns").select(F.expr(_EM.format(rounds=rounds, rules=len(votes))).alias("e")).select("e.*").first()
    return Estimate(found["share"], tuple(found["b"]), tuple(found["g"])) if found else None


def judged(docs: DataFrame, least: float = 0.5, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """documents(doc_id, text) with their signals, votes, probability of quality and verdict."""
    s, votes = signals(F.col("text")), [f"vote_{r.name}" for r in rules]
    seen = docs.select("doc_id", s.alias("s")).select("doc_id", "s.*").withColumns({v: vote(r).cast("int") for v, r in zip(votes, rules, strict=True)})
    seen = kept(seen, "signals")
    found = estimate(seen, votes)
    quality = found.posterior(votes) if found else F.lit(None).cast("double")
    return seen.withColumns(
        {"base_failed": F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words"), "quality": quality}
    ).withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least))


def op5_weak_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.col("quality").alias("posterior"), *(f"vote_{r.name}" for r in RULES)
    )
