"""Secrets in texts, told apart by who else has them.

Patterns propose spans. The value of each span is hashed, and over the whole corpus the hashes are
counted by distinct owners and repositories. A value that `copied_owners` owners have, or that two
share over `copied_repositories` repositories, is an example that was copied widely; one that stays
with its owner, or goes to one other in few repositories as a fork does, is a live credential if it
looks random. Spans of the base patterns are always reported; spans of the wider ones only if they
are live.

Everything is DataFrame expressions. Before any value is shuffled it is reduced to one row per
owner and repository in each task; texts are scanned once and never shuffled. A text's spans are
built and looked up in about linear time, however many it has. Lists of values are joined with the
copied values by broadcast up to SENT of these and else over SALTS salted copies, so that a value
that many lists hold is spread.

Defined results: null and empty texts have no spans; a null owner or repository counts as one
unnamed owner or repository; equal rows stay rows of their own; an empty table gives an empty
result. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm._common import joined, kept, let

# The base patterns, in the order in which kinds are listed.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"  # the runs of [0-9a-f]+ that have 16 or more
# The wider patterns, whose spans need the corpus' verdict.
URL = r"[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\s:/@]{1,256}:([^\s/@]{1,256})@"
BEARER = r"(?i:bearer)\x20+([A-Za-z0-9._~+/=-]{16,})"
PRIVATE_KEY = r"-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----([^-]+)-----END"
MIXED = r"[A-Za-z0-9+/_-]{24,}"

#: kind, pattern, group of the value, least length of the value, a cheap test that the pattern can match
KINDS = (
    ("assign", ASSIGN, 2, 12, lambda t: t.rlike(r"(?i:passw|secret|token|api_?key)")),
    ("access", ACCESS, 0, 18, lambda t: t.contains("AKIA")),
    ("hex", HEX, 0, 16, lambda t: t.rlike(r"[0-9a-f]{16}")),
    ("url", URL, 1, 6, lambda t: t.contains("://") & t.contains("@")),
    ("bearer", BEARER, 1, 16, lambda t: t.rlike(r"(?i:bearer)\x20")),
    ("private_key", PRIVATE_KEY, 1, 64, lambda t: t.contains("PRIVATE KEY-----")),
    ("mixed", MIXED, 0, 24, lambda t: t.rlike(r"[A-Za-z0-9+/_-]{24}")),
)
BASE = ("assign", "access", "hex")
SPAN = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"
#: Up to so many copied values (10 MB) travel to all tasks; more are joined by shuffle over so many salts.
SENT, SALTS = 100_000, 64
CHUNK = 128


def running(x: Column, op: Callable[[Column, Column], Column]) -> Column:
    """op over all elements of the array of ints x up to each; in chunks, as an array that grows by one is copied each time."""

    def within(part: Column, start: Column) -> Column:
        step = lambda a, v: let(op(a["at"], v), lambda y: F.struct(y.alias("at"), F.concat(a["out"], F.array(y)).alias("out")))
        return F.aggregate(part, F.struct(start.alias("at"), F.array().cast("array<int>").alias("out")), step, lambda a: a["out"])

    zero = F.lit(0)
    parts = F.transform(F.sequence(zero, (F.size(x) - 1).bitwiseOR(CHUNK - 1), F.lit(CHUNK)), lambda k: F.slice(x, k + 1, CHUNK))
    totals = lambda p: F.transform(p, lambda q: F.aggregate(q, zero, op))
    whole = let(parts, lambda p: F.flatten(F.zip_with(p, F.concat(F.array(zero), within(totals(p), zero)), lambda q, start: F.when(q.isNull(), F.array().cast("array<int>")).otherwise(within(q, start)))))
    return F.when(F.size(x) > 0, whole).otherwise(F.array().cast("array<int>"))


def below(x: Column, test: Callable[[Column], Column]) -> Column:
    """How many of the first elements of the array x, sorted so that they come first, pass test; by bisection."""
    halve = lambda s, _: F.when(s["low"] >= s["high"], s).otherwise(
        let(
            ((s["low"] + s["high"]) / 2).cast("int"),
            lambda m: F.when(test(F.get(x, m)), F.struct((m + 1).alias("low"), s["high"].alias("high"))).otherwise(F.struct(s["low"].alias("low"), m.alias("high"))),
        )
    )
    return F.aggregate(F.sequence(F.lit(1), F.lit(32)), F.struct(F.lit(0).alias("low"), F.size(x).alias("high")), halve, lambda s: s["low"])


def _spans(text: Column, rank: int) -> Column:
    """Spans of one kind. What lies between matches and the matches themselves add up to offsets."""
    kind, pattern, group, least, can = KINDS[rank]
    found = let(
        F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"), F.split(text, pattern, -1).alias("gaps")),
        lambda m: let(
            running(F.zip_with(m["hits"], F.slice(m["gaps"], 1, F.size(m["hits"])), lambda h, g: F.length(h) + F.length(g)), lambda a, n: a + n),
            lambda ends: F.zip_with(
                F.arrays_zip(m["hits"].alias("hit"), ends.alias("end")),
                m["hits"] if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group)),
                lambda x, value: F.struct(
                    (x["end"] - F.length(x["hit"])).alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"), F.lit(kind).alias("kind"), value.alias("value")
                ),
            ),
        ),
    )
    long = F.filter(found, lambda s: F.length(s["value"]) >= least)
    return F.when(can(text), long).otherwise(F.array().cast(SPAN))


def _apart(wider: Column, base: Column) -> Column:
    """Those of wider that overlap no span of base: of the base spans that start before its end, none ends after its start."""
    by_start = F.array_sort(F.transform(base, lambda b: F.struct(b["start"], b["end"])))
    kept_apart = let(
        by_start,
        lambda b: let(
            running(F.transform(b, lambda x: x["end"]), lambda a, x: F.greatest(a, x)),
            lambda ends: F.filter(wider, lambda w: let(below(b, lambda x: x["start"] < w["end"]), lambda k: (k == 0) | (F.get(ends, k - 1) <= w["start"]))),
        ),
    )
    return F.when((F.size(wider) > 0) & (F.size(base) > 0), kept_apart).otherwise(wider)


def candidates(text: Column) -> Column:
    """All spans of all kinds by start, then kind; a wider one that overlaps a base span is left out."""
    some = F.coalesce(text, F.lit(""))
    base = F.concat(*(_spans(some, r) for r in range(len(BASE))))
    wider = F.concat(*(_spans(some, r) for r in range(len(BASE), len(KINDS))))
    return let(F.struct(base.alias("base"), wider.alias("wider")), lambda s: F.array_sort(F.concat(s["base"], _apart(s["wider"], s["base"]))))


def looks_random(value: Column) -> Column:
    """Eight different characters or more, digits and letters, and nothing that placeholders say."""
    return (
        (F.size(F.array_distinct(F.split(value, ""))) >= 8)
        & value.rlike("[0-9]")
        & value.rlike("[A-Za-z]")
        & ~F.lower(value).rlike("example|placeholder|changeme|your|xxxx|dummy|sample|0000|1234")
    )


def _mixed(value: Column) -> Column:
    return value.rlike("[0-9]") & value.rlike("[a-z]") & value.rlike("[A-Z]")


def ownership(held: DataFrame, value: str, owner: str, repository: str) -> DataFrame:
    """Distinct owners and repositories of each value; rows are reduced in each task before each shuffle."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return (
        held.select(F.col(value).alias("value"), name(owner).alias("owner"), name(repository).alias("repository"))
        .groupBy("value", "owner", "repository")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("value", "owner")
        .agg(F.count(F.lit(1)).alias("repositories"), F.sum("n").alias("n"))
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("n_owners"), F.sum("repositories").alias("n_repositories"), F.sum("n").alias("n_seen"))
    )


def scanned(docs: DataFrame, owner: str, repository: Column, copied_owners: int = 3, copied_repositories: int = 4) -> DataFrame:
    """doc_id with found: an array of spans, each with its verdict.

    copied_owners: a value that so many owners have, or more, counts as copied; copied_repositories:
    so does one that at least two owners have in so many repositories together.
    """
    spans = candidates(F.col("text"))
    hashed = F.transform(
        spans,
        lambda s: F.struct(
            s["start"], s["rank"], s["end"], s["kind"],
            F.sha2(s["value"], 256).alias("value"),
            F.when(s["kind"] == "mixed", _mixed(s["value"]) & looks_random(s["value"])).otherwise(looks_random(s["value"])).alias("random"),
        ),
    )
    found = docs.select("doc_id", F.col(owner).alias("owner"), repository.alias("repository"), hashed.alias("found"))
    values = F.array_sort(F.array_distinct(F.transform("found", lambda s: s["value"])))
    found = kept(found.withColumn("held", values).withColumn("key", F.when(F.size("held") > 0, F.sha2(F.array_join("held", ","), 256))), "secrets")
    some = found.filter(F.size("held") > 0)
    wide = (F.col("n_owners") >= copied_owners) | ((F.col("n_owners") > 1) & (F.col("n_repositories") >= copied_repositories))
    held = some.groupBy("key", "owner", "repository").agg(F.first("held").alias("held"))  # equal lists hold equal values
    copied = kept(ownership(held.select("owner", "repository", F.explode("held").alias("value")), "value", "owner", "repository").filter(wide).select("value"), "copied")
    lists = kept(some.groupBy("key").agg(F.first("held").alias("held"), F.count(F.lit(1)).alias("n")), "lists")
    values, copied_here = lists.select("key", F.explode("held").alias("value")), copied.withColumn("here", F.lit(True))
    if copied.count() <= SENT:
        values = values.join(F.broadcast(copied_here), "value", "left")
    else:
        salted = copied_here.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        values = values.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")).join(salted, ["value", "salt"], "left")
    marked = values.groupBy("key").agg(F.sort_array(F.collect_set(F.when(F.col("here"), F.col("value")))).alias("copied"))
    marked = kept(marked.join(lists.select("key", "n"), "key"), "marked")
    none = F.array().cast("array<string>")
    every = joined(some, marked, "key").unionByName(found.filter(F.size("held") == 0).withColumn("copied", none))
    has = lambda c, v: F.coalesce(F.get(c, below(c, lambda x: x < v)) == v, F.lit(False))
    verdict = lambda s: F.when(has(F.col("copied"), s["value"]), "copied").when(s["random"], "live").otherwise("weak")
    return every.select(
        "doc_id",
        F.transform("found", lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"], s["value"], verdict(s).alias("verdict"))).alias("found"),
    )


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op9_secret_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An owner is a document's source, a repository that source in one language."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = scanned(docs, "source", F.concat_ws("/", "source", "lang"))
    count = lambda test: F.size(F.filter("found", test)).cast("long")
    of_kind = lambda kind: count(lambda s: s["kind"] == kind)
    base = F.filter("found", lambda s: s["rank"] < len(BASE))
    shown = F.filter("found", lambda s: (s["rank"] < len(BASE)) | (s["verdict"] == "live"))
    return found.select(
        "doc_id",
        *(of_kind(k).alias(f"n_{k}") for k in BASE),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(shown).alias("spans"),
        count(lambda s: s["verdict"] == "live").alias("n_live"),
        count(lambda s: s["verdict"] == "copied").alias("n_copied"),
        count(lambda s: s["verdict"] == "weak").alias("n_weak"),
    )
