"""What a part of a question needs besides itself: an ordered closure over references in which a place that is shown covers others.

parts(doc, label, ord, intro): the places of a question, a letter or letter.roman, in printed order;
intro: whether a letter has an introduction above its romans. edges(doc, src, kind, n, name, dst, alone): what
the text at src refers to by name, in order of n; src is a label, a letter with #intro, or '' for the stem. Kinds, in the
order in which a text's references are followed: `exhibit` (dst is where it is printed, null if it is not in
the question; alone: it can be shown by itself under its name), `part`, `own` (the answer before) and `label`
(dst is where the name is defined first). units(task, doc, label): what each task shows anyway.

References are followed first in, first out. Each round takes the texts that the last one added, of all
tasks at once, and numbers their references in the order in which a queue would give them. One is followed unless a
place that it can be seen at (itself, what holds it, its introduction) is shown already or comes
earlier in the round. An earlier one that is not followed itself is covered by a place that covers the later one too
(exhibits in introductions apart, which are taken out first), so that looking at all earlier ones is enough and a round needs no order of evaluation.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.session import checkpointed, sorted_joins

KINDS = ("exhibit", "part", "own", "label")
INTRO = "#intro"


def holders(label: Column) -> Column:
    """A label and what holds it: a.ii and a."""
    levels = F.split(label, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(levels)), lambda k: F.array_join(F.slice(levels, 1, k), "."))


def within(label: Column, those: Column) -> Column:
    """Whether label or what holds it is among those."""
    return F.arrays_overlap(holders(label), those)


def tasks_of(units: DataFrame, parts: DataFrame) -> DataFrame:
    """A row per task: doc, units, intros (letters whose introduction is shown above a unit), the units' letters, the first unit's ord and the leaf before it."""
    letter = F.split("label", r"\.")[0]
    letters = parts.filter("intro").select("doc", F.col("label").alias("letter"))
    leaf = parts.withColumn("up", F.when(F.col("label").contains("."), letter))
    inner = leaf.filter("up IS NOT NULL").select("doc", F.col("up").alias("label")).distinct()
    leaves = parts.select("doc", "label", "ord").join(inner, ["doc", "label"], "left_anti")
    x = units.join(parts.select("doc", "label", "ord"), ["doc", "label"]).withColumn("letter", letter)
    x = x.join(letters.withColumn("has", F.lit(True)), ["doc", "letter"], "left")
    x = x.groupBy("task", "doc").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("ord", "label"))), lambda u: u["label"]).alias("units"),
        F.array_sort(F.collect_set(F.when(F.col("has") & (F.col("letter") != F.col("label")), F.col("letter")))).alias("intros"),
        F.collect_set("letter").alias("letters"),
        F.min("ord").alias("first"),
    )
    before = leaves.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("ord", "label"))).alias("leaves"))
    last = F.try_element_at(F.filter("leaves", lambda v: v["ord"] < F.col("first")), F.lit(-1))
    return x.join(sorted_joins(before), "doc").withColumn("before", last["label"]).drop("leaves")


def texts_of(parts: DataFrame) -> DataFrame:
    """doc, site, text and sub: the places whose texts are read when a site is shown, in order; a letter has its introduction and its romans."""
    letter = F.split("label", r"\.")[0]
    own = parts.select("doc", F.col("label").alias("site"), F.col("label").alias("text"), "ord")
    inner = parts.filter(F.col("label").contains(".")).select("doc", letter.alias("site"), F.col("label").alias("text"), "ord")
    intro = parts.filter("intro").select("doc", F.col("label").alias("site"), F.concat("label", F.lit(INTRO)).alias("text"), "ord")
    alone = intro.select("doc", F.col("text").alias("site"), "text", "ord")
    return own.unionByName(inner).unionByName(intro).unionByName(alone).withColumnRenamed("ord", "sub")


def context(units: DataFrame, parts: DataFrame, edges: DataFrame) -> DataFrame:
    """task, site, kind, depth, dep and ord of each place that a task needs besides its units: why it was first needed and after how many references.

    dep: a part whose answer is needed. A task that refers to an exhibit which its question does not have
    gives one row with the kind `missing` and the exhibit's name as site. A roman that is shown brings its letter's introduction.
    """
    ord_ = parts.select("doc", F.col("label").alias("dst"), F.col("ord").alias("dst_ord"))
    two_levels = parts.filter(F.col("label").contains(".")).select("doc", F.split("label", r"\.")[0].alias("dst")).distinct().withColumn("romans", F.lit(True))
    asks = F.max(F.col("kind") == "part").over(Window.partitionBy("doc", "src"))
    edges = edges.withColumn("asks", asks).filter("NOT (asks AND kind = 'own')").drop("asks").join(ord_, ["doc", "dst"], "left").join(two_levels, ["doc", "dst"], "left")
    edges = checkpointed(edges.withColumnRenamed("src", "text"))
    tasks, texts = checkpointed(tasks_of(units, parts)), texts_of(parts)
    stem = tasks.select("task", "doc", F.lit("").alias("text"), F.lit(-1).alias("place"), F.lit(0).alias("sub"))
    intros = tasks.select("task", "doc", F.posexplode("intros").alias("place", "letter")).select("task", "doc", F.concat("letter", F.lit(INTRO)).alias("text"), "place", F.lit(0).alias("sub"))
    own = tasks.select("task", "doc", F.posexplode("units").alias("place", "site")).join(texts, ["doc", "site"]).select("task", "doc", "text", (F.col("place") + 1_000).alias("place"), "sub")
    read = stem.unionByName(intros).unionByName(own)
    # an introduction above a unit is read once, with the introductions
    read = read.groupBy("task", "doc", "text").agg(F.min(F.struct("place", "sub")).alias("p")).select("task", "doc", "text", "p.place", "p.sub")
    found: list[DataFrame] = []
    missing: list[DataFrame] = []
    state = tasks.withColumn("shown", F.array().cast("array<string>"))
    for depth in count(1):
        place = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).alias("rank")
        ref = F.struct("place", "sub", "text", place, "n", "name", "kind", "dst", "alone", "dst_ord", "romans")
        x = read.join(edges, ["doc", "text"]).groupBy("task").agg(F.array_sort(F.collect_list(ref)).alias("refs")).join(state, "task")
        new = checkpointed(_round(x).select(*state.columns, "new", "none"))
        missing.append(new.select("task", F.inline("none")))
        # a task that adds nothing has come to rest
        active = new.filter(F.size("new") > 0)
        if active.isEmpty():
            break
        new = active.select("task", "doc", F.inline("new"))
        found.append(new.withColumn("depth", F.lit(depth).cast("long")))
        read = new.join(texts, ["doc", "site"]).select("task", "doc", "text", F.col("order").alias("place"), "sub")
        state = active.withColumn("shown", F.concat("shown", F.transform("new", lambda r: r["site"]))).select(*state.columns)
    return _settled(found, missing, tasks, parts)


def _round(x: DataFrame) -> DataFrame:
    """x with new(order, kind, site), the references that are followed, and none(site, order), the exhibits that there are not.

    x has a row per task: refs, what the texts of the round refer to in the order of the queue, and shown, the sites of earlier rounds.
    """

    def numbered(r: Column, i: Column) -> Column:
        dst = F.when(r["kind"] == "own", F.col("before")).otherwise(r["dst"])
        return F.struct((i + 1).alias("order"), dst.alias("dst"), *(r[c].alias(c) for c in ("kind", "name", "alone", "dst_ord", "romans")))

    def open_(r: Column) -> Column:
        shown = within(r["dst"], F.col("units"))
        # an introduction that is above a unit is shown, and a text's own letter; what comes later than the first unit is no help, but an exhibit is
        shown |= r["kind"].isin("part", "label", "exhibit") & F.array_contains("intros", r["dst"])
        shown |= (r["kind"] == "part") & F.array_contains("letters", r["dst"])
        later = r["kind"].isin("part", "label") & (r["dst_ord"] > F.col("first"))
        return r["dst"].isNotNull() & ((r["kind"] == "own") | r["dst_ord"].isNotNull()) & ~shown & ~later

    def offer(r: Column) -> Column:
        exhibit, label, above = r["kind"] == "exhibit", r["kind"] == "label", F.concat(r["dst"], F.lit(INTRO))
        site = F.when(exhibit & r["alone"], r["name"]).when(label & r["romans"], above).otherwise(r["dst"])
        seen_at = F.when(label, F.concat(holders(r["dst"]), F.array(above))).when(exhibit & r["alone"], F.concat(holders(r["dst"]), F.array(r["name"]))).otherwise(holders(r["dst"]))
        return F.struct(r["order"].alias("order"), r["kind"].alias("kind"), site.alias("site"), seen_at.alias("seen_at"), F.when(exhibit, above).alias("above"))

    def seen(key: Column, i: Column) -> Column:
        """Whether a key is shown already, or offered in the round by one before the i-th."""
        at = F.array_position("sites", key)
        return F.array_contains("shown", key) | ((at > 0) & (at <= i))

    sites = F.transform("offers", lambda r: r["site"])
    x = x.withColumn("refs", F.transform("refs", numbered))
    x = x.withColumn("none", F.transform(F.filter("refs", lambda r: (r["kind"] == "exhibit") & r["dst"].isNull()), lambda r: F.struct(r["name"].alias("site"), r["order"].alias("order"))))
    x = x.withColumn("offers", F.transform(F.filter("refs", open_), offer)).withColumn("sites", sites)
    # an exhibit in an introduction that is shown goes first, as its letter is not shown by that
    x = x.withColumn("offers", F.filter("offers", lambda r, i: r["above"].isNull() | ~seen(r["above"], i))).withColumn("sites", sites)
    new = F.filter("offers", lambda r, i: ~F.exists(r["seen_at"], lambda key: seen(key, i)))
    return x.withColumn("new", F.transform(new, lambda r: F.struct(r["order"].alias("order"), r["kind"].alias("kind"), r["site"].alias("site"))))


def _settled(found: list[DataFrame], missing: list[DataFrame], tasks: DataFrame, parts: DataFrame) -> DataFrame:
    """Rounds put together: introductions of romans added, tasks that lack an exhibit reduced to that."""
    none = missing[0].withColumn("depth", F.lit(1).cast("long"))
    for depth, m in enumerate(missing[1:], 2):
        none = none.unionByName(m.withColumn("depth", F.lit(depth).cast("long")))
    none = none.groupBy("task").agg(F.min(F.struct("depth", "order", "site")).alias("m")).select("task", F.col("m.site").alias("site"), F.lit("missing").alias("kind"), F.col("m.depth").alias("depth"), F.lit(False).alias("dep"), F.lit(None).cast("int").alias("ord"))
    if not found:
        return none
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    every = checkpointed(every.join(sorted_joins(none.select("task")), "task", "left_anti"))
    roman = every.filter(F.col("site").contains(".")).select("task", "doc", F.split("site", r"\.")[0].alias("label"), "depth")
    letters = parts.filter("intro").select("doc", "label")
    intro = roman.join(letters, ["doc", "label"], "left_semi").groupBy("task", "doc", "label").agg(F.min("depth").alias("depth")).join(tasks.select("task", "units", "intros"), "task")
    intro = intro.filter(~F.array_contains("intros", F.col("label")) & ~F.array_contains("units", F.col("label"))).withColumn("site", F.concat("label", F.lit(INTRO)))
    intro = intro.join(every.select("task", "site"), ["task", "site"], "left_anti").select("task", "doc", F.lit(0).alias("order"), F.lit("introduction").alias("kind"), "site", "depth")
    shown = every.unionByName(intro)
    answers = every.filter("kind IN ('part', 'own')").select("task", F.explode(holders(F.col("site"))).alias("site")).distinct().withColumn("dep", F.lit(True))
    place = parts.select("doc", F.col("label").alias("at"), "ord")
    shown = shown.join(answers, ["task", "site"], "left").withColumn("at", F.regexp_replace("site", INTRO + "$", "")).join(place, ["doc", "at"], "left")
    return shown.select("task", "site", "kind", "depth", F.coalesce("dep", F.lit(False)).alias("dep"), "ord").unionByName(none)


def scoped(uses: DataFrame, definitions: DataFrame) -> DataFrame:
    """uses(doc, ord, label, name) with the definition that each means: scope (`enclosing`, `before`, `after` or null), at and at_ord.

    The nearest definition in the part itself or in what holds it counts first, then the last one before
    the use, then the first one after it. definitions(doc, ord, label, name). The candidates of a name within a
    document are ordered by two windows, and what encloses is found by equality with the use's holders.
    """
    d = definitions.select("doc", "name", F.col("label").alias("at"), F.col("ord").alias("at_ord"))
    u = uses.select("doc", "ord", "label", "name").distinct()
    held = u.select("*", F.explode(holders(F.col("label"))).alias("at")).join(d, ["doc", "name", "at"])
    enclosing = held.groupBy("doc", "ord", "label", "name").agg(F.max_by(F.struct("at", "at_ord"), F.struct(F.length("at"), F.col("at_ord"))).alias("e"))
    both = u.select("doc", "name", "ord", "label", F.lit(None).cast(d.schema["at"].dataType).alias("at"), F.lit(1).alias("side"))
    both = both.unionByName(d.select("doc", "name", F.col("at_ord").alias("ord"), F.lit(None).cast("string").alias("label"), "at", F.lit(0).alias("side")))
    w = Window.partitionBy("doc", "name").orderBy("ord", "side", "at")
    here = F.when(F.col("side") == 0, F.struct("at", F.col("ord").alias("at_ord")))
    near = both.withColumns({
        "b": F.last(here, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)),
        "a": F.first(here, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing)),
    }).filter("side = 1").select("doc", "name", "ord", "label", "b", "a")
    x = near.join(enclosing, ["doc", "ord", "label", "name"], "left")
    scope = F.when(F.col("e").isNotNull(), "enclosing").when(F.col("b").isNotNull(), "before").when(F.col("a").isNotNull(), "after")
    best = F.coalesce("e", "b", "a")
    return x.select("doc", "ord", "label", "name", scope.alias("scope"), best["at"].alias("at"), best["at_ord"].alias("at_ord"))


def unshown(meant: DataFrame, shown: DataFrame) -> DataFrame:
    """meant(task, and what scoped() gives) with the fault of each use that its task does not make clear: `undefined`, `not shown` (defined before) or `forward`.

    shown(task, site): places that the task shows; a place shows all that is in it.
    """
    at = meant.filter("at IS NOT NULL").select("task", "at").distinct()
    seen = at.select("task", "at", F.explode(holders(F.col("at"))).alias("site")).join(shown.select("task", "site").distinct(), ["task", "site"], "left_semi").select("task", "at").distinct()
    fault = F.when(F.col("scope").isNull(), "undefined").when(F.col("scope") == "after", "forward").otherwise("not shown")
    return meant.join(seen, ["task", "at"], "left_anti").withColumn("fault", fault)
