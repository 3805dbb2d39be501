"""Leaves of questions put together to items of one topic each, with a reason for every leaf that is in none.

leaves(doc, label, letter, ord, topic, marks, scheme, height): topic null means out of scope; scheme: the
marks that the mark scheme gives. needs(doc, label, on): the leaves that must be shown beside a leaf. The
context of an item is what its leaves need besides themselves; it has room for so much height.

All questions go through the same steps at once; what is decided one after the other within a question
(units of a topic, blocks) is a fold over its few units or one merge a round in all questions that still change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.session import checkpointed, sorted_joins

LETTER = ("doc", "letter")


def needed(members: DataFrame, needs: DataFrame, key: str) -> DataFrame:
    """doc, key and on: what members(doc, key, label) of a key need that is not among them."""
    on = members.join(needs, ["doc", "label"]).select("doc", key, F.col("on").alias("label")).distinct()
    return on.join(members.select("doc", key, "label"), ["doc", key, "label"], "left_anti").withColumnRenamed("label", "on")


def context_heights(members: DataFrame, needs: DataFrame, leaves: DataFrame, key: str) -> DataFrame:
    """doc, key and tall: the height of the context, for keys that have one."""
    height = leaves.select("doc", F.col("label").alias("on"), "height")
    return needed(members, needs, key).join(height, ["doc", "on"]).groupBy("doc", key).agg(F.sum("height").alias("tall"))


def majority(rows: DataFrame, by: list[str]) -> DataFrame:
    """by and topic: the one with most marks, of equal ones that which comes first."""
    sums = rows.filter("topic IS NOT NULL").groupBy(*by, "topic").agg(F.sum("marks").alias("m"), F.min("ord").alias("o"))
    return sums.groupBy(*by).agg(F.max_by("topic", F.struct("m", -F.col("o"))).alias("topic"))


def units(leaves: DataFrame, needs: DataFrame, room: int) -> DataFrame:
    """leaves with unit (the ord of its first leaf) and filed (the unit's topic), or a reason.

    A letter of one topic is a unit. Another is split into runs of equal topic if each stands by itself: it needs no
    other leaf of the letter, its marks are those of the scheme, its context has room. If not, a letter with
    leaves out of scope is left out, and any other is filed where most of its marks are.
    """
    letter, order = Window.partitionBy(*LETTER), Window.partitionBy(*LETTER).orderBy("ord")
    same = F.col("topic").eqNullSafe(F.lag("topic").over(order)) & (F.row_number().over(order) > 1)
    x = leaves.withColumn("new", F.when(~same, F.col("ord"))).withColumn("run", F.last("new", ignorenulls=True).over(order)).drop("new")
    x = x.withColumns({"runs": F.size(F.collect_set("run").over(letter)), "out": F.max(F.col("topic").isNull()).over(letter), "in": F.max(F.col("topic").isNotNull()).over(letter)})
    x = checkpointed(x)
    mixed = x.filter("runs > 1")
    of = mixed.select("doc", "label", "letter", "run")
    siblings = of.join(needs, ["doc", "label"]).join(of.select("doc", F.col("label").alias("on"), F.col("letter").alias("l2"), F.col("run").alias("r2")), ["doc", "on"])
    siblings = siblings.filter("letter = l2 AND run <> r2").select(*LETTER).distinct()
    unequal = mixed.groupBy(*LETTER, "run").agg(F.sum("marks").alias("m"), F.sum("scheme").alias("s")).filter("NOT (m <=> s)").select(*LETTER).distinct()
    tall = context_heights(of, needs, leaves, "run").filter(F.col("tall") > room).join(of.select("doc", "letter", "run").distinct(), ["doc", "run"]).select(*LETTER).distinct()
    bound = siblings.unionByName(unequal).unionByName(tall).distinct().withColumn("bound", F.lit(True))
    most = majority(mixed, [*LETTER]).withColumnRenamed("topic", "most")
    x = x.join(bound, [*LETTER], "left").join(most, [*LETTER], "left").withColumn("bound", F.coalesce("bound", F.lit(False)))
    first = F.min("ord").over(letter)
    reason = F.when(F.col("topic").isNull() & ~F.col("bound"), "out of scope").when(~F.col("in"), "out of scope").when(F.col("bound") & F.col("out"), "not separable")
    unit = F.when(F.col("bound") | (F.col("runs") == 1), first).otherwise(F.col("run"))
    x = x.withColumns({"reason": reason, "unit": unit, "filed": F.when(F.col("bound"), F.col("most")).otherwise(F.col("topic"))})
    kept = {c: F.when(F.col("reason").isNull(), F.col(c)) for c in ("unit", "filed")}
    return x.withColumns(kept).select(*leaves.columns, "unit", "filed", "reason")


def by_topic(x: DataFrame, needs: DataFrame, leaves: DataFrame, room: int) -> DataFrame:
    """x with item: the units of a topic as one if their marks are those of the scheme and their context has room; else a unit joins the one before if it needs it."""
    real = x.filter("reason IS NULL")
    topic = ["doc", "filed"]
    whole = real.groupBy(*topic).agg(F.sum("marks").alias("m"), F.sum("scheme").alias("s"), F.min("unit").alias("first"), F.countDistinct("unit").alias("n"))
    tall = context_heights(real.select("doc", "filed", "label"), needs, leaves, "filed")
    whole = whole.join(tall, topic, "left").withColumn("one", F.col("m").eqNullSafe(F.col("s")) & (F.coalesce("tall", F.lit(0)) <= room))
    # which units of the same topic each unit needs, and then where an item begins, unit by unit
    at = real.select("doc", F.col("label").alias("on"), F.col("unit").alias("u2"), F.col("filed").alias("f2"))
    back = real.join(needs, ["doc", "label"]).join(at, ["doc", "on"]).filter("filed = f2 AND u2 < unit").groupBy(*topic, "unit").agg(F.max("u2").alias("back"))
    each = real.select(*topic, "unit").distinct().join(back, [*topic, "unit"], "left").groupBy(*topic).agg(F.array_sort(F.collect_list(F.struct("unit", F.coalesce("back", F.lit(-1)).alias("back")))).alias("u"))
    start = F.struct(F.lit(-1).cast("long").alias("begin"), F.array().cast("array<struct<unit:long,item:long>>").alias("out"))

    def step(s: Column, u: Column) -> Column:
        begin = F.when((s["begin"] >= 0) & (u["back"] >= s["begin"]), s["begin"]).otherwise(u["unit"].cast("long"))
        return F.struct(begin.alias("begin"), F.concat(s["out"], F.array(F.struct(u["unit"].cast("long").alias("unit"), begin.alias("item")))).alias("out"))

    chained = each.select(*topic, F.explode(F.aggregate("u", start, step, lambda s: s["out"])).alias("c")).select(*topic, F.col("c.unit").alias("unit"), F.col("c.item").alias("chain"))
    x = x.withColumn("unit", F.col("unit").cast("long")).join(whole.select(*topic, "first", "one"), topic, "left").join(chained, [*topic, "unit"], "left")
    return x.withColumn("item", F.when(F.col("one"), F.col("first").cast("long")).otherwise(F.col("chain"))).select(*leaves.columns, "reason", "item", "filed")


def blocks(x: DataFrame, needs: DataFrame, leaves: DataFrame, room: int) -> DataFrame:
    """x with items merged to a fixpoint: the first item of a question whose context has no room becomes one with the items that it needs, filed anew.

    It must need other items, and the marks of all together must be those of the scheme; if not, the next such item is looked at. A round
    merges one block in each question that still changes.
    """
    done: list[DataFrame] = []
    while True:
        real = x.filter("item IS NOT NULL")
        members = real.select("doc", "item", "label")
        tall = context_heights(members, needs, leaves, "item").filter(F.col("tall") > room)
        others = members.select("doc", F.col("label").alias("on"), F.col("item").alias("other"))
        pairs = needed(members, needs, "item").join(tall.select("doc", "item"), ["doc", "item"]).join(others, ["doc", "on"]).select("doc", "item", "other").distinct()
        group = pairs.unionByName(pairs.select("doc", "item", F.col("item").alias("other")).distinct())
        sums = real.groupBy("doc", F.col("item").alias("other")).agg(F.sum("marks").alias("m"), F.sum("scheme").alias("s"))
        fit = group.join(sums, ["doc", "other"]).groupBy("doc", "item").agg(F.sum("m").alias("m"), F.sum("s").alias("s")).filter("m <=> s")
        chosen = fit.groupBy("doc").agg(F.min("item").alias("item"))
        group = checkpointed(group.join(chosen, ["doc", "item"]))
        if group.isEmpty():
            break
        to = group.groupBy("doc").agg(F.min("other").alias("to"))
        moved = real.join(group.select("doc", F.col("other").alias("item")), ["doc", "item"])
        by = moved.groupBy("doc", "topic").agg(F.sum("marks").alias("m"))
        tops = by.withColumn("best", F.max("m").over(Window.partitionBy("doc"))).filter("m = best").groupBy("doc").agg(F.array_sort(F.collect_list("topic")).alias("tops"))
        filed = moved.join(sorted_joins(tops), "doc").groupBy("doc", "tops").agg(F.min_by("filed", F.when(F.array_contains("tops", F.col("filed")), F.col("item"))).alias("f"))
        new = filed.select("doc", F.when((F.size("tops") == 1) | F.col("f").isNull(), F.col("tops")[0]).otherwise(F.col("f")).alias("to_topic")).join(to, "doc")
        inside = group.select("doc", F.col("other").alias("item"), F.lit(True).alias("moved"))
        y = x.join(new, "doc", "left").join(inside, ["doc", "item"], "left")
        y = y.withColumns({"item": F.when(F.col("moved"), F.col("to")).otherwise(F.col("item")), "filed": F.when(F.col("moved"), F.col("to_topic")).otherwise(F.col("filed"))})
        # questions without a merge have come to rest
        y = checkpointed(y.select(*x.columns, F.col("to").isNotNull().alias("active")))
        done.append(y.filter("NOT active").drop("active"))
        x = y.filter("active").drop("active")
    for rest in done:
        x = x.unionByName(rest)
    return x


def assembled(leaves: DataFrame, needs: DataFrame, room: int) -> DataFrame:
    """doc, label, ord, item (the ord of its first leaf), filed and reason: every leaf is in one item or has a reason.

    Reasons: out of scope, not separable, marks (the item's are not those of the scheme), context (it has no room).
    """
    needs = checkpointed(needs.select("doc", "label", "on").distinct())
    x = checkpointed(by_topic(checkpointed(units(leaves, needs, room)), needs, leaves, room))
    x = checkpointed(blocks(x, needs, leaves, room))
    real = x.filter("item IS NOT NULL")
    sums = real.groupBy("doc", "item").agg(F.sum("marks").alias("m"), F.sum("scheme").alias("s"))
    sums = sums.join(context_heights(real.select("doc", "item", "label"), needs, leaves, "item"), ["doc", "item"], "left")
    bad = sums.select("doc", "item", F.when(~F.col("m").eqNullSafe(F.col("s")), "marks").when(F.col("tall") > room, "context").alias("bad"))
    x = x.join(bad, ["doc", "item"], "left").withColumn("reason", F.coalesce("reason", "bad"))
    gone = F.col("reason").isNotNull()
    return x.select("doc", "label", "ord", F.when(~gone, F.col("item")).alias("item"), F.when(~gone, F.col("filed")).alias("filed"), "reason")
