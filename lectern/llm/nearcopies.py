"""Near copies by the exact Jaccard similarity of word shingles.

Two texts are linked if the sets of their five-word shingles have a similarity of at least 0.8, and
linked texts form groups. All shingles have one order, common ones last. Sets of similarity p / q
share a shingle among the first n - ceil(n * p / q) + 1 of each, n being the size of the set; so
only these are shuffled, and no pair is lost, whatever the order. Common ones come from a bounded
sample first. Sets that then still share a shingle of their prefixes with OFTEN others or more are
read whole and their shingles counted, and prefixes are taken anew in the order of these counts: so
texts that share a passage are not compared for it, however many they are, unless it is most of them.

Sets that share such a shingle are candidates, and so are those whose SimHash fingerprints the
vantage-point tree of `simhash` links within RADIUS bits; the tree alone reaches few sets of 0.8, as
those differ in about 10 of 64 bits, a radius at which no vantage splits. Rounds link large groups
without all their pairs. The sets before a set by size, one under each shingle of its prefix, are its
neighbours. First it is compared with what the tree gives and with the two neighbours it shares most
with, then with other neighbours that are still apart. Then, in rounds, sets still apart meet a few others of other
groups under each shingle, in another order each time: sets of a large group that are alike to a fifth of it join
it within a few rounds, for a few comparisons each. When few pairs that meet are alike, all sets still apart that
share a shingle are compared, so that no link is lost. Before the rounds, where a shingle has CROWD sets that are apart
or more, these stand no longer under it but under the shingles in which they differ from what most of them are: two that
share none of those differ too much, or are both so near the middle that they are alike for certain. All leave out pairs for which the sizes and the places of the shared shingle, or the
sketches of the sets, rule 0.8 out: a sketch has the parity of the number of shingles at each of 512
bits, so it differs in no more bits than the sets differ in shingles.

Defined results: words are those of op4's contract; a text of fewer than five words is one shingle;
null and empty texts have no shingle and are one group. Shingles and sets stand as 64-bit hashes.
Texts are told apart by 64-bit hashes of their own; those that need comparing are read again and not
kept, so docs must give the same rows each time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm import simhash
from lectern.llm._common import dropped, fresh, joined, kept

SHINGLE, SIMILAR = 5, (4, 5)
#: About so many documents decide which shingles are common: those in COMMON of them or more, KNOWN at most.
SAMPLE, COMMON, KNOWN = 8_192, 4, 65_536
#: Shingles that so many sets have count as common too; COUNTED at most (16 MB of hashes, 16 of ranks), the most common.
OFTEN, COUNTED = 8, 2_000_000
#: So many neighbours are compared first.
NEAREST = 2
#: Then sets still apart meet so many others under each shingle in up to so many rounds, until at most one pair in RARE is alike.
PARTNERS, TURNS, RARE = 4, 6, 16
#: Under a shingle with so many sets still apart these are told by their differences from a middle, the shingles that most of
#: MIDDLE of them have. A middle is dealt to SALTS places.
CROWD, MIDDLE, SALTS = 64, 15, 16
#: A task gives the prefix of a set once, as long as it remembers it among so many.
SEEN = 100_000
#: 64-bit words of a sketch.
SKETCH = 8
#: Up to so many keys or numbers (some 20 MB) travel to all tasks; more are joined by shuffle.
SENT = 500_000
RADIUS = 2


def text_key() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def shingles(text: str | None, n: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    return np.unique(simhash.hashes(text, n))


def number(s: np.ndarray) -> int:
    """The hash that stands for a set, as a signed long."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(s.astype("<u8").tobytes())).astype(np.int64))


def prefix(s: np.ndarray, known: np.ndarray, ranks: np.ndarray, similar: tuple[int, int] = SIMILAR) -> np.ndarray:
    """The first of a set's shingles in the common order: those not in known (sorted), then by rank."""
    p, q = similar
    size = len(s) - -(-len(s) * p // q) + 1 if len(s) else 0
    if not len(known):
        return s[:size]
    at = np.minimum(np.searchsorted(known, s), len(known) - 1)
    rank = np.where(known[at] == s, ranks[at], -1)
    return s[np.argsort(rank, kind="stable")[:size]]


def sketch(s: np.ndarray) -> np.ndarray:
    """Bit by bit whether an odd number of shingles falls on it."""
    odd = np.bincount((s % np.uint64(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def alike(a: np.ndarray, b: np.ndarray, similar: tuple[int, int] = SIMILAR) -> bool:
    p, q = similar
    shared = len(a) + len(b) - len(np.union1d(a, b))
    return (p + q) * shared >= p * (len(a) + len(b))


def common(docs: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The common shingles of a sample of docs(doc_id, text), sorted, and about how many sets have each."""
    each = max(1, docs.count() // SAMPLE)
    some = docs.select("doc_id", "text").filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(each)) == 0).limit(2 * SAMPLE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in b.column(1).to_pylist():
                s = shingles(t, n)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), number(s))), pa.array(s.view(np.int64))], ["id", "shingle"])

    counted = some.mapInArrow(run, "id long, shingle long").distinct().groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    found, ranks = fetched(counted, COMMON, KNOWN)
    return found, ranks * each


def fetched(counted: DataFrame, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of counted(shingle, n) with an n of least or more, sorted, and the n of each; of over most those of largest n."""
    top = counted.filter(F.col("n") >= least).orderBy(F.desc("n"), "shingle").limit(most).select("shingle", "n").toArrow()
    found, ranks = (top.column(i).to_numpy().astype(np.int64) for i in range(2))
    found = found.view(np.uint64)
    order = np.argsort(found)
    return found[order], ranks[order]


def counts(found: DataFrame, docs: DataFrame, n: int) -> DataFrame | None:
    """shingle and n, how many have it of those sets in whose prefix (in marks found) is a shingle that OFTEN prefixes have; None without such sets."""
    rows = found.filter(F.col("prefix").isNotNull()).select("key", F.explode("prefix").alias("shingle"))
    crowded = rows.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("shingle"))).filter(F.col("n") >= OFTEN)
    crowded = kept(crowded.select("key").distinct(), "crowded")
    if not crowded.limit(1).count():
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            each = [np.frombuffer(x, "<u8") for x in b.column(0).to_pylist()]
            s, k = np.unique(np.concatenate([*each, np.empty(0, np.uint64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(s.view(np.int64)), pa.array(k.astype(np.int64))], ["shingle", "n"])

    return kept(whole(docs, crowded, n).select("shingles").mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).filter(F.col("n") >= OFTEN), "counts")


def merged(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Both tables of shingles and counts as one, sorted; b counts where both have a shingle."""
    alone = ~np.isin(a[0], b[0])
    s, k = np.concatenate([a[0][alone], b[0]]), np.concatenate([a[1][alone], b[1]])
    order = np.argsort(s)
    return s[order], k[order]


def marks(docs: DataFrame, n: int = SHINGLE, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """doc_id, key (a hash of the text), id (the number of its set) and, once a task and text, the set's fingerprint, size, sketch and prefix."""
    order = common(docs, n)
    found = marked(docs, order, n, similar)
    counted = counts(found, docs, n)
    if counted is None:
        return found
    dropped(found)
    return marked(docs, merged(order, fetched(counted, OFTEN, COUNTED)), n, similar)


def marked(docs: DataFrame, order: tuple[np.ndarray, np.ndarray], n: int, similar: tuple[int, int]) -> DataFrame:
    """marks, with prefixes by the given order."""
    known, ranks = order
    names = ["doc_id", "key", "id", "fingerprint", "size", "sketch", "prefix"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for b in batches:
            rows = []
            for key, t in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if key in seen:
                    rows.append((seen[key], None, None, None, None))
                    continue
                h = simhash.hashes(t, n)
                s = np.unique(h)
                x = number(s)
                rows.append((x, int(np.uint64(simhash.fingerprint(h)).view(np.int64)), len(s), sketch(s), prefix(s, known, ranks, similar).view(np.int64)))
                if len(seen) >= SEEN:
                    seen.clear()
                seen[key] = x
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], t) for t in kinds]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *columns], names)

    kinds = (T.LongType(), T.LongType(), T.LongType(), T.IntegerType(), T.ArrayType(T.LongType()), T.ArrayType(T.LongType()))
    added = [T.StructField(x, k) for x, k in zip(names[1:], kinds, strict=True)]
    return kept(docs.select("doc_id", text_key().alias("key"), "text").mapInArrow(run, T.StructType([docs.schema["doc_id"], *added])), "marks")


def near_enough(x: str, y: str, sizes: Column, similar: tuple[int, int]) -> Column:
    """Whether sets of these sketches, whose sizes add up to sizes, can be alike."""
    p, q = similar
    differ = F.aggregate(F.zip_with(x, y, lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda s, d: s + d)
    return (p + q) * differ <= (q - p) * sizes


def linked(pairs: DataFrame, sets: DataFrame, docs: DataFrame, n: int, similar: tuple[int, int]) -> DataFrame:
    """Those of pairs(a, b) whose sets are alike; sets: id, size, sketch and key, the hash of a text that has this set."""
    p, q = similar
    of = lambda end, c, size: sets.select(F.col("id").alias(end), F.col("sketch").alias(c), F.col("size").alias(size))
    pairs = pairs.join(of("a", "x", "m"), "a").join(of("b", "y", "n"), "b")
    pairs = kept(pairs.filter(near_enough("x", "y", F.col("m") + F.col("n"), similar)).select("a", "b"), "pairs")
    involved = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    involved = kept(sets.select("id", "key").join(involved, "id", "left_semi").select("key"), "involved")
    if not involved.limit(1).count():
        return pairs

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            of = lambda c: (np.frombuffer(x, "<u8") for x in c.to_pylist())
            keep = [alike(x, y, similar) for x, y in zip(of(b.column(2)), of(b.column(3)), strict=True)]
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    read = whole(docs, involved, n)
    both = pairs.join(read.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a")
    both = both.join(read.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b")
    return kept(both.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long"), "linked")


def whole(docs: DataFrame, keys: DataFrame, n: int) -> DataFrame:
    """id and shingles, all of them, of each set that a text has whose key is in the kept table keys."""
    if keys.count() <= SENT:
        keys = F.broadcast(keys)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            ids, found = [], []
            for key, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if key not in seen:
                    s = shingles(t, n)
                    ids.append(number(s))
                    found.append(s.astype("<u8").tobytes())
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(key)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.binary())], ["id", "shingles"])

    texts = docs.select(text_key().alias("key"), "text").join(keys, "key", "left_semi")
    return texts.mapInArrow(read, "id long, shingles binary").dropDuplicates(["id"])


def treed(sets: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs (a, b) of sets whose fingerprints the vantage-point tree links: a star a group and not its pairs."""
    by = kept(sets.groupBy("fingerprint").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")), "fingerprints")
    equal = joined(sets.select("fingerprint", "id"), by, "fingerprint").select(F.col("first").alias("a"), F.col("id").alias("b"))
    near = simhash.stars(by.select("fingerprint"), radius)
    of = lambda c, end: by.select(F.col("fingerprint").alias(c), F.col("first").alias(end))
    near = near.withColumnsRenamed({"a": "x", "b": "y"}).join(of("x", "a"), "x").join(of("y", "b"), "y").select("a", "b")
    return equal.unionByName(near).filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def sent(roots: DataFrame) -> DataFrame:
    return F.broadcast(roots) if roots.count() <= SENT else roots


def between(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """Those of edges(a, b) that are not within one group, with the roots of their ends."""
    of = sent(roots)
    for c in "ab":
        edges = edges.join(of.withColumnsRenamed({"id": c, "root": f"{c}_root"}), c, "left").withColumn(f"{c}_root", F.coalesce(f"{c}_root", c))
    return edges.filter("a_root <> b_root")


def rooted(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """roots(id, root), the groups so far, with those that edges(a, b) join: components only of the roots that change."""
    joins = between(roots, edges).select(F.col("a_root").alias("a"), F.col("b_root").alias("b")).distinct()
    changed = kept(simhash.components(joins), "changed")
    moved = sent(changed.select(F.col("node").alias("root"), F.col("root").alias("to")))
    old = roots.join(moved, "root", "left").select("id", F.coalesce("to", "root").alias("root"))
    new = changed.select(F.col("node").alias("id"), "root").join(roots, "id", "left_anti")
    return kept(old.unionByName(new), "roots")


def differences(rows: DataFrame, sets: DataFrame, docs: DataFrame, n: int, similar: tuple[int, int]) -> tuple[DataFrame, DataFrame] | None:
    """rows(shingle, id, left, need) with those of crowded shingles dealt anew, and pairs(a, b) that are alike for certain; None without such shingles.

    Let d(A) be the number of shingles in which A differs from the middle M of its crowd, and t(A) = |A| (q - p) / (p + q): A and B
    are alike if and only if they differ in at most t(A) + t(B) shingles. If d(A) + d(B) is no more, they do, and so does each of
    them from the set of least d - t. Else their differences from M share at least (d(A) + d(B) - t(A) - t(B)) / 2 shingles, and
    d(A) - |A| (q - p) / p, as alike sets differ in no more than the latter; so they share one of the first d(A) - that + 1.
    A set alike for certain to that of least d - t looks only for sets that are not, and these have a d - t above the least one's negative.
    """
    p, q = similar
    crowds = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.xxhash64("id"), "id"))["id"].alias("crowd"))
    crowds = kept(crowds.filter(F.col("n") >= CROWD), "crowds")
    if not crowds.limit(1).count():
        return None
    of = kept(joined(rows.select("shingle", "id"), crowds, "shingle").select("id", "crowd").distinct(), "members")
    involved = kept(sets.select("id", "key").join(of.select("id").distinct(), "id", "left_semi").select("key"), "involved")
    read = kept(whole(docs, involved, n), "members")

    def middles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for some in b.column(1).to_pylist():
                s, k = np.unique(np.concatenate([np.frombuffer(x, "<u8") for x in some]), return_counts=True)
                found.append(s[2 * k > len(some)].tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.binary())], ["crowd", "middle"])

    some = of.withColumn("r", F.row_number().over(Window.partitionBy("crowd").orderBy(F.xxhash64("id"), "id"))).filter(F.col("r") <= MIDDLE)
    some = some.join(read, "id").groupBy("crowd").agg(F.collect_list("shingles").alias("some"))
    middle = kept(some.mapInArrow(middles, "crowd long, middle binary"), "middles")

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "crowd", "differ", "need", "shingles"]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()))
        for b in batches:
            out = []
            for i, c, x, m in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                x, m = np.frombuffer(x, "<u8"), np.frombuffer(m, "<u8")
                away = np.concatenate([np.setdiff1d(x, m, assume_unique=True), np.setdiff1d(m, x, assume_unique=True)])
                first = len(away) - max(1, len(away) - len(x) * (q - p) // p) + 1
                out.append((i, c, len(away), (p + q) * len(away) - (q - p) * len(x), away[:first].view(np.int64)))
            columns = zip(*out, strict=True) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt")
    dealt = middle.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    both = of.select("id", "crowd", salt).join(read, "id").join(dealt, ["crowd", "salt"])
    told = kept(both.select("id", "crowd", "shingles", "middle").mapInArrow(tell, "id long, crowd long, differ int, need long, shingles array<long>"), "told")
    nearest = told.groupBy("crowd").agg(F.min(F.struct("need", "id")).alias("near"), F.count(F.lit(1)).alias("n"))
    told = kept(joined(told, kept(nearest, "nearest"), "crowd"), "told")
    held = F.col("need") + F.col("near.need") <= 0
    sure = told.filter(held & (F.col("id") != F.col("near.id"))).select(F.least("id", "near.id").alias("a"), F.greatest("id", "near.id").alias("b")).distinct()
    least = F.greatest(F.lit(1), F.ceil((F.col("need") - F.col("near.need") + 1) / (2 * (p + q)))).cast("int")
    first = F.when(held, F.slice("shingles", 1, F.greatest(F.lit(0), F.col("differ") - least + 1))).otherwise(F.col("shingles"))
    anew = told.select("id", "crowd", "differ", "need", F.posexplode(first).alias("place", "shingle"))
    anew = anew.select(F.shiftrightunsigned(F.xxhash64("crowd", "shingle"), 24).alias("shingle"), "id", (F.col("differ") - F.col("place")).alias("left"), "need")
    return rows.join(sent(crowds.select("shingle")), "shingle", "left_anti").unionByName(anew), sure


def groups(found: DataFrame, docs: DataFrame, n: int = SHINGLE, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """node (the number of a set) and root, the smallest number of its group, of each set in marks of docs."""
    p, q = similar
    once = found.filter(F.col("prefix").isNotNull())
    sets = kept(once.select("id", "fingerprint", "size", "sketch", "key").dropDuplicates(["id"]), "sets")
    rows = once.select("id", "size", F.posexplode("prefix").alias("place", "shingle"))
    # 40 bits tell shingles apart well enough here: two that fall together only give more candidates
    rows = rows.select(F.shiftrightunsigned("shingle", 24).alias("shingle"), "id", (F.col("size") - F.col("place")).alias("left"), (2 * p * F.col("size").cast("long")).alias("need"))
    by = Window.partitionBy("shingle")
    several = lambda rows, c: rows.withColumn("l", F.min(c).over(by)).withColumn("m", F.max(c).over(by)).filter("l <> m").drop("l", "m")

    def possible(a: str, b: str):
        """Whether sets that first share this shingle can be alike."""
        left = F.least(*(F.col(f"{x}.left") for x in (a, b)))
        return (F.col(f"{a}.id") != F.col(f"{b}.id")) & (2 * (p + q) * left >= F.col(f"{a}.need") + F.col(f"{b}.need"))

    def pairs(rows: DataFrame, a: str, b: str) -> DataFrame:
        ids = F.col(f"{a}.id"), F.col(f"{b}.id")
        return rows.filter(possible(a, b)).select(F.least(*ids).alias("a"), F.greatest(*ids).alias("b"))

    rows = several(rows.withColumn("y", F.lag(F.struct("id", "left", "need")).over(by.orderBy("need", "id"))), "id")
    rows = kept(rows.select("shingle", F.struct("id", "left", "need").alias("x"), "y"), "shared")
    before = rows.filter("y IS NOT NULL").filter(possible("x", "y")).groupBy(F.col("x.id").alias("id"), F.col("y.id").alias("near")).agg(F.count(F.lit(1)).alias("n"))
    before = before.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("n", "near")), asc=False).alias("near"))
    before = kept(before.select("id", F.col("near.near").alias("near")), "neighbours")

    def neighbours(near) -> DataFrame:
        return before.select("id", F.explode(near).alias("near")).select(F.least("id", "near").alias("a"), F.greatest("id", "near").alias("b"))

    def still_apart(rows: DataFrame, roots: DataFrame) -> DataFrame:
        """rows with the root of each set, of the shingles whose sets are not all in one group."""
        return several(rows.join(sent(roots), "id", "left").withColumn("root", F.coalesce("root", "id")), "root")

    first = linked(neighbours(F.slice("near", 1, NEAREST)).unionByName(treed(sets)).distinct(), sets, docs, n, similar)
    roots = rooted(sets.select("id", F.col("id").alias("root")).limit(0), first)
    others = between(roots, neighbours(F.slice("near", NEAREST + 1, F.size("near")))).select("a", "b").distinct()
    roots = rooted(roots, linked(others, sets, docs, n, similar))
    rows, item = rows.select("shingle", "x.*"), F.struct("id", "left", "need", "root")
    rows = kept(still_apart(rows, roots), "apart").drop("root")
    if anew := differences(rows, sets, docs, n, similar):
        rows, sure = anew
        roots = rooted(roots, sure)
    for turn in range(TURNS):
        apart = kept(still_apart(rows, roots), "apart")
        order = by.orderBy(F.xxhash64("id", F.lit(turn)), "id")
        others = F.array(*(F.lag(item, k).over(order) for k in range(1, PARTNERS + 1)))
        met = apart.select("shingle", item.alias("x"), others.alias("y")).withColumn("y", F.explode("y"))
        met = kept(pairs(met.filter("y IS NOT NULL AND x.root <> y.root"), "x", "y").distinct(), "met")
        found = linked(met, sets, docs, n, similar)
        roots = rooted(roots, found)
        rows = apart.drop("root")
        if RARE * found.count() <= met.count():
            break
    # the last ones meet with their sketches, so that only pairs that can be alike leave the join
    rows = kept(still_apart(rows, roots).join(sets.select("id", "size", "sketch"), "id"), "apart")
    item = F.struct("id", "left", "need", "root", "size", "sketch")
    x, y = (rows.select("shingle", item.alias(c)) for c in "xy")
    last = x.join(y, "shingle").filter("x.id < y.id AND x.root <> y.root").filter(near_enough("x.sketch", "y.sketch", F.col("x.size") + F.col("y.size"), similar))
    roots = rooted(roots, linked(pairs(last, "x", "y").distinct(), sets, docs, n, similar))
    return sets.select("id").join(roots, "id", "left").select(F.col("id").alias("node"), F.coalesce("root", "id").alias("root"))


def deduplicated(docs: DataFrame, n: int = SHINGLE, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """One row of docs per group of near copies, with all its columns: that of the smallest doc_id, null last."""
    name = fresh(docs.columns, "__text")
    found = marks(docs, n, similar)
    return simhash.one_a_group(docs.withColumn(name, text_key()), found.select("doc_id", "key", F.col("id").alias("node")), groups(found, docs, n, similar), name)
