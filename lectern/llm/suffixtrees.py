"""Passages that several documents have, by suffix trees that are partitioned by prefixes.

The suffixes of all documents, word by word, form one suffix tree. It is not held anywhere: suffixes
are dealt into groups by prefixes of variable length, short ones for rare beginnings and longer ones
for common beginnings, so that every group fits a task, and a group is a subtree. Sorted, it is read
as a tree by the words that neighbours have in common: an internal node of a depth of `words` or more
stands for a passage that occurs at all places below it. The least doc_id below a deep node owns the
passage; places of other documents below it are repeats. Overlapping repeats make up the maximal ones.

1. Texts are dealt into blocks by hash. Of equal texts only that of the least doc_id goes on, the others are
   repeats as a whole; a block's equal windows count once from here on.
2. A suffix whose first `words` words occur in one document only is a leaf, and no deep node is above
   it. Blocks send short hashes of their windows, sorted, as differences, some three bytes each, to
   ranges of hashes; what comes back says which of its windows another block or document has too.
   A hash in common by chance costs a suffix in step 3 and does not change the result.
3. Only those suffixes travel, each cut at `words` words as nothing below matters: a byte of each
   word's hash, by which they are partitioned and sorted, then 64 bits of the window's. Prefixes are
   counted; one with more than GROUP suffixes is lengthened by a word until none is, or until it is
   whole: then it is one node, with one suffix a block at most, however many documents have it.
4. Deep nodes answer the blocks with the least doc_id, and blocks mark, cover and remove words.

Two different windows count as equal if 168 bits of hashes agree, 104 of them word by word; two texts if
128 bits do.

Defined results: null and empty texts have no words; a text with fewer words than a window loses none;
a null doc_id comes after all others; rows with equal doc_id do not make repeats of each other, equal rows
stay rows of their own; ids that are no integers are compared as Spark orders them; an empty table
gives an empty result. Columns besides doc_id and text play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5
from itertools import groupby
from math import ceil, log2
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from lectern.llm._common import dropped, kept

WORDS = 13
#: Bytes of text of a block, windows of a range of hashes, suffixes of a group: about so many each.
BLOCK, RANGE, GROUP = 8 << 20, 2_000_000, 200_000
#: Words whose hashes a task remembers.
REMEMBERED = 300_000
#: Long prefixes up to so many (some 20 MB) travel to all tasks; more are joined by shuffle.
SENT = 500_000
LAST = (1 << 63) - 1
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class Hashes(dict):
    """64-bit hashes of words; those met are remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def keys(hashes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each window of n words."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.empty(0, np.uint64)
    # hashes of 1, 2, 4, ... words, of which those in n's binary form are put together
    out, at, power, length, factor = np.zeros(size, np.uint64), 0, hashes, 1, int(MULTIPLIER)
    while True:
        if n & length:
            out = out * np.uint64(factor) + power[at : at + size]
            at += length
        if 2 * length > n:
            break
        power = power[:-length] * np.uint64(factor) + power[length:]
        length, factor = 2 * length, factor * factor % (1 << 64)
    out ^= out >> np.uint64(29)
    out *= MULTIPLIER
    return out ^ (out >> np.uint64(32))


def suffixes(hashes: np.ndarray, key: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """The suffixes at these places, a row of bytes each whose order is that of the words' codes: a byte a word, then the key."""
    codes = (hashes >> np.uint64(56)).astype(np.uint8)[at[:, None] + np.arange(n)]
    return np.hstack([codes, key[at].astype(">u8").view(np.uint8).reshape(len(at), 8)])


def packed(sorted_: np.ndarray) -> bytes:
    """Differences of sorted numbers, equal bytes together, compressed."""
    steps = np.diff(sorted_.astype("<u8"), prepend=np.uint64(0))
    return zstandard.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8")[:, 0], dtype=np.uint64)


def among(x: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    """Where each of x is in sorted_, or -1."""
    if not len(sorted_):
        return np.full(len(x), -1)
    at = np.minimum(np.searchsorted(sorted_, x), len(sorted_) - 1)
    return np.where(sorted_[at] == x, at, -1)


class Block:
    """The windows of a block's texts and the ranks of their documents. copies: the least rank that has a text which several documents have."""

    def __init__(self, n: int, hashes: Hashes):
        self.n, self.hashes = n, hashes
        self.place: dict[bytes, int] = {}
        self.copies: dict[bytes, int] = {}
        self.least: list[int] = []
        self.keys: list[np.ndarray] = []
        self.words: list[np.ndarray] = []

    def copied(self, rank: int, text: bytes) -> bool:
        """Whether a document of a lesser rank has the same text."""
        return self.copies.get(md5(text).digest(), rank) < rank

    def add(self, rank: int, text: bytes, only: np.ndarray | None = None, shift: int = 0) -> None:
        """only: the hashes, cut by shift bits, of the windows that count; their suffixes are held then."""
        name = md5(text).digest()
        if self.copies.get(name, rank) < rank or (name in self.place and self.least[self.place[name]] == rank):
            return
        h = self.hashes.of(text.split())
        key = keys(h, self.n)
        if only is not None:
            at = np.flatnonzero(among(key >> np.uint64(shift), only) >= 0)
            if len(at):
                self.words.append(suffixes(h, key, at, self.n))
            key = key[at]
        if len(key):
            self.place[name] = len(self.least)
            self.least.append(rank)
            self.keys.append(key)

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The distinct keys in order, a place in the joined arrays where each occurs, the least rank that has it and whether several have."""
        if not self.keys:
            return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
        key = np.concatenate(self.keys)
        doc = np.repeat(np.arange(len(self.keys)), [len(k) for k in self.keys])
        order = np.argsort(key)
        key, rank = key[order], np.array(self.least, np.int64)[doc[order]]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        least = np.minimum.reduceat(rank, first)
        return key[first], order[first], least, least < np.maximum.reduceat(rank, first)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(b.column(i).to_pylist() for i in range(b.num_columns)), strict=True)


def _batch(columns: list, schema: T.StructType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], schema.names)


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of bytes as a column."""
    rows = np.ascontiguousarray(rows)
    return pa.Array.from_buffers(pa.binary(rows.shape[1]), len(rows), [None, pa.py_buffer(rows)]).cast(pa.binary())


def ranked(docs: DataFrame) -> DataFrame:
    """doc_id, rank (a long in the order of the ids, null last) and text in UTF-8 of each row."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    if isinstance(docs.schema["doc_id"].dataType, T.ByteType | T.ShortType | T.IntegerType | T.LongType):
        return docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("rank"), text)
    ids = docs.select("doc_id").filter("doc_id IS NOT NULL").distinct().repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ranks = kept(ids.withColumn("rank", F.monotonically_increasing_id()), "ranks")
    return docs.select("doc_id", text).join(ranks, "doc_id", "left").select("doc_id", F.coalesce("rank", F.lit(LAST)).alias("rank"), "text")


def _with(texts: DataFrame, *given: DataFrame) -> DataFrame:
    """The rows of each block together, what is given for it first: block, kind (of what is given), given, doc_id, rank, text."""
    none = [F.lit(None).cast(k).alias(c) for c, k in texts.select("doc_id", "rank", "text").dtypes]
    both = texts.select("block", F.lit(None).cast("int").alias("kind"), F.lit(None).cast("binary").alias("given"), "doc_id", "rank", "text")
    for kind, df in enumerate(given):
        both = both.unionByName(df.select("block", F.lit(kind).alias("kind"), "given", *none))
    return both.repartition("block").sortWithinPartitions("block", F.col("kind").isNull())


def copies(texts: DataFrame) -> DataFrame:
    """block and given: a text's digest and the least rank that has it, for the texts that several documents have; a row a block and text."""
    own = texts.groupBy(F.md5("text").alias("name"), "block").agg(F.min("rank").alias("least"), F.max("rank").alias("most"))
    own = kept(own, "texts")
    several = own.groupBy("name").agg(F.min("least").alias("first"), F.max("most").alias("last")).filter("first < last").select("name", "first")
    given = F.concat(F.unhex("name"), F.unhex(F.lpad(F.hex("first"), 16, "0")))
    return kept(own.join(several, "name").select("block", given.alias("given")), "copies")


def _copied(b: Block, given: bytes) -> None:
    b.copies[given[:16]] = int.from_bytes(given[16:], "big", signed=True)


def shared_windows(texts: DataFrame, copied: DataFrame, n: int, ranges: int, shift: int) -> DataFrame:
    """block and given: packed hashes, cut by shift bits, of the windows that another document of the table may have too."""
    schema = T.StructType.fromDDL("part int, block int, alone binary, several binary")

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for block, rows in groupby(_rows(batches), itemgetter(0)):
            b = Block(n, hashes)
            for _, kind, given, rank, text in rows:
                if kind is None:
                    b.add(rank, text)
                else:
                    _copied(b, given)
            key, _, _, several = b.distinct()
            part = ((key >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
            edges = [*np.flatnonzero(np.r_[len(part) > 0, part[1:] != part[:-1]]), len(part)]
            out = []
            for i, j in zip(edges[:-1], edges[1:], strict=True):
                k, both = key[i:j] >> np.uint64(shift), several[i:j]
                out.append((int(part[i]), block, packed(k[~both]), packed(k[both])))
            if out:
                yield _batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)], schema)

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groupby(_rows(batches), itemgetter(0)):
            own = [(block, unpacked(alone), unpacked(several)) for _, block, alone, several in rows]
            every = np.sort(np.concatenate([np.unique(np.r_[a, s]) for _, a, s in own]))
            shared = np.union1d(every[1:][every[1:] == every[:-1]], np.concatenate([s for _, _, s in own]))
            out = [(block, np.union1d(a[among(a, shared) >= 0], s)) for block, a, s in own]
            out = [(block, packed(x)) for block, x in out if len(x)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())], ["block", "given"])

    parts = _with(texts, copied).drop("doc_id").mapInArrow(sent, schema).repartition("part").sortWithinPartitions("part")
    return kept(parts.mapInArrow(answered, "block int, given binary"), "shared")


def shared_suffixes(texts: DataFrame, copied: DataFrame, shared: DataFrame, n: int, shift: int) -> DataFrame:
    """suffix, block, least (rank) and whether several documents of the block have it, of each distinct window of a block that step 2 does not rule out."""
    schema = T.StructType.fromDDL("suffix binary, block int, least long, several boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for block, rows in groupby(_rows(batches), itemgetter(0)):
            only, b = [np.empty(0, np.uint64)], Block(n, hashes)
            for _, kind, given, _, rank, text in rows:
                if kind == 0:
                    _copied(b, given)
                elif kind == 1:
                    only.append(unpacked(given))
                else:
                    if len(only) > 1:
                        only = [np.unique(np.concatenate(only))]
                    b.add(rank, text, only[0], shift)
            key, at, least, several = b.distinct()
            words = np.concatenate(b.words) if b.words else np.empty((0, n + 8), np.uint8)
            for i in range(0, len(key), 20_000):
                s = slice(i, i + 20_000)
                yield _batch([_binary(words[at[s]]), pa.array(np.full(len(key[s]), block, np.int32)), pa.array(least[s]), pa.array(several[s])], schema)

    return kept(_with(texts, copied, shared).mapInArrow(run, schema), "suffixes")


def prefixed(found: DataFrame, n: int, group: int) -> DataFrame:
    """found with prefix: the shortest beginning of the suffix, whole words, that no more than group suffixes have, or all its words."""
    beginning = lambda k: F.substring("suffix", 1, k)
    common, level, under = [], 1, found.select("suffix")
    while level < n:
        many = kept(under.groupBy(beginning(level).alias("begin")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > group).select("begin"), "prefixes")
        size = many.count()
        if not size:
            break
        common.append(F.broadcast(many) if size <= SENT else many)
        under = under.join(common[-1], beginning(level) == F.col("begin"), "left_semi")
        level += 1
    out = found.withColumn("length", F.lit(1))
    for k, many in enumerate(common, 1):
        out = out.join(many, beginning(k) == F.col("begin"), "left").withColumn("length", F.col("length") + F.col("begin").isNotNull().cast("int")).drop("begin")
    return out.withColumn("prefix", F.expr("substring(suffix, 1, length)")).drop("length")


def deep_nodes(suffix: np.ndarray, depth: int) -> np.ndarray:
    """Where the deep nodes of a subtree begin, in its sorted suffixes (rows of bytes): neighbours with depth bytes in common have one above them."""
    if len(suffix) < 2:
        return np.zeros(len(suffix), np.int64)
    return np.flatnonzero(np.r_[True, (suffix[1:, :depth] != suffix[:-1, :depth]).any(axis=1)])


def owned(found: DataFrame, n: int) -> DataFrame:
    """block, key and least (rank) of the windows that another document, of that lesser rank, has too."""
    width = n + 8
    schema = T.StructType.fromDDL("block int, key long, least long")

    def subtree(columns: list[pa.Array]) -> pa.RecordBatch:
        suffix = np.frombuffer(b"".join(columns[0].to_pylist()), np.uint8).reshape(-1, width)
        block, least, several = (c.to_numpy(zero_copy_only=False) for c in columns[1:])
        first = deep_nodes(suffix, width)
        low = np.repeat(np.minimum.reduceat(least, first), np.diff(np.r_[first, len(suffix)]))
        repeated = several | (low < least)
        key = np.ascontiguousarray(suffix[repeated, n:]).view(">i8")[:, 0].astype(np.int64)
        return _batch([pa.array(block[repeated]), pa.array(key), pa.array(low[repeated])], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(rows).combine_chunks()
            return subtree([t.column(c).chunk(0) for c in ("suffix", "block", "least", "several")])

        for b in batches:
            prefix = b.column(0).dictionary_encode().indices.to_numpy()
            edges = [0, *(np.flatnonzero(prefix[1:] != prefix[:-1]) + 1), b.num_rows]
            if held and b.num_rows and held[-1].column(0)[-1] != b.column(0)[0]:
                yield done(held)
                held = []
            # groups that are whole in this batch are one forest: no node reaches over two of them
            if len(edges) > 2:
                yield done([*held, b.slice(0, edges[-2])])
                held = [b.slice(edges[-2])]
            elif b.num_rows:
                held.append(b)
        if held:
            yield done(held)

    groups = found.select("prefix", "suffix", "block", "least", "several").repartition("prefix").sortWithinPartitions("suffix")
    return kept(groups.mapInArrow(run, schema), "owners")


def marked(docs: DataFrame, n: int = WORDS, block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """doc_id, n_words, kept_text (the words that stay, one space between) and removed (start and end of each maximal repeat, in words) of docs(doc_id, text).

    Removed is each word of a window of n words that also starts in a document with a smaller doc_id.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, ranges = ceil(size / block) or 1, ceil(size / 6 / RANGE) or 1
    shift = 64 - min(64, max(32, ceil(log2(size + 1)) + 10))
    texts = ranked(docs).withColumn("block", F.pmod(F.xxhash64("rank", "text"), F.lit(blocks)).cast("int"))
    copied = copies(texts)
    shared = shared_windows(texts, copied, n, ranges, shift)
    found = shared_suffixes(texts, copied, shared, n, shift)
    dropped(shared)
    owners = owned(prefixed(found, n, group), n)
    dropped(found)
    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL("n_words long, kept_text string, removed array<struct<start: long, end: long>>")])
    kinds = [to_arrow_type(docs.schema["doc_id"].dataType), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]

    def packed_owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            of = b.column(0).to_numpy()
            pairs = np.stack([b.column(1).to_numpy(), b.column(2).to_numpy()], axis=1).astype("<i8")
            order = np.argsort(of, kind="stable")
            of, pairs = of[order], pairs[order]
            first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(of[first]), pa.array([p.tobytes() for p in np.split(pairs, first[1:])][: len(first)], pa.binary())], ["block", "given"])

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, out, held = Hashes(), [], 0
        for _, rows in groupby(_rows(batches), itemgetter(0)):
            b, given, key, least = Block(n, hashes), [b""], np.empty(0, np.uint64), np.empty(0, np.int64)
            for _, kind, g, doc, rank, text in rows:
                if kind == 0:
                    _copied(b, g)
                    continue
                if kind == 1:
                    given.append(g)
                    continue
                if given:
                    pairs = np.frombuffer(b"".join(given), "<i8").reshape(-1, 2)
                    order = np.argsort(pairs[:, 0].astype(np.uint64), kind="stable")
                    key, least, given = pairs[order, 0].astype(np.uint64), pairs[order, 1], []
                words, edges = text.split(), []
                if len(words) >= n and b.copied(rank, text):
                    edges = [(0, len(words))]
                elif len(words) >= n and len(key):
                    at = among(keys(hashes.of(words), n), key)
                    starts = np.flatnonzero((at >= 0) & (least[at] < rank))
                    if len(starts):
                        # windows that overlap or touch make one span
                        cut = np.flatnonzero(np.diff(starts) > n)
                        edges = list(zip(starts[np.r_[0, cut + 1]].tolist(), (starts[np.r_[cut, len(starts) - 1]] + n).tolist(), strict=True))
                ends = [0, *(x for e in edges for x in e), len(words)]
                stay = b" ".join([w for i, j in zip(ends[::2], ends[1::2], strict=True) for w in words[i:j]])
                out.append((doc, len(words), stay.decode(), [{"start": i, "end": j} for i, j in edges]))
                held += len(stay)
                if len(out) >= 4096 or held > 8 << 20:
                    yield batch(out)
                    out, held = [], 0
        if out:
            yield batch(out)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], schema.names)

    return _with(texts, copied, owners.mapInArrow(packed_owners, "block int, given binary")).mapInArrow(removed, schema)


def op11_prefix_suffix_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = marked(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return found.select("doc_id", "n_words", gone.alias("n_removed"), F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLES = {
    "op11_prefix_suffix_trees": rf"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT doc_id, i, sha256(array_to_string(w[i:i + {WORDS - 1}], ' ')) AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WORDS - 2})) AS i FROM d)),
        l AS (SELECT s, min(doc_id) AS least FROM s GROUP BY s HAVING min(doc_id) < max(doc_id)),
        g AS (SELECT DISTINCT doc_id, i FROM (SELECT doc_id, unnest(range(i, i + {WORDS})) AS i FROM s JOIN l USING (s) WHERE least < doc_id)),
        x AS (SELECT doc_id, count(g.i)::BIGINT AS n, string_agg(w[e.i], ' ' ORDER BY e.i) FILTER (g.i IS NULL) AS t
              FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d) e LEFT JOIN g USING (doc_id, i) GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN x USING (doc_id)""",
}
