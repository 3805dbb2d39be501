"""Benchmark passages in documents.

A window is as many words as a benchmark item has, at any place in a document. Windows and items
have SimHash fingerprints over their five-word shingles. A multi-index over the items' fingerprints
(one index per item length) returns all items within `radius` bits of a window: of four blocks of 16
bits that differ in 20 together, one of the first three differs in 4 or fewer or the last in 5 or fewer.
Half of that is spent on the items' side, where each is listed under all such values of a block, and
the rest on the window's, which probes as many. The exact similarity of what it returns, shared shingle
weight over total shingle weight with the occurrences as weights, decides. At radius 20 a random item
is a candidate for one window in five.

A window without any shingle of an item of its length has similarity zero with all of them, so
only windows around such shingles are fingerprinted; this leaves no pair out.

The benchmark travels with the task in parts of at most PART bytes of text; a larger one is worked
through in several passes over the documents.

Defined results: words are runs of letters and digits, lower-cased; an item of fewer than five
words is one shingle; a document shorter than an item is one window; null and empty texts and items
have no words and match nothing; documents that are equal rows give equal rows; items of equal text
are all reported; empty tables give an empty result.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

SHINGLE, SIMILAR, RADIUS, BLOCKS, PART = 5, 0.8, 20, 4, 8 << 20
#: So many windows are fingerprinted at a time, at 320 bytes each and as much for each word of one.
RUN = 4096
WORD = re.compile(r"[^\W_]+")


def tokens(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def shingle_hashes(words: list[str], k: int) -> np.ndarray:
    """A 64-bit hash of each run of k words."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - k + 1
    if n < 1:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def window_fingerprints(h: np.ndarray, size: int) -> np.ndarray:
    """The fingerprint of each run of size hashes: a bit is 1 if it is set in over half of them."""
    bits = np.unpackbits(np.ascontiguousarray(h.astype("<u8")).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    total = np.zeros((len(h) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, dtype=np.int32, out=total[1:])
    return np.packbits(2 * (total[size:] - total[:-size]) > size, axis=1, bitorder="little").view("<u8").ravel()


def masks(width: int, most: int) -> np.ndarray:
    """All words of width bits with most set bits or fewer."""
    return np.array([sum(1 << b for b in bits) for r in range(most + 1) for bits in combinations(range(width), r)], np.uint64)


class MultiIndex:
    """All of a set of fingerprints within radius bits of a query.

    Blocks have budgets of bits that with one more each add up to radius + 1, so that of two words
    within radius some block differs within its budget. Each fingerprint is listed under all values
    of each block within half of its budget.
    """

    def __init__(self, fingerprints: np.ndarray, radius: int = RADIUS, blocks: int = BLOCKS):
        self.all, self.radius, self.width = fingerprints, radius, 64 // blocks
        self.lists = []
        for b in range(blocks):
            most = (radius + 1 - blocks + b) // blocks
            if most >= 0:
                listed = masks(self.width, most // 2)
                keys = (self._block(fingerprints, b)[:, None] ^ listed[None, :]).ravel().astype(np.uint32)
                order = np.argsort(keys, kind="stable")
                self.lists.append((b, masks(self.width, most - most // 2), keys[order], (order // len(listed)).astype(np.int32)))

    def _block(self, x: np.ndarray, b: int) -> np.ndarray:
        return (x >> np.uint64(b * self.width)) & np.uint64((1 << self.width) - 1)

    def candidates(self, query: np.uint64) -> np.ndarray:
        """The fingerprints that differ from the query within the budget of some block."""
        found = []
        for b, near, keys, at in self.lists:
            probes = (self._block(query, b) ^ near).astype(np.uint32)
            first, last = np.searchsorted(keys, probes), np.searchsorted(keys, probes, "right")
            found += [at[i:j] for i, j in zip(first[first < last], last[first < last], strict=True)]
        return np.unique(np.concatenate(found)) if found else np.empty(0, np.int32)

    def near(self, queries: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(query, fingerprint, distance) of all pairs within radius, once each."""
        for q, x in enumerate(queries):
            found = self.candidates(x)
            d = np.bitwise_count(self.all[found] ^ x)
            yield from ((q, int(i), int(y)) for i, y in zip(found[d <= self.radius], d[d <= self.radius], strict=True))


class Items:
    """Benchmark items of one shingle length (five words, or the item's own where it has fewer)."""

    def __init__(self, k: int, items: list[tuple[int, list[str]]], similar: float, radius: int):
        self.k, self.similar = k, similar
        self.ids = [i for i, _ in items]
        self.lengths = np.array([len(w) for _, w in items])
        self.weights = [Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) for _, w in items]
        lengths_at, prints = defaultdict(set), defaultdict(list)
        for n, (_, w) in enumerate(items):
            h = shingle_hashes(w, k)
            for x in h.tolist():
                lengths_at[x].add(len(w))
            prints[len(w)].append((n, window_fingerprints(h, len(h))[0]))
        self.lengths_at = dict(lengths_at)
        self.known = np.array(sorted(lengths_at), np.uint64)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.known & np.uint64((1 << 20) - 1)] = True
        self.by_length = {size: ([n for n, _ in x], MultiIndex(np.array([f for _, f in x], np.uint64), radius)) for size, x in prints.items()}

    def similarity(self, window: list[str], item: int) -> float:
        ours, theirs = Counter(tuple(window[i : i + self.k]) for i in range(len(window) - self.k + 1)), self.weights[item]
        shared = (ours & theirs).total()
        return shared / (ours.total() + theirs.total() - shared)

    def matches(self, words: list[str]) -> Iterator[tuple[int, int, float, int]]:
        """item_id, first word, similarity and distance of the best window of each item found; the first of equals."""
        h = shingle_hashes(words, self.k)
        some = np.flatnonzero(self.maybe[h & np.uint64((1 << 20) - 1)])
        at_known = np.minimum(np.searchsorted(self.known, h[some]), len(self.known) - 1)
        hits = some[self.known[at_known] == h[some]]
        at: dict[int, list[int]] = defaultdict(list)
        for i in hits.tolist():
            for size in self.lengths_at[int(h[i])]:
                at[size].append(i)
        best: dict[int, tuple[float, int, int]] = {}
        for size, places in at.items():
            size_here = min(size, len(words))
            span, last = size_here - self.k + 1, len(words) - size_here
            starts = np.zeros(last + 2, np.int32)
            for i in places:
                starts[min(max(0, i - span + 1), last)] += 1
                starts[min(i, last) + 1] -= 1
            starts = np.flatnonzero(np.cumsum(starts[:-1]) > 0)
            items, index = self.by_length[size]
            cuts = np.flatnonzero((np.diff(starts) > 1) | (np.arange(1, len(starts)) % RUN == 0)) + 1
            for run in np.split(starts, cuts):
                first = int(run[0])
                prints = window_fingerprints(h[first : int(run[-1]) + span], span)
                for q, i, distance in index.near(prints):
                    s = self.similarity(words[first + q : first + q + size_here], items[i])
                    if s >= self.similar and (-s, first + q) < best.get(items[i], (0.0, 0, 0))[:2]:
                        best[items[i]] = (-s, first + q, distance)
        for n, (s, start, distance) in best.items():
            yield self.ids[n], start, -s, distance


class Benchmark:
    """All items of one part of a benchmark."""

    def __init__(self, items: list[tuple[int, str | None]], similar: float = SIMILAR, radius: int = RADIUS):
        by = defaultdict(list)
        for i, text in items:
            w = tokens(text)
            if w:
                by[min(SHINGLE, len(w))].append((i, w))
        self.kinds = [Items(k, x, similar, radius) for k, x in sorted(by.items())]

    def matches(self, text: str | None) -> Iterator[tuple[int, int, float, int]]:
        w = tokens(text)
        for kind in self.kinds:
            if len(w) >= kind.k:
                yield from kind.matches(w)


def parts(benchmark: DataFrame, size: int = PART) -> Iterator[Benchmark]:
    """benchmark(item_id, text) in parts of about size bytes, one on the driver at a time."""
    rows = benchmark.select("item_id", "text")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // size)
    for i in range(n):
        part = rows if n == 1 else rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)
        yield Benchmark([tuple(r) for r in part.collect()])


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, first_word, similarity and distance: a row per document and item found in it."""
    ids = [T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("item_id", benchmark.schema["item_id"].dataType)]
    schema = T.StructType([*ids, *T.StructType.fromDDL("first_word int, similarity double, distance int").fields])
    kinds, out = [to_arrow_type(f.dataType) for f in schema.fields], None
    for part in parts(benchmark):

        def run(batches: Iterator[pa.RecordBatch], part: Benchmark = part) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows = [(d, *m) for d, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for m in part.matches(text)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], schema.names)

        found = docs.select("doc_id", "text").mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, in which no item is found."""
    at, out = docs.columns.index("text"), docs
    for part in parts(benchmark):

        def run(batches: Iterator[pa.RecordBatch], part: Benchmark = part) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield b.filter(pa.array([next(part.matches(t), None) is None for t in b.column(at).to_pylist()], pa.bool_()))

        out = out.mapInArrow(run, docs.schema)
    return out


def op6_window_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
