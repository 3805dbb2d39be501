"""A language model with Katz backoff, of order three unless told otherwise, trained and evaluated over a partitioned corpus.

P(w | h) is d(r) * r / c(h) for an n-gram seen r times, else alpha(h) * P(w | h without its first
word), and so on down to P(w); a history that was never seen has alpha 1. P(w) is d(c) * c / N for a
word seen c times, and what the discounts leave belongs to all unknown words together. d is Good-
Turing's ratio r*/r by order: Turing's estimate for counts up to CUT where it lies between 0 and 1, and
the log-linear fit of simple Good-Turing over all counts of counts otherwise, which stays below 1
for every count, so that each history keeps mass to back off with. alpha(h) = (1 - sum of P(w | h)
over seen w) / (1 - sum of P(w | shorter h) over the same w), so probabilities add up to 1 exactly
for every history. Before a document stand start marks, which are histories and never predicted.

How it runs. Documents become blocks of about a million tokens: a sorted vocabulary of word hashes
and token numbers. Each block asks for its distinct n-grams once, packed and dealt out by ranges of
their hashes to `parts`; a part is one partition of the count tables, sums what all blocks have, and
answers each block in the order it was asked; the answers are what is stored. With these counts a block
computes all that needs no alpha. For alpha it sends, dealt out by history, the partial sums of those
histories of which it owns n-grams (the first block that has an n-gram owns it) and which held-out
documents have somewhere, as no other text meets an unseen n-gram, and the unseen n-grams of its
documents. A frequent word or passage thus costs a row per block, and the number of parts, and of
tasks, follows the corpus.

Defined results: null and empty texts are one end token; a null doc_id counts as the empty string
for the hold-out; equal rows stay rows of their own; without training documents every word is
unknown; an empty table gives an empty result. Words are told apart by 64-bit hashes,
longer n-grams by hashes whose length grows with the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from lectern.llm._common import dropped, kept

ORDER, BLOCK, PART, CUT = 3, 1 << 20, 2 << 20, 5
#: N-grams above words have hashes of log2(tokens) + SPARE bits, so that at any size one in 2 ** SPARE falls together with another.
SPARE = 20
INT = np.dtype("<i8")
END = b" end"  # no word has a space


def word_key(w: bytes) -> int:
    return xxhash.xxh3_64_intdigest(w)


START = np.uint64(word_key(b" start"))


def packed(x: np.ndarray) -> bytes:
    """Whole numbers as zstandard of their byte planes; sorted ones should come as differences."""
    x = np.ascontiguousarray(x.astype("<u8"))
    return zstandard.ZstdCompressor(level=1).compress(x.view(np.uint8).reshape(-1, 8).T.tobytes())


def unpacked(b: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def packed_keys(x: np.ndarray) -> bytes:
    return packed(np.diff(x, prepend=np.uint64(0)))


def unpacked_keys(b: bytes) -> np.ndarray:
    return np.cumsum(unpacked(b), dtype=np.uint64)


def packed_doubles(x: np.ndarray) -> bytes:
    """To 36 bits after the point of the mantissa: 2e-11 of a sum."""
    return packed((np.ascontiguousarray(x.astype("<f8")).view("<u8") + np.uint64(1 << 15)) & ~np.uint64((1 << 16) - 1))


def unpacked_doubles(b: bytes) -> np.ndarray:
    return unpacked(b).view("<f8")


def joint(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """A 64-bit hash of a pair of hashes."""
    x = h * np.uint64(0x9E3779B97F4A7C15) + (w ^ (h >> np.uint64(31)))
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted distinct values of x, the place among them of each element, and an element of each."""
    order = np.argsort(x)
    y = x[order]
    new = np.ones(len(x), bool)
    new[1:] = y[1:] != y[:-1]
    back = np.empty(len(x), np.int64)
    back[order] = np.cumsum(new) - 1
    return y[new], back, order[new]


def bounds(keys: np.ndarray, parts: int, bits: int) -> np.ndarray:
    """Where each of the parts, equal ranges of hashes of so many bits, begins and ends in sorted keys."""
    cuts = [(p << bits) // parts for p in range(1, parts)]
    return np.r_[0, np.searchsorted(keys, np.array(cuts, np.uint64)), len(keys)].astype(np.int64)


@dataclass(frozen=True)
class Discount:
    """d by count: a table up to CUT, above it (1 + 1/r) ** power."""

    table: tuple[float, ...]
    power: float

    def __call__(self, r: np.ndarray) -> np.ndarray:
        r = np.maximum(np.asarray(r, float), 1)
        low = np.array(self.table)[np.minimum(r, CUT).astype(int) - 1]
        return np.where(r <= CUT, low, (1 + 1 / r) ** self.power)


def good_turing(types: dict[int, int]) -> Discount:
    """From the numbers of types seen 1, 2, ... times, of all counts that there are."""
    r = np.array(sorted(types), float)
    n = np.array([types[int(x)] for x in r], float)
    slope = -1.5
    if len(r) > 1:
        before, after = np.r_[0, r[:-1]], np.r_[r[1:], 2 * r[-1] - r[-2]]
        slope = min(-1.1, float(np.polyfit(np.log(r), np.log(n / ((after - before) / 2)), 1)[0]))
    table = []
    for k in range(1, CUT + 1):
        turing = (k + 1) * types.get(k + 1, 0) / (k * types[k]) if types.get(k) else 0
        table.append(float(turing) if 0 < turing < 1 else (1 + 1 / k) ** (slope + 1))
    return Discount(tuple(table), slope + 1)


@dataclass(frozen=True)
class Model:
    """What all blocks need besides counts: sizes, discounts by order, and the share of unknown words."""

    tokens: int
    types: int
    documents: int
    discounts: tuple[Discount, ...]
    unknown: float

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.5) / (self.tokens + 0.5 * (self.types + 1)))

    def unigram(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, self.discounts[0](c) * c / max(1, self.tokens), self.unknown)


class Numbers(dict):
    """Words numbered as they come."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def blocks(docs: DataFrame, tokens: int = BLOCK) -> DataFrame:
    """A row per block of `tokens` tokens or, with its last document, more: its documents' ids, hold-out marks and token counts, vocabulary, its places by frequency, and tokens as places among these."""
    of_id = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("block", T.StringType()), T.StructField("doc_id", T.ArrayType(of_id)), *T.StructType.fromDDL("held array<boolean>, size array<int>, vocabulary binary, ranked binary, tokens binary").fields])
    id_type = to_arrow_type(of_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, n = TaskContext.get().partitionId(), 0
        ids, held, sizes, parts, size, numbers = [], [], [], [], 0, Numbers()

        def block() -> pa.RecordBatch:
            vocabulary, back, _ = distinct(np.fromiter(map(word_key, numbers), np.uint64, len(numbers)))
            text = back[np.concatenate(parts)]
            ranked = np.argsort(-np.bincount(text, minlength=len(vocabulary)), kind="stable")  # frequent words have small numbers
            rank = np.empty(len(ranked), np.int64)
            rank[ranked] = np.arange(len(ranked))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([f"{task}-{n}"]), pa.array([ids], pa.list_(id_type)), pa.array([held], pa.list_(pa.bool_())), pa.array([sizes], pa.list_(pa.int32())),
                    pa.array([packed_keys(vocabulary)], pa.binary()), pa.array([packed(ranked)], pa.binary()), pa.array([packed(rank[text])], pa.binary()),
                ],
                ["block", "doc_id", "held", "size", "vocabulary", "ranked", "tokens"],
            )

        for b in batches:
            for d, h, text in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                w = (text or "").encode().lower().split()
                w.append(END)
                parts.append(np.fromiter(map(numbers.__getitem__, w), np.int64, len(w)))
                ids.append(d)
                held.append(h)
                sizes.append(len(w))
                size += len(w)
                if size >= tokens:
                    yield block()
                    n, ids, held, sizes, parts, size, numbers = n + 1, [], [], [], [], 0, Numbers()
        if ids:
            yield block()

    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(5)) == 1
    return docs.select("doc_id", held.alias("held"), "text").mapInArrow(run, schema)


class Block:
    """A block's n-grams by order, from words on: distinct keys, the place of each token's, its training count and,
    but for the longest, whether a held-out token has it as its history; and of orders above one the
    place of its history (-1: start marks alone, whose key is `start`) and of its n-gram without the first word."""

    def __init__(self, row: dict, order: int, bits: int):
        self.ids, self.held, self.sizes = row["doc_id"], np.array(row["held"], bool), np.array(row["size"])
        at = unpacked(row["ranked"]).astype(np.int64)[unpacked(row["tokens"]).astype(np.int64)]
        self.document = np.repeat(np.arange(len(self.sizes)), self.sizes)
        unheard = self.held[self.document]
        first = np.zeros(len(at), bool)
        first[np.r_[0, np.cumsum(self.sizes)[:-1]]] = True
        self.keys, self.back, self.n, self.asked = [unpacked_keys(row["vocabulary"])], [at], [], []
        self.history, self.low, self.start = [None], [None], [None]
        word = key = self.keys[0][at]
        start, shift = START, np.uint64(64 - bits)
        self.bits = [64, *[bits] * (order - 1)]
        after = np.flatnonzero(unheard & ~first) - 1
        for k in range(1, order):
            before = np.r_[start, key[:-1]]
            before[first] = start
            key = joint(before, word)
            u, back, one = distinct(key >> shift)
            self.keys.append(u)
            self.history.append(np.where(first[one], -1, self.back[-1][one - 1]))
            self.low.append(self.back[-1][one])
            self.start.append(start if k == 1 else start >> shift)
            self.back.append(back)
            start = joint(np.array([start]), np.array([START]))[0]
        for u, back in zip(self.keys, self.back, strict=True):
            self.n.append(np.bincount(back, ~unheard, len(u)).astype(INT))
            asked = np.zeros(len(u), bool)
            asked[back[after]] = True
            self.asked.append(asked)


def requests(found: DataFrame, parts: int, order: int, bits: int) -> DataFrame:
    """For each block and part the keys of each order, and twice their counts, plus 1 for histories of held-out tokens."""
    fields = [f"{c}{k}" for k in range(order) for c in ("key", "n")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                x = Block(row, order, bits)
                ends = [bounds(u, parts, n) for u, n in zip(x.keys, x.bits, strict=True)]
                value = [2 * n + asked for n, asked in zip(x.n, x.asked, strict=True)]
                columns = [pa.array(range(parts), pa.int32()), pa.array([row["block"]] * parts, pa.string())]
                for u, v, e in zip(x.keys, value, ends, strict=True):
                    columns += [pa.array([f(y[e[p] : e[p + 1]]) for p in range(parts)], pa.binary()) for f, y in ((packed_keys, u), (packed, v))]
                yield pa.RecordBatch.from_arrays(columns, ["part", "block", *fields])

    return found.mapInArrow(run, f"part int, block string, {', '.join(f'{f} binary' for f in fields)}")


def answers(asked: DataFrame, order: int) -> DataFrame:
    """For each part and block, by order, four times the totals asked for, plus 2 for histories of held-out tokens, plus 1 for the owner.

    A row of each part without a block has by order the counts that there are and how many keys have each.
    """
    of = range(order)
    fields = ["block string", "part int", *(f"answer{k} binary" for k in of), *(f"{c}{k} array<long>" for k in of for c in ("count", "types"))]

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("block")
        names, part, n = t.column("block").to_pylist(), t.column("part")[0].as_py(), t.num_rows
        out = {"block": pa.array([*names, None], pa.string()), "part": pa.array([part] * (n + 1), pa.int32())}
        for k in of:
            keys = [unpacked_keys(b.as_py()) for b in t.column(f"key{k}")]
            value = np.concatenate([unpacked(b.as_py()) for b in t.column(f"n{k}")]).astype(INT)
            ends = np.cumsum([len(x) for x in keys])[:-1]
            every = np.concatenate(keys)
            u, back, _ = distinct(every)
            total = np.zeros(len(u), INT)
            np.add.at(total, back, value >> 1)
            held = np.bincount(back, value & 1, len(u)) > 0
            owner = np.full(len(u), len(every), np.int64)
            np.minimum.at(owner, back, np.arange(len(every)))
            answer = 4 * total[back] + 2 * held[back] + ((owner[back] == np.arange(len(every))) & (total[back] > 0))
            count, types = np.unique(total[total > 0], return_counts=True)
            out[f"answer{k}"] = pa.array([*(packed(x) for x in np.split(answer, ends)), None], pa.binary())
            out[f"count{k}"] = pa.array([*[None] * n, count.tolist()], pa.list_(pa.int64()))
            out[f"types{k}"] = pa.array([*[None] * n, types.tolist()], pa.list_(pa.int64()))
        return pa.table({f.split()[0]: out[f.split()[0]] for f in fields})

    return asked.groupBy("part").applyInArrow(run, ", ".join(fields))


def model(tables: DataFrame, documents: int, order: int) -> Model:
    """The counts of counts come to the driver: of N tokens there are sqrt(2 * N) different counts at most."""

    def of(k: int):
        zipped = F.arrays_zip(F.col(f"count{k}").alias("count"), F.col(f"types{k}").alias("types"))
        return F.transform(zipped, lambda x: F.struct(F.lit(k).alias("order"), x["count"].alias("count"), x["types"].alias("types")))

    pairs = F.concat(*map(of, range(order)))
    rows = tables.select(F.inline(pairs)).groupBy("order", "count").agg(F.sum("types").alias("types")).collect()
    types: list[dict[int, int]] = [{r["count"]: r["types"] for r in rows if r["order"] == k} for k in range(order)]
    discounts = tuple(map(good_turing, types))
    tokens = sum(r * n for r, n in types[0].items())
    mass = sum(float(discounts[0](np.array([r]))[0]) * r * n for r, n in types[0].items()) / max(1, tokens)
    return Model(tokens, sum(types[0].values()), documents, discounts, max(1 - mass, 1e-300))


def evaluated(found: DataFrame, answered: DataFrame, m: Model, parts: int, order: int, bits: int, tasks: int) -> DataFrame:
    """Rows of kind 0: documents, with what of their score needs no alpha. Rows of kind 1: a block's share
    of the histories of one order in one part (keys, sums of P(w | shorter), sums of P(w | h)), and the
    unseen n-grams of its documents there (keys of histories, document, number)."""
    plain = T.StructType.fromDDL("held_out boolean, n_tokens long, n_known long, base_score double, score double, part int, a binary, b binary, c binary, d binary, e binary, f binary").fields
    schema = T.StructType([*T.StructType.fromDDL("kind int, block string, at int").fields, T.StructField("doc_id", found.schema["doc_id"].dataType.elementType), *plain])
    kinds = [(f.name, to_arrow_type(f.dataType)) for f in schema.fields]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        tables = []

        def emit(n: int, **given) -> None:
            tables.append(pa.table({name: pa.array(given[name], t) if name in given else pa.nulls(n, t) for name, t in kinds}))

        right = right.sort_by("part")
        for row in left.to_pylist():
            x, docs = Block(row, order, bits), len(row["size"])
            answer = [np.concatenate([unpacked(b.as_py()) for b in right.column(f"answer{k}")]).astype(INT) for k in range(order)]
            total = [a >> 2 for a in answer]
            p = m.unigram(total[0])
            log_p = np.log10(p)
            shares = []
            for k in range(1, order):
                history, low, seen = x.history[k], x.low[k], total[k] > 0
                context = np.where(history < 0, m.documents, total[k - 1][history])
                p_seen = np.where(seen, m.discounts[k](total[k]) * total[k] / np.maximum(context, 1), 0)
                log_p = np.where(seen, np.log10(np.where(seen, p_seen, 1)), log_p[low])
                key = np.where(history < 0, x.start[k], x.keys[k - 1][history])
                wanted = (answer[k] & 1 == 1) & np.where(history < 0, True, answer[k - 1][history] & 2 == 2)
                h, back, _ = distinct(key[wanted])
                sums = [np.bincount(back, v[wanted], len(h)) for v in (p[low], p_seen)]
                gap = np.flatnonzero((~seen & (context > 0))[x.back[k]])
                g, back, _ = distinct(key[x.back[k][gap]])
                pair, times = np.unique(back * docs + x.document[gap], return_counts=True)
                shares.append((h, *sums, g[pair // docs], pair % docs, times))
                p = p_seen
            by_doc = lambda v: np.bincount(x.document, v, docs)  # noqa: E731, B023
            emit(
                docs, kind=[0] * docs, block=[row["block"]] * docs, at=range(docs), doc_id=x.ids, held_out=x.held.tolist(), n_tokens=x.sizes.tolist(),
                n_known=by_doc((total[0] > 0)[x.back[0]]).astype(int).tolist(), base_score=by_doc(m.base(total[0])[x.back[0]]).tolist(), score=by_doc(log_p[x.back[-1]]).tolist(),
            )
            for level, (h, s_low, s_seen, g, at, times) in enumerate(shares):
                e, f = (bounds(y, parts, x.bits[level]) for y in (h, g))
                some = [q for q in range(parts) if e[q] < e[q + 1] or f[q] < f[q + 1]]
                cut = lambda f, v, e: [f(v[e[q] : e[q + 1]]) for q in some]  # noqa: E731, B023
                emit(
                    len(some), kind=[1] * len(some), block=[row["block"]] * len(some), part=[level * parts + q for q in some], a=cut(packed_keys, h, e), b=cut(packed_doubles, s_low, e),
                    c=cut(packed_doubles, s_seen, e), d=cut(packed_keys, g, f), e=cut(packed, at, f), f=cut(packed, times, f),
                )
        return pa.concat_tables(tables)

    asked = answered.select("block", "part", *(f"answer{k}" for k in range(order)))
    return found.repartition(tasks, "block").groupBy("block").cogroup(asked.repartition(tasks, "block").groupBy("block")).applyInArrow(run, schema)


def backoffs(shares: DataFrame) -> DataFrame:
    """(block, at, backoff): the logarithms of alpha that a document's unseen n-grams add.

    A part answers each block in one row, and a block's answers are added up in one group.
    """

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("block")
        column = lambda c, f: [f(b.as_py()) for b in t.column(c)]
        h, back, _ = distinct(np.concatenate(column("a", unpacked_keys)))
        s_low, s_seen = (np.bincount(back, np.concatenate(column(c, unpacked_doubles)), len(h)) for c in "bc")
        alpha = np.log10((1 - s_seen) / (1 - s_low))
        blocks, at, total = [], [], []
        for name, g, d, n in zip(t.column("block").to_pylist(), column("d", unpacked_keys), column("e", unpacked), column("f", unpacked), strict=True):
            if len(g):
                sums = np.bincount(d.astype(np.int64), alpha[np.searchsorted(h, g)] * n.astype(float))
                some = np.unique(d)
                blocks.append(name)
                at.append(packed(some))
                total.append(packed_doubles(sums[some.astype(np.int64)]))
        return pa.table({"block": pa.array(blocks, pa.string()), "at": pa.array(at, pa.binary()), "backoff": pa.array(total, pa.binary())})

    def add(t: pa.Table) -> pa.Table:
        at = np.concatenate([unpacked(b.as_py()) for b in t.column("at")]).astype(np.int64)
        sums = np.bincount(at, np.concatenate([unpacked_doubles(b.as_py()) for b in t.column("backoff")]))
        some = np.unique(at)
        return pa.table({"block": pa.array([t.column("block")[0].as_py()] * len(some), pa.string()), "at": pa.array(some.astype(np.int32)), "backoff": pa.array(sums[some])})

    by_part = shares.groupBy("part").applyInArrow(run, "block string, at binary, backoff binary")
    return by_part.groupBy("block").applyInArrow(add, "block string, at int, backoff double")


def scored(docs: DataFrame, order: int = ORDER, block: int = BLOCK, part: int = PART) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of documents(doc_id, text)."""
    if order < 2:
        raise ValueError("the order must be 2 or more")
    found = kept(blocks(docs, block), "blocks")
    size = F.aggregate("size", F.lit(0).cast("long"), lambda a, n: a + n)
    train = F.size(F.filter("held", lambda h: ~h))
    total, documents, n_blocks = found.agg(F.sum(size), F.sum(train), F.count(F.lit(1))).first()
    shuffled = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(shuffled, -(-(total or 0) // 1024)), -(-(total or 0) // part))
    bits = min(64, (total or 1).bit_length() + SPARE)
    answered = kept(answers(requests(found, parts, order, bits).repartition(max(1, parts), "part"), order), "counts")
    m = model(answered.filter("block IS NULL"), documents or 0, order)
    result = kept(evaluated(found, answered.filter("block IS NOT NULL"), m, parts, order, bits, max(1, min(n_blocks, parts))), "evaluated")
    dropped(found)
    dropped(answered)
    shares = result.filter("kind = 1").select("part", "block", *"abcdef")
    return result.filter("kind = 0").join(backoffs(shares), ["block", "at"], "left").select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(m.tokens).cast("long").alias("train_tokens"), "base_score", (F.col("score") + F.coalesce("backoff", F.lit(0.0))).alias("score")
    )


def op8_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark.read.parquet(f"{sf_dir}/documents.parquet"))
