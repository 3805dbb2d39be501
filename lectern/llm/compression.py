"""Quality by compression: which of two zstandard dictionaries, one trained on good and one on bad
labelled texts, makes a text smaller.

Texts are compressed whole, in blocks of BLOCK bytes so that the dictionary and not the text's own
past decides, once with each dictionary. The difference of the two sizes over the plain size is the
evidence, and the only one: a text of a few words said again and again is small under either
dictionary, so its difference is near nothing, as it is not of good texts. Isotonic regression on
labelled rows outside the dictionaries' samples turns the evidence into a probability, with one
hundredth of a logistic fit to tell apart what it gives equal values.

The model comes from a bounded sample: for each label the `per_label` labels of lowest hash, one
third of them for the fit, and for a dictionary the `blocks` blocks of lowest hash of the whole texts
of the others. Only these blocks and counts of rounded evidence come to the driver.

Defined results: null and empty texts get the score of zero evidence; a null doc_id counts as the
empty string for the hold-out; rows of a doc_id with two different labels are not learnt from; if
a label has no rows, every score is the share of label 1 (0.5 without labels); equal rows stay
rows of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm._common import kept

BLOCK, LEVEL, DICTIONARY = 1024, 3, 110_000
#: Evidence is counted in steps of so much for the fit.
STEP = 0.002


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(5))


def split(text: bytes, size: int = BLOCK) -> list[bytes]:
    return [text[i : i + size] for i in range(0, len(text), size)]


def dictionary(blocks: list[bytes], size: int = DICTIONARY) -> bytes:
    """A trained dictionary, or the blocks themselves where they are too few to train one."""
    try:
        return zstandard.train_dictionary(size, blocks).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[-size:]


@dataclass
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, ...] = ()
    knots: tuple[tuple[float, ...], tuple[float, ...]] = ((0.0,), (0.5,))
    share: float = 0.5

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_compressors"}

    @cached_property
    def _compressors(self):
        found = []
        for data in (self.good, self.bad):
            d = zstandard.ZstdCompressionDict(data)
            d.precompute_compress(level=LEVEL)
            found.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_dict_id=False, write_checksum=False))
        return found

    def sizes(self, text: bytes) -> tuple[int, int]:
        blocks = split(text)
        good, bad = (sum(map(len, map(c.compress, blocks))) for c in self._compressors)
        return good, bad

    def evidence(self, text: bytes) -> float:
        """The normalised size difference, above 0 if the good dictionary wins."""
        if not text:
            return 0.0
        good, bad = self.sizes(text)
        return (bad - good) / len(text)

    def score(self, text: bytes) -> float:
        if not self.weights:
            return self.share
        e = self.evidence(text)
        smooth = 1 / (1 + np.exp(-np.clip(self.weights[0] + self.weights[1] * e, -50, 50)))
        return float(0.99 * np.interp(e, *self.knots) + 0.01 * smooth)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> tuple[float, ...]:
    """Weights (the constant first) by Newton's method on standardised columns, given back in the units of x."""
    mean = np.average(x, 0, weight)
    spread = np.maximum(np.sqrt(np.average((x - mean) ** 2, 0, weight)), 1e-9)
    a = np.c_[np.ones(len(x)), (x - mean) / spread]
    b = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        step = np.linalg.solve((a.T * (weight * p * (1 - p))) @ a + ridge * np.eye(len(b)), a.T @ (weight * (y - p)) - ridge * b)
        b += step
        if abs(step).max() < 1e-8:
            break
    slopes = b[1:] / spread
    return (float(b[0] - slopes @ mean), *map(float, slopes))


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[tuple[float, ...], tuple[float, ...]]:
    """Knots of the non-decreasing function of x nearest to y: the mean of x and y in each run of equal values."""
    runs: list[list[float]] = []  # weight, weight * x, weight * y
    for i in np.argsort(x, kind="stable"):
        runs.append([weight[i], weight[i] * x[i], weight[i] * y[i]])
        while len(runs) > 1 and runs[-2][2] * runs[-1][0] >= runs[-1][2] * runs[-2][0]:
            last = runs.pop()
            runs[-1] = [a + b for a, b in zip(runs[-1], last, strict=True)]
    return tuple(float(r[1] / r[0]) for r in runs), tuple(float(r[2] / r[0]) for r in runs)


def fit(docs: DataFrame, labels: DataFrame, per_label: int = 1200, blocks: int = 2048) -> Model:
    """Learn from labels(doc_id, quality) outside the hold-out; per_label and blocks bound the sample."""
    known = (
        labels.filter((fold(F.col("doc_id")) != 0) & F.col("quality").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
        .filter("quality = other")
        .select(F.col("doc_id").alias("id"), "quality", F.xxhash64("doc_id").alias("h"))
    )
    n = {r[0]: r[1] for r in known.groupBy("quality").count().collect()}
    share = n.get(1, 0) / sum(n.values()) if n else 0.5
    some = reduce(DataFrame.unionByName, (known.filter(F.col("quality") == q).orderBy("h", "id").limit(per_label) for q in (0, 1)))
    sample = kept(
        docs.select("doc_id", "text")
        .join(F.broadcast(some), F.col("doc_id") == F.col("id"))  # 2 * per_label rows
        .filter(F.octet_length("text") > 0)
        .select("quality", (F.pmod("h", F.lit(3)) == 0).alias("fits"), "text")
        .distinct(),
        "labelled",
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for quality, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                parts = split(text.encode())
                yield pa.RecordBatch.from_arrays([pa.array([quality] * len(parts), pa.int32()), pa.array(parts, pa.binary())], ["quality", "block"])

    pieces = sample.filter("NOT fits").select(F.col("quality").cast("int").alias("quality"), "text").mapInArrow(cut, "quality int, block binary")
    chosen = {q: [r[0] for r in pieces.filter(F.col("quality") == q).orderBy(F.xxhash64("block"), "block").select("block").limit(blocks).collect()] for q in (0, 1)}
    if not all(chosen.values()):
        return Model(b"", b"", share=share)
    model = Model(dictionary([bytes(x) for x in chosen[1]]), dictionary([bytes(x) for x in chosen[0]]), share=share)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            steps = [round(model.evidence(t.encode()) / STEP) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(steps, pa.int32())], ["quality", "step"])

    counts = sample.filter("fits").select(F.col("quality").cast("int").alias("quality"), "text").mapInArrow(weigh, "quality int, step int").groupBy("quality", "step").count().collect()
    y, x, m = (np.array([r[i] for r in counts], float) for i in range(3))
    if len(set(y)) < 2:
        return Model(b"", b"", share=share)
    for q, part in ((1, share), (0, 1 - share)):
        m[y == q] *= part / m[y == q].sum()
    model.weights = logistic(x[:, None] * STEP, y, m * sum(r[2] for r in counts))
    model.knots = isotonic(x * STEP, y, m)
    return model


def scored(docs: DataFrame, model: Model, least: float = 0.3) -> DataFrame:
    """documents(doc_id, text) with held_out, score and predicted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = np.array([model.score((t or "").encode()) for t in b.column(2).to_pylist()], float)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(s), pa.array((s >= least).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"]
            )

    rows = docs.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "text")
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, model: Model, least: float = 0.3) -> DataFrame:
    """The rows of docs, with all their columns, whose text scores least or more."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([model.score((t or "").encode()) >= least for t in b.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op7_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return scored(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
