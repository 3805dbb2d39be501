"""Grey pages, one row each: key columns and a page of height x width bytes. numpy in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def runs(flags: np.ndarray, join: int = 0) -> list[tuple[int, int]]:
    """[start, end) of runs of true, joined where join or fewer places lie between."""
    edges = np.flatnonzero(np.diff(np.r_[0, flags.astype(np.int8), 0]))
    out: list[tuple[int, int]] = []
    for a, b in edges.reshape(-1, 2).tolist():
        if out and a - out[-1][1] <= join:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def ink_rows(page: np.ndarray, dark: int = 160, join: int = 2, white: tuple[tuple[int, int, int, int], ...] = ()) -> list[tuple[int, int]]:
    """Runs of rows with ink, areas (y0, x0, y1, x1) in white left out."""
    ink = page < dark
    for y0, x0, y1, x1 in white:
        ink[y0:y1, x0:x1] = False
    return runs(ink.any(1), join)


def dotted(rows: np.ndarray, dark: int = 160, least: int = 10) -> bool:
    """Whether a strip is a row of dots: many narrow runs, evenly apart."""
    found = runs((rows < dark).any(0))
    if len(found) < least:
        return False
    steps = np.diff([a for a, _ in found])
    return max(b - a for a, b in found) <= 4 and float(np.median(abs(steps - np.median(steps)))) <= 1


def difference(a: np.ndarray, b: np.ndarray, reach: int = 2, dark: int = 160) -> int:
    """Ink of either page that the other lacks within a pixel, at the best of (2 * reach + 1) ** 2 shifts."""
    x, y = a < dark, b < dark
    grow = lambda m: np.logical_or.reduce([np.roll(np.roll(m, i, 0), j, 1) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    wide_x, best = grow(x), None
    for i in range(-reach, reach + 1):
        for j in range(-reach, reach + 1):
            z = np.roll(np.roll(y, i, 0), j, 1)
            n = int((x & ~grow(z)).sum() + (z & ~wide_x).sum())
            best = n if best is None else min(best, n)
    return best or 0


def by_page(pages: DataFrame, keys: list[str], f: Callable[[np.ndarray], list[tuple[int, int]]]) -> DataFrame:
    """keys, start and end of what f finds on each page(keys..., height, width, pixels)."""
    kinds = dict(pages.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for r in b.to_pylist():
                page = np.frombuffer(r["pixels"], np.uint8).reshape(r["height"], r["width"]).copy()
                rows += [{**{k: r[k] for k in keys}, "start": s, "end": e} for s, e in f(page)]
            if rows:
                fields = [b.schema.field(k) for k in keys] + [pa.field("start", pa.int64()), pa.field("end", pa.int64())]
                yield pa.RecordBatch.from_pylist(rows, pa.schema(fields))

    return pages.select(*keys, "height", "width", "pixels").mapInArrow(run, ", ".join(f"{k} {kinds[k]}" for k in keys) + ", start long, end long")
