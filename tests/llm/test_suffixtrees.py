import random

import duckdb
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from lectern.llm import suffixtrees as x

SF = "/root/testdata/sf0.001"


def brute(rows, n=13):
    """(doc_id, words, kept text, spans) of each row, by a table of all windows."""
    last = (1, "")
    key = lambda d: last if d is None else (0, d)
    first, out = {}, []
    split = [(d, (t or "").encode().split()) for d, t in rows]
    for d, w in split:
        for i in range(len(w) - n + 1):
            s = tuple(w[i : i + n])
            first[s] = min(first.get(s, key(d)), key(d))
    for d, w in split:
        gone = set()
        for i in range(len(w) - n + 1):
            if first[tuple(w[i : i + n])] < key(d):
                gone |= set(range(i, i + n))
        starts = [i for i in sorted(gone) if i - 1 not in gone]
        ends = [i + 1 for i in sorted(gone) if i + 1 not in gone]
        out.append((d, len(w), b" ".join(y for i, y in enumerate(w) if i not in gone).decode(), list(zip(starts, ends, strict=True))))
    return sorted(out, key=str)


def got(df, **more):
    return sorted(((r.doc_id, r.n_words, r.kept_text, [tuple(s) for s in r.removed]) for r in x.marked(df, **more).collect()), key=str)


def test_query_equals_sql(spark):
    want = duckdb.sql(x.ORACLES["op11_prefix_suffix_trees"].replace("FROM documents", f"FROM '{SF}/documents.parquet'")).fetchall()
    assert sorted(map(tuple, x.op11_prefix_suffix_trees(spark, SF).collect())) == sorted(want)


def made(r, size):
    """Texts with copies, passages in nearly all of them, runs of one word, odd white space and other letters."""
    words = [f"wort{i}" for i in range(30)] + ["straße", "日本", "a"]
    passage, line = r.choices(words, k=25), ["a"] * 40
    rows = []
    for i in range(size):
        w = r.choices(words, k=r.randint(0, 60))
        kind = r.random()
        if kind < 0.4:
            at = r.randint(0, len(w))
            w[at:at] = passage[r.randint(0, 5) :]
        elif kind < 0.5:
            w += line[: r.randint(5, 40)]
        elif kind < 0.7 and rows:
            w = (r.choice(rows)[1] or "").split()
            if w and r.random() < 0.5:
                w[r.randrange(len(w))] = "new"
        rows.append((i, r.choice([" ", "\n\t", "\x0b"]).join(w)))
    return rows + [(size, None), (size + 1, ""), (size + 2, " \n"), (size + 3, "one")]


@pytest.mark.parametrize(("block", "group", "seed"), [(8 << 20, 200_000, 1), (2_000, 5, 2), (500, 1, 3)])
def test_equals_brute_force(spark, block, group, seed):
    r = random.Random(seed)
    rows = made(r, 250)
    rows += [rows[3], rows[3], (3, rows[5][1]), (None, rows[6][1]), (None, rows[6][1]), (None, " ".join(f"n{i}" for i in range(30)))]
    r.shuffle(rows)
    df = spark.createDataFrame([Row(doc_id=d, text=t, block=1, given="g", rank=2.0) for d, t in rows], "doc_id long, text string, block int, given string, rank double").repartition(4)
    assert got(df, block=block, group=group) == brute(rows)


def test_string_ids_other_lengths_and_a_long_text(spark):
    r = random.Random(9)
    rows = [(f"d{d:04}", t) for d, t in made(r, 60)] + [("z", " ".join(r.choices("abc", k=50_000)))]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    assert got(df, n=5, block=4_000, group=20) == brute(rows, 5)
    assert got(df.limit(0)) == []


def test_prefixes_are_short_for_rare_and_long_for_common_beginnings(spark):
    r = random.Random(4)
    same = bytes(13)
    rows = [(same + i.to_bytes(8, "big"),) for i in range(50)] + [(bytes([r.randrange(1, 256)]) + r.randbytes(20),) for _ in range(200)]
    found = x.prefixed(spark.createDataFrame(rows, "suffix binary"), 13, 10)
    sizes = found.groupBy("prefix").agg(F.count(F.lit(1)).alias("n"), F.max(F.length("prefix")).alias("bytes")).collect()
    assert {(s.n, s.bytes) for s in sizes if s.n > 10} == {(50, 13)}
    assert all(s.bytes <= 2 for s in sizes if s.n <= 10)
    assert found.count() == 250


def test_packing_round_trip():
    import numpy as np

    for n in (0, 1, 1000):
        a = np.unique(np.random.default_rng(n).integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
        assert (x.unpacked(x.packed(a)) == a).all()
