import hashlib
from collections import Counter, defaultdict

import duckdb
import pytest

from lectern.llm import mixing as m

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, whole int, domain string"


def deal(budget, children):
    """children: name -> (cap, weight); fills by repeated rounds."""
    full = set()
    while True:
        rest, among = budget - sum(children[c][0] for c in full), sum(w for c, (_, w) in children.items() if c not in full)
        new = {c for c, (cap, w) in children.items() if c not in full and cap * among <= rest * w}
        if not new:
            return {c: cap if c in full else rest * w // among for c, (cap, w) in children.items()}
        full |= new


def brute(rows, share, epochs, seed=17):
    docs = []
    for d, text, lang, source, *_ in rows:
        n = int(source[3:]) % 3 if source else None
        domain = {0: "web", 1: "books", 2: "reference", None: "none"}[n]
        docs.append((d, (domain, lang or "none", source or "none"), len((text or "").split())))
    tokens = Counter()
    for _, leaf, n in docs:
        tokens[leaf] += n
    weight = lambda path: m.TREE[len(path) - 1].weights.get(path[-1], 1)
    cap = lambda path: epochs * sum(v for k, v in tokens.items() if k[: len(path)] == path)
    budget = {(): min(sum(tokens.values()) * share[0] // share[1], cap(()))}
    for depth in range(3):
        for parent in {k[:depth] for k in tokens}:
            budget |= deal(budget[parent], {c: (cap(c), weight(c)) for c in {k[: depth + 1] for k in tokens if k[:depth] == parent}})
    out, by = [], defaultdict(list)
    for x in docs:
        by[x[1]].append(x)
    for leaf, xs in by.items():
        whole, rest = divmod(budget[leaf], tokens[leaf]) if tokens[leaf] else (0, 0)
        key = lambda d: hashlib.md5(f"{seed}:{whole}:{'' if d is None else d}".encode()).hexdigest()  # noqa: E731, B023
        sums = Counter()
        for d, _, n in xs:
            sums[key(d)] += n
        inside, total = set(), 0
        for k in sorted(sums):
            total += sums[k]
            if rest and total <= rest:
                inside.add(k)
        out += [(str(d), *leaf, n, budget[leaf], whole + (key(d) in inside)) for d, _, n in xs]
    return sorted(out)


ROWS = [(i, "w " * (i % 37), ("en", "de", "fr", None)[i % 4], f"src{i % 7}" if i % 11 else None, 1, 2, "x") for i in range(400)] + [(1, "w w", "de", "src1", 0, 0, "")] * 3 + [(None, None, None, None, None, None, None)] * 2


@pytest.mark.parametrize(("share", "epochs"), [((3, 5), 2), ((9, 5), 2), ((1, 1), 1), ((5, 1), 3), ((0, 1), 1)])
def test_copies_equal_brute_force(spark, share, epochs):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    got = m.mixed(docs, share=share, epochs=epochs).collect()
    found = sorted((str(r.doc_id), r.domain, r.lang, r.source, r.n_tokens, r.leaf_budget, r.copies) for r in got)
    assert found == brute(ROWS, share, epochs)
    if share == (3, 5):
        again = Counter(str(r.doc_id) for r in m.resampled(docs).collect())
        want = Counter()
        for d, *_, c in found:
            want[d] += c
        assert again == +want and m.resampled(docs).columns == docs.columns


def test_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert sorted(map(tuple, m.op1_budget_tree(spark, sf).collect())) == sorted(con.execute(m.ORACLES["op1_budget_tree"]).fetchall())


def test_empty(spark):
    assert m.mixed(spark.createDataFrame([], SCHEMA)).count() == 0
