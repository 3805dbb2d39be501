import random

import corpus_pipeline
from lectern.llm import nearcopies as n

SF = "/root/testdata/sf0.01"


def brute_stays(rows):
    """The least doc_id of each group of texts linked by a Jaccard similarity of 0.8 or more of five-word shingles."""
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) or frozenset([tuple(w)]))
    distinct = sorted(set(sets), key=len)
    of = list(range(len(distinct)))

    def root(i):
        while of[i] != i:
            i = of[i]
        return i

    for j, b in enumerate(distinct):
        for i in range(j):
            a = distinct[i]
            if 5 * len(a) >= 4 * len(b) and 9 * len(a & b) >= 4 * (len(a) + len(b)):
                of[root(j)] = root(i)
    at, least = {s: root(i) for i, s in enumerate(distinct)}, {}
    for (d, _), s in zip(rows, sets, strict=True):
        least[at[s]] = min(least.get(at[s], d), d)
    return sorted(least.values())


def test_stage_equals_brute_force_jaccard(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()) == brute_stays(rows)


def test_groups_around_the_limit(spark):
    r = random.Random(3)
    words, line = [f"w{i}" for i in range(400)], "a line that all of them have in common here"
    rows = [(i, f"{' '.join(r.choices(words, k=r.randint(0, 60)))} {line}") for i in range(60)]
    for i in range(60, 240):
        w = r.choice(rows)[1].split()
        for _ in range(r.randint(0, 2)):
            w[r.randrange(len(w))] = r.choice(words)
        rows.append((i, " ".join(w).upper()))
    rows += [(300, ""), (301, None), (302, " \n"), (303, "a"), (304, "A"), (305, "a b c d"), (306, "a b c d e")]
    docs = spark.createDataFrame([(*x, i) for i, x in enumerate(rows)], "doc_id long, text string, n_chars int")
    old, n.COMMON = n.COMMON, 2
    try:
        got = n.deduplicated(docs)
        assert got.columns == docs.columns
        assert sorted(x.doc_id for x in got.collect()) == brute_stays(rows)
        assert n.deduplicated(docs.limit(0)).count() == 0
    finally:
        n.COMMON = old


def test_pairs_of_a_large_group_stay_few(spark, monkeypatch):
    """Copies of one text, changed at one to five places, and texts that only share a passage: right groups, and few of all pairs leave a join."""
    r = random.Random(11)
    base, line = [f"b{i}" for i in range(120)], " ".join(f"c{i}" for i in range(12))
    rows = []
    for i in range(360):
        w = list(base)
        for _ in range(r.randint(2, 5)):
            w[r.randrange(len(w))] = f"x{r.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    rows += [(400 + i, f"{' '.join(f'y{r.randrange(10**6)}' for _ in range(20))} {line}") for i in range(120)]
    rows += [(600, " ".join(base)), (601, line)]
    met, linked = [], n.linked
    monkeypatch.setattr(n, "linked", lambda pairs, *more: met.append(pairs.distinct().count()) or linked(pairs, *more))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(x.doc_id for x in n.deduplicated(docs).collect()) == brute_stays(rows)
    assert sum(met) < 5_000, met
