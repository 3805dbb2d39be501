import random
from collections import Counter

import numpy as np

from lectern.llm import decontaminate as d


def brute(text, item):
    """Similarity of the most similar window of the item's length."""
    w, b = d.tokens(text), d.tokens(item)
    k = min(5, len(b))
    grams = lambda x: Counter(tuple(x[i : i + k]) for i in range(len(x) - k + 1))
    if not b:
        return 0.0
    size, best = min(len(b), len(w)), 0.0
    for i in range(len(w) - size + 1):
        x, y = grams(w[i : i + size]), grams(b)
        if x and y:
            best = max(best, (x & y).total() / (x | y).total())
    return best


def corpus():
    r = random.Random(11)
    words = [f"w{i}" for i in range(150)]
    items = [(i, " ".join(r.choices(words, k=r.randint(12, 55)))) for i in range(25)] + [(90, "short item"), (91, ""), (92, None), (93, "short item")]
    docs = []
    for i in range(70):
        text = r.choices(words, k=r.randint(0, 120))
        if i % 2:
            passage = r.choice(items[:25])[1].split()
            for _ in range(i % 4):
                passage[r.randrange(len(passage))] = "changed"
            at = r.randrange(len(text) + 1)
            text[at:at] = passage
        docs.append((i, " ".join(text) if i % 3 else ", ".join(text).upper()))
    docs += [(200, None), (201, ""), (202, items[3][1]), (203, " ".join(items[3][1].split()[1:])), (203, " ".join(items[3][1].split()[1:])), (204, "A Short, item!"), (205, (items[5][1] + " x ") * 12)]
    return docs, items


def test_pairs_equal_brute_force(spark):
    docs, items = corpus()
    got = d.contaminated(
        spark.createDataFrame([(*x, "en") for x in docs], "doc_id long, text string, item_id string"),
        spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, doc_id int"),
    ).collect()
    want = sorted((i, j, round(s, 9)) for i, t in docs for j, b in items if (s := brute(t, b)) >= 0.8)
    assert sorted((r.doc_id, r.item_id, round(r.similarity, 9)) for r in got) == want
    assert len(want) > 6 and all(r.distance <= d.RADIUS for r in got)


def test_parts_and_filter(spark):
    docs, items = corpus()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = [m for _, t in docs for m in d.Benchmark(items).matches(t)]
    some = list(d.parts(benchmark, 1000))
    split = [m for _, t in docs for p in some for m in p.matches(t)]
    assert sorted(whole) == sorted(split)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bad = {i for i, t in docs for j, b in items if brute(t, b) >= 0.8}
    assert sorted(r.doc_id for r in d.decontaminated(frame, benchmark).collect()) == sorted(i for i, _ in docs if i not in bad)
    assert d.contaminated(frame.limit(0), benchmark).count() == 0
    assert d.contaminated(frame, benchmark.limit(0)).count() == 0


def test_multi_index_finds_all_within_radius():
    r = np.random.default_rng(2)
    prints = r.integers(0, 2**63, 300, dtype=np.uint64)
    queries = prints[:60].copy()
    for i in range(60):
        for b in r.integers(0, 64, i // 2):
            queries[i] ^= np.uint64(1 << int(b))
    want = {(q, i) for q in range(60) for i in range(300) if int(queries[q] ^ prints[i]).bit_count() <= 20}
    assert {(q, i) for q, i, _ in d.MultiIndex(prints).near(queries)} == want


def test_index_prunes_and_recall_of_planted_changes():
    """Of random items few are candidates; of windows changed down to a similarity of 0.8 hardly any is beyond the radius."""
    import random

    import numpy as np

    r = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    items = [r.choices(words, k=r.choice((40, 60, 90))) for _ in range(400)]
    prints = np.array([d.window_fingerprints(d.shingle_hashes(w, 5), len(w) - 4)[0] for w in items], np.uint64)
    index = d.MultiIndex(prints)
    queries = np.random.default_rng(4).integers(0, 2**63, 200, dtype=np.uint64)
    assert sum(len(index.candidates(q)) for q in queries) < 0.25 * len(prints) * len(queries)
    want = found = 0
    for n, w in enumerate(items):
        for _ in range(6):
            x = list(w)
            for _ in range(r.randint(1, 3)):
                x[r.randrange(len(x))] = "changed"
            a, b = ({tuple(y[i : i + 5]) for i in range(len(y) - 4)} for y in (w, x))
            if len(a & b) / len(a | b) >= 0.8:
                want += 1
                q = d.window_fingerprints(d.shingle_hashes(x, 5), len(x) - 4)
                found += any(i == n for _, i, _ in index.near(q))
    assert want > 500 and found >= 0.995 * want
