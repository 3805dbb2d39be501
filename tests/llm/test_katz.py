import random
import zlib
from collections import Counter
from functools import cache
from math import isclose, log10

import pytest

from lectern.llm import katz as k


def brute(rows, order=3):
    """Scores by plain dictionaries and plain recursion, and the model as a function of a word and its history."""
    split = [(d, zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1, [w.decode() for w in (t or "").encode().lower().split()] + ["</s>"]) for d, t in rows]
    grams, context = [Counter() for _ in range(order)], Counter()
    for _, held, w in split:
        if not held:
            padded = ["<s>"] * (order - 1) + w
            for i in range(order - 1, len(padded)):
                for n in range(order):
                    grams[n][tuple(padded[i - n : i + 1])] += 1
                    if n:
                        context[tuple(padded[i - n : i])] += 1
    total, types = grams[0].total(), len(grams[0])
    d = [k.good_turing(Counter(g.values())) for g in grams]
    unknown = 1 - sum(float(d[0](x)) * x for x in grams[0].values()) / max(1, total)
    follow = {}
    for g in grams[1:]:
        for x in g:
            follow.setdefault(x[:-1], []).append(x[-1])

    @cache
    def alpha(h):
        seen = follow[h]
        return (1 - sum(prob(b, h) for b in seen)) / (1 - sum(prob(b, h[1:]) for b in seen))

    @cache
    def prob(w, h):
        n = len(h)
        if not n:
            return float(d[0](grams[0][w,])) * grams[0][w,] / total if grams[0][w,] else unknown
        r = grams[n][*h, w]
        if r:
            return float(d[n](r)) * r / context[h]
        return (alpha(h) if context[h] else 1) * prob(w, h[1:])

    out = []
    for i, held, w in split:
        base = sum(log10((grams[0][x,] + 0.5) / (total + 0.5 * (types + 1))) for x in w)
        padded = ["<s>"] * (order - 1) + w
        score = sum(log10(prob(x, tuple(padded[j : j + order - 1]))) for j, x in enumerate(w))
        out.append((str(i), held, len(w), sum(grams[0][x,] > 0 for x in w), total, base, score))
    return sorted(out), prob, [w for w, in grams[0]], list(context)


def rows(n=90):
    r = random.Random(4)
    words = [f"w{i}" for i in range(40)]
    out = [(i, " ".join(r.choices(words, [1 / (j + 1) for j in range(40)], k=r.randint(0, 40)) + ["new"] * (i % 9 == 0))) for i in range(n)]
    return out + [(500, None), (501, ""), (None, "w1 W2\nw3"), (None, "w1 W2\nw3"), (502, "É é only here"), (503, "w0 w1 " * 4000)]


@pytest.mark.parametrize(("order", "block", "part"), [(3, 1 << 20, 1 << 22), (3, 100, 1000), (2, 300, 500), (4, 400, 700)])
def test_scores_equal_brute_force(spark, order, block, part):
    docs = spark.createDataFrame([(*x, 0.0) for x in rows()], "doc_id long, text string, score double")
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in k.scored(docs, order, block, part).collect())
    want, *_ = brute(rows(), order)
    assert [x[:5] for x in got] == [x[:5] for x in want]
    assert all(isclose(a, b, rel_tol=1e-9) for x, y in zip(got, want) for a, b in zip(x[5:], y[5:]))


def test_probabilities_add_up_to_one():
    _, prob, words, histories = brute(rows(30))
    for h in histories[:30]:
        assert isclose(sum(prob(w, h) for w in words) + prob("never seen", h), 1, rel_tol=1e-9)


def test_string_keys(spark):
    docs = spark.createDataFrame([("a", "x y x y"), ("b", "x y z"), (None, None)], "doc_id string, text string")
    assert sorted(str(r.doc_id) for r in k.scored(docs).collect()) == ["None", "a", "b"]


def test_empty_and_untrained(spark):
    assert k.scored(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 1)
    (r,) = k.scored(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0)
