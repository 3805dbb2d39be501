"""Assembly against one question at a time, step after step."""

import random
from collections import defaultdict
from itertools import groupby

import pytest

from lectern.operators import assembly as A
from lectern.plans import items as P

SF = "/root/testdata/sf0.001"


def one(leaves, needs, room):
    """leaves: label -> (letter, ord, topic, marks, scheme, height); needs: label -> set. label -> (item, filed, reason)."""
    order = sorted(leaves, key=lambda x: leaves[x][1])
    topic, ordinal = {x: leaves[x][2] for x in order}, {x: leaves[x][1] for x in order}
    context = lambda g: set().union(*(needs.get(x, set()) for x in g)) - set(g)
    tall = lambda g: sum(leaves[x][5] for x in context(g) if x in leaves)
    equal = lambda g: sum(leaves[x][3] for x in g) == sum(leaves[x][4] for x in g)

    def by(g):
        out = {}
        for x in g:
            out[topic[x]] = out.get(topic[x], 0) + leaves[x][3]
        return out

    out, units = {}, []
    for _, own in groupby(order, key=lambda x: leaves[x][0]):
        own = list(own)
        bad = [x for x in own if topic[x] is None]
        if len(bad) == len(own):
            out |= {x: (None, None, "out of scope") for x in own}
            continue
        runs = [list(g) for _, g in groupby(own, key=topic.get)]
        if len(runs) == 1:
            units.append((own, topic[own[0]]))
        elif all(not (context(g) & set(own)) and equal(g) and tall(g) <= room for g in runs):
            for g in runs:
                if topic[g[0]] is None:
                    out |= {x: (None, None, "out of scope") for x in g}
                else:
                    units.append((g, topic[g[0]]))
        elif bad:
            out |= {x: (None, None, "not separable") for x in own}
        else:
            b = by(own)
            units.append((own, next(t for t in map(topic.get, own) if b[t] == max(b.values()))))
    items = []
    for t in dict.fromkeys(u[1] for u in units):
        group = [u for u, f in units if f == t]
        whole = [x for u in group for x in u]
        if equal(whole) and tall(whole) <= room:
            items.append((whole, t))
            continue
        chain = []
        for u in group:
            if chain and context(u) & set(chain[-1]):
                chain[-1] = chain[-1] + u
            else:
                chain.append(u)
        items += [(c, t) for c in chain]
    first = lambda i: min(ordinal[x] for x in i[0])
    changed = True
    while changed:
        changed = False
        items.sort(key=first)
        for k, (own, _) in enumerate(items):
            partners = [j for j, (o, _) in enumerate(items) if j != k and context(own) & set(o)]
            group = sorted([k, *partners])
            union = [x for j in group for x in items[j][0]]
            if tall(own) <= room or not partners or not equal(union):
                continue
            b = by(union)
            tops = sorted(t for t in b if b[t] == max(b.values()))
            new = tops[0] if len(tops) == 1 else next((items[j][1] for j in group if items[j][1] in tops), tops[0])
            items = [i for j, i in enumerate(items) if j not in group] + [(union, new)]
            changed = True
            break
    for own, t in items:
        why = "marks" if not equal(own) else "context" if tall(own) > room else None
        out |= {x: (None, None, why) if why else (first((own, t)), t, None) for x in own}
    return out


def brute(leaves, needs, room):
    trees, on = defaultdict(dict), defaultdict(lambda: defaultdict(set))
    for doc, label, *rest in leaves:
        trees[doc][label] = tuple(rest)
    for doc, label, other in needs:
        on[doc][label].add(other)
    return sorted(((doc, x, *r) for doc, t in trees.items() for x, r in one(t, on[doc], room).items()), key=str)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.mark.parametrize("room", [30, 80])
def test_random_questions(spark, room):
    r = random.Random(room)
    leaves, needs = [], []
    for doc in range(120):
        labels, o = [], 0
        for a in "abcd"[: r.randint(1, 4)]:
            for k in ["", "i", "ii", "iii"][1 : 1 + r.randint(1, 3)]:
                marks = r.randint(1, 4)
                leaves.append((doc, f"{a}.{k}", a, o, r.choice([0, 0, 1, 2, None]) if r.random() < 0.6 else 1, marks, marks + (r.random() < 0.05), r.randint(10, 40)))
                labels.append(f"{a}.{k}")
                o += 1
        needs += [(doc, r.choice(labels), r.choice([*labels, "z.i"])) for _ in range(r.randint(0, 5))]
    ldf = spark.createDataFrame(leaves, "doc long, label string, letter string, ord int, topic int, marks long, scheme long, height long")
    ndf = spark.createDataFrame(needs, "doc long, label string, on string")
    assert rows(A.assembled(ldf, ndf, room), "doc", "label", "item", "filed", "reason") == brute(leaves, needs, room)


def test_query_equals_step_by_step(spark):
    leaves, needs = P.question(spark, SF)
    want = brute(rows(leaves, "doc", "label", "letter", "ord", "topic", "marks", "scheme", "height"), rows(needs, "doc", "label", "on"), P.ROOM)
    assert rows(P.item_assembly(spark, SF), "doc", "label", "item", "filed", "reason") == want
    assert {w[4] for w in want} == {None, "out of scope", "not separable", "marks", "context"}
