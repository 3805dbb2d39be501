"""The ordered closure against a worklist, one task at a time."""

import random
from collections import defaultdict

import pytest

from lectern.operators import context as C
from lectern.plans import closures as P

SF = "/root/testdata/sf0.001"


def worklist(units, parts, edges):
    """(site, kind, depth, dep) of a task's context by one queue; parts: label to (ord, intro), edges by text."""
    order = {x: o for x, (o, _) in parts.items()}
    romans = defaultdict(list)
    for x in sorted(parts, key=order.get):
        if "." in x:
            romans[x.split(".")[0]].append(x)
    letter = lambda x: x.split(".")[0]
    covers = lambda c, x: x == c or x.startswith(c + ".")
    units = sorted(units, key=order.get)
    intros = sorted({letter(u) for u in units if u != letter(u) and parts[letter(u)][1]})
    leaves = [x for x in sorted(parts, key=order.get) if x not in romans]
    first = order[units[0]]
    before = [x for x in leaves if order[x] < first]

    def texts(site):
        if site.endswith(C.INTRO):
            return [site]
        found = [(order[site], site)] + [(order[r], r) for r in romans.get(site, [])]
        if parts[site][1]:
            found.append((order[site], site + C.INTRO))
        return [t for _, t in sorted(found)]

    queue = [("", 0)] + [(i + C.INTRO, 0) for i in intros]
    for u in units:
        queue += [(t, 0) for t in texts(u) if (t, 0) not in queue]
    context = []
    shown = lambda x, more=(): any(c in (x, *more) or (not c.endswith(C.INTRO) and covers(c, x)) for c, *_ in context)
    while queue:
        text, depth = queue.pop(0)
        own = edges.get(text, [])
        asks = any(k == "part" for k, *_ in own)
        for kind, n, name, dst, alone in sorted(own, key=lambda e: (C.KINDS.index(e[0]), e[1], e[2])):
            if kind == "exhibit" and dst is None:
                return [(name, "missing", depth + 1, False)]
            if kind == "own":
                if asks or not before:
                    continue
                dst = before[-1]
            if dst not in parts or any(covers(u, dst) for u in units):
                continue
            if kind != "own" and dst in intros or kind == "part" and dst in {letter(u) for u in units}:
                continue
            if kind in ("part", "label") and order[dst] > first:
                continue
            site = name if alone and kind == "exhibit" else dst + C.INTRO if kind == "label" and dst in romans else dst
            more = () if kind in ("part", "own") else (dst + C.INTRO, *((name,) if alone and kind == "exhibit" else ()))
            if shown(dst, more):
                continue
            context.append((site, kind, depth + 1))
            if site != name or kind != "exhibit" or not alone:
                queue += [(t, depth + 1) for t in texts(site)]
    deps = {s for s, k, _ in context if k in ("part", "own")}
    out = list(context)
    for site, _, depth in sorted(context, key=lambda c: c[2]):
        i = letter(site) + C.INTRO
        if "." in site and parts.get(letter(site), (0, False))[1] and letter(site) not in intros and letter(site) not in units and i not in {s for s, *_ in out}:
            out.append((i, "introduction", depth))
    return [(s, k, d, any(covers(s, x) for x in deps)) for s, k, d in out]


def brute(units, parts, edges):
    by = defaultdict(lambda: defaultdict(list))
    for doc, src, kind, n, name, dst, alone in edges:
        by[doc][src].append((kind, n, name, dst, alone))
    tree, tasks = defaultdict(dict), defaultdict(list)
    for doc, label, o, intro in parts:
        tree[doc][label] = (o, intro)
    for task, doc, label in units:
        tasks[task, doc].append(label)
    return sorted((task, *r) for (task, doc), own in tasks.items() for r in worklist(own, tree[doc], by[doc]))


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def got(spark, units, parts, edges):
    found = C.context(
        spark.createDataFrame(units, "task string, doc long, label string"),
        spark.createDataFrame(parts, "doc long, label string, ord int, intro boolean"),
        spark.createDataFrame(edges, "doc long, src string, kind string, n int, name string, dst string, alone boolean"),
    )
    return sorted(rows(found, "task", "site", "kind", "depth", "dep"))


@pytest.mark.parametrize("seed", range(3))
def test_random_graphs(spark, seed):
    r = random.Random(seed)
    units, parts, edges = [], [], []
    for doc in range(60):
        labels, o = [], 0
        for a in "abcd"[: r.randint(1, 4)]:
            inner = r.choice([0, 0, 2, 3])
            parts.append((doc, a, o, bool(inner) and r.random() < 0.6))
            labels.append(a)
            o += 1
            for k in ("i", "ii", "iii")[:inner]:
                parts.append((doc, f"{a}.{k}", o, False))
                labels.append(f"{a}.{k}")
                o += 1
        sources = ["", *labels, *(f"{p[1]}{C.INTRO}" for p in parts if p[0] == doc and p[3])]
        printed = {f"T{k}": (None if r.random() < 0.1 else r.choice([*labels, ""]), r.random() < 0.5) for k in range(4)}
        for src in sources:
            for n in range(r.choice([0, 1, 1, 2, 3])):
                kind = r.choice(C.KINDS)
                name = r.choice(list(printed)) if kind == "exhibit" else f"x{r.randint(1, 3)}"
                dst, alone = printed.get(name, (None if kind == "own" else r.choice([*labels, "z", "", "a.x"]), False))
                edges.append((doc, src, kind, n, name, dst, alone))
        for t in range(3):
            units += [(f"{doc}-{t}", doc, u) for u in r.sample(labels, min(len(labels), r.choice([1, 1, 2])))]
    assert got(spark, units, parts, edges) == brute(units, parts, edges)


def test_query_equals_worklist(spark):
    units, parts, edges = P.question(P.parts(spark, SF))
    want = brute(rows(units, "task", "doc", "label"), rows(parts, "doc", "label", "ord", "intro"), rows(edges, "doc", "src", "kind", "n", "name", "dst", "alone"))
    assert sorted(rows(P.context_closure(spark, SF), "task", "site", "kind", "depth", "dep")) == want


def test_no_references(spark):
    assert got(spark, [("t", 1, "a")], [(1, "a", 0, False)], []) == []
