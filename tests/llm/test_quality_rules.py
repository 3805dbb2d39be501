import re
from collections import Counter

from lectern.llm import quality_rules as q

DOCS = [
    (0, None), (1, ""), (2, " \t\n"), (3, "a b c d e a b c d e"), (4, "x " * 400), (5, "one two three four"),
    (6, "line one\nline one\n \n\nline two\r\nline one"), (7, "#*$%&|<> ÄÖ ü é"), (8, "a b c d e f a b c d e q a b c d e\n" * 3),
    (9, " ".join(f"w{i}" for i in range(3000)) + " w0 w1 w2 w3 w4"), (None, "Good words here, all of them. " * 1), (3, "a b c d e a b c d e"),
]
WORD = "".join(chr(97 + k % 26) for k in range(200))
DOCS += [(100 + i, " ".join(WORD[i + k : i + k + 3 + k // 20] + "." * (k % 9 == 8) for k in range(60))) for i in range(40)]
DOCS += [(200 + i, " ".join(WORD[i + k : i + k + 3 + k // 20] + "$$$" for k in range(60))) for i in range(8)]


def base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if n[tuple(w[i : i + 5])] > 1 for k in range(5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_counts_equal_brute_force_and_votes_separate(spark):
    docs = spark.createDataFrame([(*r, -1) for r in DOCS], "doc_id long, text string, n_words long")
    got = q.judged(docs).collect()
    row = lambda i, b: (i if i is not None else -1, *b)
    assert sorted(row(r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in got) == sorted(row(i, base(t)) for i, t in DOCS)
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)
        if r.doc_id and 100 <= r.doc_id < 140:
            assert r.kept and r.quality > 0.5
        if r.doc_id and r.doc_id >= 200:
            assert not r.kept


def test_empty(spark):
    assert q.judged(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def plain_em(n, rules, rounds):
    """Share of good and rates by rule, written as loops over the patterns n."""
    good = {p: (0.98, 0.5, 0.05)[min(2, p.count(-1))] for p in n}
    for i in range(rounds + 1):
        share = (sum(n[p] * good[p] for p in n) + 1) / (sum(n.values()) + 2)
        rate = []
        for prior, w in ((0.5, {p: n[p] * (1 - good[p]) for p in n}), (0.02, {p: n[p] * good[p] for p in n})):
            rate.append([(sum(w[p] for p in n if p[j] == -1) + 10 * prior) / (sum(w[p] for p in n if p[j]) + 10) for j in range(rules)])
        b, g = rate
        for p in n:
            like = [share, 1 - share]
            for j, v in enumerate(p):
                if v:
                    like[0] *= g[j] if v < 0 else 1 - g[j]
                    like[1] *= b[j] if v < 0 else 1 - b[j]
            good[p] = like[0] / sum(like)
    return share, b, g, good


def test_em_equals_plain_iteration(spark):
    import random

    r, names = random.Random(3), ["a", "b", "c"]
    rows = []
    for _ in range(400):
        good = r.random() < 0.8
        rows.append(tuple(r.choices((-1, 0, 1), ((1, 4, 15) if good else (12, 4, 4)))[0] for _ in range(3)))
    got = q.estimate(spark.createDataFrame(rows, "a int, b int, c int"), names, rounds=15)
    n = Counter(rows)
    share, b, g, good = plain_em(n, 3, 15)
    assert abs(got.share - share) < 1e-9
    assert all(abs(x - y) < 1e-9 for x, y in zip((*got.on_bad, *got.on_good), (*b, *g)))
    df = spark.createDataFrame(list(n), "a int, b int, c int")
    assert all(abs(x.p - good[x.a, x.b, x.c]) < 1e-9 for x in df.select("*", got.posterior(names).alias("p")).collect())


def test_true_rates_are_found_and_a_weak_rule_is_outweighed(spark):
    """Known accuracies come back; a rule that misfires on a third of good texts does not drop them, and all-must-pass would."""
    import random

    r, names = random.Random(5), ["a", "b", "c", "d", "noisy"]
    rates = {True: (0.05, 0.1, 0.05, 0.08, 0.33), False: (0.9, 0.8, 0.85, 0.7, 0.4)}
    truth = [r.random() < 0.85 for _ in range(6000)]
    rows = [(i, *(0 if r.random() < 0.2 else -1 if r.random() < f else 1 for f in rates[t])) for i, t in enumerate(truth)]
    df = spark.createDataFrame(rows, "id int, a int, b int, c int, d int, noisy int")
    got = q.estimate(df, names)
    assert abs(got.share - 0.85) < 0.02
    assert all(abs(x - y) < 0.06 for x, y in zip((*got.on_good, *got.on_bad), (*rates[True], *rates[False])))
    kept = {x.id: x.p >= 0.5 for x in df.select("id", got.posterior(names).alias("p")).collect()}
    right = sum(kept[i] == t for i, t in enumerate(truth))
    all_must_pass = sum((min(x[1:]) >= 0) == truth[x[0]] for x in rows)
    assert right > 0.97 * len(rows) and all_must_pass < 0.7 * len(rows)
    assert all(kept[x[0]] for x in rows if x[5] == -1 and min(x[1:5]) > 0)


def test_labelled_documents(spark):
    """Nearly all good documents stay and nearly all bad ones go, though no label was seen."""
    sf = "/root/testdata/sf0.01"
    x = q.op5_weak_rules(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert all(r.kept for r in x if r.quality == 1 and not r.base_failed)
    assert sum(r.kept for r in x if r.quality == 0) <= 0.05 * sum(r.quality == 0 for r in x)


def test_verdicts_are_not_all_must_pass(spark):
    """Where a rule votes bad and the text is kept all the same, labels side with the posterior."""
    sf = "/root/testdata/sf0.01"
    x = q.op5_weak_rules(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    differ = [r for r in x if r.kept and any(r[f"vote_{k.name}"] == -1 for k in q.RULES)]
    assert len(differ) >= 15 and sum(r.quality == 1 for r in differ) >= 0.9 * len(differ)
