import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import Row

from lectern.llm import turns as t

SF = "/root/testdata/sf0.01"
COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SOLID = re.compile(r"[^\x20\x09-\x0D]")


def broken(rows):
    """The damage of the query, row by row; a list of rows or none for each row."""
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        of = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if of == 1 else re.sub("[.!?]", "", text) if of == 2 else text
        out += [(conv, turn, "user" if of == 4 else role, text)] * (0 if of == 0 else 2 if of == 3 else 1)
    return out


def cheapest(rows):
    """(cost, letters) of a conversation's rows (role, text, fault), all choices tried, at most two rows inserted in one place."""
    pattern = {"": 0, "s": 1}

    @lru_cache(None)
    def best(i, state, inserts):
        found = []
        follow = "a" if state == "u" else "u"
        if i == len(rows):
            if state in ("", "a"):
                found.append((0, ""))
        else:
            role, text, fault = rows[i]
            c, x = best(i + 1, state, 0)
            found.append((c + 2, "D" + x))
            if fault not in ("blank", "duplicate"):
                more, initial = (5 if fault == "truncated" else 0), role[:1]
                if initial == follow or (initial == "s" and state == "" and initial in pattern):
                    c, x = best(i + 1, initial, 0)
                    found.append((c + more, "K" + x))
                c, x = best(i + 1, follow, 0)
                found.append((c + more + 1, "R" + x))
        if inserts < 2:
            c, x = best(i, follow, inserts + 1)
            found.append((c + 5, "I" + x))
        return min(found, default=(10**9, ""))

    return best(0, "", 0)


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r[0], [])
    for r in broken(rows):
        by[r[0]].append(r[1:])
    return {conv: report(sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:32]))) for conv, own in by.items()}


def report(own):
    seen, marked = set(), []
    for _, role, text in own:
        solid = SOLID.findall(text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
        seen.add((role, text))
        marked.append((role, text, fault))
    numbers = [n for n, _, _ in own if n is not None]
    cost, audit = cheapest(tuple(marked))
    lines, i, state = [], 0, ""
    for x in audit:
        follow = "a" if state == "u" else "u"
        named = {"a": "assistant", "u": "user"}[follow]
        if x == "I":
            lines.append(f"{named}:")
            state = follow
            continue
        role, text, _ = marked[i]
        i += 1
        if x != "D":
            lines.append(f"{named if x == 'R' else role}:{text}")
            state = follow if x == "R" else role[:1]
    faults = [f for _, _, f in marked]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _, _), (b, _, _) in zip(marked, marked[1:], strict=False))
    return gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def got(df):
    rows = t.reported(t.repaired(t.damaged(df))).select(*COLUMNS).collect()
    found = {r[0]: tuple(r[1:]) for r in rows}
    assert len(found) == len(rows)
    return found


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = {r.conv_id: tuple(r[c] for c in COLUMNS[1:]) for r in t.op12_turn_repair(spark, SF).collect()}
    assert found == brute(rows)


@pytest.mark.parametrize("size", [1024, 3])
def test_odd_rows_ties_and_long_conversations(spark, size):
    r = random.Random(11)
    texts = ["Yes.", "No", " ", "", None, "Why?\n", "word " * 30, "x!", "Yes.  \t"]
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant"]
    rows = [(r.randint(0, 40), r.choice([None, *range(9)]), r.choice(roles), r.choice(texts)) for _ in range(500)]
    rows += [(99, i, r.choice(roles[:3]), f"{i % 50}{r.choice('.x')}") for i in range(400)]  # one conversation with most rows
    rows += [(98, 7, "user", "again.")] * 300 + [(None, i, "user", "w?") for i in range(5)] + [(None, None, None, None)]
    rows += [(10**6 + i, 0, "user", "one.") for i in range(60)]  # some of them lose their only row
    df = spark.createDataFrame([Row(conv_id=c, turn=n, role=x, text=y, piece=1, audit="z") for c, n, x, y in rows], "conv_id long, turn long, role string, text string, piece int, audit string").repartition(5)
    old, t.ROWS = t.ROWS, size
    try:
        assert got(df) == brute(rows)
    finally:
        t.ROWS = old


def test_string_keys_and_no_rows(spark):
    rows = [("a", 0, "user", "Hi."), ("a", 1, "assistant", "Hello."), ("b", 3, "assistant", "So.")]
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    assert got(df) == brute(rows)
    assert got(df.limit(0)) == {}


def test_repaired_turns_are_legal(spark):
    rows = spark.createDataFrame([(1, i, x, "Well.") for i, x in enumerate(["assistant", "user", "system", "user"])], "conv_id long, turn long, role string, text string")
    found = t.repaired_turns(rows.selectExpr("*", "1L AS copies")).orderBy("piece", "place").collect()
    assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in found))


def test_pieces_composed_equal_one_piece():
    r = random.Random(2)
    for _ in range(200):
        runs = [(r.choice("suax"), r.choice(["", "", "t", "b", "d"]), 1) for _ in range(r.randint(0, 12))]
        cut = r.randint(0, len(runs))
        whole = t.composed(t.through(runs), t.ENDED)
        assert t.composed(t.through(runs[:cut]), t.composed(t.through(runs[cut:]), t.ENDED)) == whole
        middle, first = t.walked(runs[:cut], t.composed(t.through(runs[cut:]), t.ENDED), t.START, False)
        assert first + t.walked(runs[cut:], t.ENDED, middle, True)[1] == t.walked(runs, t.ENDED, t.START, True)[1]
