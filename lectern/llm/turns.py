"""Repair of conversations: the cheapest edits that give roles of the form (s?(ua)+)?.

The rows of a conversation are taken by turn. One that is blank or repeats an earlier row must be
deleted; others are kept, given another role or deleted, and empty rows of user or assistant may be
inserted anywhere. The grammar has four states: nothing yet, after system, after user, after
assistant. Backward over the rows, the cost to go is found for each state: the least cost of bringing
what is left to an end that the grammar allows. Forward from the first state, the edit of the least
letter among those that keep to that cost is taken, which gives the ASCII-least of the cheapest edits.

A conversation of any length is cut into pieces of bounded size. The cost to go through a piece is a
4 x 4 table (least cost from a state before it to a state after it), and tables of pieces are composed
as the pieces of a conversation stream by, last one first. Then each piece is walked from all four
states, its ends are followed first piece first, and each piece is walked once more from the state in
which it is really entered. So a conversation with a third of all rows costs one task a row a piece
and no more; only its hash, which is serial by definition, reads its repaired texts in one task, as
a stream. Equal rows are counted before anything is shuffled, and a copied row costs one row.

Defined results: null roles and texts are one space; rows of equal turn are taken by role, then by the
first 32 characters of the text, then by hash; null turns come first; a null conv_id is a conversation
of its own; a role that begins with none of s, u and a cannot be kept; a row with copies = 0 only names
its conversation; an empty table gives an empty result. Other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lectern.llm._common import joined, kept

#: Rows and characters of a piece, at most; a single longer row is a piece.
ROWS, CHARACTERS = 1024, 1 << 19
#: What the edits cost, and what a truncated row that is not deleted costs besides.
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
BLANKS = " \t\n\x0b\x0c\r"
NEVER = 1 << 60

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
#: The state after an inserted (or re-roled) row, which is the only one that the grammar allows.
AFTER = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: Costs to go after the last row.
ENDED = [0, 2 * INSERT, INSERT, 0]
LEGAL = {"su", "ua", "au"}


def choices(state: int, initial: str, fault: str) -> list[tuple[str, int, int]]:
    """Letter, cost and next state of what can be done with a row, by letter; fault: b(lank), d(uplicate), t(runcated) or none."""
    out = [("D", DELETE, state)]
    if fault not in ("b", "d"):
        extra = TRUNCATED if fault == "t" else 0
        if (state, initial) in KEPT:
            out.append(("K", extra, KEPT[state, initial]))
        out.append(("R", REROLE + extra, AFTER[state]))
    return out


#: For each initial and fault, the choices of each state.
CHOICES = {(i, f): [choices(s, i, f) for s in STATES] for i in ("s", "u", "a", "") for f in ("b", "d", "t", "")}


def fault(text: str, repeated: bool) -> str:
    body = text.rstrip(BLANKS)
    return "b" if not body else "d" if repeated else "" if body[-1] in ".!?" else "t"


def faults(rows: Iterable[tuple[str, str, int, bool]]) -> list[tuple[str, str, int]]:
    """Initial, fault and number of each run of equal rows (role, text, copies, repeated)."""
    out = []
    for role, text, n, repeated in rows:
        f, initial = fault(text, repeated), role[:1]
        out.append((initial, f, n if f in ("b", "d") else 1))
        if n > 1 and f not in ("b", "d"):
            out.append((initial, "d", n - 1))
    return out


def inserted(togo: list[int]) -> list[int]:
    """Costs to go with what inserting first may save."""
    for _ in range(2):
        togo = [min(c, INSERT + togo[AFTER[s]]) for s, c in enumerate(togo)]
    return togo


def before(run: tuple[str, str, int], togo: list[int]) -> list[int]:
    """Costs to go before a run of equal rows, by those after it."""
    initial, f, n = run
    if f in ("b", "d"):
        return inserted([DELETE * n + c for c in togo])
    return inserted([min(c + togo[s] for _, c, s in options) for options in CHOICES[initial if initial in "sua" else "", f]])


def through(runs: list[tuple[str, str, int]]) -> list[int]:
    """Least cost from each state before the runs to each state after them, 16 numbers."""
    columns = []
    for end in STATES:
        togo = [0 if s == end else NEVER for s in STATES]
        for run in reversed(runs):
            togo = before(run, togo)
        columns.append(togo)
    return [min(columns[e][s], NEVER) for s in STATES for e in STATES]


def composed(table: list[int], togo: list[int]) -> list[int]:
    return [min(min(table[4 * s + e] + togo[e] for e in STATES), NEVER) for s in STATES]


def walked(runs: list[tuple[str, str, int]], togo: list[int], state: int, last: bool) -> tuple[int, list[tuple[str, int]]]:
    """The state after the runs, and the edits: letter and state after it, a run of deletions as one of many letters. last: up to the end."""
    costs = [togo]
    for run in reversed(runs):
        costs.append(before(run, costs[-1]))
    costs.reverse()
    out: list[tuple[str, int]] = []
    for i, (initial, f, n) in enumerate(runs):
        while True:
            here, after = costs[i], costs[i + 1]
            if f in ("b", "d"):
                out.append(("D" * n, state))
                break
            tight = [(x, INSERT, AFTER[state], here) for x in "I"] + [(x, c, s, after) for x, c, s in CHOICES[initial if initial in "sua" else "", f][state]]
            letter, _, state = min((x, c, s) for x, c, s, rest in tight if c + rest[s] == here[state])
            out.append((letter, state))
            if letter != "I":
                break
    while last and state not in (START, ASSISTANT):
        state = AFTER[state]
        out.append(("I", state))
    return state, out


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies: each row dropped, emptied, cut short, repeated, re-roled or let be, by its checksum."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    of = F.pmod(F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))), F.lit(20))
    rows = conversations.select("conv_id", "turn", *(F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")), of.alias("damage"))
    text = F.when(F.col("damage") == 1, "").when(F.col("damage") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("damage") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(F.col("damage") == 0, 0).when(F.col("damage") == 3, 2).otherwise(1).cast("long").alias("copies"))


def counted(rows: DataFrame) -> DataFrame:
    """The distinct rows with their copies and whether an earlier turn has their role and text."""
    named = F.col("copies") == 0
    plain = rows.select(
        "conv_id",
        F.when(~named, F.col("turn").cast("long")).alias("turn"),
        *(F.when(named, "").otherwise(F.coalesce(F.col(c), F.lit(" "))).alias(c) for c in ("role", "text")),
        "copies",
    )
    once = plain.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    said = F.concat(F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("")), F.lit("\n"), F.length("role").cast("string"), F.lit("\n"), "role", "text")
    once = kept(once.withColumn("said", F.sha2(said, 256)), "turns")
    real = once.filter("copies > 0")
    first = kept(real.groupBy("said").agg(F.min(F.struct(F.col("turn").isNotNull(), "turn")).alias("first"), F.count(F.lit(1)).alias("n")), "first-said")
    marked = joined(real, first.select("said", F.col("first.turn").alias("first"), "n"), "said")
    marked = marked.select("conv_id", "turn", "role", "text", "copies", "said", (~F.col("first").eqNullSafe(F.col("turn"))).alias("repeated"))
    return marked.unionByName(once.filter("copies = 0").select("conv_id", "turn", "role", "text", "copies", "said", F.lit(False).alias("repeated")))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(b.column(i).to_pylist() for i in range(b.num_columns)), strict=True)


def _batches(rows: Iterator[tuple], schema: T.StructType, most: int = 256) -> Iterator[pa.RecordBatch]:
    arrow, held = to_arrow_schema(schema), []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), arrow, strict=True)], schema=arrow)

    for r in rows:
        held.append(r)
        if len(held) >= most:
            yield batch()
            held = []
    if held:
        yield batch()


def _mapped(df: DataFrame, schema: T.StructType, f) -> DataFrame:
    return df.mapInArrow(lambda batches: _batches(f(_rows(batches)), schema), schema)


def _schema(conv: T.StructField, ddl: str) -> T.StructType:
    return T.StructType([conv, *T.StructType.fromDDL(ddl)])


def pieces(rows: DataFrame) -> DataFrame:
    """The rows in order, cut: conv_id, piece (in order), what the piece has of faults and turns, its table of costs and its rows."""
    order = ["conv_id", "turn", "role", F.substring("text", 1, 32), "said"]
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "copies", "repeated")
    schema = _schema(rows.schema["conv_id"], "piece long, first_turn long, last_turn long, turns long, first_initial string, last_initial string, rows long, blank long, duplicate long, truncated long, illegal long, costs array<long>, initials array<string>, faults array<string>, numbers array<long>, roles array<string>, texts array<string>")

    def piece(conv, number: int, held: list[tuple]) -> tuple:
        real = [r for r in held if r[3] > 0]
        runs = [(r, x) for r in real for x in faults([r[1:]])]
        marks = [x for _, x in runs]
        turns = sorted({r[0] for r in real if r[0] is not None})
        count = lambda f: sum(n for _, x, n in marks if x == f)
        illegal = sum(n - 1 for _, _, n in marks) + sum(a + b not in LEGAL for (a, _, _), (b, _, _) in zip(marks, marks[1:], strict=False))
        # the texts of rows that must go are read no more
        texts = ["" if f in ("b", "d") else r[2] for r, (_, f, _) in runs]
        return (
            conv, number, turns[0] if turns else None, turns[-1] if turns else None, len(turns), marks[0][0] if marks else None, marks[-1][0] if marks else None,
            sum(n for _, _, n in marks), count("b"), count("d"), count("t"), illegal, through(marks), [i for i, _, _ in marks], [f for _, f, _ in marks], [n for _, _, n in marks], [r[1] for r, _ in runs], texts,
        )

    def cut(found: Iterator[tuple]) -> Iterator[tuple]:
        number, held, size, conv = TaskContext.get().partitionId() << 33, [], 0, None
        for c, *row in found:
            if held and (c != conv or len(held) >= ROWS or size + len(row[2]) > CHARACTERS):
                yield piece(conv, number, held)
                number, held, size = number + 1, [], 0
            conv, size = c, size + len(row[2])
            held.append(tuple(row))
        if held:
            yield piece(conv, number, held)

    return kept(sorted_.mapInArrow(lambda batches: _batches(cut(_rows(batches)), schema, 16), schema), "pieces")


def _in_order(df: DataFrame, *columns: str, backward: bool = False) -> DataFrame:
    return df.select("conv_id", "piece", *columns).repartition("conv_id").sortWithinPartitions("conv_id", F.desc("piece") if backward else "piece")


_NONE = object()


def entered(cut: DataFrame) -> DataFrame:
    """piece, the costs to go after it, the state in which it is entered and whether it is the last of its conversation."""
    conv = cut.schema["conv_id"]

    def backward(rows: Iterator[tuple]) -> Iterator[tuple]:
        current, togo = _NONE, ENDED
        for c, number, costs in rows:
            last = current is _NONE or c != current
            current, togo = c, ENDED if last else togo
            yield c, number, togo, last
            togo = composed(costs, togo)

    def ends(rows: Iterator[tuple]) -> Iterator[tuple]:
        for c, number, togo, last, *runs in rows:
            runs = list(zip(*runs, strict=True))
            yield c, number, togo, last, [walked(runs, togo, s, False)[0] for s in STATES]

    def forward(rows: Iterator[tuple]) -> Iterator[tuple]:
        current, state = _NONE, START
        for c, number, togo, last, after in rows:
            if current is _NONE or c != current:
                current, state = c, START
            yield c, number, togo, last, state
            state = after[state]

    marks = ("initials", "faults", "numbers")
    togo = _mapped(_in_order(cut, "costs", backward=True), _schema(conv, "piece long, togo array<long>, last boolean"), backward)
    slim = cut.select("conv_id", "piece", *marks).join(togo.drop("conv_id"), "piece").select("conv_id", "piece", "togo", "last", *marks)
    after = _mapped(slim, _schema(conv, "piece long, togo array<long>, last boolean, after array<int>"), ends)
    out = _mapped(_in_order(after, "togo", "last", "after"), _schema(conv, "piece long, togo array<long>, last boolean, state int"), forward)
    return kept(out.drop("conv_id"), "entered")


def repaired(rows: DataFrame) -> DataFrame:
    """The pieces of the conversations(conv_id, turn, role, text, copies) with edits: conv_id, piece, the counts of `pieces`, edits (letters), roles and texts of what stays."""
    cut = pieces(counted(rows))
    counts = ["first_turn", "last_turn", "turns", "first_initial", "last_initial", "rows", "blank", "duplicate", "truncated", "illegal"]
    schema = _schema(cut.schema["conv_id"], "piece long, first_turn long, last_turn long, turns long, first_initial string, last_initial string, rows long, blank long, duplicate long, truncated long, illegal long, cost long, edits string, roles array<string>, texts array<string>")

    def edit(found: Iterator[tuple]) -> Iterator[tuple]:
        for *head, togo, last, state, initials, marks, numbers, roles, texts in found:
            _, edits = walked(list(zip(initials, marks, numbers, strict=True)), togo, state, last)
            i, out, cost = 0, [], 0
            for letters, state_after in edits:
                if letters == "I":
                    out.append((NAMES[state_after], ""))
                    cost += INSERT
                    continue
                if letters[0] == "D":
                    cost += DELETE * len(letters)
                else:
                    out.append((roles[i] if letters == "K" else NAMES[state_after], texts[i]))
                    cost += (letters == "R") * REROLE + (marks[i] == "t") * TRUNCATED
                i += 1
            yield *head, cost, "".join(x for x, _ in edits), [r for r, _ in out], [t for _, t in out]

    both = cut.join(entered(cut), "piece").select("conv_id", "piece", *counts, "togo", "last", "state", "initials", "faults", "numbers", "roles", "texts")
    return kept(both.mapInArrow(lambda batches: _batches(edit(_rows(batches)), schema, 16), schema), "repaired")


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations as rows: conv_id, piece, place (within the piece), role and text."""
    each = repaired(rows).select("conv_id", "piece", F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "x"))
    return each.select("conv_id", "piece", "place", F.col("x.roles").alias("role"), F.col("x.texts").alias("text"))


def reported(found: DataFrame) -> DataFrame:
    """A row per conversation of repaired(): faults, cost, edits and the hash of the repaired rows."""
    schema = _schema(found.schema["conv_id"], "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
    columns = [c for c in found.columns if c not in ("conv_id", "piece")]

    def gather(rows: Iterator[tuple]) -> Iterator[tuple]:
        current, held = _NONE, None
        for c, _, *row in rows:
            if current is _NONE or c != current:
                if held:
                    yield held.row(current)
                current, held = c, _Report()
            held.add(*row)
        if held:
            yield held.row(current)

    return _mapped(_in_order(found, *columns), schema, gather)


class _Report:
    """What is carried from piece to piece of a conversation."""

    def __init__(self) -> None:
        self.least = self.most = self.initial = None
        self.turns, self.counts, self.edits, self.any = 0, [0] * 5, [], False
        self.hash = hashlib.sha256()

    def add(self, first_turn, last_turn, turns, first_initial, last_initial, rows, blank, duplicate, truncated, illegal, cost, edits, roles, texts) -> None:
        if turns:
            self.turns += turns - (self.most == first_turn)
            self.least, self.most = first_turn if self.least is None else self.least, last_turn
        if rows:
            if self.initial is not None:
                illegal += self.initial + first_initial not in LEGAL
            self.initial = last_initial
        self.counts = [a + b for a, b in zip(self.counts, (blank, duplicate, truncated, illegal, cost), strict=True)]
        self.edits.append(edits)
        for role, text in zip(roles, texts, strict=True):
            self.hash.update(f"{chr(10) * self.any}{role}:{text}".encode())
            self.any = True

    def row(self, conv) -> tuple:
        gaps = self.most - self.least + 1 - self.turns if self.turns else 0
        return conv, gaps, *self.counts, "".join(self.edits), self.hash.hexdigest()


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reported(repaired(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))
