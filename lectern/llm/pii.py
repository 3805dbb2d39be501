"""Personal data by weak supervision.

Patterns propose spans; four labelers (pattern check, gazetteer, context, surroundings) vote on
each or abstain; expectation-maximisation over the corpus' vote patterns estimates how reliable
each labeler is; a logistic span classifier is trained on the posterior, with the span's shape and
the word before it as further features, so that it carries over what labelers see to spans on
which they abstain, and decides on the spans of the wider kinds. Spans of the base kinds that
pass their check are always reported.

The classifier's inputs are few discrete values, so that EM and training need only the counts of
their combinations: CODES rows at most come to the driver, whatever the corpus. Its weights go back
as an expression. Texts are read once, whole, and never shuffled; a text's spans are compared in
order and not each with each.

Defined results: null and empty texts have no spans; equal rows stay rows of their own; an empty
table gives an empty result. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm._common import kept

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "email_words", "phone_local", "ssn", "iban", "person", "address")
LABELERS = ("check", "gazetteer", "context", "surroundings")
#: Buckets of the character pattern of a span and of the word before it.
SHAPES, WORDS = 16, 16
CODES = len(KINDS) * 3 ** len(LABELERS) * SHAPES * WORDS

# The base patterns; email is read around each @, which gives the same spans in linear time.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Gazetteers of first names, titles, places and words for streets.
NAMES = frozenset(
    "James Mary John Patricia Robert Jennifer Michael Linda William Elizabeth David Barbara Richard Susan Joseph Jessica Thomas Sarah Charles Karen "
    "Daniel Nancy Matthew Lisa Anthony Margaret Mark Sandra Paul Emily Hans Peter Klaus Anna Ursula Heinz Jürgen Monika Sabine Stefan "
    "Jean Marie Pierre Jacques Nathalie Isabelle Philippe Sophie José María Carlos Carmen Juan Ana Luis Pilar Javier Lucía Miguel Elena".split()
)
TITLES = "Mr Mrs Ms Dr Prof Herr Frau Monsieur Madame Señor Señora".split()
PLACES = frozenset(
    "London Paris Berlin Madrid Rome Vienna Boston Chicago Houston Seattle Denver Dallas Toronto Sydney Dublin Munich Hamburg Lyon Marseille Barcelona "
    "Sevilla Zürich Geneva Brussels Amsterdam Lisbon Mexico Springfield England France Germany Spain Texas California Florida Ohio".split()
)
STREETS = "Street St Avenue Ave Road Rd Lane Ln Drive Dr Boulevard Blvd Court Ct".split()
# The wider patterns.
WIDER = {
    "email_words": re.compile(r"\b[A-Za-z0-9._-]{1,64} ?[(\[]at[)\]] ?[A-Za-z0-9-]{1,63}(?: ?[(\[]dot[)\]] ?[A-Za-z]{2,24})+"),
    "phone_local": re.compile(r"(?<![0-9+(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"),
    "ssn": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "iban": re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b"),
    "person": re.compile(rf"\b(?:(?:{'|'.join(TITLES)})\.? [A-Z]\w{{1,30}}(?: [A-Z]\w{{1,30}})?|(?:{'|'.join(sorted(NAMES))}) [A-Z]\w{{1,30}})\b"),
    "address": re.compile(rf"\b[0-9]{{1,5}} (?:[A-Z]\w{{1,30}} ){{1,3}}(?:{'|'.join(STREETS)})\b"),
}
# The gazetteers.
TOP_LEVEL = frozenset("com org net edu gov mil int info io co de fr es it nl uk us eu ch at be pl se no dk fi pt br mx ar ca au jp cn in".split())
CALLING = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
CUES = {
    "email": "mail contact correo courriel write reach", "email_words": "mail contact correo courriel write reach",
    "ip": "ip host server client address adresse dirección", "card": "card visa credit tarjeta karte carte payment pay",
    "phone": "phone tel call fax mobile telefon téléphone teléfono", "phone_local": "phone tel call fax mobile telefon téléphone teléfono",
    "ssn": "ssn social security", "iban": "iban account bank konto compte cuenta",
    "person": "name signed sincerely dear author contact patient", "address": "address live lives street home office located ship",
}
AGAINST = "version release section isbn order part chapter figure id serial sku"
_CUES = {k: re.compile("|".join(map(re.escape, v.split()))) for k, v in CUES.items()}
_AGAINST = re.compile(rf"\b(?:{'|'.join(AGAINST.split())})\b")


def digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def luhn(d: str) -> bool:
    odd, even = map(int, d[::-1][::2]), (2 * int(c) for c in d[::-1][1::2])
    return (sum(odd) + sum(x - 9 * (x > 9) for x in even)) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Spans of LOCAL@DOMAIN. A match has one @ and nothing left of it that is not in its local part."""
    after, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > after and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            after = domain.end()
        at = text.find("@", max(at + 1, after))


def checked(kind: str, s: str) -> int:
    """1 or -1 where the kind has a rule for what it matched, else 0."""
    if kind == "ip":
        return 1 if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in s.split(".")) else -1
    if kind == "card":
        d = digits(s)
        return 1 if 16 <= len(d) <= 19 and luhn(d) else -1
    if kind == "phone":
        return 1 if 8 <= len(digits(s)) <= 15 else -1
    if kind == "iban":
        t = s.replace(" ", "")
        return 1 if int("".join(str(int(c, 36)) for c in t[4:] + t[:4])) % 97 == 1 else -1
    if kind == "email_words":
        return 1 if 2 <= len(re.findall(r"[A-Za-z]+", s)[-1]) <= 6 and len(re.findall(r"[(\[]at[)\]]", s)) == 1 else -1
    if kind == "phone_local":
        d = digits(s)
        return 1 if d[0] not in "01" and d[3] not in "01" and d[1:3] != "11" else -1
    if kind == "ssn":
        d = digits(s)
        return -1 if d[:3] in ("000", "666") or d[0] == "9" or d[3:5] == "00" or d[5:] == "0000" else 1
    return 1 if kind == "email" else 0


def listed(kind: str, s: str, after: str) -> int:
    d = digits(s)
    if kind == "person":
        return 1 if NAMES & set(s.split()) else -1 if PLACES & set(s.split()) else 0
    if kind == "address":
        return 1 if PLACES & set(re.findall(r"\w+", after)) else 0
    if kind == "email":
        return 1 if s.rpartition(".")[2].lower() in TOP_LEVEL else -1
    if kind == "email_words":
        return 1 if re.findall(r"[A-Za-z]+", s)[-1].lower() in TOP_LEVEL else -1
    if kind == "ip":
        return -1 if re.match(r"(?:0|127|255)\.", s) else 1
    if kind == "card":
        return 1 if re.match(r"4|5[1-5]|2[2-7]|3[47]|6011|65|35", d) else -1
    if kind == "phone":
        return 1 if any(d[:n] in CALLING for n in (1, 2)) else -1
    if kind == "phone_local":
        return -1 if d[3:8] == "55501" else 0
    if kind == "ssn":
        return -1 if d in ("078051120", "219099999", "123456789") else 0
    return 0


def shape(s: str) -> int:
    """The bucket of a span's pattern of digits, small and large letters and other characters, runs taken as one."""
    classes = "".join("9" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c for c in s)
    return zlib.crc32(re.sub(r"(.)\1+", r"\1", classes).encode()) % SHAPES


def word_before(before: str) -> int:
    """The bucket of the last word of what stands before a span, 0 if there is none."""
    w = re.findall(r"\w+", before)
    return 1 + zlib.crc32(w[-1].encode()) % (WORDS - 1) if w else 0


def code(kind: str, text: str, start: int, end: int, valid: int) -> int:
    """Kind, votes and shape of a candidate in one number below CODES."""
    s = text[start:end]
    before = text[max(0, start - 40) : start].lower()
    context = 1 if _CUES[kind].search(before) else -1 if _AGAINST.search(before) else 0
    near = (text[start - 1] if start else " ") + (text[end] if end < len(text) else " ")
    around = -1 if any(c.isalnum() or c in "_/=" for c in near) else 1 if near[0].isspace() else 0
    votes = (valid, listed(kind, s, text[end : end + 40]), context, around)
    n = KINDS.index(kind)
    for v in votes:
        n = n * 3 + v + 1
    return (n * SHAPES + shape(s)) * WORDS + word_before(before)


def base_matches(text: str) -> Iterator[tuple[str, int, int, int]]:
    """Kind, start, end and check of every match of the base patterns, whether it passes or not."""
    yield from (("email", a, b, 1) for a, b in emails(text))
    for kind, p in (("ip", IP), ("card", CARD), ("phone", PHONE)):
        for m in p.finditer(text):
            if kind != "card" or m.end() - m.start() >= 16:
                yield kind, m.start(), m.end(), checked(kind, m[0])


def scan(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[int, int, int, bool]]]:
    """Base spans, and all candidates as (code, start, end, wider); a wider one that overlaps a base span is left out."""
    if not text:
        return [], []
    base, found = [], []
    if re.search("[0-9@]", text):
        for kind, a, b, valid in base_matches(text):
            if valid > 0:
                base.append((kind, a, b))
            found.append((code(kind, text, a, b, valid), a, b, False))
    taken = sorted((a, b) for _, a, b in base)
    starts, ends = [a for a, _ in taken], list(accumulate((b for _, b in taken), max))
    for kind, p in WIDER.items():
        for m in p.finditer(text):
            a, b = m.span()
            before = bisect_left(starts, b)  # base spans that start before its end; none of them may end after its start
            if not before or ends[before - 1] <= a:
                found.append((code(kind, text, a, b, checked(kind, m[0])), a, b, True))
    return base, found


def decoded(c: int) -> tuple[int, tuple[int, ...], int, int]:
    """Kind, votes (0 against, 1 abstains, 2 for), shape and word before of a code."""
    n, word = divmod(c, WORDS)
    n, form = divmod(n, SHAPES)
    votes = []
    for _ in LABELERS:
        n, v = divmod(n, 3)
        votes.append(v)
    return n, tuple(votes[::-1]), form, word


def reliabilities(votes: np.ndarray, n: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of each row, and P(vote | class) by labeler, from rows of votes that occur n times.

    EM for class-conditional votes; it starts from the majority of the votes cast.
    """
    cast = (votes == 2).sum(1) - (votes == 0).sum(1)
    post = 1 / (1 + np.exp(-1.5 * cast.astype(float)))
    for _ in range(rounds):
        p = np.empty((2, votes.shape[1], 3))
        for y, w in ((0, n * (1 - post)), (1, n * post)):
            for v in range(3):
                p[y, :, v] = (w[:, None] * (votes == v)).sum(0) + 1
            p[y] /= p[y].sum(1, keepdims=True)
        share = ((n * post).sum() + 1) / (n.sum() + 2)
        each = np.log(p[:, np.arange(votes.shape[1])[None, :], votes]).sum(2)
        post = 1 / (1 + np.exp(np.clip(np.log(1 - share) - np.log(share) + each[0] - each[1], -500, 500)))
    return post, p


#: Where each group of features begins: kinds, votes of each labeler, shapes, words before.
AT = (0, *(len(KINDS) + 3 * j for j in range(len(LABELERS))), len(KINDS) + 3 * len(LABELERS), len(KINDS) + 3 * len(LABELERS) + SHAPES)
FEATURES = AT[-1] + WORDS


def features(codes: np.ndarray) -> np.ndarray:
    """One column per kind, per vote of each labeler, per shape and per word before."""
    x = np.zeros((len(codes), FEATURES))
    for i, c in enumerate(codes):
        kind, votes, form, word = decoded(int(c))
        x[i, [a + v for a, v in zip(AT, (kind, *votes, form, word), strict=True)]] = 1
    return x


def train(codes: np.ndarray, n: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights (the constant last) of the span classifier, by Newton's method against EM's posterior."""
    votes = np.array([decoded(int(c))[1] for c in codes]).reshape(-1, len(LABELERS))
    post, _ = reliabilities(votes, n)
    x = np.c_[features(codes), np.ones(len(codes))]
    w, size = np.zeros(x.shape[1]), n / max(1.0, n.sum()) * 1000
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w += np.linalg.solve((x.T * (size * p * (1 - p))) @ x + ridge * np.eye(len(w)), x.T @ (size * (post - p)) - ridge * w)
    return w


def accepted(codes: np.ndarray, weights: np.ndarray, least: float = 0.5) -> list[int]:
    """The codes whose probability of personal data is least or more."""
    z = np.c_[features(codes), np.ones(len(codes))] @ weights
    return [int(c) for c, v in zip(codes, z, strict=True) if 1 / (1 + np.exp(-v)) >= least]


def accepts(code: Column, weights: np.ndarray, least: float = 0.5) -> Column:
    """accepted() as an expression: the weights of a code's features, added up."""
    sizes = (len(KINDS), *[3] * len(LABELERS), SHAPES, WORDS)
    z, rest = F.lit(float(weights[-1] - np.log(least / (1 - least)))), code
    for a, size in reversed(list(zip(AT, sizes, strict=True))):
        z = z + F.get(F.array(*(F.lit(float(w)) for w in weights[a : a + size])), F.pmod(rest, F.lit(size)).cast("int"))
        rest = F.floor(rest / size)
    return z >= 0


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, counts of base spans, base (kind:start:end, joined) and candidates of each row."""
    candidate = pa.struct([("code", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("wider", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, joined, hashed, found = [], [], [], []
            for text in b.column(1).to_pylist():
                base, some = scan(text)
                counts.append([sum(k == kind for k, _, _ in base) for kind in BASE])
                joined.append(",".join(f"{k}:{x}:{y}" for k, x, y in base))
                hashed.append(hashlib.sha256(joined[-1].encode()).hexdigest())
                found.append([dict(zip(("code", "start", "end", "wider"), c, strict=True)) for c in some])
            by = [pa.array([c[i] for c in counts], pa.int64()) for i in range(len(BASE))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *by, pa.array(hashed, pa.string()), pa.array(joined, pa.string()), pa.array(found, pa.list_(candidate))],
                ["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "base", "candidates"],
            )

    counts = ", ".join(f"n_{k} long" for k in BASE)
    added = T.StructType.fromDDL(f"{counts}, base_sha256 string, base string, candidates array<struct<code:int,start:int,end:int,wider:boolean>>")
    return docs.select("doc_id", "text").mapInArrow(run, T.StructType([docs.schema["doc_id"], *added.fields]))


def personal_data(docs: DataFrame) -> DataFrame:
    """Spans of documents(doc_id, text): base ones, then those of wider kinds that the classifier accepts."""
    found = kept(scanned(docs), "personal")
    counts = found.select(F.explode("candidates.code").alias("code")).groupBy("code").count().collect()  # CODES rows at most
    weights = train(np.array([r[0] for r in counts]), np.array([float(r[1]) for r in counts])) if counts else np.zeros(FEATURES + 1)
    names = F.array(*map(F.lit, KINDS))
    extra = F.array_sort(
        F.transform(
            F.filter("candidates", lambda c: c["wider"] & accepts(c["code"], weights)),
            lambda c: F.struct(F.floor(c["code"] / (CODES // len(KINDS))).cast("int").alias("kind"), c["start"], c["end"]),
        )
    )
    extra = F.array_join(F.transform(extra, lambda c: F.concat_ws(":", F.get(names, c["kind"]), c["start"], c["end"])), ",")
    return found.select(
        "doc_id", *(f"n_{k}" for k in BASE), "base_sha256", F.concat_ws(",", F.nullif("base", F.lit("")), F.nullif(extra, F.lit(""))).alias("spans")
    )


def op3_pii_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))
