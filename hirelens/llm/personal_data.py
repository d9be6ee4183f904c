"""Personal data by weak supervision: labelers vote on candidate spans, and a classifier learns from their votes.

Candidates are the matches of the base patterns (e-mail addresses, IP addresses, card and phone numbers) and looser forms: addresses
with a spelt-out sign, IPv6, card numbers with other separators, phone numbers without a country code, and matches that failed a
base check. Five labelers vote for or against each one, or abstain: the pattern's own check, the form, a
gazetteer, the words before it, and its borders.

Votes are counted by pattern over all documents. Expectation-maximisation on these counts estimates how reliable each labeler is;
base matches are known spans, and candidates that fail a checksum or a range are known not to be. A logistic
classifier over votes and form is then trained on the resulting probabilities. It adds the loose
candidates that it finds at least `sure` likely and that touch no base span. Base spans always stay.

The driver sees counts of vote patterns only, a few thousand numbers at most. Whole texts are read; the
work is linear in their length. Nulls and empty texts have no spans. Repeated rows get equal spans. Positions are
code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm.base import Scratch

KINDS = ("email", "ip", "card", "phone")

# Base patterns. Long runs are matched without going back, where going back could not help.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Looser forms.
SPELT_AT = re.compile(r"\x20?[\[(](?:at|AT)[\])]\x20?")
SPELT_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:(?:\.|\x20?[\[(](?:dot|DOT)[\])]\x20?)[A-Za-z0-9-]+)+")
IPV6 = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
LOOSE_CARD = re.compile(r"(?<![0-9])[0-9]{4}(?:\x20?[.\x20/-]\x20?[0-9]{4}){3}(?![0-9])")
LOCAL_PHONE = re.compile(r"(?<![0-9A-Za-z+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])")

# Gazetteers.
ENDINGS = set("com org net edu gov mil int info biz io co de fr es it uk us eu ch at nl be pl ru cn jp in br au ca example test".split())
ISSUERS = ("34", "37", "4", "51", "52", "53", "54", "55", "60", "62", "64", "65", "22", "23", "24", "25", "26", "27", "30", "36", "38", "35")
COUNTRIES = set("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92".split())
BEFORE = {
    "email": ("mail", "contact", "write", "correo", "courriel", "kontakt", "reach"),
    "ip": ("ip", "host", "server", "address", "adresse", "client", "from", "login"),
    "card": ("card", "visa", "credit", "payment", "karte", "carte", "tarjeta", "mastercard"),
    "phone": ("phone", "tel", "call", "fax", "mobile", "telefon", "handy", "whatsapp"),
}
AGAINST = ("version", "isbn", "order", "sku", "build", "invoice", "serial", "article", "release")
LETTERS = re.compile(r"[A-Za-z]+")
LOCAL = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


@dataclass(frozen=True)
class Fit:
    """A loose candidate is added if it is at least `sure` likely; `rounds` of expectation-maximisation, `steps` of the
    classifier's training with ridge `ridge`."""

    sure: float = 0.9
    rounds: int = 50
    steps: int = 25
    ridge: float = 1.0


@dataclass(frozen=True)
class Candidate:
    kind: int
    start: int
    end: int
    base: bool
    code: int  # votes and form, as one number


def digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(number: str) -> bool:
    """The check sum of card numbers."""
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def addresses(text: str, sign: re.Pattern, domain: re.Pattern) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, sign and domain that do not overlap.

    The run of local characters before each sign is walked back from it, so no run is scanned twice.
    """
    free = 0
    for at in sign.finditer(text):
        if at.start() < free or not (end := domain.match(text, at.end())):
            continue
        start = at.start()
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < at.start():
            yield start, end.end()
            free = end.end()


AT = re.compile("@")


def base_matches(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """Kind, start, end of every match of a base pattern, and whether it passes the check."""
    if "@" in text:
        for start, end in addresses(text, AT, DOMAIN):
            yield 0, start, end, True
    for m in IP.finditer(text):
        yield 1, m.start(), m.end(), all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            d = digits(m[0])
            if 13 <= len(d) <= 19:
                yield 2, m.start(), m.end(), len(d) >= 14 and luhn(d)
    if "+" in text:
        for m in PHONE.finditer(text):
            yield 3, m.start(), m.end(), 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15


def loose_matches(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """The same for the looser forms."""
    if "at]" in text or "at)" in text or "AT]" in text or "AT)" in text:
        for start, end in addresses(text, SPELT_AT, SPELT_DOMAIN):
            yield 0, start, end, True
    if ":" in text:
        for m in IPV6.finditer(text):
            yield 1, m.start(), m.end(), True
    for m in LOOSE_CARD.finditer(text):
        yield 2, m.start(), m.end(), luhn(digits(m[0]))
    for m in LOCAL_PHONE.finditer(text):
        yield 3, m.start(), m.end(), True


def votes(kind: int, text: str, start: int, end: int, base: bool, passes: bool) -> int:
    """The labelers' votes (0 against, 1 none, 2 for) and the form of a candidate, as one number.

    Check: for base matches, against failed ones. Form, gazetteer: see the lines. Words: a word of the kind or one
    that speaks against it within 40 characters before. Borders: no letter or digit on either side.
    """
    own = text[start:end]
    d = digits(own)
    if kind == 0:
        ending = own.rsplit(".", 1)[-1].rsplit(")", 1)[-1].rsplit("]", 1)[-1].strip().lower()
        form, listed = ending.isalpha() and 2 <= len(ending) <= 24, ending in ENDINGS
    elif kind == 1:
        parts = own.split(".")
        form = len(parts) != 4 or all(p == str(int(p)) if len(p) < 4 else False for p in parts)
        listed = len(parts) != 4 or parts[0] not in ("0", "255")
    elif kind == 2:
        form, listed = len(d) in (14, 15, 16), d.startswith(ISSUERS)
    else:
        form = 10 <= len(d) <= 13
        listed = any(d.startswith(c) for c in COUNTRIES) if own[0] == "+" else d[0] > "1"
    near = LETTERS.findall(text[max(0, start - 40):start].lower())
    spoken = 2 if any(w.startswith(BEFORE[KINDS[kind]]) for w in near) else 0 if any(w in AGAINST for w in near) else 1
    border = not (text[max(0, start - 1):start].isalnum() or text[end:end + 1].isalnum())
    check = 2 if base else 1 if passes else 0
    code = 0
    for v in (check, 2 * form, 2 if listed else 1, spoken, 2 * border):
        code = code * 3 + v
    return code * 4 + min(3, len(own) // 8)


def candidates(text: str | None) -> list[Candidate]:
    """All candidates of a text; loose ones only where they touch no base span and no earlier loose one."""
    if not text:
        return []
    found = [Candidate(k, s, e, ok, votes(k, text, s, e, ok, ok)) for k, s, e, ok in base_matches(text)]
    loose = sorted(loose_matches(text), key=lambda c: (c[1], c[0]))
    if not loose and not any(not c.base for c in found):
        return found
    kept = [c for c in found if c.base]
    taken: list[tuple[int, int]] = []  # sorted, apart from each other
    for start, end in sorted((c.start, c.end) for c in kept):
        if taken and start < taken[-1][1]:
            taken[-1] = taken[-1][0], max(end, taken[-1][1])
        else:
            taken.append((start, end))
    rest = sorted([(c.kind, c.start, c.end, False) for c in found if not c.base] + loose, key=lambda c: (not c[3], c[1], c[0]))
    for k, s, e, passes in rest:
        at = bisect_left(taken, (s, s))
        if (at and taken[at - 1][1] > s) or (at < len(taken) and taken[at][0] < e):
            continue
        kept.append(Candidate(k, s, e, False, votes(k, text, s, e, False, passes)))
        taken.insert(at, (s, e))
    return kept


# Learning from counts of patterns -------------------------------------------------------------------------


def unpacked(code: int) -> tuple[list[int], int]:
    code, form = divmod(code, 4)
    out = []
    for _ in range(5):
        code, v = divmod(code, 3)
        out.append(v)
    return out[::-1], form


def reliabilities(v: np.ndarray, n: np.ndarray, known: np.ndarray, rounds: int) -> np.ndarray:
    """Probability that each vote pattern is a span, by expectation-maximisation.

    `v` has a row of votes per pattern, `n` how often it occurs, `known` 1 or 0 for patterns whose truth is known, else
    nan. Labelers are taken as independent given the truth, each with its own vote frequencies for either truth.
    """
    lean = (v - 1).mean(axis=1)
    p = np.where(np.isnan(known), 1 / (1 + np.exp(-3 * lean)), known)
    for _ in range(rounds):
        odds = np.log((n @ p + 1) / (n @ (1 - p) + 1)) * np.ones(len(v))
        for j in range(v.shape[1]):
            yes, no = np.bincount(v[:, j], n * p, 3) + 1, np.bincount(v[:, j], n * (1 - p), 3) + 1
            odds += np.log(yes / yes.sum())[v[:, j]] - np.log(no / no.sum())[v[:, j]]
        p = np.where(np.isnan(known), 1 / (1 + np.exp(-np.clip(odds, -30, 30))), known)
    return p


def logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float, steps: int) -> np.ndarray:
    """Weights of a logistic regression on soft labels, by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w - np.linalg.solve(h, x.T @ (n * (p - y)) + ridge * w)
    return w


def learn(counts: list[tuple[int, int, bool, int]], how: Fit = Fit()) -> set[tuple[int, int]]:
    """The (kind, code) of loose candidates to add, from counts of (kind, code, base)."""
    accepted = set()
    for kind in range(len(KINDS)):
        own = [c for c in counts if c[0] == kind]
        loose = [i for i, c in enumerate(own) if not c[2]]
        if not loose:
            continue
        parts = [unpacked(c[1]) for c in own]
        v, form = np.array([p for p, _ in parts]), np.array([f for _, f in parts])
        n = np.array([float(c[3]) for c in own])
        known = np.array([1.0 if c[2] else 0.0 if p[0] == 0 else np.nan for c, (p, _) in zip(own, parts)])
        y = reliabilities(v[:, 1:], n, known, how.rounds)
        x = np.concatenate([np.ones((len(own), 1))] + [np.eye(3)[v[:, j]] for j in range(1, 5)] + [np.eye(4)[form]], axis=1)
        w = logistic(x, y, n, how.ridge, how.steps)
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        accepted |= {(kind, own[i][1]) for i in loose if p[i] >= how.sure and v[i, 0] != 0}
    return accepted


# Spark --------------------------------------------------------------------------------------------------

FOUND = "array<struct<kind:int,start:int,end:int,base:boolean,code:int>>"


def with_candidates(docs: DataFrame) -> DataFrame:
    """doc_id and `found`, the candidates of the text, for every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    item = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("code", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[vars(c) for c in candidates(t)] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(item))], ["doc_id", "found"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, found {FOUND}")


def learnt(found: DataFrame, how: Fit = Fit()) -> set[tuple[int, int]]:
    """Count the patterns of candidates and learn which loose ones to add."""
    c = found.select(F.explode("found").alias("c")).groupBy("c.kind", "c.code", "c.base").agg(F.count(F.lit(1)).alias("n"))
    return learn(sorted((r.kind, r.code, r.base, r.n) for r in c.collect()), how)


def written(spans: list[tuple[int, int, int]]) -> str:
    """kind:start:end of spans (start, kind, end), in order."""
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def find(docs: DataFrame, how: Fit = Fit()) -> DataFrame:
    """doc_id, counts of base spans by kind, the hash of all base spans, and all spans of every row."""
    scratch = Scratch(docs.sparkSession, "personal-data")
    found = scratch.keep(with_candidates(docs), "found")
    accepted = learnt(found, how)
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for cs in batch.column(1).to_pylist():
                base = [(c["start"], c["kind"], c["end"]) for c in cs if c["base"]]
                more = [(c["start"], c["kind"], c["end"]) for c in cs if not c["base"] and (c["kind"], c["code"]) in accepted]
                rows.append((*[sum(k == i for _, k, _ in base) for i in range(len(KINDS))],
                             hashlib.sha256(written(base).encode()).hexdigest(), written(base + more)))
            types = [pa.int64()] * len(KINDS) + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]], names)

    return found.mapInArrow(
        run, f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")


def masked(text: str, accepted: set[tuple[int, int]]) -> str:
    """The text with its spans, joined where they overlap, replaced by the kind of the first in brackets."""
    spans = sorted((c.start, c.kind, c.end) for c in candidates(text) if c.base or (c.kind, c.code) in accepted)
    out, free, i = [], 0, 0
    while i < len(spans):
        start, kind, end = spans[i]
        while i < len(spans) and spans[i][0] < end:
            end, i = max(end, spans[i][2]), i + 1
        out += [text[free:start], f"[{KINDS[kind].upper()}]"]
        free = end
    return "".join([*out, text[free:]]) if out else text


def mask(docs: DataFrame, how: Fit = Fit()) -> DataFrame:
    """All rows and columns with the spans of `text` masked and `n_chars`, if there is one, counted anew.

    Texts are read twice, to learn and to mask, and never shuffled.
    """
    accepted = learnt(with_candidates(docs.select("doc_id", "text")), how)
    at = docs.columns.index("text")
    size = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            old = columns[at].to_pylist()
            new = [t if t is None else masked(t, accepted) for t in old]
            columns[at] = pa.array(new, columns[at].type)
            if size is not None:
                sizes = columns[size].to_pylist()
                columns[size] = pa.array(
                    [n if a == b else len(b) for n, a, b in zip(sizes, old, new)], columns[size].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
