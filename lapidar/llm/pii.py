"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "iban", "national_id", "local_phone")
"""The first four are the base: whatever passes their checks is reported."""
ACCEPTED = 0.6
"""Least score of a span of the other kinds."""
REACH = 40
"""Characters before and after a span in which context words count."""

_HINT = re.compile("[0-9@]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a greedy match ends where its run ends, so the next can only begin where a run does:
# looking behind gives the same matches without trying every digit
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_LENGTHS = {k[:2]: int(k[2:]) for k in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 "
    "GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 "
    "PT25 QA29 RO24 RS22 SA24 SC31 SD18 SE24 SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20").split()}
"""Characters of an account number by country, after ISO 13616."""
_NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+().-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])")
_CONTEXT = {
    "email": ("mail", "contact", "courriel", "correo"),
    "ip": ("ip", "server", "host", "address", "login"),
    "card": ("card", "visa", "mastercard", "credit", "debit", "payment", "karte", "carte", "tarjeta"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "telefon", "telefono"),
    "iban": ("iban", "bank", "account", "konto", "compte", "cuenta"),
    "national_id": ("ssn", "social security", "national id", "tax id"),
    "local_phone": ("phone", "call", "tel", "mobile", "fax", "telefon", "telefono"),
}
#: Words that speak for a number of another kind.
_AGAINST = {
    "email": ("example", "sample"),
    "ip": ("version", "release", "chapter", "section"),
    "card": ("order", "tracking", "serial", "isbn", "invoice"),
    "phone": ("order", "serial", "isbn", "invoice"),
    "iban": ("serial", "part number"),
    "national_id": ("part", "order", "serial", "model", "invoice", "isbn"),
    "local_phone": ("part", "order", "serial", "model", "invoice", "isbn"),
}
_SCORE = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.8, "iban": 0.9, "national_id": 0.4, "local_phone": 0.4}
CHANGE = 0.3
"""What context words add to a score, or take from it."""


def _any(some: tuple[str, ...]) -> re.Pattern:
    return re.compile(r"(?<![^\W_])(?:" + "|".join(some) + r")", re.I)


_WORDS, _OTHERS = ({k: _any(v) for k, v in table.items()} for table in (_CONTEXT, _AGAINST))


def luhn(digits: str) -> bool:
    """Check digit of payment cards."""
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(d - 9 if d > 9 else d for d in (2 * int(c) for c in even))) % 10 == 0


def mod97(text: str) -> bool:
    """Check digits of an account number as ISO 13616 writes it."""
    text = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Account numbers, of all ends of words first the one at the country's length, then the farthest."""
    m = _IBAN.search(text)
    while m:
        run = m[0]
        ends = [i for i in range(len(run), 14, -1) if i == len(run) or run[i] == " "]
        sizes = {i: i - run.count(" ", 0, i) for i in ends}
        ends = sorted((i for i in ends if sizes[i] >= 15), key=lambda i: sizes[i] != _LENGTHS.get(run[:2]))
        end = next((i for i in ends if mod97(run[:i])), 0)
        if end:
            yield m.start(), m.start() + end
        m = _IBAN.search(text, m.start() + (end or 2))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+, found from each @."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", at + 1)


def _is_byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and int(part) <= 255


def propose(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, kind) of what passes the pattern and the checksum of its kind."""
    yield from ((a, b, "email") for a, b in emails(text))
    for m in _IP.finditer(text):
        if all(map(_is_byte, m.groups())):
            yield m.start(), m.end(), "ip"
    for m in _CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield m.start(), m.end(), "card"
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
                yield m.start(), m.end(), "phone"
    yield from ((a, b, "iban") for a, b in ibans(text))
    for m in _NATIONAL.finditer(text):
        if m[0][:3] not in ("000", "666") and m[0][0] != "9" and m[0][4:6] != "00" and m[0][7:] != "0000":
            yield m.start(), m.end(), "national_id"
    for m in _LOCAL_PHONE.finditer(text):
        yield m.start(), m.end(), "local_phone"


def spans_of(text: str | None) -> list[tuple[int, int, int, float]]:
    """(start, index of kind, end, score), in that order of sorting; code points, end exclusive."""
    if not text or not _HINT.search(text):
        return []
    base, more = [], []
    for start, end, kind in propose(text):
        near, other = (bool(words[kind].search(text, max(0, start - REACH), start) or words[kind].search(text, end, end + REACH)) for words in (_WORDS, _OTHERS))
        found = (start, KINDS.index(kind), end, round(min(1.0, _SCORE[kind] + CHANGE * near - CHANGE * other), 6))
        (base if found[1] < 4 else more).append(found)
    # an added span that a base one overlaps says nothing new
    base.sort()
    ends, far = [], 0
    for x in base:
        far = max(far, x[2])
        ends.append(far)
    starts = [x[0] for x in base]
    for x in more:
        i = bisect_left(starts, x[2])
        if x[3] >= ACCEPTED and not (i and ends[i - 1] > x[0]):
            base.append(x)
    return sorted(base)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, spans array<struct<kind, start, end, score>> in order of start, then kind.

    Base kinds (email, ip, card, phone) hold all leftmost non-overlapping matches that
    pass their checks; iban, national_id and local_phone are added where checksum and
    context words, which may also speak against a kind, leave a score of ACCEPTED. Spans of
    one start are ordered as KINDS. Null and empty texts have no spans; null
    ids stay null; equal rows give equal rows; an empty table gives an empty one; other
    columns are ignored. One pass, no shuffle; work and memory grow with a text and its matches.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, len(b), 500):
                part = b.slice(at, 500)
                found = [[{"kind": KINDS[k], "start": s, "end": e, "score": p} for s, k, e, p in spans_of(t)] for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, kind)], ["doc_id", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, spans array<struct<kind: string, start: int, end: int, score: double>>")
