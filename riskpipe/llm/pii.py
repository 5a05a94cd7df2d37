"""Operator 5: personal data.

Regular expressions propose spans, validators confirm them (address ranges, digit
counts, Luhn, mod-97, issued number ranges), and words near a span raise its score.
The four base kinds are reported whenever they validate; the added kinds only from
``THRESHOLD`` on, so the weaker patterns need a validator or a context word.

Each text is searched on its own, so the work is a map over the rows without a
shuffle.  Every search is linear in the length of the text: e-mail addresses are
found from their ``@`` outwards and the digit patterns never step back.

Defined results: a null text has no spans; of overlapping spans of different kinds
all are reported, and redaction replaces their union by the kind that starts first.
Positions are code points.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from riskpipe.llm import common

BASE_KINDS = ["email", "ip", "card", "phone"]
ADDED_KINDS = ["iban", "ssn", "paycard", "local_phone"]
KINDS = BASE_KINDS + ADDED_KINDS
THRESHOLD = 0.6
NEAR = 48  # code points on each side in which context words count

#: Fixed by the contract: the four base patterns (here in forms that match the same spans in linear time).
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_DIGIT = re.compile(r"[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
#: ISO 13616: the length of an IBAN by its country.
_IBAN_LENGTH = {code: n for n, codes in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ DZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "IS TR", 27: "BF BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BJ BY CI CY DO GT HN HU LB MA ML NE NI PL PS SN SV TG", 29: "BR EG QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU"}.items() for code in codes.split()}
_IBAN_OF = {n: re.compile(rf"[A-Z0-9]{{4}}(?:\x20?[A-Z0-9]{{4}}){{{n // 4 - 1}}}" + rf"\x20?[A-Z0-9]{{{n % 4}}}" * (n % 4 > 0) + "(?![A-Za-z0-9])")
            for n in set(_IBAN_LENGTH.values())}
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+().-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9-])")

#: Score of a validated span, and the words that raise it by CONTEXT when they stand near it.
_SCORE = {"email": 0.9, "ip": 0.8, "card": 0.9, "phone": 0.7, "iban": 0.9, "ssn": 0.4, "paycard": 0.4, "local_phone": 0.35}
CONTEXT = 0.3
_WORDS = {
    "email": {"email", "mail", "e-mail", "contact", "courriel", "correo"},
    "ip": {"ip", "address", "host", "server", "adresse"},
    "card": {"card", "visa", "credit", "payment", "carte", "karte", "tarjeta"},
    "phone": {"phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"},
    "iban": {"iban", "account", "bank", "konto", "compte", "cuenta"},
    "ssn": {"ssn", "social", "security"},
    "paycard": {"card", "amex", "credit", "payment", "carte", "karte", "tarjeta"},
    "local_phone": {"phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"},
}
_NEAR_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


# -- validators -------------------------------------------------------------------------------


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """ISO 13616: the first four characters go to the end, letters count from 10, the remainder is 1."""
    rest = 0
    for c in iban[4:] + iban[:4]:
        v = int(c, 36)
        rest = (rest * (100 if v > 9 else 10) + v) % 97
    return rest == 1


def _octets(address: str) -> bool:
    return all(len(p := part.lstrip("0")) < 3 or len(p) == 3 and p <= "255" for part in address.split("."))


def _issued(area: str, group: str, serial: str) -> bool:
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


# -- search -----------------------------------------------------------------------------------


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, floor = text.find("@"), 0
    while at >= 0:
        local = text[floor:at]
        start = floor + len(local.rstrip(_LOCAL))
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        floor = m.end() if m else at + 1
        at = text.find("@", floor)


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """At each start the country's length is tried first, then the longest match and, where the country has no length
    here, the shorter ones that end a group.  A start that fails hides none of those after it."""
    m = _IBAN.search(text)
    while m:
        start, end = m.span()
        length = _IBAN_LENGTH.get(text[start:start + 2])
        fixed = length and _IBAN_OF[length].match(text, start)
        ends = [fixed.end()] if fixed else []
        ends += [end] if length else [end, *(i for i in range(end - 1, start, -1) if text[i] == " ")]
        good = next((e for e in ends if 15 <= len(s := text[start:e].replace(" ", "")) <= 34 and mod97(s)), None)
        if good:
            yield start, good
        m = _IBAN.search(text, good or start + 1)


def _candidates(text: str) -> Iterator[tuple[str, int, int]]:
    if "@" in text:
        for a, b in _emails(text):
            yield "email", a, b
    if not _DIGIT.search(text):
        return
    for m in _IP.finditer(text):
        if _octets(m[0]):
            yield "ip", *m.span()
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield "card" if len(digits) >= 16 else "paycard", *m.span()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                yield "phone", *m.span()
    for a, b in _ibans(text):
        yield "iban", a, b
    for m in _SSN.finditer(text):
        if _issued(*m.groups()):
            yield "ssn", *m.span()
    for m in _LOCAL_PHONE.finditer(text):
        yield "local_phone", *m.span()


def find(text: str | None) -> list[Span]:
    """All spans of a text, by kind as listed in KINDS, then by start."""
    out = []
    for kind, a, b in _candidates(text or ""):
        near = _NEAR_WORD.findall(f"{text[max(0, a - NEAR):a]} {text[b:b + NEAR]}".lower())
        score = min(1.0, _SCORE[kind] + CONTEXT * (not _WORDS[kind].isdisjoint(near)))
        if kind in BASE_KINDS or score >= THRESHOLD:
            out.append(Span(kind, a, b, round(score, 4)))
    return sorted(out, key=lambda s: (KINDS.index(s.kind), s.start))


def redact(text: str, spans: list[Span]) -> str:
    """Each union of overlapping spans becomes the name of the kind that starts first."""
    parts, done = [], 0
    last = -1
    for s in sorted(spans, key=lambda s: (s.start, -s.end)):
        if s.start >= last:
            parts += [text[done:s.start], f"<{s.kind.upper()}>"]
        last = max(last, s.end)
        done = last
    return "".join([*parts, text[done:]])


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


# -- DataFrame operators ----------------------------------------------------------------------

_DIGEST = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, least_score double"


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                spans = find(text.as_py())
                base = [s for s in spans if s.kind in BASE_KINDS]
                counts = [sum(s.kind == k for s in base) for k in BASE_KINDS]
                rows.append((*counts, hashlib.sha256(_listed(base).encode()).hexdigest(), _listed(spans),
                             len(spans) - len(base), min((s.score for s in spans), default=None)))
            cols = list(zip(*rows, strict=True)) or [[]] * 8
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"].cast(pa.int64()), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]],
                                             names=[c.split()[0] for c in _DIGEST.split(", ")])

    return common.documents(spark, sf_dir).select("doc_id", "text").mapInArrow(scan, _DIGEST)


def redacted(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind, and ``length`` (if there is such a column) made to fit."""
    names = docs.columns

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = []
            for x in batch.column(names.index(text)):
                t = x.as_py()
                new.append(redact(t, spans) if t and (spans := find(t)) else t)
            cols = list(batch.columns)
            old = cols[names.index(text)]
            cols[names.index(text)] = pa.array(new, pa.string()).cast(old.type)
            if length in names:
                i = names.index(length)
                sizes = [n if t is None or t == o else len(t) for t, o, n in zip(new, old.to_pylist(), cols[i].to_pylist(), strict=True)]
                cols[i] = pa.array(sizes, cols[i].type)
            yield pa.RecordBatch.from_arrays(cols, schema=batch.schema)

    return docs.mapInArrow(rewrite, T.StructType(docs.schema.fields))
