"""Personal data: patterns propose, checksums confirm, context words adjust (operator 1).

Base kinds (email, ip, card, phone) follow their patterns over the whole text, leftmost and
non-overlapping per kind, and drop what fails its check. The method adds three kinds: ``iban``
(mod-97), ``ssn`` (issuable areas) and ``card_short`` (13 to 15 digits passing Luhn), each with
a starting score that context words within ``CONTEXT_CHARS`` raise, and words that name other
numbers (orders, versions, books) before it lower; an added span counts from ``MIN_SCORE``. An
iban ends at its country's length, whatever capitals follow it, or, for a country that is not in
the table, at the longest group end that passes. Base spans always count; their score is informative.

Texts are scanned as Latin-1 bytes, one byte per code point ("?" for others, which no pattern
here accepts), so byte offsets are code-point offsets. Every scan is linear in the text: a run
of digits is entered at its start only, an address at its "@".

Defined cases: null or empty text has no spans; a null id stays null; repeated rows give
repeated results; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("iban", "ssn", "card_short")
CONTEXT_CHARS = 48
MIN_SCORE = 0.5
START = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.7, "ssn": 0.35, "card_short": 0.3}
CONTEXT_BOOST = 0.25
CONTEXT = {
    "email": re.compile(rb"(?i)e-?mail|contact|write to|address"),
    "ip": re.compile(rb"(?i)\bip\b|host|server|address|login"),
    "card": re.compile(rb"(?i)card|visa|master|amex|credit|debit|payment|karte|carte|tarjeta"),
    "phone": re.compile(rb"(?i)phone|call|tel|mobile|fax|contact"),
    "iban": re.compile(rb"(?i)iban|account|bank|konto|compte|cuenta"),
    "ssn": re.compile(rb"(?i)ssn|social security|tax id"),
    "card_short": re.compile(rb"(?i)card|visa|master|amex|credit|debit|payment|karte|carte|tarjeta"),
}

#: Before a span of an added kind, within ``CONTEXT_CHARS``: it is rather a number of another kind.
OTHER_NUMBERS = re.compile(
    rb"(?i)\b(?:order|invoice|isbn|issn|version|build|serial|part|item|sku|ticket|tracking|model|article|"
    rb"bestellung|rechnung|commande|facture|pedido|factura)(?:s|\b|[ _-]?(?:no|nr|num|number|id)\b)"
)
# Length of an iban by country.
IBAN_LENGTH = {
    country: int(length)
    for country, length in (
        (x[:2].encode(), x[2:])
        for x in (
            "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 "
            "FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 "
            "LU20 LV21 LY25 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SD18 "
            "SE24 SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20"
        ).split()
    )
}

LOCAL = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DIGIT = re.compile(rb"[0-9]")
IP = re.compile(rb"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
# A match of two digits or more always starts where its run of digits starts.
CARD = re.compile(rb"(?<![0-9])[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(rb"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(rb"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
SSN = re.compile(rb"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")

_DOUBLED = bytes((0, 2, 4, 6, 8, 1, 3, 5, 7, 9))

SPAN = "struct<kind:string,start:bigint,end:bigint,score:double>"
_ARROW_SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
)


def luhn(digits: bytes) -> bool:
    """Digits as ASCII bytes."""
    v = [d - 48 for d in reversed(digits)]
    return (sum(v[::2]) + sum(_DOUBLED[d] for d in v[1::2])) % 10 == 0


def mod97(iban: bytes) -> bool:
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(chr(c), 36)) for c in turned)) % 97 == 1


def iban_end(run: bytes, after: bytes) -> int:
    """Where the iban at the start of a run of capitals, digits and single blanks ends, 0 if there
    is none; ``after`` is the byte behind the run."""
    ends = [i + 1 for i, c in enumerate(run) if c != 32]  # by number of characters
    wanted = IBAN_LENGTH.get(run[:2])
    for n in [wanted] if wanted else range(min(34, len(ends)), 14, -1):
        if n <= len(ends):
            e = ends[n - 1]
            follows = run[e : e + 1] or after
            if not follows.isalnum() and mod97(run[:e].replace(b" ", b"")):
                return e
    return 0


def emails(raw: bytes) -> list[tuple[int, int]]:
    """From each "@": the local characters before it, back to the last match or "@"."""
    out, floor, at = [], 0, raw.find(b"@")
    while at != -1:
        part = raw[floor:at]
        start = floor + len(part.rstrip(LOCAL))
        m = DOMAIN.match(raw, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
        floor = m.end() if m else at + 1
        at = raw.find(b"@", floor)
    return out


def _ip_ok(x: bytes) -> bool:
    return all(len(p := part.lstrip(b"0")) <= 3 and int(p or b"0") <= 255 for part in x.split(b"."))


def _digits(x: bytes) -> bytes:
    return x.translate(None, b" ().+-")


def find_spans(text: str) -> list[tuple[str, int, int, float]]:
    """All spans (kind, start, end, score) of a text, by kind as in ``KINDS``, then start."""
    raw = text.encode("latin-1", "replace")
    found = [("email", s, e) for s, e in emails(raw)]
    if DIGIT.search(raw):
        numbers = list(CARD.finditer(raw))
        found += [("ip", *m.span()) for m in IP.finditer(raw) if _ip_ok(m[0])]
        digits = [(m, _digits(m[0])) for m in numbers if m.end() - m.start() >= 13]
        found += [("card", *m.span()) for m, d in digits if 16 <= len(d) <= 19 and luhn(d)]
        found += [("phone", *m.span()) for m in PHONE.finditer(raw) if 8 <= len(_digits(m[0])) <= 15]
        at = 0
        while m := IBAN.search(raw, at):
            e = iban_end(m[0], raw[m.end() : m.end() + 1])
            at = m.start() + (e or 4)
            if e:
                found.append(("iban", m.start(), at))
        found += [("ssn", *m.span()) for m in SSN.finditer(raw)]
        found += [("card_short", *m.span()) for m, d in digits if 13 <= len(d) <= 15 and luhn(d)]
    out = []
    for kind, s, e in found:
        near = raw[max(0, s - CONTEXT_CHARS) : s], raw[e : e + CONTEXT_CHARS]
        score = START[kind] + CONTEXT_BOOST * any(map(CONTEXT[kind].search, near))
        if kind not in BASE_KINDS and OTHER_NUMBERS.search(near[0]):
            score -= CONTEXT_BOOST
        if kind in BASE_KINDS or score >= MIN_SCORE:
            out.append((kind, s, e, min(1.0, round(score, 2))))
    return out


def redacted(text: str, spans: list[tuple[str, int, int, float]]) -> str:
    """The text with each span replaced by ``<kind>``; overlapping spans become the first's."""
    out, at = [], 0
    for kind, s, e, _ in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], f"<{kind}>"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id and ``spans``, an array of (kind, start, end, score)."""
    small_batches(docs.sparkSession)
    schema = docs.select(F.col(id_col)).schema

    def run(batches):
        for b in batches:
            spans = [
                [dict(zip(("kind", "start", "end", "score"), x, strict=True)) for x in find_spans(t or "")]
                for t in b.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, _ARROW_SPANS)], names=[id_col, "spans"])

    out = f"`{id_col}` {schema[0].dataType.simpleString()}, spans array<{SPAN}>"
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, out)


def redact_pii(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; ``chars_col``, where the
    table has it as a number, becomes the new length of a changed text. Null texts stay null."""
    small_batches(docs.sparkSession)
    names = docs.columns
    at = names.index(text_col)
    count_at = names.index(chars_col) if chars_col in names else -1
    if count_at >= 0 and docs.schema[count_at].dataType.typeName() not in ("long", "integer"):
        count_at = -1

    def run(batches):
        for b in batches:
            old = b.column(at).to_pylist()
            new = [t and (redacted(t, s) if (s := find_spans(t)) else t) for t in old]
            cols = b.columns
            cols[at] = pa.array(new, b.schema.field(at).type)
            if count_at >= 0:
                counts = cols[count_at].to_pylist()
                counts = [c if x is y else len(x) for c, x, y in zip(counts, new, old, strict=True)]
                cols[count_at] = pa.array(counts, b.schema.field(count_at).type)
            yield pa.RecordBatch.from_arrays(cols, schema=b.schema)

    return docs.mapInArrow(run, docs.schema)
