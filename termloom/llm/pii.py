"""Personal data: patterns propose spans, validators confirm them, near words move the score.

Patterns are written so that none takes more than linear time, whatever the text: what
follows a run of one class can't begin within it, so runs are matched possessively and
e-mail addresses are sought from their ``@``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from termloom.llm.batches import add_columns, filled

#: Kinds in the order in which spans of one start are listed; the first four are the base.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")

#: A span of an added kind is kept from this score on. Base spans stay whatever their score.
THRESHOLD = 0.6
CONTEXT_CHARS = 40

_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

#: Score of a confirmed span by itself, and words near it that raise or lower the score.
BASE_SCORE = {"email": 0.8, "ip": 0.5, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.4}
RAISING = {
    "email": ("mail", "contact", "kontakt", "correo", "courriel"),
    "ip": ("ip", "address", "server", "host", "client"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta", "payment"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "telefon"),
    "iban": ("iban", "bank", "account", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social security"),
}
LOWERING = {"ip": ("version", "release"), "ssn": ("order", "part", "model"), "card": ("isbn", "serial")}
STEP = 0.2


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for found in _DOMAIN.finditer(text):
        start = found.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < found.start():
            done = found.end()
            yield start, done


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for found in _IP.finditer(text):
        parts = [part.lstrip("0") for part in found[0].split(".")]
        if all(len(part) <= 3 and int(part or 0) <= 255 for part in parts):
            yield found.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for found in _CARD.finditer(text):
        digits = digits_of(found[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield found.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for found in _PHONE.finditer(text):
        if 9 <= len(digits_of(found[0])) <= 15:
            yield found.span()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """A match may have taken words after the number: it is cut at its last spaces until it holds."""
    for found in _IBAN.finditer(text):
        number, end = found[0], found.end()
        while True:
            plain = number.replace(" ", "")
            if len(plain) >= 15 and mod97(plain):
                yield found.start(), end
                break
            number, space, last = number.rpartition(" ")
            if not space:
                break
            end -= len(last) + 1


def _ssns(text: str) -> Iterator[tuple[int, int]]:
    for found in _SSN.finditer(text):
        area, group, serial = found[0].split("-")
        if area not in ("000", "666") and area[0] != "9" and group != "00" and serial != "0000":
            yield found.span()


_FINDERS = dict(zip(KINDS, (_emails, _ips, _cards, _phones, _ibans, _ssns), strict=True))
#: A kind is not sought in a text without any of these.
_NEEDS = {"email": "@", "phone": "+", "ssn": "-"}
_DIGIT = re.compile("[0-9]")


def score(text: str, kind: str, start: int, end: int) -> float:
    near = f"{text[max(0, start - CONTEXT_CHARS) : start]} {text[end : end + CONTEXT_CHARS]}".lower()
    value = BASE_SCORE[kind] + STEP * any(word in near for word in RAISING[kind])
    value -= STEP * any(word in near for word in LOWERING.get(kind, ()))
    return round(min(1.0, max(0.0, value)), 2)


def find_spans(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by start, then kind; offsets are code points, ends exclusive."""
    has_digit = _DIGIT.search(text) is not None
    spans = []
    for order, (kind, finder) in enumerate(_FINDERS.items()):
        if (kind == "email" or has_digit) and _NEEDS.get(kind, "") in text:
            for start, end in finder(text):
                value = score(text, kind, start, end)
                if order < 4 or value >= THRESHOLD:
                    spans.append((start, order, end, value))
    return [(KINDS[order], start, end, value) for start, order, end, value in sorted(spans)]


def redact(text: str, spans: list[tuple[str, int, int, float]]) -> str:
    """The text with ``<KIND>`` in place of every span; spans that overlap become one."""
    out, at, i = [], 0, 0
    while i < len(spans):
        kind, start, end, _ = spans[i]
        i += 1
        while i < len(spans) and spans[i][1] < end:
            end = max(end, spans[i][2])
            i += 1
        out += [text[at:start], f"<{kind.upper()}>"]
        at = end
    return "".join(out) + text[at:]


SPANS = "array<struct<kind: string, start: bigint, end: bigint, score: double>>"
_ARROW_SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
)


def find_pii(docs: DataFrame, column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns and ``pii``, the spans of the text. A null text has none."""

    def make(part: pa.RecordBatch) -> dict[str, pa.Array]:
        rows = [
            [{"kind": k, "start": s, "end": e, "score": v} for k, s, e, v in find_spans(text)]
            for text in filled(part.column(column)).to_pylist()
        ]
        return {"pii": pa.array(rows, _ARROW_SPANS)}

    return add_columns(docs, make, f"pii {SPANS}", column, keep)


def redact_pii(docs: DataFrame, column: str = "text") -> DataFrame:
    """All rows and columns, with personal data in ``column`` replaced; a null text stays null."""

    def make(part: pa.RecordBatch) -> dict[str, pa.Array]:
        texts = part.column(column).to_pylist()
        return {column: pa.array([t if t is None else redact(t, find_spans(t)) for t in texts], pa.string())}

    return add_columns(docs, make, f"`{column}` string", column).select(*[f"`{c}`" for c in docs.columns])
