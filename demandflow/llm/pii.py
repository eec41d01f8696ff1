"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust their score."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


BASE = ("email", "ip", "card", "phone")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A number starts where a run of digits starts, or where the last match ended: both are run starts.
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
NUMBER = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
NOT_DIGIT = re.compile(r"[^0-9]")

# Words that speak for a kind, in the languages of the corpus.
CONTEXT = {
    "email": ("mail", "contact", "kontakt", "correo", "courriel", "write"),
    "ip": ("ip", "host", "server", "address", "adresse"),
    "card": ("card", "visa", "mastercard", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "telefon", "teléfono", "appel"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "national": ("ssn", "social", "security", "insurance"),
}
AGAINST = ("version", "invoice", "order", "part", "isbn", "figure", "section")
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "national": 0.4}
NEAR = 48
STEP = 0.15
THRESHOLD = 0.5


def luhn(digits: str) -> bool:
    """The check digit of payment cards."""
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = int(d) * (1 + place % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def mod97(account: str) -> bool:
    """The check of international account numbers."""
    turned = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: a local part starts at the start of the run before its @."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        # a run is walked once: nothing before the last match or the last @ can belong to it
        local = at - last - len(text[last:at].rstrip(LOCAL))
        match = DOMAIN.match(text, at) if local else None
        if match:
            out.append((at - local, match.end()))
            last = match.end()
            at = text.find("@", last)
        else:
            last = at + 1
            at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the four base kinds; each kind's matches do not overlap each other."""
    out = [(a, b, "email") for a, b in emails(text)]
    if "." in text:
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
                out.append((m.start(), m.end(), "ip"))
    for m in NUMBER.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(NOT_DIGIT.sub("", m.group())) <= 15:
                out.append((m.start(), m.end(), "phone"))
    return out


def added_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans beyond the base kinds: account numbers that pass mod 97, and national numbers."""
    out = []
    for m in IBAN.finditer(text):
        if mod97(m.group().replace(" ", "")):
            out.append((m.start(), m.end(), "iban"))
    for m in NATIONAL.finditer(text):
        area, group, serial = m.group().split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            out.append((m.start(), m.end(), "national"))
    return out


def score(text: str, start: int, end: int, kind: str) -> float:
    near = (text[max(0, start - NEAR) : start] + " " + text[end : end + NEAR]).lower()
    words = set(re.findall(r"[^\W\d_]+", near))
    return PRIOR[kind] + STEP * min(2, len(words.intersection(CONTEXT[kind]))) - STEP * min(2, len(words.intersection(AGAINST)))


def find(text: str, threshold: float = THRESHOLD) -> list[Span]:
    """All spans by start, then kind. Base spans stay whatever their score; added ones need the threshold."""
    spans = [Span(k, a, b, min(1.0, max(0.0, score(text, a, b, k)))) for a, b, k in base_spans(text)]
    for a, b, k in added_spans(text):
        s = score(text, a, b, k)
        if s >= threshold:
            spans.append(Span(k, a, b, min(1.0, s)))
    rank = {k: i for i, k in enumerate((*BASE, "iban", "national"))}
    return sorted(spans, key=lambda s: (s.start, rank[s.kind]))


def _find_pass(threshold: float) -> Callable:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[s._asdict() for s in find(t.as_py() or "", threshold)] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], ["id", "spans"])

    return run


def find_pii(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) per row; a span has kind, start, end (code points, end exclusive) and score.

    Emails, IP addresses, cards (Luhn) and phones are always reported, account numbers (mod 97) and
    national numbers when words nearby carry them over ``threshold``. Null and empty texts have no
    spans; repeated rows and null ids are rows like others; other columns are ignored. One pass
    without a shuffle, an empty table gives no rows; no pattern backtracks over a run twice, so long texts take linear time.
    """
    schema = "id long, spans array<struct<kind: string, start: long, end: long, score: double>>"
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(_find_pass(threshold), schema)


def digest(spans: str = "spans") -> list:
    """Contract columns of a ``spans`` column: counts per base kind, hash of base spans, all spans."""
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE))

    def joined(c):
        return F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return [*map(count, BASE), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col(spans)).alias("spans")]
