"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust their score.

Base kinds are decided by pattern and checksum alone: email, ip (parts up to 255), card (12 to 19 digits, Luhn) and
phone (+ and 9 to 15 digits). Further spans are proposals with a score: iban (mod 97), ssn (allowed areas), tel
(numbers without a +), and cards (Luhn) and phones in tighter forms, where a base pattern ran into a neighbour. A checksum or a fitting word close by raises the score, a word that names another kind of
number lowers it; from ``ACCEPT`` on the span is taken, if no base span and no better one overlaps it.
Positions are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airsift.llm.store import documents_of, small_batches

KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "tel")
ACCEPT = 0.5
NEAR = 40  # code points before and after a span that are searched for context words

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Begun only where a run of digits begins, and runs taken whole: equal matches, and linear in long runs of digits.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_TEL = re.compile(r"(?<![0-9A-Za-z+.-])(?:\([0-9]{2,5}\) ?|0[0-9]{1,4}[ /-])[0-9]{2,4}(?:[ -]?[0-9]{2,4}){1,3}(?![0-9])")
# Tighter forms, for numbers that a base pattern lost by running into a neighbour.
_CARD_ALONE = re.compile(r"(?<![0-9])(?:[0-9]{12,19}|[0-9]{4}(?:([ -])[0-9]{4})(?:\1[0-9]{4}){1,2}(?:\1[0-9]{1,4})?)(?![0-9])")
_PHONE_ALONE = re.compile(r"\+[0-9]{1,3}[ -]?(?:\([0-9]{1,4}\)|[0-9]{1,4})[ -]?[0-9]{3,4}[ -]?[0-9]{3,4}(?![0-9])")
_DIGIT = re.compile("[0-9]")

# Words that speak for a kind, in the languages of the corpus.
CONTEXT = {
    "iban": ("iban", "konto", "account", "compte", "cuenta", "bank", "banque", "banco"),
    "ssn": ("ssn", "social security", "sozialversicherung", "sécurité sociale", "seguridad social"),
    "card": ("card", "visa", "karte", "carte", "tarjeta"),
    "phone": ("tel", "phone", "call", "telefon", "téléphone", "teléfono"),
    "tel": ("tel", "phone", "call", "fax", "mobile", "telefon", "téléphone", "teléfono", "handy", "anruf", "appel", "llame"),
}
AGAINST = ("order", "invoice", "isbn", "serial", "rechnung", "facture", "factura", "version")

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def mod97(text: str) -> bool:
    moved = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The pattern's leftmost matches, begun at each @ instead of at each letter."""
    done = 0
    while (at := text.find("@", done)) >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _EMAIL.match(text, start) if start < at else None
        if match:
            yield match.span()
        done = match.end() if match else at + 1


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def base_spans(text: str) -> list[Span]:
    spans = [(*span, "email") for span in emails(text)]
    if _DIGIT.search(text):
        # A part of more than three digits may be a number with leading zeros; they are stripped, so it stays small.
        spans += [(*m.span(), "ip") for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
        spans += [(*m.span(), "card") for m in _CARD.finditer(text) if 12 <= len(d := _digits(m.group())) <= 19 and luhn(d)]
        if "+" in text:
            spans += [(*m.span(), "phone") for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return spans


def _proposals(text: str) -> Iterator[tuple[float, int, int, str]]:
    for match in _IBAN.finditer(text):
        # The pattern may run into following words: the longest prefix that confirms counts.
        end = match.end()
        while end - match.start() >= 15:
            if text[end - 1] != " " and (end == len(text) or not text[end].isalnum()) and mod97(text[match.start() : end].replace(" ", "")):
                yield 0.6, match.start(), end, "iban"
                break
            end -= 1
    for match in _CARD_ALONE.finditer(text):
        if 12 <= len(digits := _digits(match.group())) <= 19 and luhn(digits):
            yield 0.6, *match.span(), "card"
    if "+" in text:
        for match in _PHONE_ALONE.finditer(text):
            if 9 <= len(_digits(match.group())) <= 15:
                yield 0.5, *match.span(), "phone"
    for match in _SSN.finditer(text):
        area, group, serial = match.groups()
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield 0.4, *match.span(), "ssn"
    for match in _TEL.finditer(text):
        if 7 <= len(_digits(match.group())) <= 13:
            yield 0.3, *match.span(), "tel"


def _names(words: tuple[str, ...], text: str) -> bool:
    return any(re.search(rf"(?<!\w){re.escape(word)}", text) for word in words)


def _covered(spans: list[Span]) -> tuple[list[int], list[int]]:
    """Starts and ends, in order, of the disjoint runs that the spans cover."""
    starts: list[int] = []
    ends: list[int] = []
    for start, end, _ in sorted(spans):
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def added_spans(text: str, base: list[Span]) -> list[Span]:
    if not _DIGIT.search(text):
        return []
    scored = []
    for score, start, end, kind in _proposals(text):
        near = (text[max(0, start - NEAR) : start] + " " + text[end : end + NEAR]).lower()
        score += 0.4 * _names(CONTEXT[kind], near) - 0.3 * _names(AGAINST, near)
        if score >= ACCEPT:
            scored.append((-score, start, end, kind))
    starts, ends = _covered(base)
    taken: list[Span] = []
    for _, start, end, kind in sorted(scored):
        place = bisect_left(starts, end)
        if not place or ends[place - 1] <= start:
            starts.insert(place, start)
            ends.insert(place, end)
            taken.append((start, end, kind))
    return taken


def _order(span: Span) -> tuple[int, int]:
    return span[0], KINDS.index(span[2])


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in sorted(spans, key=_order))


def masked(text: str, spans: list[Span]) -> str:
    """``text`` with each span, or run of overlapping spans, replaced by the kind of its first."""
    parts, done = [], 0
    for start, end, kind in sorted(spans, key=_order):
        if start >= done:
            parts += [text[done:start], f"<{kind.upper()}>"]
        done = max(done, end)
    return "".join(parts) + text[done:]


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        base_of, all_of = [], []
        for text in batch.column(1):
            text = text.as_py() or ""
            base_of.append(base_spans(text))
            all_of.append(base_of[-1] + added_spans(text, base_of[-1]))
        counts = [pa.array([sum(s[2] == kind for s in spans) for spans in base_of], pa.int64()) for kind in KINDS[:4]]
        digests = [hashlib.sha256(joined(spans).encode()).hexdigest() for spans in base_of]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *counts, pa.array(digests, pa.string()), pa.array([joined(s) for s in all_of], pa.string()), pa.array([len(s) for s in all_of], pa.int64())],
            names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_spans"],
        )


def personal_data(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans and n_spans (base and added).

    Null and empty texts have no spans. Every row is judged by itself, so repeated rows and null ids do no harm; an
    empty table gives no rows.
    """
    return documents_of(documents).mapInArrow(
        _found, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long"
    )


def mask(documents: DataFrame) -> DataFrame:
    """All documents, with personal data in ``text`` replaced by its kind, and ``n_chars`` (if there) counted anew."""
    columns = documents.columns

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value in batch.column(columns.index("text")):
                text = value.as_py()
                if text:
                    base = base_spans(text)
                    text = masked(text, base + added_spans(text, base))
                out.append(text)
            arrays = list(batch.columns)
            arrays[columns.index("text")] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    changed = small_batches(documents).withColumn("text", F.col("text").cast("string")).select(columns)
    changed = changed.mapInArrow(rows, changed.schema)
    if "n_chars" in columns:
        changed = changed.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast(documents.schema["n_chars"].dataType))
    return changed.select(columns)
