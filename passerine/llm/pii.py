"""Personal data: patterns propose spans, checksums confirm them, nearby context words adjust the score.

Base kinds are e-mail addresses, IP addresses, card numbers that pass Luhn, and phone numbers; their spans always stay.
The method adds bank account numbers that pass mod-97, phone numbers without a plus sign, and numbers of persons
(three-two-four digits); these need a score of ``ADDED_SCORE``, which context words nearby can lift or lower.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from passerine.llm.arrow import map_slices, plain, texts_of

# The base patterns. The e-mail pattern is applied from each "@", so that long runs stay linear.
_LOCAL_END = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Added kinds.
_IBAN = re.compile(r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b")
_LOCAL_PHONE = re.compile(r"(?<![0-9+-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9-])")
_PERSON = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

KINDS = ("email", "ip", "card", "phone", "iban", "local_phone", "person_number")
BASE_KINDS = KINDS[:4]

#: Score of a span by its kind alone, how far context reaches in characters, and what it gives or takes.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "local_phone": 0.4, "person_number": 0.4}
CONTEXT_CHARS, CONTEXT_GAIN, CONTEXT_LOSS, ADDED_SCORE = 40, 0.3, 0.3, 0.6
_FOR = {
    "email": r"mail|contact|write|address", "ip": r"\bip\b|host|server|address|login", "card": r"card|visa|credit|debit|payment",
    "phone": r"phone|tel|call|mobile|fax", "iban": r"iban|bank|account|transfer", "local_phone": r"phone|tel|call|mobile|fax|contact",
    "person_number": r"ssn|social|security|person|tax|\bid\b",
}
_FOR = {kind: re.compile(words, re.IGNORECASE) for kind, words in _FOR.items()}
_AGAINST = re.compile(r"version|release|order|invoice|serial|isbn|build|example|\bpart\b", re.IGNORECASE)

Span = tuple[int, int, str, float]


def luhn(digits: str) -> bool:
    """Whether the last digit is the Luhn check digit of the others."""
    total = sum(map(int, digits[-1::-2])) + sum(n * 2 - 9 * (n > 4) for n in map(int, digits[-2::-2]))
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Whether an account number's two check digits are right."""
    account = account.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def accounts(text: str):
    """Account numbers: of every proposed run of groups the longest that passes mod-97, since the next word may look like a group."""
    at = 0
    while m := _IBAN.search(text, at):
        start, end = m.span()
        while end - start > 14 and not mod97(text[start:end]):
            end = text.rfind(" ", start, end)
        if end - start > 14:
            yield start, end
        at = end if end - start > 14 else start + 4


def emails(text: str):
    """Leftmost matches that don't overlap, found from their "@"."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_END:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            end = domain.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the base kinds, by kind and then start."""
    spans = [(a, b, "email") for a, b in emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return spans
    spans += [(m.start(), m.end(), "ip") for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        if 16 <= m.end() - m.start():
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), m.end(), "card"))
    if "+" in text:
        spans += [(m.start(), m.end(), "phone") for m in _PHONE.finditer(text) if 8 <= sum(c in "0123456789" for c in m.group()) <= 15]
    return spans


_DIGIT = re.compile("[0-9]")


def score(text: str, start: int, end: int, kind: str) -> float:
    """The kind's own score, more or less by the words around the span."""
    near = text[max(0, start - CONTEXT_CHARS) : start] + " " + text[end : end + CONTEXT_CHARS]
    value = SCORES[kind] + CONTEXT_GAIN * bool(_FOR[kind].search(near)) - CONTEXT_LOSS * bool(_AGAINST.search(near))
    return round(min(1.0, max(0.0, value)), 2)


def all_spans(text: str) -> tuple[list[tuple[int, int, str]], list[Span]]:
    """(base spans, all spans with their scores); added spans meet no base span and no other added one."""
    base = base_spans(text)
    spans = [(a, b, k, score(text, a, b, k)) for a, b, k in base]
    if _DIGIT.search(text):
        taken = sorted((a, b) for a, b, _ in base)
        starts, reach = [a for a, _ in taken], list(accumulate((b for _, b in taken), max))
        end = 0
        proposed = [(a, b, "iban") for a, b in accounts(text)]
        proposed += [(m.start(), m.end(), "local_phone") for m in _LOCAL_PHONE.finditer(text)]
        proposed += [(m.start(), m.end(), "person_number") for m in _PERSON.finditer(text)]
        for a, b, kind in sorted(proposed):
            before = bisect_left(starts, b)
            if a >= end and (not before or reach[before - 1] <= a) and (value := score(text, a, b, kind)) >= ADDED_SCORE:
                spans.append((a, b, kind, value))
                end = b
    return base, sorted(spans, key=lambda s: (KINDS.index(s[2]), s[0]))


def join_spans(spans) -> str:
    return ",".join(f"{s[2]}:{s[0]}:{s[1]}" for s in spans)


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Personal data of every row of ``df``: counts and digest of the base spans, all spans, their scores.

    Offsets are code points, ends exclusive. Null counts as empty and has no spans (the digest is that of no bytes).
    Repeated rows stay repeated; no row depends on another, so hot keys don't matter.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, digests, spans, scores = [[] for _ in BASE_KINDS], [], [], []
        for text in plain(batch.column("text")).to_pylist():
            base, every = all_spans(text)
            kinds = [k for _, _, k in base]
            for n, kind in zip(counts, BASE_KINDS):
                n.append(kinds.count(kind))
            digests.append(hashlib.sha256(join_spans(base).encode()).hexdigest())
            spans.append(join_spans(every))
            scores.append([s[3] for s in every])
        columns = {"doc_id": batch.column("doc_id"), **{f"n_{k}": pa.array(n, pa.int64()) for k, n in zip(BASE_KINDS, counts)}, "base_sha256": pa.array(digests), "spans": pa.array(spans), "scores": pa.array(scores, pa.list_(pa.float64()))}
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return map_slices(texts_of(df, id_col, text_col), "text", work, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, scores array<double>")
