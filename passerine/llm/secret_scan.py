"""Secret scans: base patterns, and spans of high entropy found by sliding windows.

Candidate strings are runs of characters that encoded secrets are made of. For the class of characters that a candidate
keeps to (digits and hex letters, letters and digits, base64) a window slides over it; the counts of its characters, and
with them the entropy, change by one character in and one out at a step. Windows over the class's threshold are joined to
spans. A candidate shorter than the window is one window of its own length, its threshold scaled by the logarithm of it. The allow-list drops what looks random but isn't secret; spans of the base patterns are never dropped.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from passerine.llm.arrow import map_slices, plain, texts_of

# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 8, 16, 32
# A run of hex digits matches as a whole or not at all, so its least length can be part of the pattern.
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{%d,}" % HEX_LEAST)

KINDS = ("assign", "access", "hex", "entropy")

#: Class of characters: (pattern of the whole candidate, window, least entropy in bits a character).
CLASSES = (
    ("hex", re.compile(r"[0-9a-fA-F]+"), 24, 3.0),
    ("alnum", re.compile(r"[A-Za-z0-9]+"), 20, 3.6),
    ("base64", re.compile(r"[A-Za-z0-9+/_=-]+"), 24, 4.0),
)
LEAST_CANDIDATE = 20
_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % LEAST_CANDIDATE)

#: What looks random but isn't secret: identifiers, words joined by signs, paths, dates, sequences, placeholders.
ALLOW = tuple(re.compile(p) for p in (
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
    r"[A-Za-z]+",
    r"[0-9_/=+-]+",
    r"[A-Z]?[a-z]*([-_/=+][A-Z]?[a-z]*)*[0-9]{0,4}",
    r"([A-Za-z]{2,}|[0-9]{1,4})([-_/]([A-Za-z]{2,}|[0-9]{1,4}))*",
))
#: Pieces of a candidate, between signs, that hold one of these are no secret; the rest on either side is scored for itself.
PLACEHOLDER = re.compile(r"(?i)example|placeholder|dummy|sample|changeme|0123456789|abcdefghij|xxxxxx")
_PIECE = re.compile("[A-Za-z0-9]+")

_NLOGN = [0.0] + [k * math.log2(k) for k in range(1, 65)]
_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")


def high_windows(text: str, window: int, least: float) -> list[tuple[int, int]]:
    """Joined stretches of windows whose Shannon entropy is at least ``least`` bits a character.

    The sum of c log2 c over the window's character counts is kept up to date, one character in and one out at a step.
    """
    if len(text) < window:
        return []
    counts: dict[str, int] = {}
    total, found, bound = 0.0, [], math.log2(window)
    for k, c in enumerate(text):
        n = counts.get(c, 0)
        total += _NLOGN[n + 1] - _NLOGN[n]
        counts[c] = n + 1
        if k >= window:
            gone = text[k - window]
            n = counts[gone]
            total += _NLOGN[n - 1] - _NLOGN[n]
            counts[gone] = n - 1
        if k >= window - 1 and bound - total / window >= least - 1e-9:
            start = k - window + 1
            if found and start <= found[-1][1]:
                found[-1] = (found[-1][0], k + 1)
            else:
                found.append((start, k + 1))
    return found


def is_allowed(text: str) -> bool:
    """Whether the allow-list knows the string as harmless."""
    return any(p.fullmatch(text) for p in ALLOW)


def candidates(text: str):
    """(start, string) of what is scored: runs of candidate characters, without the placeholders in them."""
    for m in _CANDIDATE.finditer(text):
        start = m.start()
        held = [p for p in _PIECE.finditer(text, m.start(), m.end()) if PLACEHOLDER.search(p.group())] if PLACEHOLDER.search(m.group()) else []
        for gap in [*held, None]:
            end = gap.start() if gap else m.end()
            if end - start >= LEAST_CANDIDATE:
                yield start, text[start:end]
            start = gap.end() if gap else end


def entropy_spans(text: str) -> list[tuple[int, int]]:
    """Spans that the method adds."""
    spans = []
    for start, string in candidates(text):
        if string.isalpha() or is_allowed(string):
            continue
        _, _, window, least = next(c for c in CLASSES if c[1].fullmatch(string))
        if len(string) < window:  # one window of its own length, with the same share of the entropy that it can have
            window, least = len(string), least * math.log2(len(string)) / math.log2(window)
        spans += [(start + a, start + b) for a, b in high_windows(string, window, least)]
    return spans


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the base patterns, by start and then kind."""
    spans = []
    low = text.lower()
    if any(h in low for h in _HINTS):
        spans += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


class _Free:
    """Whether a span meets none of the given ones."""

    def __init__(self, spans: list[tuple[int, int, str]]):
        self.starts = [a for a, _, _ in spans]
        self.reach = list(accumulate((b for _, b, _ in spans), max))

    def __call__(self, start: int, end: int) -> bool:
        before = bisect_left(self.starts, end)  # spans that start before the end
        return not before or self.reach[before - 1] <= start


def all_spans(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """(base spans, base spans and those that the method adds where no base span is)."""
    base = base_spans(text)
    free = _Free(base)
    added = [(a, b, "entropy") for a, b in entropy_spans(text) if free(a, b)]
    return base, sorted([*base, *added], key=lambda s: (s[0], KINDS.index(s[2])))


def join_spans(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Secrets of every row of ``df``: counts and digest of the base spans, all spans, how many the method added.

    Offsets are code points, ends exclusive. Null counts as empty and has no spans (the digest is that of no bytes).
    Repeated rows stay repeated; no row depends on another, so hot keys don't matter.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, digests, spans = [[], [], [], []], [], []
        for text in plain(batch.column("text")).to_pylist():
            base, every = all_spans(text)
            kinds = [k for _, _, k in every]
            for n, kind in zip(counts, KINDS):
                n.append(kinds.count(kind))
            digests.append(hashlib.sha256(join_spans(base).encode()).hexdigest())
            spans.append(join_spans(every))
        found = {f"n_{k}": pa.array(n, pa.int64()) for k, n in zip(KINDS, counts)}
        columns = {"doc_id": batch.column("doc_id"), **found, "base_sha256": pa.array(digests), "spans": pa.array(spans)}
        columns["n_entropy"] = columns.pop("n_entropy")
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return map_slices(texts_of(df, id_col, text_col), "text", work, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_entropy long")
