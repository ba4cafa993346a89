"""Licences of texts: Aho-Corasick finds identifier tags and notice phrases, a shunting-yard parser evaluates expressions.

Two automata go over a text once each. One knows the words of notices and meets the text as words between single spaces;
the other knows identifier tags and meets the lower-cased text. What follows a tag is parsed as an expression of licence
ids with ``and``, ``or`` and ``with``: of alternatives the least restrictive counts, of joint terms the most restrictive,
and an exception loosens a strong copyleft.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from passerine.llm.arrow import map_slices, plain, texts_of

#: How restrictive a licence is.
PERMISSIVE, WEAK, STRONG, NONCOMMERCIAL, UNKNOWN = range(5)
CATEGORIES = ("permissive", "weak copyleft", "strong copyleft", "non-commercial", "unknown")

# The base phrases with their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Licence ids of expressions, without "-only", "-or-later" and "+": label and category.
LICENCES = {
    "0bsd": ("0bsd", PERMISSIVE), "apache-1.1": ("apache-1.1", PERMISSIVE), "apache-2.0": ("apache-2", PERMISSIVE), "artistic-2.0": ("artistic-2", WEAK),
    "bsd-2-clause": ("bsd-2", PERMISSIVE), "bsd-3-clause": ("bsd-3", PERMISSIVE), "bsl-1.0": ("boost-1", PERMISSIVE), "cc0-1.0": ("cc0", PERMISSIVE),
    "cc-by-3.0": ("cc-by", PERMISSIVE), "cc-by-4.0": ("cc-by", PERMISSIVE), "cc-by-sa-3.0": ("cc-by-sa", WEAK), "cc-by-sa-4.0": ("cc-by-sa", WEAK),
    "cc-by-nc-3.0": ("cc-by-nc", NONCOMMERCIAL), "cc-by-nc-4.0": ("cc-by-nc", NONCOMMERCIAL), "cc-by-nc-sa-4.0": ("cc-by-nc-sa", NONCOMMERCIAL),
    "cc-by-nc-nd-4.0": ("cc-by-nc-nd", NONCOMMERCIAL), "cc-by-nd-4.0": ("cc-by-nd", STRONG), "epl-1.0": ("epl-1", WEAK), "epl-2.0": ("epl-2", WEAK),
    "gpl-2.0": ("gpl-2", STRONG), "gpl-3.0": ("gpl-3", STRONG), "agpl-3.0": ("agpl-3", STRONG), "lgpl-2.1": ("lgpl-2.1", WEAK), "lgpl-3.0": ("lgpl-3", WEAK),
    "isc": ("isc", PERMISSIVE), "mit": ("mit", PERMISSIVE), "mit-0": ("mit-0", PERMISSIVE), "mpl-1.1": ("mpl-1.1", WEAK), "mpl-2.0": ("mpl-2", WEAK),
    "ofl-1.1": ("ofl-1.1", WEAK), "python-2.0": ("python-2", PERMISSIVE), "unlicense": ("unlicense", PERMISSIVE), "wtfpl": ("wtfpl", PERMISSIVE), "zlib": ("zlib", PERMISSIVE),
}
EXCEPTIONS = {"autoconf-exception-3.0", "bison-exception-2.2", "classpath-exception-2.0", "font-exception-2.0", "gcc-exception-3.1", "linux-syscall-note", "llvm-exception"}

#: Notices that the method adds: words, label. A notice inside a longer one found there gives no label of its own.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit", "the mit license": "mit",
    "licensed under the apache license version 2 0": "apache-2", "apache 2 0 license": "apache-2",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd", "bsd 2 clause license": "bsd-2", "bsd 3 clause license": "bsd-3",
    "gnu general public license": "gpl", "gnu general public license version 2": "gpl-2", "gnu general public license version 3": "gpl-3",
    "version 2 of the gnu general public license": "gpl-2", "version 3 of the gnu general public license": "gpl-3",
    "gnu lesser general public license": "lgpl", "gnu lesser general public license version 2 1": "lgpl-2.1", "gnu lesser general public license version 3": "lgpl-3",
    "gnu affero general public license": "agpl", "gnu affero general public license version 3": "agpl-3",
    "mozilla public license": "mpl", "mozilla public license version 2": "mpl-2", "mozilla public license v 2": "mpl-2", "eclipse public license": "epl",
    "cc by 3 0": "cc-by", "cc by 4 0": "cc-by", "cc by sa": "cc-by-sa", "cc by nd": "cc-by-nd", "cc by nc sa": "cc-by-nc-sa", "cc by nc nd": "cc-by-nc-nd", "cc0 1 0": "cc0",
    "creative commons attribution 4 0 international license": "cc-by", "creative commons attribution sharealike": "cc-by-sa", "creative commons attribution noncommercial": "cc-by-nc",
    "this is free and unencumbered software released into the public domain": "unlicense", "boost software license version 1": "boost-1", "sil open font license version 1 1": "ofl-1.1",
}
_FAMILIES = {"bsd": PERMISSIVE, "gpl": STRONG, "lgpl": WEAK, "agpl": STRONG, "mpl": WEAK, "epl": WEAK}
_CATEGORY = {label: category for label, category in LICENCES.values()} | _FAMILIES

TAGS = ("spdx-license-identifier:", "license-expression:", '"license":')
#: Label of a tag whose expression starts with no known id.
OTHER = "other"
#: How sure a label is by what shows it.
SURE = {"tag": 0.9, "base": 0.7, "notice": 0.6}

_LOWER = bytes(range(256)).lower()
_FOLD = bytes(c if c >= 128 or 48 <= c < 58 or 97 <= c < 123 else 32 for c in _LOWER)
_SPACES = re.compile(rb"\x20{2,}")
_TOKEN = re.compile(r"[\x20\t]*([()]|[a-z0-9][a-z0-9.+-]*)")
_LEAD = re.compile(r"[\x20\t]*[\"']?")
_RANK = {"or": 1, "and": 2, "with": 3}
_LATER = re.compile(r"(-only|-or-later|\+)$")

Value = tuple[int, frozenset[str]]


@lru_cache(1)
def _phrases() -> ahocorasick.Automaton:
    """Every phrase between spaces: (words, label, whether it's a base phrase)."""
    found = ahocorasick.Automaton()
    for phrase, label in {**NOTICES, **BASE}.items():
        found.add_word(f" {phrase} ", (phrase.count(" ") + 1, label, phrase in BASE))
    found.make_automaton()
    return found


@lru_cache(1)
def _tags() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for tag in TAGS:
        found.add_word(tag, len(tag))
    found.make_automaton()
    return found


def normalised(text: str) -> str:
    """The text's words, each between single spaces; empty without words."""
    words = _SPACES.sub(b" ", text.encode("utf-8", "surrogatepass").translate(_FOLD)).strip(b" ")
    return f" {words.decode('utf-8', 'surrogatepass')} " if words else ""


def notices(words: str) -> tuple[int, list[tuple[int, int, str, bool]]]:
    """(number of words, (first word, word after the last, label, is base) of every phrase found) of normalised words."""
    found, seen, passed = [], 0, 0
    for end, (length, label, base) in _phrases().iter(words):
        passed += words.count(" ", seen, end)
        seen = end
        found.append((passed - length, passed, label, base))
    return max(0, passed + words.count(" ", seen) - 1), found


def _longest(found: list[tuple[int, int, str, bool]]) -> set[str]:
    """Labels of what lies in no longer phrase that was found."""
    labels, reach = set(), (-1, -1)
    for first, end, label, _ in sorted(found, key=lambda x: (x[0], -x[1])):
        if end > reach[1] or (first, end) == reach:
            labels.add(label)
            reach = (first, end)
    return labels


def _operand(token: str) -> Value | None:
    token = token.rstrip(".")
    known = LICENCES.get(_LATER.sub("", token))
    if known:
        return known[1], frozenset([known[0]])
    return (UNKNOWN, frozenset([token])) if token.startswith("licenseref-") else None


def _apply(operator: str, a: Value, b: Value) -> Value:
    if operator == "with":
        category = WEAK if a[0] == STRONG else a[0]
        return category, frozenset(f"{x}-with-{y}" for x in a[1] for y in b[1])
    return (min if operator == "or" else max)(a[0], b[0]), a[1] | b[1]


def evaluate(text: str, at: int = 0) -> tuple[Value, int]:
    """(category and labels, end) of the longest licence expression that starts at ``at``.

    Two stacks and no recursion, so nesting may be deep. An operator without a following operand isn't part of the
    expression; what starts with no known id is ``OTHER``; an unclosed parenthesis makes the category unknown.
    """
    values: list[Value] = []
    operators: list[str] = []

    def reduce(rank: int) -> None:
        while operators and operators[-1] != "(" and _RANK[operators[-1]] >= rank:
            b, a = values.pop(), values.pop()
            values.append(_apply(operators.pop(), a, b))

    end, pending, wants = at, None, True
    while match := _TOKEN.match(text, end):
        token = match[1]
        if wants:
            exception = pending == "with"
            value = (PERMISSIVE, frozenset([token.rstrip(".")])) if exception and token.rstrip(".") in EXCEPTIONS else None if exception else _operand(token)
            if value is None and (token != "(" or exception):
                break
            if pending:
                reduce(_RANK[pending])
                operators.append(pending)
                pending = None
            if value is None:
                operators.append("(")
            else:
                values.append(value)
                wants = False
        elif token == ")":
            if pending or "(" not in operators:
                break
            reduce(0)
            operators.pop()
        elif token in _RANK and not (token == "with" and len(values[-1][1]) != 1):
            pending, wants = token, True
        else:
            break
        end = match.end()
    if not values:
        return (UNKNOWN, frozenset([OTHER])), end
    broken = "(" in operators
    while operators:
        operator = operators.pop()
        if operator != "(" and len(values) > 1:
            b, a = values.pop(), values.pop()
            values.append(_apply(operator, a, b))
    return (UNKNOWN if broken else values[0][0], values[0][1]), end


def expressions(text: str) -> list[Value]:
    """The evaluated expression after every tag of a text in lower case."""
    return [evaluate(text, _LEAD.match(text, end + 1).end())[0] for end, _ in _tags().iter(text)]


def describe(text: str) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score, n_expressions, category) of a text."""
    n_words, found = notices(normalised(text))
    starts = [first for first, _, _, base in found if base]
    base = {label for _, _, label, is_base in found if is_base}
    by_notice = _longest(found)
    low = text.encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass")
    stated = expressions(low)
    by_tag = {label for _, labels in stated for label in labels}
    labels, doubt = base | by_notice | by_tag, 1.0
    for label in sorted(labels):
        doubt *= 1 - max(SURE["tag"] * (label in by_tag), SURE["base"] * (label in base), SURE["notice"] * (label in by_notice))
    categories = [category for category, _ in stated] + [_CATEGORY.get(label, UNKNOWN) for label in base | by_notice]
    return (
        n_words, len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)),
        round(1 - doubt, 6), len(stated), CATEGORIES[max(categories)] if categories else None,
    )


_SCHEMA = {"n_words": "long", "n_base": "long", "first_word": "long", "last_word": "long", "base_labels": "string", "labels": "string", "score": "double", "n_expressions": "long", "category": "string"}
_TYPES = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licences of every row of ``df``: words, base phrases and their places, base labels, all labels, how sure they are
    (``score``; 0 without labels), the number of expressions, and the most restrictive category of all that was found.

    Words are numbered from 0. Null counts as empty: no words, no labels, null places. Long texts are gone through whole,
    one at a time; repeated rows stay repeated; no row depends on another, so hot keys don't matter. An empty table gives
    no rows, and further columns of ``df`` may have any name.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [describe(text) for text in plain(batch.column("text")).to_pylist()]
        columns = list(zip(*rows)) if rows else [()] * len(_SCHEMA)
        arrays = [pa.array(list(values), _TYPES[kind]) for values, kind in zip(columns, _SCHEMA.values())]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=["doc_id", *_SCHEMA])

    return map_slices(texts_of(df, id_col, text_col), "text", work, "doc_id long, " + ", ".join(f"{n} {t}" for n, t in _SCHEMA.items()))
