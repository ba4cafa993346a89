"""Licence scan: base places against a plain search, expressions against a plain recursive evaluation."""

import itertools
import random
import re

import pytest

from passerine.llm import licenses
from passerine.llm.queries import op11_license_scan

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_base(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    places = [(k, label) for phrase, label in licenses.BASE.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
    starts = [k for k, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in places}))


TEXTS = [
    None, "", " \n\t", "Released under the MIT License.", "CC BY-NC 4.0; cc by nc cc_by nc ccby nc", "under the mit license under the mit license", "Apache License,\x00Version 2.0!", "ünder the mit license",
    "under the MİT license", "cc by ncé", "é under-the-mit/license é", "under the under the mit license 2", "word " * 50_000 + "cc by nc", "a" * 200_000, "cc by " * 20_000, "x 𝒳 under the mit license",
]


def test_base_places_equal_a_plain_search(spark):
    df = spark.createDataFrame([(k, t, "c", k, None) for k, t in enumerate(TEXTS)] + [(None, "cc by nc", "c", 0, None)] * 2, "doc_id long, text string, labels string, n_words int, score double").repartition(3)
    got = licenses.scan(df).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        text = "cc by nc" if r.doc_id is None else TEXTS[r.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain_base(text), text
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) or not r.base_labels
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
    assert licenses.scan(df.limit(0)).count() == 0


def test_base_places_of_random_words():
    draw = random.Random(2)
    words = ["under", "the", "mit", "license", "apache", "version", "2", "cc", "by", "nc", "sa"]
    for _ in range(300):
        text = "".join(draw.choice(words) + draw.choice([" ", "-", "\n", ", ", "_"]) for _ in range(draw.randint(0, 60)))
        assert licenses.describe(text)[:5] == plain_base(text)


def test_query_over_documents_equals_a_plain_search(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op11_license_scan(spark, sf_dir).collect()
    assert len(rows) == len(texts) and any(r.n_base for r in rows)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain_base(texts[r.doc_id])


def recursive(tree):
    """(text, category, labels) of a tree of terms."""
    if isinstance(tree, str):
        label, category = licenses.LICENCES[tree]
        return tree, category, {label}
    op, *parts = tree
    if op == "with":
        text, category, labels = recursive(parts[0])
        return f"{text} with {parts[1]}", licenses.WEAK if category == licenses.STRONG else category, {f"{x}-with-{parts[1]}" for x in labels}
    done = [recursive(p) for p in parts]
    wrap = lambda p, t: f"({t})" if not isinstance(p, str) and p[0] != "with" and (op == "and" or p[0] == "or") else t
    return f" {op} ".join(wrap(p, d[0]) for p, d in zip(parts, done)), (min if op == "or" else max)(d[1] for d in done), set().union(*(d[2] for d in done))


def test_expressions_equal_a_recursive_evaluation():
    draw = random.Random(6)

    def tree(depth):
        kind = draw.random()
        if depth == 0 or kind < 0.3:
            return draw.choice(list(licenses.LICENCES))
        if kind < 0.45:
            return ("with", draw.choice(["gpl-2.0", "apache-2.0"]), draw.choice(sorted(licenses.EXCEPTIONS)))
        return (draw.choice(["and", "or"]), *(tree(depth - 1) for _ in range(draw.randint(2, 3))))

    for _ in range(300):
        text, category, labels = recursive(tree(4))
        (got, found), end = licenses.evaluate(text)
        assert (got, found, end) == (category, labels, len(text)), text


@pytest.mark.parametrize(
    "text,labels,category",
    [
        ("SPDX-License-Identifier: (MIT OR GPL-2.0-only WITH Classpath-exception-2.0) AND Apache-2.0 and more", "apache-2,gpl-2-with-classpath-exception-2.0,mit", "permissive"),
        ("SPDX-License-Identifier: GPL-3.0-or-later", "gpl-3", "strong copyleft"),
        ("SPDX-License-Identifier: MIT or the other", "mit", "permissive"),
        ("SPDX-License-Identifier: nonsense", "other", "unknown"),
        ("SPDX-License-Identifier:", "other", "unknown"),
        ("SPDX-License-Identifier: (MIT", "mit", "unknown"),
        ("SPDX-License-Identifier: " + "(" * 30_000 + "ISC" + ")" * 30_000, "isc", "permissive"),
        ("SPDX-License-Identifier: LicenseRef-own AND MIT", "licenseref-own,mit", "unknown"),
        ("SPDX-License-Identifier: MIT AND LGPL-2.1+ // under the MIT license, CC BY-NC-SA", "cc-by-nc,cc-by-nc-sa,lgpl-2.1,mit", "non-commercial"),
        ('{"license": "MIT OR Apache-2.0"}', "apache-2,mit", "permissive"),
        ("licensed under the GNU General Public License, version 3.", "gpl-3", "strong copyleft"),
        ("the GNU Lesser General Public License", "lgpl", "weak copyleft"),
        ("a licence of no kind, mit apache", "", None),
    ],
)
def test_labels_of_tags_and_notices(text, labels, category):
    out = licenses.describe(text)
    assert (out[5], out[8]) == (labels, category)


def test_no_order_of_terms_changes_the_labels():
    for terms in itertools.permutations(["mit", "gpl-3.0", "cc0-1.0"]):
        assert licenses.evaluate(" or ".join(terms))[0] == (licenses.PERMISSIVE, {"mit", "gpl-3", "cc0"})
