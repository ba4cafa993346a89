"""Quality rules, toxicity and mixing against brute force, and edge rows."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from passerine.llm import mixing, quality, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_counts(t):
    t = t or ""
    words, seen, twice = WORD.findall(t), set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            twice += line in seen
            seen.add(line)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {k + d for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for d in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), twice, len(covered)


def test_base_counts_equal_brute_force():
    draw = random.Random(6)
    pieces = ["a", "b", "é", "日本", " ", "  ", "\n", "\t", "\x0b", "#", "|", "a b", "\r\n", "　"]
    texts = ["".join(draw.choice(pieces) + draw.choice(["", " "]) for _ in range(draw.randint(0, 60))) for _ in range(1500)] + [None, ""]
    counts, _ = quality.base_counts(quality.plain(pa.array(texts)))
    assert list(zip(*(c.tolist() for c in counts.values()))) == [base_counts(t) for t in texts]


def test_distance_is_jensen_shannon():
    p, q = np.array([[3, 1, 0, 4]]), np.array([[1.0, 1.0, 2.0, 0.0]])
    a, b = p[0] / 8, q[0] / 4
    m = (a + b) / 2
    kl = lambda x: sum(v * math.log2(v / w) for v, w in zip(x, m) if v)
    assert quality.distance(p, q)[0] == pytest.approx(math.sqrt((kl(a) + kl(b)) / 2))
    assert quality.distance(np.zeros((1, 4)), q)[0] == 0
    assert quality.distance(p, p.astype(float))[0] == pytest.approx(0, abs=1e-7)


def test_verdict_follows_the_language_s_histograms(spark):
    draw = random.Random(8)
    usual, odd = ["the", "of", "and", "to"] + [f"w{chr(97 + k % 26)}{k}" for k in range(60)], [f"#{k}|Q$" for k in range(300)]
    rows = [(i, " ".join(draw.choices(usual, [9, 7, 6, 5] + [1] * 60, k=300)), "en" if i % 2 else None) for i in range(60)]
    rows += [(100, " ".join(draw.choices(odd, k=300)), "en"), (101, "too short", "en"), (102, None, None), (103, " ".join(draw.choices(usual, [9, 7, 6, 5] + [1] * 60, k=300)), "xx"), (104, "the of and " * 100, "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in quality.rate(df).collect()}
    assert all(got[i].kept for i in range(60)) and got[103].kept
    assert not got[100].kept and not got[100].base_failed
    assert got[101].base_failed and got[102].base_failed and got[104].base_failed
    for i, text, _ in rows:
        assert tuple(got[i][1:6]) == base_counts(text)


def test_quality_of_edge_rows(docs, edge_rows):
    """Every row has its base counts and base verdict: null, empty, blank, very long and repeated texts."""
    got = quality.rate(docs(edge_rows)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    want = [(i, *base_counts(text)) for i, text, *_ in edge_rows]
    assert sorted((str(r[0]), tuple(r[1:6])) for r in got) == sorted((str(i), tuple(c)) for i, *c in want)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept)
    assert quality.rate(docs([])).count() == 0


def test_references_of_many_languages_in_one_reading(spark):
    """As summed text by text: the fullest languages have a reference each, all others one; texts that don't count are left out."""
    draw = random.Random(8)
    line = lambda n: " ".join(draw.choice(["Ab", "c1", "d.", "e", "\u00e9f"] * 2 + ["#"]) for _ in range(n))
    rows = [(f"l{draw.randrange(900) if k % 3 else draw.randrange(40)}" if k % 50 else None, line(draw.choice([20, 60, 80]))) for k in range(3000)]
    found = quality.language_references(spark.createDataFrame([*rows, ("l1", None), ("zz", "")], "lang string, text string").repartition(3))
    sums = {}
    for lang, text in rows:
        n = len(text.split())
        if n >= quality.MIN_WORDS and sum(c in "#*$%&|<>" for c in text) <= quality.MAX_SYMBOL_SHARE * n:
            sums.setdefault(lang, []).append(text)
    fullest = sorted((x for x in sums if x is not None), key=lambda x: (-len(sums[x]), x))[: quality.MAX_LANGUAGES]
    assert len(sums) > quality.MAX_LANGUAGES + 100 and set(found) == {*fullest, None}
    for lang in [*fullest, None]:
        texts = sums[lang] if lang else [t for x, some in sums.items() if x not in set(fullest) for t in some]
        classes, buckets = found[lang]
        assert classes.tolist() == quality.class_histograms(pa.array(texts)).sum(axis=0).tolist()
        words = pa.array([w for t in texts for w in t.split()])
        assert buckets.tolist() == np.bincount(quality._buckets(words), minlength=quality.WORD_BUCKETS).tolist()


def labelled(spark, n=600):
    draw = random.Random(3)
    vocabulary = [f"w{k}" for k in range(300)]
    rows, labels = [], []
    for i in range(n):
        words = draw.choices(vocabulary, k=60)
        bad = i % 5 == 0
        if bad:
            words[draw.randrange(60)] = draw.choice(["vile", "nasty", "awful"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return rows, spark.createDataFrame([*labels, (None, 1), (5000, None)], "doc_id long, toxic int")


def test_toxicity_learns_and_holds_out(spark, docs):
    rows, labels = labelled(spark)
    got = toxicity.rate(docs([*rows, (None, "vile"), (9999, None)]), labels).collect()
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in range(600))
    right = [by_id[i].predicted == (i % 5 == 0) for i in range(600) if by_id[i].held_out]
    assert sum(right) / len(right) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert by_id[None].held_out is False and by_id[9999].predicted == 0
    kept = toxicity.reject(docs(rows), labels)
    assert kept.columns == docs([]).columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows if by_id[i].predicted == 0}


def test_labels_of_held_out_rows_teach_nothing(spark, docs):
    rows, labels = labelled(spark, 300)
    flipped = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 4 = 2 then 1 - toxic else toxic end as toxic")
    a, b = (toxicity.fit(docs(rows), x) for x in (labels, flipped))
    assert np.array_equal(a[0], b[0]) and np.allclose(a[1], b[1])


def test_toxicity_without_labels_or_documents(spark, docs, edge_rows):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.rate(docs(edge_rows), none).collect()} == {0.5}
    rows, labels = labelled(spark, 100)
    assert toxicity.rate(docs([]), labels).count() == 0 and toxicity.reject(docs([]), labels).count() == 0
    assert toxicity.rate(docs(edge_rows), labels).count() == len(edge_rows)


def test_features_are_words_stems_pairs_and_skips():
    own, at = toxicity.features(pa.array(["Red fox, runs", "", "red"]))
    assert Counter(own.tolist()) == {0: 3 + 3 + 2 + 1, 2: 2}
    assert at[own == 2][0] == at[own == 0][0]  # case and edges don't matter


def mix_rows():
    draw = random.Random(5)
    sizes = {"big": 400, "mid": 60, "small": 12, "tiny": 2}
    rows = [(s, draw.randint(0, 40)) for s, n in sizes.items() for _ in range(n)]
    return [(i, " ".join(["w"] * n) if n else draw.choice([None, ""]), s) for i, (s, n) in enumerate(rows)] + [(10_000, "", "empty"), (10_001, "a b", None)]


@pytest.mark.parametrize("limits", [{}, {"target_entropy": 0.6}, {"max_repeats": 1.5}, {"budget": 3000, "target_entropy": 1.0, "max_repeats": 100.0}, {"budget": 40}])
def test_mixture_meets_entropy_limit_and_budget(spark, monkeypatch, limits):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 200)
    rows = mix_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mixture(df, **limits).collect()
    tokens = {i: len((t or "").split()) for i, t, _ in rows}
    totals = Counter()
    for i, _, s in rows:
        totals[s or ""] += tokens[i]
    budget = limits.get("budget", sum(totals.values()))
    names = [s for s in totals if totals[s]]
    a = mixing.exponent([totals[s] for s in names], budget, limits.get("target_entropy", 0.95), limits.get("max_repeats", 4.0))
    w = dict(zip(names, mixing.weights([totals[s] for s in names], a)))
    repeats = max(w[s] * budget / totals[s] for s in names)
    assert repeats <= limits.get("max_repeats", 4.0) * (1 + 1e-9)
    goal = limits.get("target_entropy", 0.95) * math.log(len(names))
    assert mixing.entropy(list(w.values())) >= goal - 1e-6 or repeats > limits.get("max_repeats", 4.0) * 0.999
    taken = Counter()
    for r in got:
        taken[r.source] += r.n_tokens
    for s in names:
        want = math.floor(w[s] * budget * (1 + mixing.ROUNDING))
        assert want - 41 < taken[s] <= want
    # Each source's rows are a prefix of its passes: whole passes, then a part in the pass's order.
    for s in names:
        mine = [r for r in got if r.source == s]
        last = max((r.epoch for r in mine), default=0)
        ids = {i for i, _, x in rows if (x or "") == s}
        for e in range(last):
            assert {r.doc_id for r in mine if r.epoch == e} == ids
        assert len({(r.doc_id, r.epoch) for r in mine}) == len(mine)
    assert [r.epoch for r in got if r.source == "empty"] == [0]


def test_last_pass_is_a_prefix_of_its_permutation(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 200)
    df = spark.createDataFrame(mix_rows(), "doc_id long, text string, source string")
    whole = [r for r in mixing.mixture(df, target_entropy=0.0).collect() if r.source == "big"]  # one pass over all
    part = [r for r in mixing.mixture(df, target_entropy=0.0, budget=4000).collect() if r.source == "big"]
    order = [r.doc_id for r in sorted(whole, key=lambda r: (r.block_key, r.doc_key))]
    assert {r.doc_id for r in part} == set(order[: len(part)]) and 0 < len(part) < len(order)
    with pytest.raises(ValueError):
        mixing.exponent([10, 20], 1000, max_repeats=4.0)


def test_mixture_of_edge_rows(spark, docs, edge_rows):
    got = mixing.mixture(docs(edge_rows), target_entropy=0.0)
    assert got.count() == len(edge_rows)
    assert mixing.mixture(docs([])).count() == 0
    found = mixing.plan(docs(edge_rows), target_entropy=0.0)
    assert mixing.mix(docs(edge_rows), found).columns[:2] == ["doc_id", "text"]


def test_columns_of_any_name_go_through_the_mixture(spark, docs):
    clashes = ["mix_source", "mix_passes", "mix_epoch", "source2", "epoch", "block", "passes", "cut_doc"]
    df = docs([(i, "a b c") for i in range(30)]).selectExpr("*", *(f"concat('{c}', doc_id) as {c}" for c in clashes if c != "block"), "'b' as block")
    got = mixing.mix(df, mixing.plan(df, max_repeats=8.0, budget=120))
    assert got.columns == df.columns and got.count() > 30
    assert all(r.mix_epoch == f"mix_epoch{r.doc_id}" and r.mix_source == f"mix_source{r.doc_id}" for r in got.collect())


def test_fit_and_scores_equal_a_plain_loop(spark, docs):
    """FTRL-proximal, one number at a time, over the same rows in the same order; scores as sigmoids of summed weights."""
    import math

    rows, labels = labelled(spark, 120)
    rows += [(5, "another text of id five"), (5, "another text of id five")]
    df = docs(rows)
    known = {r.doc_id: r.toxic for r in labels.collect() if r.doc_id is not None and r.toxic is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2}
    hashes = {(r.doc_id, r.text): (r.c, r.o) for r in df.selectExpr("doc_id", "text", "xxhash64(text) as c", "xxhash64(doc_id, 1) as o").collect()}
    chosen = {}
    for (i, text), (content, order) in hashes.items():
        if i in known and (i not in chosen or content < chosen[i][0]):
            chosen[i] = content, order, text
    z, n = {}, {}
    bias = 2**toxicity.BITS

    def weight(k):
        l1 = 0.0 if k == bias else toxicity.L1
        if abs(z.get(k, 0.0)) <= l1:
            return 0.0
        return -(z[k] - math.copysign(l1, z[k])) / ((toxicity.BETA + math.sqrt(n[k])) / toxicity.ALPHA + toxicity.L2)

    for _ in range(toxicity.EPOCHS):
        for i, (_, _, text) in sorted(chosen.items(), key=lambda x: (x[1][1], x[0])):
            at = sorted(set(toxicity.features(pa.array([text]))[1].tolist())) + [bias]
            w = {k: weight(k) for k in at}
            g = 1 / (1 + math.exp(-max(-35.0, min(35.0, sum(w.values()))))) - known[i]
            for k in at:
                sigma = (math.sqrt(n.get(k, 0.0) + g * g) - math.sqrt(n.get(k, 0.0))) / toxicity.ALPHA
                z[k] = z.get(k, 0.0) + g - sigma * w[k]
                n[k] = n.get(k, 0.0) + g * g
    at, w = toxicity.fit(df, labels)
    want = {k: weight(k) for k in z if weight(k)}
    assert dict(zip(at.tolist(), w.tolist())) == pytest.approx(want, rel=1e-6) and len(want) > 5
    for r in toxicity.rate(df, labels).collect():
        for text in {t for i, t in rows if i == r.doc_id}:
            margin = want.get(bias, 0.0) + sum(want.get(k, 0.0) for k in set(toxicity.features(pa.array([text]))[1].tolist()))
            if abs(1 / (1 + math.exp(-margin)) - r.score) < 1e-6:
                break
        else:
            raise AssertionError(r)
