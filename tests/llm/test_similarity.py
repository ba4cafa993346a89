"""Near-duplicate documents, line dedup, components and top-k search against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from passerine.llm import line_dedup, minhash, shared, topk

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(text or "")
    return Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else None


def similar(a, b):
    both = sum((a & b).values())
    return both >= 0.8 * (sum(a.values()) + sum(b.values()) - both) - 1e-9


def components_of(n, links):
    parent = list(range(n))

    def top(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        parent[max(top(a), top(b))] = min(top(a), top(b))
    return [top(k) for k in range(n)]


def planted(seed=4):
    """Texts with exact copies, chains of edits, a large group of near copies, shared passages and short texts."""
    draw = random.Random(seed)
    fresh = lambda n: [f"w{draw.randint(0, 5000)}" for _ in range(n)]
    texts = [" ".join(fresh(draw.randint(1, 120))) for _ in range(150)]
    original = fresh(140)
    for _ in range(120):  # near copies that are often not near to each other
        copy = original[:]
        for _ in range(draw.randint(1, 7)):
            copy[draw.randrange(140)] = f"x{draw.randint(0, 10**6)}"
        texts.append(" ".join(copy))
    link = fresh(100)
    for k in range(12):  # a chain: ends are far apart
        link = link[:]
        link[8 * k] = f"y{k}"
        texts.append(" ".join(link))
    passage = " ".join(fresh(60))
    texts += [passage + " " + " ".join(fresh(60)) for _ in range(60)]
    texts += ["same words here " * 40 + "end", "same words here " * 41 + "end", "same words here " * 20 + "end", "a b c", "a b c", "a b", "  a b c\n"]
    texts += [draw.choice(texts) for _ in range(60)]
    return texts


def test_classes_equal_brute_force(docs):
    texts = planted()
    sets = [shingles(t) for t in texts]
    links = [(a, b) for b in range(len(sets)) for a in range(b) if similar(sets[a], sets[b])]
    want = components_of(len(texts), links)
    got = minhash.classes(docs(enumerate(texts))).collect()
    assert {r.doc_id: r.class_id for r in got} == dict(enumerate(want))
    kept = minhash.keep_one(docs(enumerate(texts)))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want))
    assert kept.columns == docs([]).columns


def test_signatures_estimate_weighted_jaccard():
    draw = np.random.default_rng(0)
    shingle = np.arange(60, dtype=np.uint64) * 977 + 5
    agree = truth = 0.0
    for trial in range(40):
        a, b = draw.integers(0, 9, 60), draw.integers(0, 9, 60)
        own = np.concatenate([np.zeros((a > 0).sum(), int), np.ones((b > 0).sum(), int)])
        hashed = minhash.mix(np.concatenate([shingle[a > 0], shingle[b > 0]]) + np.uint64(trial * 10**6))
        times = minhash.signatures(own, hashed, np.concatenate([a[a > 0], b[b > 0]]), 2)
        agree += (times[0] == times[1]).mean() / 40
        truth += np.minimum(a, b).sum() / np.maximum(a, b).sum() / 40
    assert abs(agree - truth) < 0.03


def test_near_duplicates_of_edge_rows(docs, edge_rows):
    got = sorted(map(str, map(tuple, minhash.classes(docs(edge_rows)).collect())))
    six = [(None, 4), (4, 4), (4, 4), (5, 4)]
    own = [(i, i) for i in (1, 2, 3, -7, 6, 7, 2**62)] + [(8, 8), (9, 9), (8, 8)]
    assert got == sorted(map(str, six + own))
    kept = [(r.doc_id, r.text) for r in minhash.keep_one(docs(edge_rows)).collect()]
    # Of the four equal texts one stays; null ids count as least.
    assert sum(t == "one two three four five six" for _, t in kept) == 1
    assert len(kept) == len(edge_rows) - 3
    assert minhash.classes(docs([])).count() == 0 and minhash.keep_one(docs([])).count() == 0


def test_components(spark):
    draw = random.Random(2)
    pairs = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 400)] + [(500 + draw.randrange(50), 500 + draw.randrange(50)) for _ in range(40)]
    top = components_of(600, pairs)
    got = shared.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    nodes = {x for a, b in pairs if a != b for x in (a, b)}
    assert {r.node: r.component for r in got} == {k: top[k] for k in nodes} and len(got) == len(nodes)
    assert shared.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_slots(spark):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), 123456789 << 30]
    filled = shared.slots(spark.createDataFrame([(k,) for k in keys], "k long"), F.col("k"), 12)
    assert shared.in_slots(filled, np.array(keys), 12).all()
    assert not shared.in_slots(filled, np.array([5 << 52, -(5 << 52)]), 12).any()


def lines_gone(rows):
    """Lines that match an earlier line, by comparing all pairs."""
    found = []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        found += [(i, k, set(WORD.findall(x))) for k, x in enumerate((t or "").split("\n")) if WORD.search(x)]
    return {(i, k) for n, (i, k, s) in enumerate(found) if any(9 * len(s & o) >= 4 * (len(s) + len(o)) for _, _, o in found[:n])}, found


def line_rows(seed, documents=60):
    draw = random.Random(seed)
    common = [f"c{k}" for k in range(9)]
    word = lambda: draw.choice(common) if draw.random() < 0.6 else f"r{draw.randint(0, 400)}"
    pool = [[word() for _ in range(draw.choice([1, 2, 3, 4, 5, 6, 8, 10, 12, 13, 15, 20, 40]))] for _ in range(60)]
    rows = []
    for i in range(documents):
        lines = []
        for _ in range(draw.randint(0, 9)):
            line = draw.choice(pool)[:]
            for _ in range(draw.choice([0, 0, 1, 1, 2, 4])):
                line[draw.randrange(len(line))] = word()
            draw.shuffle(line)
            lines.append(" ".join(line) if draw.random() < 0.9 else "  ")
        rows.append((i * 7 % documents, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("batch, hot_rows", [("10000", 1 << 17), ("3", 1 << 17), ("50", 8)])
def test_lines_equal_brute_force(spark, docs, monkeypatch, batch, hot_rows):
    monkeypatch.setattr(line_dedup, "HOT_ROWS", hot_rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        rows = line_rows(int(batch))
        gone, _ = lines_gone(rows)
        got = {(r.doc_id, int(k)) for r in line_dedup.removed(docs(rows)).collect() for k in r.removed.split(",") if k}
        assert got == gone
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")


def test_lines_of_a_crowd(docs):
    """Very many near copies of one line, and of a line of common words."""
    draw = random.Random(9)
    base, short = [f"b{k}" for k in range(30)], [f"s{k}" for k in range(8)]
    rows = []
    for i in range(300):
        a, b = base[:], short[:]
        for _ in range(draw.randint(0, 4)):
            a[draw.randrange(30)] = f"z{draw.randint(0, 10**6)}"
        b[draw.randrange(8)] = f"q{draw.randint(0, 10)}"
        rows.append((i, " ".join(a) + "\n" + " ".join(b)))
    gone, _ = lines_gone(rows)
    assert {(r.doc_id, int(k)) for r in line_dedup.removed(docs(rows)).collect() for k in r.removed.split(",") if k} == gone


def test_lines_of_edge_rows(docs, edge_rows):
    got = {(r.doc_id, r.n_lines, r.n_removed, r.removed) for r in line_dedup.removed(docs(edge_rows)).collect()}
    assert got == {
        (None, 1, 0, ""), (1, 0, 0, ""), (2, 0, 0, ""), (3, 0, 0, ""), (4, 1, 1, "0"), (5, 1, 1, "0"), (-7, 1, 0, ""), (6, 1, 0, ""),
        (7, 1, 0, ""), (8, 1, 0, ""), (9, 2, 1, "2"), (2**62, 1, 0, ""),
    }
    kept = line_dedup.dedup(docs(edge_rows))
    assert kept.columns == docs([]).columns
    texts = {(r.doc_id, r.text) for r in kept.collect()}
    assert (9, "\n\n\none two\n") in texts and (3, " \n\t ") in texts and (1, None) in texts and not any(i in (4, 5) for i, _ in texts)
    assert line_dedup.removed(docs([])).count() == 0 and line_dedup.dedup(docs([])).count() == 0


def test_documents_without_ids_are_told_apart(spark, docs):
    """Very many distinct texts of one id have distinct names; lines of each are found and cut for itself."""
    df = spark.range(200_000).selectExpr("cast(null as long) as doc_id", "concat('t', id) as text")
    assert line_dedup.with_names(df).select("doc", "rest").distinct().count() == 200_000
    rows = [(None, f"own words of text number {k}") for k in range(50)] + [(None, "a line that all of them share\n" + f"z{k} y{k} x{k}") for k in range(50)] + [(3, "a line that all of them share")]
    kept = [r.text for r in line_dedup.dedup(docs(rows)).collect()]
    assert sum("that all of them share" in t for t in kept) == 1 and sum("z" in t for t in kept) == 50


def test_lines_whose_names_clash_are_still_compared():
    """Lines that share the first half of their name are different lines of a bucket; equal ones are one."""
    name = 20 << line_dedup._N_SHIFT | 5
    rows = [(64, 0, name, 1, 0, 0), (64, 0, name, 1, 9 << 39, 0), (64, 0, name, 2, 0, 0), (128, 0, name, 2, 0, 0)]
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["bucket", "salt", "name", "more", "rest", "bits"])
    got = [tuple(r.values()) for out in line_dedup._walk([batch]) for r in out.to_pylist()]
    assert got == [(None, name, 1, name, 2)]


def walked(rows):
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["bucket", "salt", "name", "more", "rest", "bits"])
    return [tuple(r.values()) for out in line_dedup._walk([batch]) for r in out.to_pylist()]


def test_pairs_of_a_crowd_grow_with_its_lines():
    """Of 400 lines that may all match each other, each is paired with the oldest only; the others are told by marked rows."""
    rows = [(64, 0, 20 << line_dedup._N_SHIFT | k, k, (400 - k) << 39, 0) for k in range(400)]
    got = walked(rows)
    pairs = [r for r in got if r[0] is None]
    assert len(pairs) == 399 and all(r[3] == rows[399][2] for r in pairs)
    assert sum(r[0] == 64 for r in got) == 400 and sum(r[0] == 64 and r[3] < 0 for r in got) == 398  # the two oldest have no further candidate


def test_long_lines_without_common_words_are_no_candidates(docs):
    """The bitmap tells long lines apart: its parities do not fill up as its bits would."""
    draw = random.Random(4)
    lines = [" ".join(["shared", *(f"w{draw.randrange(10**9)}" for _ in range(140))]) for _ in range(30)]
    made = line_dedup.Lines(pa.array(lines), np.full(2**line_dedup.SLOT_BITS, 2))
    bucket, name, _, rest, bits = line_dedup._postings(made, np.arange(30))
    _, first = np.unique(name, return_index=True)
    a, b = np.triu_indices(30, 1)
    a, b = first[a], first[b]
    assert line_dedup._passes(name[a], name[b], rest[a] & ~(127 << 32), rest[b] & ~(127 << 32), bits[a], bits[b], bucket[a] * 0).mean() < 0.05


def test_buckets_are_shuffled_as_one_row_for_each_part(spark, docs, monkeypatch):
    """Every document is one row of names, and a slice's postings one row for each part; a bucket's salt is in one part."""
    monkeypatch.setattr(line_dedup, "HOT_ROWS", 8)
    rows = line_rows(3) + [(None, None), (None, ""), (70, "\n \n")]
    every, counts, most = line_dedup._read(line_dedup.with_names(docs(rows).select("doc_id", "text")))
    assert sorted((str(r.doc_id), len(r.name)) for r in every.collect()) == sorted((str(i), sum(bool(WORD.search(x)) for x in (t or "").split("\n"))) for i, t in rows)
    assert counts.sum() == sum(len(WORD.findall(t or "")) for _, t in rows)
    made = line_dedup.Lines(pa.array([t for _, t in rows[:60]]), counts)
    found = line_dedup._postings(made, np.arange(60))
    assert 500 < len(found[0]) <= most and (found[0] >> 1 & 31).any()
    packed = line_dedup._packed(found, 7)
    assert packed.num_rows == 7 and packed.column("part").to_pylist() == list(range(7))
    parts = list(line_dedup._unpacked([packed.slice(0, 3), packed.slice(3), packed.slice(0, 0)]))
    assert len(parts) == 7 and all((np.diff(x[:, 0]) >= 0).all() for x in parts)
    assert sorted(map(tuple, np.concatenate(parts).tolist())) == sorted(zip(*(x.tolist() for x in found)))
    held = [set(x[x[:, 0] >> 1 & 31 == 0, 0].tolist()) for x in parts]
    assert sum(map(len, held)) == len(set.union(*held))
    lines = [set(zip(x[:, 0].tolist(), x[:, 1].tolist())) for x in parts]
    assert sum(map(len, lines)) == len(set.union(*lines))


def test_lines_in_many_parts_equal_brute_force(docs, monkeypatch):
    """The result does not depend on how many parts the buckets are dealt into."""
    monkeypatch.setattr(line_dedup, "PART_ROWS", 64)
    rows = line_rows(11)
    gone, _ = lines_gone(rows)
    assert {(r.doc_id, int(k)) for r in line_dedup.removed(docs(rows)).collect() for k in r.removed.split(",") if k} == gone


def brute_top(rows, k):
    usable = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in {(i, tuple(v)) for i, v in usable if i % 3 == 0}:
        best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 7)
    monkeypatch.setattr(topk, "QUERY_ROWS", 3)
    draw = random.Random(1)
    rows = [(i, [draw.choice([0.0, 0.5, -0.25, 1.0, draw.uniform(-1, 1)]) for _ in range(5)]) for i in range(40)]
    rows += [(100, None), (None, [1.0] * 5), (102, [1.0, None, 0.0, 0.0, 0.0]), (105, [float("nan")] * 5), (108, [float("inf")] + [0.0] * 4), (5, rows[5][1]), (111, [1.0, 2.0]), (114, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1)).withColumn("id", F.lit("x"))
    got = sorted(tuple(r) for r in topk.search(df, F.col("vec_id") % 3 == 0, k=6).collect())
    assert got == brute_top(rows, 6)
    with pytest.raises(ValueError):
        topk.search(spark.createDataFrame([(0, [1e16]), (1, [1e16])], "vec_id long, embedding array<float>"), F.lit(True))
    twice = spark.createDataFrame([(100, [1.0]), (100, [-1.0]), (1, [1.0]), (2, [0.5]), (1, [1.0])], "vec_id long, embedding array<float>")
    found = sorted((r["rank"], r.vec_id, r.score) for r in topk.search(twice, F.col("vec_id") == 100).collect())
    up, down = [(1, 1, 1024**2), (2, 1, 1024**2), (3, 2, 1024 * 512)], [(1, 2, -1024 * 512), (2, 1, -(1024**2)), (3, 1, -(1024**2))]
    assert found == sorted(up + down)
    few = spark.createDataFrame(rows[:3], df.select("vec_id", "embedding").schema)
    assert topk.search(few, F.col("vec_id") == 0).count() == 2
    assert topk.search(few.where("false"), F.col("vec_id") == 0).count() == 0


def test_queries_keep_their_block_whatever_the_order_of_rows(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_ROWS", 3)
    monkeypatch.setattr(topk, "_best", lambda asked, rows, k: pd.DataFrame({"query_id": asked["id"], "key": 0, "vec_id": (asked["id"] ** 2).sum(), "score": 0}))
    rows = [(i % 30, [float(i), 1.0]) for i in range(60)]
    frame = lambda order: spark.createDataFrame(order, "vec_id long, embedding array<float>").coalesce(1)
    blocks = [sorted(tuple(r) for r in topk.search(frame(order), F.lit(True)).select("query_id", "vec_id").collect()) for order in (rows, rows[::-1], rows[31:] + rows[:31])]
    assert len({b for _, b in blocks[0]}) > 1 and blocks[0] == blocks[1] == blocks[2]
