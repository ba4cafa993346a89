"""Hard negatives against plain loops, with blocks small enough to meet many times."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from passerine.llm import hard_negatives


def plain(rows, is_anchor, positives=5, negatives=10):
    usable = {(i, tuple(math.floor(256 * x) for x in v), label) for i, v, label in rows if None not in (i, v, label) and all(x is not None and math.isfinite(x) for x in v)}
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, v, label in usable:
        if is_anchor(i):
            scored = sorted(((-score(v, w), j, m) for j, w, m in usable if j != i))
            for p, j, _ in [s for s in scored if s[2] == label][:positives]:
                band = [s for s in scored if s[2] != label and 30 * -p <= 100 * -s[0] <= 90 * -p]
                out += [(i, j, rank, k, -p, -n) for rank, (n, k, _) in enumerate(band[:negatives], 1)]
    return sorted(out)


def made(seed, n):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        dims = draw.choice([8, 8, 8, 3, 13, 0])
        v = [draw.choice([0.0, 0.25, -0.5, 1.0, -1.0, draw.uniform(-2, 2)]) for _ in range(dims)]
        rows.append((i, v, draw.choice([0, 0, 0, 1, 2])))
    rows += [(n + 1, None, 1), (n + 2, [1.0, None], 1), (n + 3, [float("nan")], 1), (n + 4, [1.0, float("inf")], 1), (n + 5, [1.0], None), (None, [1.0], 1)]
    return rows + rows[:20] + [(50, [0.5] * 8, 2), (51, [1.0] * 8, 0)] + [(49, [0.25] * 8, 1)] * 300


@pytest.mark.parametrize("block_rows,anchor_rows", [(16_384, 4096), (13, 3)])
def test_negatives_equal_plain_loops(spark, block_rows, anchor_rows):
    rows = made(3, 160)
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "vec_id long, embedding array<double>, label int, id int, v int, key string").repartition(4)
    got = hard_negatives.mine(df, F.col("vec_id") % 10 == 0, block_rows=block_rows, anchor_rows=anchor_rows).collect()
    assert sorted(map(tuple, got)) == plain(rows, lambda i: i % 10 == 0) and got


def test_table_scores_are_inner_products():
    draw = np.random.default_rng(1)
    for low, high, bits in ((-1, 1, 1), (-300, 300, 10), (-(2**20), 2**20, 21)):
        a, c = (pd.Series([draw.integers(low, high, draw.integers(0, 40)) for _ in range(n)]) for n in (9, 70))
        scorer = hard_negatives.Scorer(a, c, bits)
        for numbers, rows in ((np.arange(9), np.arange(70)), (np.array([0, 4, 8]), np.array([1, 30, 69]))):
            want = [[int(np.dot(a[x][:k], c[y][:k])) for y in scorer.candidates.order[rows] for k in [min(len(a[x]), len(c[y]))]] for x in scorer.anchors.order[numbers]]
            assert scorer(numbers, rows).tolist() == want


def test_edges_of_mining(spark):
    kind = "vec_id long, embedding array<float>, label int"
    run = lambda rows: hard_negatives.mine(spark.createDataFrame(rows, kind), F.col("vec_id") % 2 == 0).collect()
    assert run([]) == [] and run([(0, [1.0], 1)]) == [] and run([(0, [1.0], 1), (1, [1.0], 1)]) == []
    with pytest.raises(ValueError):
        run([(0, [1e16], 1), (1, [1e16], 2)])
    # Zero positives take zero negatives only; negative positives none.
    got = run([(0, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (3, [0.0, 5.0], 2), (5, [1.0, 0.0], 2)])
    assert [tuple(r) for r in got] == [(0, 1, 1, 3, 0, 0)]
    assert run([(0, [1.0], 1), (1, [-1.0], 1), (3, [-0.5], 2)]) == []
    long = [0.125] * 30_000
    assert len(run([(0, long, 1), (1, long, 1), (3, [0.0625] * 30_000, 2)])) == 1
