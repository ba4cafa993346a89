"""Joins that hash their keys find what plain joins find."""

import pytest

from passerine.operators.skew import adaptive_join

ROWS = [("bigint", "0, 1, 7, 9007199254740993, null"), ("int", "0, 1, 7, null"), ("double", "-0.0D, 1.0D, 7.5D, null"), ("string", "'1', '007', '0', null"), ("decimal(10,2)", "1.00, 7.50, null"), ("smallint", "7, null")]


@pytest.mark.parametrize("left", ROWS, ids=lambda r: r[0])
@pytest.mark.parametrize("right", ROWS, ids=lambda r: r[0])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_mixed_types_match_as_in_a_plain_join(spark, left, right, how):
    a = spark.sql(f"select cast(k as {left[0]}) k, 'a' x from (select explode(array({left[1]})) k)")
    b = spark.sql(f"select cast(k as {right[0]}) k, 'b' y from (select explode(array({right[1]})) k)")
    if "string" in (left[0], right[0]) and left[0] != right[0]:
        b = b.where("k is null or try_cast(k as bigint) is not null")
    got = adaptive_join(a, b, ["k"], how)
    other = b.withColumnRenamed("k", "k2")
    want = a.join(other, a["k"] == other["k2"], how).select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.columns[0] == "k" and dict(got.dtypes)["k"] == left[0]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_a_shuffled_join_ships_neither_side(spark, how):
    from tests.test_plans import plan_of

    a = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, x string")
    b = spark.createDataFrame([(1,), (3,), (None,)], "k int")
    got = adaptive_join(a, b, ["k"], how, shuffled=True)
    assert "Broadcast" not in plan_of(got, "simple")
    assert sorted(map(str, got.collect())) == sorted(map(str, adaptive_join(a, b, ["k"], how).collect()))


def test_running_totals_of_a_hot_key_over_many_ranges(spark):
    """A key with most rows, null keys and orders, equal rows: as a plain loop, with the hot key dealt over many tasks."""
    import random

    from pyspark.sql import functions as F

    from passerine.operators import skew

    draw = random.Random(5)
    rows = [(draw.choice(["hot"] * 6 + [None, "a", "b"]), draw.choice([None, *range(900)]), draw.randrange(-50, 50)) for _ in range(4000)]
    rows += [("hot", 7, 1)] * 20
    df = spark.createDataFrame(rows, "k string, o int, v long").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = skew.running(df, ["k"], ["o"], {"n": ("count", F.lit(1)), "s": ("sum", F.col("v")), "x": ("bit_xor", F.col("v"))})
        got = out.collect()
        ranges = skew.kept(df.repartitionByRange("k", "o")).where("k = 'hot'").select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert ranges >= 4 and sorted(map(str, out.columns)) == ["k", "n", "o", "s", "v", "x"]
    for key in ("hot", None, "a", "b"):
        mine = sorted((r for r in got if r.k == key), key=lambda r: r.n)
        assert [r.n for r in mine] == list(range(len(mine)))
        assert [r.o for r in mine] == sorted((o for k, o, _ in rows if k == key), key=lambda o: (o is not None, o or 0))
        total = xor = 0
        for r in mine:
            assert (r.s, r.x) == (total, xor)
            total, xor = total + r.v, xor ^ r.v
    assert skew.running(df.limit(0), ["k"], ["o"], {"n": ("count", F.lit(1))}).count() == 0


def test_runs_hold_a_key_in_order(spark):
    from pyspark.sql import functions as F

    from passerine.operators.skew import numbered_runs

    df = spark.range(1000).selectExpr("id % 3 as k", "id as o")
    out = numbered_runs(df, ["k"], ["o"], 100).groupBy("k", "part").agg(F.count("*").alias("n"), F.min("o").alias("a"), F.max("o").alias("b")).orderBy("k", "part").collect()
    assert all(r.n == 100 or r.part == 3 for r in out) and sum(r.n for r in out) == 1000
    assert all(x.k != y.k or x.b < y.a for x, y in zip(out, out[1:]))
