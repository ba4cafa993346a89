"""Joins that survive a hot key and a growing right side, and lists that stay bounded.

``adaptive_join`` joins on the keys plus a hash of them.  The extra column makes Spark put an
exchange of its own on both sides, also when the right side comes out of an aggregate on the same
key.  Adaptive execution then sees the measured size of both sides and

* ships the right side to the tasks when it is under the broadcast threshold, or
* splits every partition that a hot key (or the NULL key, which matches nothing) has blown up
  into many tasks of ordinary size.

Without the hash, an aggregated right side would share the join's partitioning, and adaptive
execution cannot split such a join.

Before it has measured a side, Spark goes by the size of its files, and those of a table that a stage has written may
be a hundredth of the rows in memory.  A right side that grows with the left one is therefore ``shuffled``.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from passerine.session import shared_dir


def adaptive_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "left", shuffled: bool = False) -> DataFrame:
    """Equi-join on same-named columns; ``how`` is inner, left, left_semi or left_anti.

    With ``shuffled`` both sides are shuffled, whatever their guessed or measured size: neither goes through the driver.
    """
    if shuffled:
        right = right.hint("merge")
    ltypes, rtypes = dict(left.dtypes), dict(right.dtypes)
    unequal = [k for k in on if ltypes[k] != rtypes[k]]
    digest = lambda side: F.xxhash64(*[F.col(k) if k not in unequal else F.col(f"_k_{k}") for k in on])
    if not unequal:
        return left.withColumn("_h", digest(left)).join(right.withColumn("_h", digest(right)), [*on, "_h"], how).drop("_h")
    # Equality is decided in the keys' common type, so hashes and join use it too; the left side's own column stays.
    kind = _common_types(left, {k: (ltypes[k], rtypes[k]) for k in unequal})
    cast = lambda df: df.withColumns({f"_k_{k}": F.col(k).cast(t) for k, t in kind.items()})
    left, right = cast(left), cast(right).drop(*unequal)
    keys = [f"_k_{k}" if k in unequal else k for k in on]
    joined = left.withColumn("_h", digest(left)).join(right.withColumn("_h", digest(right)), [*keys, "_h"], how)
    return joined.drop("_h", *(f"_k_{k}" for k in unequal))


def _common_types(df: DataFrame, kinds: dict[str, tuple[str, str]]) -> dict[str, str]:
    """The type in which Spark compares two types."""
    typed = lambda t: F.lit(None).cast(t)
    probe = df.sparkSession.range(0).select(*(F.coalesce(typed(a), typed(b)).alias(k) for k, (a, b) in kinds.items()))
    return dict(probe.dtypes)


def running(df: DataFrame, keys: list[str], order: list[str], measures: dict[str, tuple[str, Column]]) -> DataFrame:
    """Add, for each measure, its total over the rows of the same key that come before a row in ``order`` (nulls first).

    A measure is (kind, value), of kind ``sum``, ``bit_xor``, or ``count`` of the rows before. Rows are dealt by ranges of
    (keys, order, hash of the row), so a key's rows go on from task to task however many there are, and the dealt rows are
    kept in the shared folder. Each range adds up its own rows; what a key has in earlier ranges is a row for each range
    that the key goes on into. The null key is a key. Rows equal in every column stand beside each other.
    """
    named = {f"_m_{name}": value for name, (_, value) in measures.items()}
    dealt = df.withColumns(named).withColumn("_tie", F.xxhash64(*df.columns))
    line = [F.col(c).asc_nulls_first() for c in [*keys, *order, "_tie"]]
    dealt = kept(dealt.repartitionByRange(*line).withColumn("_range", F.spark_partition_id()))
    of_kind = {"sum": F.sum, "bit_xor": F.bit_xor, "count": F.count}
    total = lambda name, kind: of_kind[kind](f"_m_{name}")
    zero, join = F.lit(0).cast("long"), {"sum": Column.__add__, "count": Column.__add__, "bit_xor": Column.bitwiseXOR}
    ranges = dealt.groupBy("_range", *keys).agg(*(total(n, kind).alias(f"_t_{n}") for n, (kind, _) in measures.items()))
    earlier = Window.partitionBy(*keys).orderBy("_range")
    until = earlier.rowsBetween(Window.unboundedPreceding, -1)
    carried = ranges.select(
        "_range", F.row_number().over(earlier).alias("_nth"), *(F.col(k).alias(f"_k_{k}") for k in keys),
        *(of_kind[kind if kind != "count" else "sum"](f"_t_{n}").over(until).alias(f"_b_{n}") for n, (kind, _) in measures.items()),
    ).where("_nth > 1").drop("_nth")
    before = Window.partitionBy("_range", *keys).orderBy(*line[len(keys):]).rowsBetween(Window.unboundedPreceding, -1)
    own = dealt.withColumns({n: F.coalesce(total(n, kind).over(before), zero) for n, (kind, _) in measures.items()})
    # Only the first key of a range can go on from an earlier one: a row for each range at most, whatever the data.
    found = adaptive_join(own, carried, ["_range"])
    same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys))
    done = {n: F.when(same & F.col(f"_b_{n}").isNotNull(), join[kind](F.col(n), F.col(f"_b_{n}"))).otherwise(F.col(n)) for n, (kind, _) in measures.items()}
    return found.withColumns(done).select(*df.columns, *measures)


def kept(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read again: later uses see the same rows, also after lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Distinct rows of a table that has few equal ones: rows are dealt by their values first, so that a task holds the rows
    of one partition, not those of its whole input."""
    return df.repartition(*df.columns).distinct()


def numbered_runs(df: DataFrame, keys: list[str], order: list[str], length: int) -> DataFrame:
    """Add ``part``: rows of a key in ``order`` form runs of ``length`` rows, numbered from 0.

    One rule for keys of any size: a list built per key and part never holds more than ``length``
    rows, and reading the parts in turn gives the key's rows in order.  A hot key's rows are sorted
    and numbered by many tasks (see :func:`running`); equal rows take positions of their own.
    """
    position = running(df, keys, order, {"_position": ("count", F.lit(1))})
    return position.withColumn("part", F.floor(F.col("_position") / F.lit(length)).cast("bigint")).drop("_position")
