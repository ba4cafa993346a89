"""Frame helper that keeps costly expressions from being evaluated more than once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add or replace columns (they come last) that are evaluated exactly once per row.

    The optimizer may copy a projected expression into every later use: into filters it pushes
    down, and into lambdas that run per map entry.  For JSON parsing and map rewriting that would
    repeat the work many times.  Passing the values through a one-row ``inline`` generator stops
    both rewrites, stays inside the JVM and changes neither the rows nor their partitioning.
    """
    # The projection below the generator lets code generation share common sub-expressions.
    kept = [c for c in df.columns if c not in columns]
    staged = df.select(*kept, *[value.alias(f"_once_{name}") for name, value in columns.items()])
    packed = F.array(F.struct(*[F.col(f"_once_{name}").alias(name) for name in columns]))
    return staged.select(*kept, F.inline_outer(packed))


def split(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """(rows where the condition holds, all other rows); the condition is evaluated once per row."""
    flagged = once(df, _flag=F.coalesce(condition, F.lit(False)))
    return flagged.filter("_flag").drop("_flag"), flagged.filter(~F.col("_flag")).drop("_flag")


def keep(df: DataFrame, condition: Column) -> DataFrame:
    """Rows where the condition holds; the condition is evaluated once per row."""
    return once(df, _flag=condition).filter("_flag").drop("_flag")
