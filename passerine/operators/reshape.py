"""Wide to long, long to wide, nested to flat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from passerine.operators.enrich import leaf_entries


def unpivot_traits(df: DataFrame, key: str, exclude: list[str] | None = None) -> DataFrame:
    """(key, trait_name, trait_value): every other column as text, nulls dropped, distinct."""
    names = [c for c in df.columns if c != key and c not in (exclude or [])]
    texts = df.select(key, *[F.col(c).cast("string").alias(c) for c in names])
    long = texts.unpivot([key], names, "trait_name", "trait_value")
    return long.filter(F.col("trait_value").isNotNull()).distinct()


def pivot_ecosystems(df: DataFrame, keys: list[str], values: list[str], name: str = "ecoSystemName", value: str = "ecoTraitName") -> DataFrame:
    """Trait names per ecosystem as one column each, for a fixed list of ecosystems."""
    return df.groupBy(*keys).pivot(name, values).agg(F.max(value))


def unnest_json_array(df: DataFrame, json: str, path: str, outer: bool = True) -> DataFrame:
    """One row per element of a JSON array, as ``element`` text; ``outer`` keeps rows without any."""
    items = F.transform(
        F.try_variant_get(F.try_parse_json(F.get_json_object(json, path)), "$", "array<variant>"), lambda v: F.to_json(v)
    )
    return df.select("*", (F.explode_outer(items) if outer else F.explode(items)).alias("element"))


def leaves_to_rows(df: DataFrame, value: Column) -> DataFrame:
    """(.., key, val): scalar leaves of a nested variant by dotted path; array items by their index."""
    leaves = leaf_entries(
        value, F.lit(""),
        lambda path, key: F.when(path == "", key).otherwise(F.concat(path, F.lit("."), key)),
        lambda path, i: F.concat(path, F.lit("."), i.cast("string")),
        skip_null_members=False,
    )
    rows = df.withColumn("_leaves", leaves).select(*df.columns, F.explode("_leaves").alias("_l"))
    return rows.select(*df.columns, F.col("_l.path").alias("key"), F.try_variant_get("_l.value", "$", "string").alias("val"))


def split_to_rows(df: DataFrame, column: str, sep: str = "|", name: str = "value") -> DataFrame:
    """One row per part of a delimited text."""
    import re

    return df.select("*", F.explode(F.split(F.col(column), re.escape(sep))).alias(name))


def key_bucket(key: Column, buckets: int | Column) -> Column:
    """Stable bucket number of a key, the same in any engine that has MD5."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") % buckets


def batch_rows(df: DataFrame, key: str, size: int, bucket_rows: int = 100_000) -> DataFrame:
    """Add (bucket, batch, position): batches of up to ``size`` rows inside hash buckets of the key.

    There are as many buckets as ``bucket_rows`` goes into the number of rows, rounded up, so a bucket
    stays sortable in one task however large the data; the key is taken to be unique, so no bucket can be hot.
    """
    buckets = F.greatest(F.lit(1), F.ceil(df.agg(F.count(F.lit(1)).alias("n")).scalar() / F.lit(bucket_rows)))
    w = Window.partitionBy("bucket").orderBy(key)
    numbered = df.withColumn("bucket", key_bucket(F.col(key), buckets)).withColumn("_n", F.row_number().over(w) - 1)
    return numbered.withColumns({
        "batch": F.floor(F.col("_n") / size).cast("bigint"), "position": (F.col("_n") % size).cast("bigint"),
    }).drop("_n")
