"""Aggregations.  All of them combine map-side, so a hot group costs one partial row per task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passerine.functions.values import ext_type, text


def last_non_null(df: DataFrame, keys: list[str], columns: list[str], order: list[str]) -> DataFrame:
    """Per key the latest non-null value of each column; ``order`` ends in a tie-break column."""
    rank_key = F.struct(*order)
    picks = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), rank_key)).alias(c) for c in columns]
    return df.groupBy(*keys).agg(*picks)


def any_non_null_pivot(df: DataFrame, key: str, name: str, value: str, names: list[str]) -> DataFrame:
    """Entity-attribute-value rows to one wide row per key; the greatest value is chosen."""
    return df.groupBy(key).agg(*[F.max(F.when(F.col(name) == n, F.col(value))).alias(n) for n in names])


def external_id_pivot(payloads: DataFrame, types: list[str], prefix: str = "e_") -> DataFrame:
    """Add the greatest id text per external-id type, computed inside the array (no explode)."""
    picked = {}
    for name in types:
        ids = F.transform(F.filter("ext_ids", lambda x: ext_type(x) == name), lambda x: text(x["id"]))
        picked[f"{prefix}{name}"] = F.array_max(ids)
    return payloads.withColumns(picked)


def group_by_all(df: DataFrame, measures: list[str], aggs: dict[str, Column]) -> DataFrame:
    """Group by every column that is not a measure."""
    keys = [c for c in df.columns if c not in measures]
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])


def count_distinct_union(df: DataFrame, entity: str, specs: dict[str, Column]) -> DataFrame:
    """(audience_name, count): distinct entities per predicate, all audiences in one pass.

    Membership is first reduced to one row of flags per entity, then the flags are summed, so
    neither the rows nor the scan multiply with the number of audiences.
    """
    names = list(specs)
    flags = [F.max(F.when(specs[n], 1).otherwise(0)).alias(f"f{i}") for i, n in enumerate(names)]
    per_entity = df.filter(F.col(entity).isNotNull()).groupBy(entity).agg(*flags)
    totals = per_entity.agg(*[F.coalesce(F.sum(f"f{i}"), F.lit(0)).cast("bigint").alias(n) for i, n in enumerate(names)])
    pairs = F.array(*[F.struct(F.lit(n).alias("audience_name"), F.col(f"`{n}`").alias("count")) for n in names])
    return totals.select(F.inline(pairs))


def latest_per_user_event(payloads: DataFrame) -> DataFrame:
    """Latest record per (userId, event) by timestamp text.

    Decision: a missing timestamp loses, ties go to the greater message id.  Rows without userId or
    event are left out.
    """
    from passerine.functions.values import has_root, root_text

    rank_key = F.struct(F.coalesce(root_text("timestamp"), F.lit("")), F.coalesce(root_text("messageId"), F.lit("")))
    keyed = payloads.filter(has_root("userId") & has_root("event")).select(
        root_text("userId").alias("user_id"), root_text("event").alias("event"), rank_key.alias("_k"), "raw_payload",
    )
    return keyed.groupBy("user_id", "event").agg(F.max_by("raw_payload", "_k").alias("raw_payload"))


def min_max_count(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(ts).alias("first_at"), F.max(ts).alias("last_at"), F.count(F.lit(1)).alias("counts"))


def string_agg_distinct(df: DataFrame, keys: list[str], columns: list[str], sep: str = " | ", when: Column | None = None) -> DataFrame:
    """Distinct values per key joined in sorted order, NULL where ``when`` does not hold."""
    kept = {c: F.col(c).cast("string") if when is None else F.when(when, F.col(c).cast("string")) for c in columns}
    grouped = df.groupBy(*keys).agg(*[F.collect_set(v).alias(c) for c, v in kept.items()])
    joined = lambda c: F.when(F.size(c) > 0, F.array_join(F.array_sort(c), sep))
    return grouped.select(*keys, *[joined(c).alias(c) for c in columns])


def nested_best_value(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Per key the value of the row greatest by ``order`` then by the value itself; NULLs lose."""
    return df.groupBy(*keys).agg(F.max(F.struct(*order, F.col(value).alias("_v"))).alias("_b")).select(
        *keys, F.col("_b._v").alias(value)
    )


def having_filters(df: DataFrame, keys: list[str], aggs: dict[str, Column], condition: Column) -> DataFrame:
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()]).filter(condition)


def match_rate(df: DataFrame, key: str) -> DataFrame:
    """Match and mismatch sums per key with the mismatch percent; only keys that mismatch."""
    matched, un_matched = F.sum("matched"), F.sum("un_matched")
    guard = F.coalesce(matched.cast("double"), F.lit(0.01)) + F.coalesce(un_matched.cast("double"), F.lit(0.01))
    return df.groupBy(key).agg(
        F.sum(F.coalesce("matched", F.lit(0))).alias("match_count"),
        F.sum(F.coalesce("un_matched", F.lit(0))).alias("un_match_count"),
        (F.sum(F.coalesce("un_matched", F.lit(0))) / guard * 100).alias("un_match_percent"),
    ).filter(F.col("un_match_percent") > 0)


def non_blank_counts(df: DataFrame, columns: list[str], ts: str, keys: list[str] | None = None) -> DataFrame:
    """(keys.., column_name, non_blank_counts, overall_counts, latest) for many columns in one pass."""
    keys = keys or []
    aggs = [F.max(F.col(ts).cast("date")).alias("_latest")]
    for i, c in enumerate(columns):
        value = F.col(c).cast("string")
        blank = F.coalesce(F.trim(value) == "", F.lit(True))
        aggs += [
            F.sum(F.when(blank, 0).otherwise(1)).alias(f"n{i}"),
            F.count(F.col(c)).alias(f"a{i}"),
            F.max(F.when(~blank, F.col(ts).cast("date"))).alias(f"t{i}"),
        ]
    wide = df.groupBy(*keys).agg(*aggs)
    rows = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"), F.col(f"n{i}").cast("bigint").alias("non_blank_counts"),
            F.col(f"a{i}").alias("overall_counts"), F.col(f"t{i}").alias("latest"),
        )
        for i, c in enumerate(columns)
    ])
    return wide.select(*keys, F.inline(rows))


def min_created(df: DataFrame, key: str, ts: str) -> DataFrame:
    return df.groupBy(key).agg(F.min(ts).alias(ts))


def first_row_group_doc(df: DataFrame, key: str, order: list[str], scalars: list[str], listed: list[str], limit: int = 10_000) -> DataFrame:
    """One document per key: scalars of its first row and the list of its rows in order.

    A document is a part: a run of ``limit`` rows in order, numbered from 0, whatever the key's size;
    the scalars are the key's in every part.
    """
    from passerine.operators.skew import adaptive_join, numbered_runs

    rank_key = F.struct(*order)
    firsts = df.groupBy(key).agg(*[F.min_by(c, rank_key).alias(c) for c in scalars], F.count(F.lit(1)).alias("n_rows"))
    parts = numbered_runs(df, [key], order, limit)
    item = F.struct(*order, *[c for c in listed if c not in order])
    lists = parts.groupBy(key, "part").agg(F.array_sort(F.collect_list(item)).alias("items"))
    return adaptive_join(lists, firsts, [key], "inner")


def distinct(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """All-column distinct, or the distinct values of a subset of the columns."""
    return df.distinct() if subset is None else df.select(*subset).distinct()
