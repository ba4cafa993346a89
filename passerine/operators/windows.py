"""Newest-row selection.

``rank() <= 1`` and ``row_number() <= 1`` filters are written as windows on purpose: Spark then
limits each group inside every map task before the shuffle, so a hot group sends at most one row
(or its ties) per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_row(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key by ``order``; the order must end in a tie-break."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def rank_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Rows ranked first per key by ``order``; ties are kept."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rk", F.rank().over(w)).filter(F.col("_rk") == 1).drop("_rk")


def latest_row_per_user(df: DataFrame, column: str, order: list[Column]) -> DataFrame:
    """(user_id, value) of the newest row per user whose column is not blank."""
    filled = df.filter(F.trim(F.col(column).cast("string")) != "")
    return latest_row(filled, ["user_id"], order).select("user_id", column)


def latest_opt_per_service(opts: DataFrame, order: list[Column], merge: dict[str, str] | None = None) -> DataFrame:
    """Newest opt row per (user, service); ``merge`` maps several service names onto one afterwards.

    The rank is taken per original service name, as several merged names may each keep a row.
    """
    newest = latest_row(opts, ["user_id", "service_name"], order)
    if not merge:
        return newest
    renamed = F.col("service_name")
    for old, new in merge.items():
        renamed = F.when(F.col("service_name") == old, new).otherwise(renamed)
    return newest.withColumn("service_name", renamed)


def latest_trait_rank(traits: DataFrame) -> DataFrame:
    """Newest rows per (person, trait, value); ties kept."""
    return rank_first(
        traits, ["consumerid_sourceid_mpn", "traitId", "trait_value"],
        [F.col("trait_consumer_last_updated_date").desc_nulls_last()],
    )


def latest_consent_rank(consents: DataFrame) -> DataFrame:
    """Newest rows per (user, opt date, status, service, contact point); ties kept."""
    return rank_first(
        consents, ["userId", "opt_date", "opt_status", "service_name", "contact_point_type_name"],
        [F.col("created_date").desc_nulls_last(), F.col("trace_id").desc_nulls_last()],
    )


def earliest_identity_rank(identities: DataFrame) -> DataFrame:
    """Earliest created person per source user id; ties kept."""
    return rank_first(identities, ["id_value"], [F.col("created_date").asc_nulls_first()])


def report_order(df: DataFrame, columns: list[Column]) -> DataFrame:
    return df.orderBy(*columns)


def top1_in_array(df: DataFrame, array: str, order: list[str], value: str, name: str) -> DataFrame:
    """Value of the array element that is greatest by ``order``; NULL order fields lose."""
    shaped = F.transform(array, lambda x: F.struct(*[x[c].alias(c) for c in order], x[value].alias("_v")))
    return df.withColumn(name, F.array_max(shaped)["_v"])


def union_all(*dfs: DataFrame) -> DataFrame:
    out = dfs[0]
    for df in dfs[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def flatten_merge(*branches: DataFrame) -> DataFrame:
    """Branches of a split put together again."""
    return union_all(*branches)
