"""Profile users of the source side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passerine.operators.joins import anti_by_null_check, profile_users_join
from passerine.operators.skew import distinct_rows
from passerine.operators.windows import report_order, union_all


def _attributes(df: DataFrame) -> DataFrame:
    return df.select(
        "user_id", "marketing_program_number", "consumer_id", "source_id", F.sha2(F.lower("email"), 256).alias("email_sha256"),
        F.date_format("original_timestamp", "yyyy-MM-dd HH:mm:ss").alias("original_timestamp"),
    )


def profile_users(identifies: DataFrame, canonical: DataFrame, aliases: list[DataFrame], foreign: DataFrame) -> DataFrame:
    """Distinct users of identifies (without ``foreign`` programs), the canonical table, and aliases, by time."""
    own = anti_by_null_check(
        identifies.filter(F.col("marketing_program_number").isNotNull()),
        foreign.select(F.col("mpn").alias("marketing_program_number")), ["marketing_program_number"])
    current = _attributes(canonical)
    merged = union_all(distinct_rows(_attributes(own)), distinct_rows(current), profile_users_join(aliases, current))
    dated = merged.filter(F.col("original_timestamp").isNotNull())
    return report_order(dated, [F.col("original_timestamp")])
