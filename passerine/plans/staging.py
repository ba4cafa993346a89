"""Materialising an intermediate result that several outputs read."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from passerine.session import shared_dir

Stage = Callable[[DataFrame, str], DataFrame]


def shared_stage(spark: SparkSession, partition_by: list[str] | None = None) -> Stage:
    """:func:`table_stage` in a folder of its own under the folder that driver and executors share."""
    return table_stage(spark, f"{shared_dir(spark)}/stage-{uuid.uuid4().hex}", partition_by)


def inline(df: DataFrame, name: str) -> DataFrame:
    """No materialisation: every output recomputes the intermediate result."""
    return df


def table_stage(spark: SparkSession, folder: str, partition_by: list[str] | None = None) -> Stage:
    """Write the intermediate result under a shared folder once and read it back.

    The files survive the loss of executors, cut the lineage, and let each output read only its
    own partition.
    """
    def stage(df: DataFrame, name: str) -> DataFrame:
        path = f"{folder.rstrip('/')}/{name}"
        writer = df.write.mode("overwrite")
        columns = [c for c in partition_by or [] if c in df.columns]
        if columns:
            writer = writer.partitionBy(*columns)
        writer.parquet(path)
        return spark.read.schema(df.schema).parquet(path).select(*df.columns)

    return stage
