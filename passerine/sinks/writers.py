"""Writers.  Paths are shared storage; nothing is written from the driver."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passerine.operators.skew import adaptive_join, kept

from passerine.payload import to_document
from passerine.sources.readers import has_format

LANDING_SCHEMA = (
    "raw_payload string, event_type string, marketing_program_number string, source_id string, message_id string, "
    "payload_timestamp string, loaded_date timestamp"
)
LATEST_EVENT_SCHEMA = "raw_payload string, loaded_date timestamp"
FAILURE_SCHEMA = (
    "message_id string, raw_payload string, mpn string, dq_validation_id string, dq_validation_description string, "
    "error_details string, reported_at timestamp"
)


def write_lines(df: DataFrame, path: str, column: str | None = None, compression: str | None = None) -> None:
    """One JSON document per line: a text column, or the payload columns written back as JSON."""
    lines = df.select(F.col(column) if column else to_document().alias("value"))
    lines.write.mode("append").option("compression", compression or "none").text(path)


def conform(df: DataFrame, schema: str | T.StructType) -> DataFrame:
    """Columns of a fixed schema in its order and types; missing columns become NULL, others drop out."""
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted.fields
    ])


def append(df: DataFrame, path: str, schema: str | T.StructType | None = None) -> None:
    """Append to a Parquet table with a fixed schema; also INSERT .. SELECT."""
    (conform(df, schema) if schema else df).write.mode("append").parquet(path)


def replace(df: DataFrame, path: str) -> None:
    """CREATE OR REPLACE .. AS SELECT for a path no input of ``df`` reads."""
    df.write.mode("overwrite").parquet(path)


def replace_version(df: DataFrame, base: str, version: str) -> str:
    """New version of a table that the query itself reads: written beside the old one; returns its path."""
    path = f"{base.rstrip('/')}/version={version}"
    df.write.mode("overwrite").parquet(path)
    return path


def insert_select(df: DataFrame, table: str) -> None:
    """Append to a catalog table, columns matched by name."""
    df.write.mode("append").saveAsTable(table)


def export_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """Report files with a header; ``sep='\\t'`` for the tab-separated variant."""
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def export_tables(tables: dict[str, DataFrame], folder: str, fmt: str = "avro") -> dict[str, str]:
    """Every table under ``folder/<name>`` in the format named; an error where the session lacks it."""
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{folder.rstrip('/')}/{name}"
        if not has_format(df.sparkSession, fmt):
            raise ValueError(f"the session has no data source {fmt!r}")
        df.write.mode("overwrite").format(fmt).save(paths[name])
    return paths


def write_clustered(df: DataFrame, path: str, key: str, partitions: int | None = None) -> None:
    """Parquet files clustered by key range, so a key filter skips files and row groups."""
    spread = df.repartitionByRange(partitions, key) if partitions else df.repartitionByRange(key)
    spread.sortWithinPartitions(key).write.mode("overwrite").parquet(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """Catalog table bucketed and sorted by key, and read back: joins of such tables on the key need no shuffle.

    ``path`` puts its files outside the warehouse, on storage that the cluster shares.
    """
    writer = df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)


#: Values of a partition column that a merge may touch; more is an error.
MAX_TOUCHED = 10_000


def merge_partitions(spark: SparkSession, path: str, updates: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], keys: list[str], partition: str, most: int = MAX_TOUCHED) -> list:
    """Merge ``updates`` into a Parquet table partitioned by ``partition``; gives the partitions that were rewritten.

    The keys alone are read to find the partitions that hold a row to change; only these are read whole, merged, written
    beside the table, and then swapped in one by one. ``merge(table, updates)`` keeps the rows' partitions. A run that
    fails may have swapped some partitions; as a merge applied twice changes nothing more, running it again completes it.
    """
    table = spark.read.parquet(path)
    wanted = updates.select(*keys).distinct()
    found = adaptive_join(table.select(*keys, partition), wanted, keys, "left_semi").select(partition).distinct().take(most + 1)
    if len(found) > most:
        raise ValueError(f"the merge touches more than {most} partitions")
    values = [r[0] for r in found]
    if values:
        here = F.col(partition).isin([v for v in values if v is not None])
        rows = table.where(here | F.col(partition).isNull() if None in values else here)
        merged = kept(merge(rows, updates))
        merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    return values


def write_dated(df: DataFrame, path: str, tenant: str = "tenant", day: str = "load_date") -> None:
    """Partitions by tenant and load date; only the partitions present in ``df`` are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(tenant, day).parquet(path)


def import_export_files(spark: SparkSession, source: str, target: str, schema: str, fmt: str = "parquet") -> None:
    """Append exported files to a table after checking that they carry the table's columns."""
    df = spark.read.format(fmt).load(source)
    missing = [f.name for f in T.StructType.fromDDL(schema).fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"export files lack columns {missing}")
    append(df, target, schema)
