"""Readers for payload lines, tables, exports, remote snapshots and CSV files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passerine.operators.skew import adaptive_join, running
from passerine.payload import parse_payloads


def read_lines(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """One JSON document per line as ``raw_payload``; ``*.gz`` is decompressed, folders are walked."""
    reader = spark.read.option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.text(path).filter(F.trim("value") != "").select(F.col("value").alias("raw_payload"))


def read_payloads(spark: SparkSession, path: str, pattern: str | None = None, tasks: int | None = None) -> DataFrame:
    """Payload lines with the parsed payload columns.

    ``tasks`` deals the lines evenly over that many tasks before they are parsed, for a few large
    gzip files, which can't be split.
    """
    lines = read_lines(spark, path, pattern)
    return parse_payloads(lines.repartition(tasks) if tasks else lines)


def read_query(spark: SparkSession, sql: str) -> DataFrame:
    """Result of a SQL query over catalog tables or files."""
    return spark.sql(sql)


def has_format(spark: SparkSession, fmt: str) -> bool:
    """Whether a data source such as ``avro`` is on the session's class path."""
    try:
        spark._jvm.org.apache.spark.sql.execution.datasources.DataSource.lookupDataSource(
            fmt, spark._jsparkSession.sessionState().conf()
        )
        return True
    except Exception:
        return False


def read_export(spark: SparkSession, path: str, fmt: str = "avro") -> DataFrame:
    """Record files of an export: Avro where the session has that source, or Parquet."""
    if fmt not in ("avro", "parquet"):
        raise ValueError(f"unsupported export format {fmt!r}")
    return spark.read.format(fmt).load(path)


def read_remote(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """Snapshot of an operational database; the query (its filters and columns) runs remotely."""
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()


def read_snapshot(spark: SparkSession, path: str, columns: list[str], predicate: str) -> DataFrame:
    """Parquet twin of ``read_remote``: predicate and columns are pushed into the scan."""
    return spark.read.parquet(path).filter(predicate).select(*columns)


CONTACTS_SCHEMA = "record_id string, email string, account_created_on date"


def read_contacts_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    return spark.read.schema(CONTACTS_SCHEMA).option("header", True).option("sep", sep).csv(path)


def read_report_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A report written earlier; all columns are text unless a schema is given."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader).csv(path)


def catalog_columns(df: DataFrame, exclude_like: list[str] | None = None, exclude_in: list[str] | None = None) -> DataFrame:
    """(column_name, data_type) of a frame without the excluded names; ``exclude_like`` takes LIKE patterns."""
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    out = df.sparkSession.createDataFrame(rows, "column_name string, data_type string")
    for pattern in exclude_like or []:
        out = out.filter(~F.col("column_name").like(pattern))
    if exclude_in:
        out = out.filter(~F.col("column_name").isin(*exclude_in))
    return out


def column_names(df: DataFrame, exclude_like: list[str] | None = None, exclude_in: list[str] | None = None) -> list[str]:
    """The same selection as a list, for building projections from the schema."""
    import re

    drop = set(exclude_in or [])
    to_regex = lambda p: "".join(".*" if ch == "%" else "." if ch == "_" else re.escape(ch) for ch in p)
    patterns = [re.compile(to_regex(p) + r"\Z", re.DOTALL) for p in exclude_like or []]
    return [c for c in df.columns if c not in drop and not any(p.match(c) for p in patterns)]


def scan_until(df: DataFrame, column: str, day: str | dt.date) -> DataFrame:
    """Rows of load dates up to ``day``; a range on the bare column, so partitions and row groups are pruned."""
    last = dt.date.fromisoformat(day) if isinstance(day, str) else day
    kind = dict(df.dtypes)[column]
    if kind == "date":
        return df.filter(F.col(column) <= F.lit(last))
    return df.filter(F.col(column) < F.lit((last + dt.timedelta(days=1)).isoformat()).cast(kind))


def batch_keys(df: DataFrame, mpn: str, loaded: str, source: str) -> DataFrame:
    """Distinct (program, hour, source) keys with their row counts."""
    return df.groupBy(mpn, F.date_trunc("HOUR", loaded).cast("timestamp_ntz").alias("hour"), source).agg(F.count(F.lit(1)).alias("n"))


def batch_predicates(df: DataFrame, mpn: str, loaded: str, source: str, reads: int) -> list[str]:
    """``reads`` disjoint predicates at most, of near-equal row counts, that together take every row of ``df``, nulls too.

    The keys (program, hour, source) are put in order, nulls first, and counted on from key to key; a read takes the keys
    that start within its share of the rows. So a read has less than twice the mean, unless a single key has more. Each
    predicate is a range of keys on the bare columns, which partitions, row groups and remote indexes can use. Only the
    reads' first and last keys come to the driver, however many keys there are.
    """
    keys = [mpn, "hour", source]
    counts = batch_keys(df, mpn, loaded, source).withColumn("_all", F.lit(0))
    placed = running(counts, ["_all"], keys, {"_before": ("sum", F.col("n"))})
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    share = F.greatest(F.lit(1), F.ceil(total / F.lit(reads)))
    key = F.struct(*keys)
    ends = placed.groupBy(F.floor(F.col("_before") / share).alias("read")).agg(F.min(key).alias("low"), F.max(key).alias("high"))
    kinds = dict(df.dtypes)
    texts = [f"{side}.{c}" for side in ("low", "high") for c in keys]
    rows = ends.orderBy("read").select(*[F.col(c).cast("string").alias(c.replace(".", "_")) for c in texts]).take(reads + 1)  # one row a read
    quote = lambda c, v: None if v is None else v if kinds[c] in ("tinyint", "smallint", "int", "bigint") or kinds[c].startswith("decimal") else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    out = []
    for row in rows:
        low, high = tuple(row[:3]), tuple(row[3:])
        parts = [(mpn, "plain"), (loaded, "hour"), (source, "plain")]
        values = lambda key: [quote(mpn, key[0]), key[1], quote(source, key[2])]
        bounds = [f"{mpn} >= {quote(mpn, low[0])}"] if low[0] is not None else [f"({mpn} IS NULL OR {mpn} <= {quote(mpn, high[0])})"] if high[0] is not None else [f"{mpn} IS NULL"]
        if low[0] is not None:
            bounds.append(f"{mpn} <= {quote(mpn, high[0])}")
        out.append(" AND ".join([*bounds, f"({_from_key(parts, values(low))})", f"({_to_key(parts, values(high))})"]))
    return out


def _compare(part: tuple[str, str], op: str, value: str) -> str:
    """A comparison of a column, or of the hour it lies in, on the bare column."""
    column, kind = part
    if kind == "plain":
        return f"{column} {op} {value}"
    begin = f"TIMESTAMP '{value}'"
    end = f"TIMESTAMP '{dt.datetime.fromisoformat(value) + dt.timedelta(hours=1)}'"
    return {">": f"{column} >= {end}", "<": f"{column} < {begin}", "=": f"{column} >= {begin} AND {column} < {end}"}[op]


def _from_key(parts: list[tuple[str, str]], values: list[str | None]) -> str:
    """Keys at or after ``values``, nulls first."""
    if not parts:
        return "TRUE"
    column, rest = parts[0][0], _from_key(parts[1:], values[1:])
    if values[0] is None:
        return f"{column} IS NOT NULL OR ({rest})"
    return f"{_compare(parts[0], '>', values[0])} OR ({_compare(parts[0], '=', values[0])} AND ({rest}))"


def _to_key(parts: list[tuple[str, str]], values: list[str | None]) -> str:
    """Keys at or before ``values``, nulls first."""
    if not parts:
        return "TRUE"
    column, rest = parts[0][0], _to_key(parts[1:], values[1:])
    if values[0] is None:
        return f"{column} IS NULL AND ({rest})"
    return f"{column} IS NULL OR {_compare(parts[0], '<', values[0])} OR ({_compare(parts[0], '=', values[0])} AND ({rest}))"


def read_batches(df: DataFrame, predicates: list[str]) -> list[DataFrame]:
    """One read for each predicate, to be run and repeated on its own."""
    return [df.where(p) for p in predicates]


def partitioned_read(spark: SparkSession, url: str, table: str, predicates: list[str], properties: dict | None = None) -> DataFrame:
    """One remote read task per predicate."""
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties or {})


def with_program_config(df: DataFrame, config: DataFrame, mpn: str) -> DataFrame:
    """Left-join per-program settings (country, legal entity, ...) by program number."""
    return adaptive_join(df, config.withColumnRenamed("mpn", mpn), [mpn])
