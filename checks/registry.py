"""Named checks: a Spark query over the given tables and, where SQL can say it, its DuckDB twin."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixtures import view, with_views
from passerine.frames import once
from passerine.functions.values import root_text
from passerine.payload import parse_payloads
from passerine.session import configure

AS_OF = dt.date(2024, 1, 31)
NOW = dt.datetime(2024, 1, 31, 12, 0, 0)
NOW_SQL = "TIMESTAMP '2024-01-31 12:00:00'"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
CHECKED: dict[str, tuple] = {}


class Inputs:
    """Access to the views of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = configure(spark), sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return view(self.spark, self.sf_dir, name)

    def payloads(self) -> DataFrame:
        return parse_payloads(once(self.pl, raw_payload=F.col("raw_payload")).select("raw_payload"))

    def known_mpns(self) -> DataFrame:
        return self.crs_program.select("mpn")


def joined(views: list[str] | None, sql: str) -> str:
    """One DuckDB text of the views and the query over them."""
    prefix = with_views(views) if views else ""
    joiner = ",\n" if prefix and sql.lstrip().upper().startswith("WITH ") else "\n"
    return prefix + joiner + (sql.lstrip()[5:] if joiner == ",\n" else sql)


def check(key: str, views: list[str] | None = None, sql: str | None = None):
    """Register ``fn(inputs) -> DataFrame`` under ``key`` with its DuckDB text."""

    def register(fn):
        QUERIES[key] = lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
        QUERIES[key].__doc__ = fn.__doc__
        CHECKED[key] = fn, views, sql
        if sql is not None:
            ORACLES[key] = joined(views, sql)
        return fn

    return register


class WholeInputs(Inputs):
    """The same views, but all rows where the view ``canonical_ctas`` has a part."""

    @property
    def canonical_ctas(self) -> DataFrame:
        return view(self.spark, self.sf_dir, "canonical_all")


def check_whole(key: str) -> None:
    """Register the query ``key`` a second time, as ``key_all``, over all rows of ``canonical_ctas``; the given text stays."""
    fn, views, sql = CHECKED[key]
    QUERIES[f"{key}_all"] = lambda spark, sf_dir: fn(WholeInputs(spark, sf_dir))
    ORACLES[f"{key}_all"] = joined([v.replace("canonical_ctas", "canonical_all") for v in views], sql.replace("canonical_ctas", "canonical_all"))


def message_id() -> Column:
    return root_text("messageId").alias("message_id")


def branches(**frames: DataFrame) -> DataFrame:
    """Outputs of a split as one frame of (message_id, branch)."""
    out = None
    for name, df in frames.items():
        part = df.select(message_id(), F.lit(name).alias("branch"))
        out = part if out is None else out.unionByName(part)
    return out
