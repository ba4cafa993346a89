"""Publishing, replay and remediation.

A sender is a callable ``send(payloads: list[str], topic: str | None) -> list[str | None]`` that
returns one error text (or None) per payload.  It is created inside the task by a factory, so it
may hold a connection.  Delivery is at least once: a task that is run again sends again.  So that
reading a result twice sends nothing twice, the jobs here write what a send reported to a ``status``
folder on shared storage first, and go on from the written rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passerine.operators.identity import merge_status
from passerine.operators.route import dlq_extract, pending_replay
from passerine.operators.skew import adaptive_join, kept, running

Sender = Callable[[list[str], "str | None"], "list[str | None]"]
SenderFactory = Callable[[], Sender]


def send_status(df: DataFrame, payload: str, factory: SenderFactory, batch: int = 1000, topic: str | None = None) -> DataFrame:
    """Every row with ``error`` (NULL = sent); rows go out in batches per partition and topic."""
    schema = ", ".join([f"`{n}` {t}" for n, t in df.dtypes] + ["error string"])

    def deliver(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        send = factory()
        for frame in frames:
            groups = frame.groupby(topic, sort=False, dropna=False) if topic else [(None, frame)]
            for name, group in groups:
                for start in range(0, len(group), batch):
                    part = group.iloc[start:start + batch]
                    yield part.assign(error=pd.Series(send(part[payload].tolist(), name), index=part.index, dtype=object))

    return df.mapInPandas(deliver, schema)


def publish(df: DataFrame, factory: SenderFactory, payload: str = "raw_payload", batch: int = 1000) -> DataFrame:
    """Send every row; only the rows that failed come back, with their error."""
    return send_status(df, payload, factory, batch).filter(F.col("error").isNotNull())


def observed(df: DataFrame, observation) -> DataFrame:
    """Count sent and failed rows of ``send_status`` while it runs."""
    return df.observe(
        observation, F.count(F.when(F.col("error").isNull(), 1)).alias("sent"), F.count("error").alias("failed"))


def replay(df: DataFrame, factory: SenderFactory, at: dt.datetime, field: str = "servicePayload", batch: int = 1000) -> DataFrame:
    """Send the inner payload to each row's topic; every row comes back with its status.

    Sent rows are Replayed with the replay time, failed ones stay ToBeReplayed without one.
    """
    inner = df.withColumn("_inner", F.get_json_object("raw_payload", f"$.{field}"))
    done = send_status(inner, "_inner", factory, batch, topic="replay_topic")
    sent = F.col("error").isNull()
    return done.withColumns({
        "replay_status": F.when(sent, "Replayed").otherwise("ToBeReplayed"),
        "replay_time": F.when(sent, F.lit(at).cast("timestamp_ntz")),
    }).drop("_inner", "error")


def written_status(sent: DataFrame, path: str) -> DataFrame:
    """The rows of a send, sent and written once, read back from ``path``."""
    sent.write.mode("overwrite").parquet(path)
    return sent.sparkSession.read.schema(sent.schema).parquet(path)


def dlq_replay(table: DataFrame, factory: SenderFactory, at: dt.datetime, status: str) -> DataFrame:
    """Replay the pending rows once, with their status written to ``status``, and merge it into the table."""
    done = written_status(replay(pending_replay(table), factory, at), status)
    return merge_status(table, done.filter(F.col("replay_status") == "Replayed"))


def dlq_remediation(dlq: DataFrame, start: str, end: str, factory: SenderFactory, folder: str, field: str = "servicePayload") -> dict[str, DataFrame]:
    """``archive`` of the inner payloads of a publish-time window, and the ``failed`` ones after sending once.

    Both are written under ``folder``; what is sent is read from the archive.
    """
    archive = written_status(dlq_extract(dlq, start, end, field).select("inner_payload"), f"{folder.rstrip('/')}/archive")
    sent = written_status(send_status(archive, "inner_payload", factory), f"{folder.rstrip('/')}/sent")
    return {"archive": archive, "failed": sent.filter(F.col("error").isNotNull())}


def send_once(df: DataFrame, payload: str, factory: SenderFactory, ledger: str, waves: int = 16, batch: int = 1000, topic: str | None = None) -> DataFrame:
    """Every row with ``error`` (NULL = sent), by a ledger at the path ``ledger``: a run repeated after a failure sends the rest.

    Rows are told apart by their content and, among equal ones, by a number, and dealt by that into ``waves``; a wave's
    outcomes are committed to the ledger before the next is sent. What the ledger has is left out by an anti-join. A
    failure so repeats what its own wave had sent, and no more.
    """
    spark = df.sparkSession
    content = F.sha2(F.to_json(F.struct(*[F.col(c).cast("string").alias(f"c{n}") for n, c in enumerate(df.columns)]), {"ignoreNullFields": "false"}), 256)
    numbered = running(df.withColumn("_content", content), ["_content"], [], {"_copy": ("count", F.lit(1))})
    rows = kept(numbered.withColumn("_wave", F.pmod(F.xxhash64("_content", "_copy"), F.lit(waves)).cast("int")))
    keys = ["_content", "_copy"]
    outcome = "_content string, _copy long, error string, _wave int"
    spark.createDataFrame([], outcome).write.mode("append").partitionBy("_wave").parquet(ledger)
    told = lambda wave: spark.read.schema(outcome).parquet(ledger).where(F.col("_wave") == wave)
    for wave in range(waves):
        todo = adaptive_join(rows.where(F.col("_wave") == wave), told(wave).select(*keys).distinct(), keys, "left_anti")
        sent = send_status(todo, payload, factory, batch, topic).select(*keys, "error", "_wave")
        sent.write.mode("append").partitionBy("_wave").parquet(ledger)
    done = spark.read.schema(outcome).parquet(ledger).groupBy(*keys).agg(F.min("error").alias("error"))
    return adaptive_join(rows, done, keys).select(*df.columns, "error")
