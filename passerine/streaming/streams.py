"""Stream twins of batch operators.

Sinks written from ``foreachBatch`` use one folder per batch id and overwrite it, so a batch that
is run again after a failure leaves the same rows once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from passerine.frames import once
from passerine.functions.dates import lenient_timestamp
from passerine.functions.values import has_root, root_text
from passerine.payload import parse_payloads
from passerine.plans.delivery import SenderFactory, replay


def payload_stream(spark: SparkSession, path: str, max_files: int | None = None, archive: str | None = None) -> DataFrame:
    """File stream of payload lines; ``archive`` moves files there once they are done."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(path).select(F.col("value").alias("raw_payload"))


def _batch_folder(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/batch_id={batch_id}"


def latest_per_user_event(stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """Latest record per (userId, event) and day of event time, by timestamp text.

    A day's state is freed once the watermark has passed its end, and rows of such a day that come
    later are dropped.  A record whose timestamp is missing or unreadable has no day and is never
    late: it is passed on as it is, to be merged by the same rank.
    """
    written = root_text("timestamp")
    moment = F.coalesce(written.try_cast("timestamp"), lenient_timestamp(written))
    rank_key = F.struct(F.coalesce(written, F.lit("")), F.coalesce(root_text("messageId"), F.lit("")))
    keyed = parse_payloads(stream).filter(has_root("userId") & has_root("event"))
    keyed = once(keyed, user_id=root_text("userId"), event=root_text("event"), event_time=moment, _k=rank_key).select("user_id", "event", "event_time", "_k", "raw_payload")
    dated = keyed.filter("event_time is not null").withWatermark("event_time", delay).groupBy(F.window("event_time", "1 day"), "user_id", "event").agg(
        F.max_by("raw_payload", "_k").alias("raw_payload"), F.max("_k").alias("_k")).drop("window")
    return dated.unionByName(keyed.filter("event_time is null").drop("event_time"))


def stream_latest_per_user_event(stream: DataFrame, sink: str, checkpoint: str, delay: str = "1 day") -> StreamingQuery:
    """Write each batch's changed groups; ``read_latest`` reduces them to one row per group."""
    def write(batch: DataFrame, batch_id: int) -> None:
        newest = batch.groupBy("user_id", "event").agg(F.max_by("raw_payload", "_k").alias("raw_payload"), F.max("_k").alias("_k"))
        newest.write.mode("overwrite").parquet(_batch_folder(sink, batch_id))

    return (
        latest_per_user_event(stream, delay).writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def read_latest(spark: SparkSession, sink: str) -> DataFrame:
    updates = spark.read.parquet(sink)
    return updates.groupBy("user_id", "event").agg(F.max_by("raw_payload", "_k").alias("raw_payload"))


def stream_enrich_validate(stream: DataFrame, process: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str) -> StreamingQuery:
    """Run a stateless payload chain per batch, in one write.

    ``process`` gives one frame of plain columns with a ``branch``; each batch's folder is partitioned by it.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        process(parse_payloads(batch)).write.mode("overwrite").partitionBy("branch").parquet(_batch_folder(sink, batch_id))

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_dlq_replay(stream: DataFrame, factory: SenderFactory, at: dt.datetime, status: str, checkpoint: str) -> StreamingQuery:
    """Replay pending rows per batch and write their status rows, to be merged into the table."""
    def write(batch: DataFrame, batch_id: int) -> None:
        pending = batch.filter(F.col("replay_status") == "ToBeReplayed")
        replay(pending, factory, at).write.mode("overwrite").parquet(_batch_folder(status, batch_id))

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def dedupe_messages(stream: DataFrame, key: str = "message_id", event_time: str = "event_time", delay: str = "1 day") -> DataFrame:
    """First row per message id within the watermark; state is dropped once it passes."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def stream_dedupe_messages(stream: DataFrame, sink: str, checkpoint: str, key: str = "message_id", event_time: str = "event_time", delay: str = "1 day") -> StreamingQuery:
    return (
        dedupe_messages(stream, key, event_time, delay).writeStream.format("parquet").option("path", sink)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
