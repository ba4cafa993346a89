"""Sources and sinks by round trip, delivery, and streams against their batch twins."""

import tempfile
import uuid

from pyspark.sql import functions as F

from checks.q_validate import CHAIN, source_map
from checks.senders import fail_when_last_digit_in
from checks.registry import AS_OF, NOW, NOW_SQL, check, message_id
from passerine.operators import identity, route, validate
from passerine.plans import delivery, staging
from passerine.sinks import writers
from passerine.sources import readers
from passerine.streaming import streams


def scratch(spark) -> str:
    """A new folder under the folder that the cluster shares; a temporary one only in a local session that names none."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="passerine-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/run-{uuid.uuid4().hex}"


def payload_files(i, rows: str = "true") -> str:
    path = scratch(i.spark) + "/lines"
    writers.write_lines(i.pl.filter(rows), path, "raw_payload", "gzip")
    return path


@check("write_text", ["pl"], "SELECT raw_payload FROM pl")
def _(i):
    return readers.read_lines(i.spark, payload_files(i))


@check("read_payload_lines", ["pl_scalars"], "SELECT message_id, typ AS type, event_name AS event FROM pl_scalars")
def _(i):
    from passerine.functions.values import root_text

    out = readers.read_payloads(i.spark, payload_files(i), "*.gz")
    return out.select(message_id(), root_text("type").alias("type"), root_text("event").alias("event"))


@check("read_avro_export", None, "SELECT s_suppkey, s_name FROM supplier")
def _(i):
    """Export and re-read of records; the check asks for Parquet where the session has no Avro source."""
    fmt = "avro" if readers.has_format(i.spark, "avro") else "parquet"
    paths = writers.export_tables({"supplier": i.supplier}, scratch(i.spark), fmt)
    return readers.read_export(i.spark, paths["supplier"], fmt).select("s_suppkey", "s_name")


@check("read_csv_schema", ["contacts"], "SELECT record_id, email, account_created_on FROM contacts")
def _(i):
    path = scratch(i.spark) + "/contacts"
    writers.export_csv(i.contacts, path)
    return readers.read_contacts_csv(i.spark, path)


@check("read_csv_report", None, "SELECT n_name, CAST(n_regionkey AS STRING) AS n_regionkey FROM nation")
def _(i):
    path = scratch(i.spark) + "/report"
    writers.export_csv(i.nation.select("n_name", "n_regionkey"), path)
    return readers.read_report_csv(i.spark, path)


@check("append_table", ["pl"], f"""
SELECT typ AS event_type, coalesce(xmpn, 'KEY_NOT_FOUND') AS marketing_program_number, message_id, {NOW_SQL} AS loaded_date FROM pl
UNION ALL SELECT typ, coalesce(xmpn, 'KEY_NOT_FOUND'), message_id, {NOW_SQL} FROM pl WHERE is_identify
""")
def _(i):
    path = scratch(i.spark) + "/landing"
    landing = staging.shared_stage(i.spark)(route.to_landing(i.payloads(), NOW), "landing")
    writers.append(landing, path, writers.LANDING_SCHEMA)
    writers.append(landing.filter("event_type = 'identify'"), path, writers.LANDING_SCHEMA)
    out = i.spark.read.parquet(path)
    return out.select("event_type", "marketing_program_number", "message_id", F.col("loaded_date").cast("timestamp_ntz").alias("loaded_date"))


@check("replace_table", None, "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O'")
def _(i):
    path = scratch(i.spark) + "/orders"
    writers.replace(i.orders, path)
    newer = i.spark.read.parquet(path).filter("o_orderstatus = 'O'").select("o_orderkey", "o_orderstatus")
    return i.spark.read.parquet(writers.replace_version(newer, path + "_versions", "2"))


@check("insert_select", None, "SELECT event_type AS audience_name, count(*) AS count FROM events GROUP BY event_type UNION ALL SELECT 'all', count(*) FROM events")
def _(i):
    path = scratch(i.spark) + "/dashboard"
    writers.append(i.events.groupBy(F.col("event_type").alias("audience_name")).agg(F.count(F.lit(1)).alias("count")), path)
    writers.append(i.events.agg(F.count(F.lit(1)).alias("count")).select(F.lit("all").alias("audience_name"), "count"), path)
    return i.spark.read.parquet(path)


def table_name() -> str:
    """A catalog table of its own: sessions may run a check many times."""
    return f"t_{uuid.uuid4().hex}"


@check("insert_select_table", None, "SELECT event_type AS audience_name, count(*) AS count FROM events GROUP BY event_type UNION ALL SELECT 'all', count(*) FROM events")
def _(i):
    """Rows inserted into a table of Spark's catalog, columns matched by name."""
    name = table_name()
    i.spark.sql(f"CREATE TABLE {name} (audience_name STRING, count BIGINT) USING parquet LOCATION '{scratch(i.spark)}/dashboard'")
    counts = i.events.groupBy(F.col("event_type").alias("audience_name")).agg(F.count(F.lit(1)).alias("count"))
    writers.insert_select(counts, name)
    writers.insert_select(i.events.agg(F.count(F.lit(1)).alias("count")).select("count", F.lit("all").alias("audience_name")), name)
    return i.spark.table(name)


BAD_IDS = "e % 29 IN (1, 2, 3)"


def bucketed_clean(i):
    """Payloads without those that have a failure, from two tables bucketed by message id."""
    folder = scratch(i.spark)
    rows = i.pl.select("message_id", "raw_payload", F.expr(BAD_IDS).alias("bad"))
    payloads = writers.write_bucketed(rows.select("message_id", "raw_payload"), table_name(), "message_id", 8, f"{folder}/payloads")
    failures = writers.write_bucketed(rows.where("bad").select("message_id"), table_name(), "message_id", 8, f"{folder}/failures")
    return payloads.join(failures, "message_id", "left_anti")


@check("bucketed_clean_insert", ["pl"], f"SELECT message_id, raw_payload FROM pl WHERE message_id NOT IN (SELECT message_id FROM pl WHERE {BAD_IDS})")
def _(i):
    return bucketed_clean(i)


@check("export_csv", None, "SELECT CAST(c_custkey AS STRING) AS c_custkey, c_name FROM customer")
def _(i):
    path = scratch(i.spark) + "/tsv"
    writers.export_csv(i.customer.select("c_custkey", "c_name"), path, "\t")
    return i.spark.read.option("header", True).option("sep", "\t").csv(path)


@check("export_avro", None, """
SELECT 'nation' AS tbl, CAST(n_nationkey AS STRING) AS k, n_name AS name FROM nation UNION ALL SELECT 'region', CAST(r_regionkey AS STRING), r_name FROM region
UNION ALL SELECT 'supplier', CAST(s_suppkey AS STRING), s_name FROM supplier UNION ALL SELECT 'customer', CAST(c_custkey AS STRING), c_name FROM customer
""")
def _(i):
    fmt = "avro" if readers.has_format(i.spark, "avro") else "parquet"
    tables = {"nation": i.nation, "region": i.region, "supplier": i.supplier, "customer": i.customer}
    paths = writers.export_tables(tables, scratch(i.spark), fmt)
    out = None
    for name, path in paths.items():
        part = readers.read_export(i.spark, path, fmt)
        part = part.select(F.lit(name).alias("tbl"), F.col(part.columns[0]).cast("string").alias("k"), F.col(part.columns[1]).alias("name"))
        out = part if out is None else out.unionByName(part)
    return out


@check("import_export_files", None, "SELECT s_suppkey, s_name FROM supplier")
def _(i):
    base = scratch(i.spark)
    paths = writers.export_tables({"supplier": i.supplier}, base + "/export", "parquet")
    writers.import_export_files(i.spark, paths["supplier"], base + "/target", "s_suppkey bigint, s_name string")
    return i.spark.read.parquet(base + "/target")


@check("clustered_table", ["pl"], "SELECT message_id, raw_payload FROM pl")
def _(i):
    path = scratch(i.spark) + "/clustered"
    writers.write_clustered(i.payloads().select(message_id(), "raw_payload"), path, "message_id", 8)
    return i.spark.read.parquet(path)


@check("dated_output_paths", None, "SELECT CAST(event_id AS BIGINT) AS event_id, 't' || CAST(user_id % 3 AS STRING) AS tenant, CAST(ts AS DATE) AS load_date FROM events")
def _(i):
    path = scratch(i.spark) + "/dated"
    rows = i.events.select("event_id", F.concat(F.lit("t"), (F.col("user_id") % 3).cast("string")).alias("tenant"), F.col("ts").cast("date").alias("load_date"))
    writers.write_dated(rows, path)
    return i.spark.read.parquet(path)


@check("publish_batches", ["pl_scalars"], "SELECT message_id FROM pl_scalars WHERE e % 10 IN (3, 7)")
def _(i):
    """Failed records of a publish whose sender refuses some message ids."""
    rows = i.payloads().select(message_id())
    return delivery.publish(rows, fail_when_last_digit_in("37"), "message_id", 500).select("message_id")


@check("replay_with_status", ["replay_table"], f"""
SELECT message_id, replay_topic, CASE WHEN event_id % 10 IN (1, 4) THEN 'ToBeReplayed' ELSE 'Replayed' END AS replay_status, CASE WHEN event_id % 10 IN (1, 4) THEN NULL ELSE {NOW_SQL} END AS replay_time
FROM replay_table WHERE replay_status = 'ToBeReplayed'
""")
def _(i):
    out = delivery.replay(route.pending_replay(i.replay_table.drop("event_id")), fail_when_last_digit_in("14"), NOW)
    return out.select("message_id", "replay_topic", "replay_status", "replay_time")


# ---- streams -----------------------------------------------------------------------


@check("stream_latest_per_user_event", ["pl_scalars"], """
SELECT user_txt AS user_id, event_name AS event, arg_max(message_id, row(coalesce(tst, ''), message_id)) AS message_id FROM pl_scalars WHERE user_txt IS NOT NULL AND event_name IS NOT NULL GROUP BY 1, 2
""")
def _(i):
    source, base = payload_files(i), scratch(i.spark)
    streams.stream_latest_per_user_event(streams.payload_stream(i.spark, source), base + "/out", base + "/ck", "60 days").awaitTermination()
    out = streams.read_latest(i.spark, base + "/out")
    return out.select("user_id", "event", F.get_json_object("raw_payload", "$.messageId").alias("message_id"))


LATE = "{'type': 'track', 'event': 'late', 'userId': 'u1', 'messageId': 'late-%d', 'timestamp': '2023-06-0%dT00:00:00.000Z'}"


@check("stream_late_rows", ["pl_scalars"], """
SELECT user_txt AS user_id, event_name AS event, arg_max(message_id, row(coalesce(tst, ''), message_id)) AS message_id FROM pl_scalars WHERE user_txt IS NOT NULL AND event_name IS NOT NULL GROUP BY 1, 2
""")
def _(i):
    """A second batch holds only rows that are far behind the watermark: none of them arrives."""
    source, base = payload_files(i), scratch(i.spark)
    run = lambda: streams.stream_latest_per_user_event(streams.payload_stream(i.spark, source), base + "/out", base + "/ck", "1 hour").awaitTermination()
    run()
    late = i.events.limit(1).select(F.explode(F.array(*(F.lit((LATE % (k, k)).replace("'", '"')) for k in (1, 2)))).alias("raw_payload"))
    writers.write_lines(late, source, "raw_payload", "gzip")
    run()
    out = streams.read_latest(i.spark, base + "/out")
    return out.select("user_id", "event", F.get_json_object("raw_payload", "$.messageId").alias("message_id"))


UNDATED = "tst is null or tst in ('', '5', '01/15/2024')"


@check("stream_undated_rows", ["pl_scalars"], """
SELECT user_txt AS user_id, event_name AS event, arg_max(message_id, row(coalesce(tst, ''), message_id)) AS message_id FROM pl_scalars WHERE user_txt IS NOT NULL AND event_name IS NOT NULL GROUP BY 1, 2
""")
def _(i):
    """A second batch holds the rows whose timestamp is missing, unreadable or spelled in another way: all of them count."""
    source, base = payload_files(i, f"not ({UNDATED})"), scratch(i.spark)
    run = lambda: streams.stream_latest_per_user_event(streams.payload_stream(i.spark, source), base + "/out", base + "/ck", "60 days").awaitTermination()
    run()
    writers.write_lines(i.pl.filter(UNDATED), source, "raw_payload", "gzip")
    run()
    out = streams.read_latest(i.spark, base + "/out")
    return out.select("user_id", "event", F.get_json_object("raw_payload", "$.messageId").alias("message_id"))


@check("stream_enrich_validate", ["pl_blocks", "opt_map", "crs_source"], CHAIN + """
SELECT 'failed' AS branch, message_id FROM failed UNION ALL SELECT 'passed', message_id FROM s WHERE message_id NOT IN (SELECT message_id FROM failed)
""")
def _(i):
    source, base = payload_files(i), scratch(i.spark)
    opt_map, sources = i.opt_map, source_map(i)

    def process(batch):
        checked = validate.with_failures(batch, opt_map, sources, AS_OF, NOW)
        failed = F.transform("failures", lambda _: F.lit("failed"))  # a row per failed rule
        return checked.select(message_id(), F.explode(F.when(route.passes(), F.array(F.lit("passed"))).otherwise(failed)).alias("branch"))

    streams.stream_enrich_validate(streams.payload_stream(i.spark, source), process, base + "/out", base + "/ck").awaitTermination()
    return i.spark.read.parquet(base + "/out").select("branch", "message_id")


@check("stream_dlq_replay", ["replay_table"], f"""
SELECT message_id, CASE WHEN replay_status = 'ToBeReplayed' AND event_id % 10 NOT IN (1, 4) THEN 'Replayed' ELSE replay_status END AS replay_status,
  CASE WHEN replay_status = 'ToBeReplayed' AND event_id % 10 NOT IN (1, 4) THEN {NOW_SQL} ELSE replay_time END AS replay_time FROM replay_table
""")
def _(i):
    base, table = scratch(i.spark), i.replay_table.drop("event_id")
    writers.replace(table, base + "/table")
    stream = i.spark.readStream.schema(table.schema).parquet(base + "/table")
    streams.stream_dlq_replay(stream, fail_when_last_digit_in("14"), NOW, base + "/status", base + "/ck").awaitTermination()
    status = i.spark.read.parquet(base + "/status").filter("replay_status = 'Replayed'")
    return identity.merge_status(i.spark.read.parquet(base + "/table"), status).select("message_id", "replay_status", "replay_time")


@check("stream_dedupe_messages", None, "SELECT 'm' || CAST(event_id % 700 AS STRING) AS message_id FROM events GROUP BY 1")
def _(i):
    base = scratch(i.spark)
    rows = i.events.select(F.concat(F.lit("m"), (F.col("event_id") % 700).cast("string")).alias("message_id"), F.col("ts").cast("timestamp").alias("event_time"))
    writers.replace(rows, base + "/rows")
    stream = i.spark.readStream.schema(rows.schema).parquet(base + "/rows")
    streams.stream_dedupe_messages(stream, base + "/out", base + "/ck", delay="60 days").awaitTermination()
    return i.spark.read.parquet(base + "/out").select("message_id")
