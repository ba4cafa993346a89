"""Sources, filters, routing."""

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.registry import AS_OF, NOW, NOW_SQL, branches, check, message_id
from passerine.operators import joins, route
from passerine.session import shared_dir
from passerine.sources import readers

INVALID = """
WITH inv AS (SELECT DISTINCT trim(marketing_program_number) AS m FROM identifies
             WHERE trim(marketing_program_number) <> '' AND trim(marketing_program_number) NOT IN (SELECT mpn FROM crs_program))
"""


@check("resolve_user_key", ["pl_scalars"], "SELECT message_id, coalesce(user_txt, anon_txt) AS user_key FROM pl_scalars")
def _(i):
    return route.with_user_key(i.payloads()).select(message_id(), "user_key")


@check("filter_backdated", ["pl_scalars"], """
WITH d AS (SELECT message_id, anon_txt, CASE WHEN e % 19 IN (0, 1, 2, 5) THEN NULL ELSE CAST(substr(ots, 1, 10) AS DATE) END AS day FROM pl_scalars)
SELECT message_id, 'recent' AS mode FROM d WHERE CASE WHEN anon_txt IS NULL THEN day > DATE '2024-01-31' - INTERVAL 1095 DAY ELSE day > DATE '2024-01-31' - INTERVAL 180 DAY END
UNION ALL SELECT message_id, 'drop' FROM d WHERE anon_txt IS NULL AND day > DATE '2024-01-31' - INTERVAL 1095 DAY
""")
def _(i):
    both = [
        route.filter_backdated(i.payloads(), AS_OF, mode).select(message_id(), F.lit(mode).alias("mode"))
        for mode in ("recent", "drop")
    ]
    return both[0].unionByName(both[1])


@check("split_invalid_mpn", ["pl_scalars", "identifies", "crs_program"], INVALID + """
SELECT message_id, CASE WHEN coalesce(NOT xmpn_num AND xmpn IN (SELECT m FROM inv), FALSE)
   OR coalesce(NOT tmpn_num AND tmpn IN (SELECT m FROM inv) AND (NOT is_identify OR traits_state = 'object'), FALSE) THEN 'invalid' ELSE 'valid' END AS branch
FROM pl_scalars
""")
def _(i):
    invalid = joins.not_in_antijoin(i.identifies, "marketing_program_number", i.known_mpns())
    valid, bad = route.split_invalid_mpn(i.payloads(), invalid)
    return branches(valid=valid, invalid=bad)


CATALOGUE = """
WITH names AS (SELECT eventName AS n, eventCategory AS c, gacaEventName AS g FROM event_ref
    UNION ALL SELECT unnest(string_split(eventNameAlias, '|')), eventCategory, gacaEventName FROM event_ref WHERE length(eventNameAlias) > 1 AND eventNameAlias <> 'NULL'),
cat AS (SELECT 'clickstream' AS route, lower(n) AS event_name FROM names WHERE g <> 'NULL' AND g <> ''
    UNION SELECT 'clt', lower(n) FROM names WHERE c = 'Email CLT'
    UNION SELECT 'other', lower(n) FROM names WHERE n <> 'Changed Opt Status' AND c <> 'Email CLT' AND g IN ('', 'NULL')
    UNION SELECT 'registration', unnest(['changed opt status', 'identify'])
    UNION SELECT 'clickstream', unnest(['screen', 'page']))
"""


@check("event_catalogue", ["event_ref"], CATALOGUE + "SELECT route, event_name FROM cat")
def _(i):
    return route.event_catalogue(i.event_ref)


@check("route_by_event", ["pl_scalars", "event_ref"], CATALOGUE + """
SELECT message_id, coalesce(cat.route, 'unmatched') AS route
FROM pl_scalars LEFT JOIN cat ON cat.event_name = CASE WHEN event_name IS NOT NULL THEN lower(pl_scalars.event_name) ELSE typ END
""".replace("CASE WHEN event_name", "CASE WHEN pl_scalars.event_name"))
def _(i):
    return route.route_events(i.payloads(), route.event_catalogue(i.event_ref)).select(message_id(), "route")


@check("split_changed_opt", ["pl_scalars"], "SELECT message_id, CASE WHEN is_opt THEN 'opt' ELSE 'rest' END AS branch FROM pl_scalars")
def _(i):
    opt, rest = route.split_changed_opt(i.payloads())
    return branches(opt=opt, rest=rest)


@check("postal_exclude", ["pl_scalars"], """
SELECT message_id, CASE WHEN is_opt AND ch_postal AND tmail IS NULL AND tphone IS NULL THEN 'excluded' ELSE 'proper' END AS branch FROM pl_scalars
""")
def _(i):
    excluded, proper = route.split_postal_only(i.payloads())
    return branches(excluded=excluded, proper=proper)


@check("project_landing", ["pl"], f"""
SELECT raw_payload, typ AS event_type, coalesce(xmpn, 'KEY_NOT_FOUND') AS marketing_program_number,
  CASE WHEN xsrc IS NULL THEN 'KEY_NOT_FOUND' WHEN xsrc = '' THEN NULL ELSE xsrc END AS source_id, message_id,
  CASE WHEN tst IS NULL THEN 'KEY_NOT_FOUND' WHEN tst = '' THEN NULL ELSE tst END AS payload_timestamp, {NOW_SQL} AS loaded_date
FROM pl
""")
def _(i):
    return route.to_landing(i.payloads(), NOW).withColumn("loaded_date", F.col("loaded_date").cast("timestamp_ntz"))


@check("dlq_window", ["dlq"], """
SELECT publish_time, json_extract_string(data, '$.servicePayload.kind') AS kind, CAST(json_extract_string(data, '$.servicePayload.id') AS BIGINT) AS id
FROM dlq WHERE publish_time > TIMESTAMP '2024-01-05 00:00:00' AND publish_time <= TIMESTAMP '2024-01-20 00:00:00'
""")
def _(i):
    rows = route.dlq_extract(i.dlq, "2024-01-05 00:00:00", "2024-01-20 00:00:00")
    inner = F.from_json("inner_payload", "id bigint, kind string")
    return rows.select("publish_time", inner["kind"].alias("kind"), inner["id"].alias("id"))


@check("pending_replay", ["replay_table"], "SELECT message_id, trace_id, replay_topic FROM replay_table WHERE replay_status = 'ToBeReplayed'")
def _(i):
    return route.pending_replay(i.replay_table).select("message_id", "trace_id", "replay_topic")


@check("events_table_select", ["pl"], "SELECT raw_payload FROM pl")
def _(i):
    return route.select_column(i.pl, "raw_payload")


SIGNATURE = """
WITH sig AS (SELECT *, coalesce(CAST(email_subscription_opt_number AS STRING), CAST(phone_subscription_opt_number AS STRING), CAST(postal_subscription_opt_number AS STRING), CAST(social_subscription_opt_number AS STRING)) AS subscription_opt_number,
  coalesce(email_subscription_service_name, phone_subscription_service_name, postal_subscription_service_name, social_subscription_service_name, '') AS service_name,
  CASE WHEN email_subscription_opt_number IS NOT NULL OR email_subscription_service_name IS NOT NULL THEN 'Email'
       WHEN phone_subscription_opt_number IS NOT NULL OR phone_subscription_service_name IS NOT NULL THEN 'Phone'
       WHEN postal_subscription_opt_number IS NOT NULL OR postal_subscription_service_name IS NOT NULL THEN 'Postal'
       WHEN social_subscription_opt_number IS NOT NULL OR social_subscription_service_name IS NOT NULL THEN 'Social' ELSE 'KEY NOT FOUND' END AS opt_type
  FROM changed_opts),
sigs AS (SELECT *, CASE opt_type WHEN 'Email' THEN 'E' WHEN 'Phone' THEN 'P' WHEN 'Postal' THEN 'A' WHEN 'Social' THEN 'S' ELSE 'KEY NOT FOUND' END AS contact_point_type_code FROM sig)
"""


@check("opt_signature", ["changed_opts"], SIGNATURE + """
SELECT ok, subscription_opt_number, service_name, opt_type, contact_point_type_code FROM sigs
""")
def _(i):
    return route.with_opt_signature(i.changed_opts).select("ok", "subscription_opt_number", "service_name", "opt_type", "contact_point_type_code")


@check("partial_retention_users", ["identifies"], """
SELECT DISTINCT user_id FROM identifies WHERE (email = ' ' OR phone_number = ' ') AND (address_line1 IS NULL OR address_line1 <> ' ')
""")
def _(i):
    return route.partial_retention(i.identifies)


# ---- sources ----------------------------------------------------------------


@check("read_table_query", None, "SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def _(i):
    spark, sf = i.spark, i.sf_dir
    return readers.read_query(spark, f"SELECT n_name, r_name FROM parquet.`{sf}/nation.parquet` JOIN parquet.`{sf}/region.parquet` ON n_regionkey = r_regionkey")


@check("read_federated", None, "SELECT c_custkey, c_mktsegment FROM customer WHERE c_nationkey IN (1, 2, 3) AND c_mktsegment = 'BUILDING'")
def _(i):
    return readers.read_snapshot(
        i.spark, f"{i.sf_dir}/customer.parquet", ["c_custkey", "c_mktsegment"], "c_nationkey IN (1, 2, 3) AND c_mktsegment = 'BUILDING'"
    )


@check("catalog_columns", None, """
SELECT column_name, CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' ELSE 'timestamp_ntz' END AS data_type
FROM (DESCRIBE orders) AS d(column_name, data_type, a, b, c, f) WHERE column_name NOT LIKE 'o_order%' AND column_name NOT IN ('o_custkey')
""")
def _(i):
    return readers.catalog_columns(i.orders, exclude_like=["o_order%"], exclude_in=["o_custkey"])


@check("partition_pruned_scan", None, "SELECT o_orderkey, o_orderdate FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '1997-06-30'")
def _(i):
    return readers.scan_until(i.orders, "o_orderdate", "1997-06-30").select("o_orderkey", "o_orderdate")


@check("read_batches_by_key", ["identifies"], """
SELECT marketing_program_number, date_trunc('hour', ts) AS hour, source_id, count(*) AS n FROM identifies GROUP BY 1, 2, 3
""")
def _(i):
    return readers.batch_keys(i.identifies, "marketing_program_number", "ts", "source_id")


@check("read_batches", ["identifies"], """
SELECT marketing_program_number, date_trunc('hour', ts) AS hour, source_id, count(*) AS n FROM identifies GROUP BY 1, 2, 3
""")
def _(i):
    """All rows of a partitioned table, read by predicates made from its keys, and counted by key."""
    folder = f"{shared_dir(i.spark)}/batches-{uuid.uuid4().hex}"
    i.identifies.write.partitionBy("marketing_program_number").parquet(folder)
    table = i.spark.read.schema(i.identifies.schema).parquet(folder)
    keys = ["marketing_program_number", "ts", "source_id"]
    reads = readers.read_batches(table, readers.batch_predicates(table, *keys, reads=8))
    return reduce(DataFrame.unionByName, [readers.batch_keys(read, *keys) for read in reads])


@check("config_lookup", ["identifies", "crs_program"], """
SELECT ok, marketing_program_number, country_code, legal_entity FROM identifies LEFT JOIN crs_program ON mpn = marketing_program_number
""")
def _(i):
    out = readers.with_program_config(i.identifies, i.crs_program, "marketing_program_number")
    return out.select("ok", "marketing_program_number", "country_code", "legal_entity")
