"""Aggregations, windows, set operations, reshaping, identity rewrite, status merge."""

from pyspark.sql import functions as F

from checks.q_joins import COMPARED, COMPARED_VIEWS, single_users, source_traits, target_traits
from checks.registry import NOW, NOW_SQL, check, message_id
from passerine.operators import aggregates, identity, joins, reshape, route, windows
from passerine.operators.route import MPN
from passerine.sinks import writers

DUCK_BUCKET = "CAST(('0x' || substr(md5({0}), 1, 8)) AS BIGINT) % {1}"


@check("last_non_null", ["identifies"], """
SELECT user_id, arg_max(email, row(ts, ok)) FILTER (WHERE email IS NOT NULL) AS email, arg_max(phone_number, row(ts, ok)) FILTER (WHERE phone_number IS NOT NULL) AS phone_number,
  arg_max(trait_pet_kind, row(ts, ok)) FILTER (WHERE trait_pet_kind IS NOT NULL) AS trait_pet_kind FROM identifies GROUP BY user_id
""")
def _(i):
    return aggregates.last_non_null(i.identifies, ["user_id"], ["email", "phone_number", "trait_pet_kind"], ["ts", "ok"])


@check("any_non_null_pivot", ["profile_traits"], """
SELECT pg_id, max(CASE WHEN trait_name = 'email' THEN trait_value END) AS email, max(CASE WHEN trait_name = 'gender' THEN trait_value END) AS gender, max(CASE WHEN trait_name = 'optFamily' THEN trait_value END) AS "optFamily" FROM profile_traits GROUP BY pg_id
""")
def _(i):
    return aggregates.any_non_null_pivot(i.profile_traits, "pg_id", "trait_name", "trait_value", ["email", "gender", "optFamily"])


@check("external_id_pivot", ["pl_scalars"], "SELECT message_id, xmpn AS mpn, xsrc AS source, xcons AS consumer FROM pl_scalars")
def _(i):
    out = aggregates.external_id_pivot(i.payloads(), [MPN, "sourceId", "consumerId"])
    return out.select(message_id(), F.col(f"e_{MPN}").alias("mpn"), F.col("e_sourceId").alias("source"), F.col("e_consumerId").alias("consumer"))


@check("group_by_all", ["identifies"], "SELECT user_id, source_id, marketing_program_number, max(ts) AS last_ts FROM identifies GROUP BY ALL")
def _(i):
    frame = i.identifies.select("user_id", "source_id", "marketing_program_number", "ts")
    return aggregates.group_by_all(frame, ["ts"], {"last_ts": F.max("ts")})


@check("count_distinct_union", ["identifies"], """
SELECT 'with email' AS audience_name, count(DISTINCT user_id) AS count FROM identifies WHERE email <> ' '
UNION ALL SELECT 'red car', count(DISTINCT user_id) FROM identifies WHERE car_colour = 'O' UNION ALL SELECT 'source 3', count(DISTINCT user_id) FROM identifies WHERE source_id = '3'
UNION ALL SELECT 'nobody', 0
""")
def _(i):
    specs = {"with email": F.col("email") != " ", "red car": F.col("car_colour") == "O", "source 3": F.col("source_id") == "3", "nobody": F.lit(False)}
    return aggregates.count_distinct_union(i.identifies, "user_id", specs)


@check("latest_per_user_event", ["pl_scalars"], """
SELECT user_txt AS user_id, event_name AS event, arg_max(message_id, row(coalesce(tst, ''), message_id)) AS message_id FROM pl_scalars WHERE user_txt IS NOT NULL AND event_name IS NOT NULL GROUP BY 1, 2
""")
def _(i):
    out = aggregates.latest_per_user_event(i.payloads())
    return out.select("user_id", "event", F.get_json_object("raw_payload", "$.messageId").alias("message_id"))


@check("min_max_count", None, "SELECT event_type, min(ts) AS first_at, max(ts) AS last_at, count(*) AS counts FROM events GROUP BY event_type")
def _(i):
    return aggregates.min_max_count(i.events, ["event_type"], "ts")


@check("string_agg_distinct", ["identifies"], """
SELECT marketing_program_number, string_agg(DISTINCT car_colour, ' | ' ORDER BY car_colour) AS car_colour, string_agg(DISTINCT source_id, ' | ' ORDER BY source_id) AS source_id FROM identifies GROUP BY 1
""")
def _(i):
    return aggregates.string_agg_distinct(i.identifies, ["marketing_program_number"], ["car_colour", "source_id"])


@check("nested_best_value", ["profile_traits"], """
SELECT pg_id, trait_id, trait_value FROM (SELECT *, row_number() OVER (PARTITION BY pg_id, trait_id ORDER BY trait_consumer_last_updated_date DESC NULLS LAST, trait_expiration_date DESC NULLS LAST, last_updated_date DESC NULLS LAST, trait_value DESC NULLS LAST) AS rn FROM profile_traits) WHERE rn = 1
""")
def _(i):
    return aggregates.nested_best_value(
        i.profile_traits, ["pg_id", "trait_id"], ["trait_consumer_last_updated_date", "trait_expiration_date", "last_updated_date"], "trait_value")


@check("having_filters", ["id_graphs"], "SELECT pg_id, count(DISTINCT id_value) AS n FROM id_graphs WHERE id_type = 'email' GROUP BY pg_id HAVING count(DISTINCT id_value) > 1")
def _(i):
    rows = i.id_graphs.filter("id_type = 'email'").select("pg_id", "id_value").distinct()
    return aggregates.having_filters(rows, ["pg_id"], {"n": F.count("id_value")}, F.col("n") > 1)


RATE = """
SELECT trait_name, sum(coalesce(matched, 0)) AS match_count, sum(coalesce(un_matched, 0)) AS un_match_count,
  round(sum(coalesce(un_matched, 0)) / (coalesce(sum(matched), 0.01) + coalesce(sum(un_matched), 0.01)) * 100, 6) AS un_match_percent FROM cmp GROUP BY trait_name HAVING un_match_percent > 0
"""


@check("match_rate", COMPARED_VIEWS, COMPARED + RATE)
def _(i):
    rows = joins.seg_vs_cdp_join(source_traits(i), single_users(i), target_traits(i))
    return aggregates.match_rate(rows, "trait_name").withColumn("un_match_percent", F.round("un_match_percent", 6))


@check("non_blank_counts", ["identifies"], " UNION ALL ".join(f"""
SELECT marketing_program_number, '{c}' AS column_name, count(*) FILTER (WHERE trim(CAST({c} AS STRING)) <> '') AS non_blank_counts, count({c}) AS overall_counts,
  max(CAST(ts AS DATE)) FILTER (WHERE trim(CAST({c} AS STRING)) <> '') AS latest FROM identifies GROUP BY 1
""" for c in ("email", "trait_pet_kind", "score_web")))
def _(i):
    return aggregates.non_blank_counts(i.identifies, ["email", "trait_pet_kind", "score_web"], "ts", ["marketing_program_number"])


@check("min_created", ["id_aliases"], "SELECT pg_id, min(created_date) AS created_date FROM id_aliases GROUP BY pg_id")
def _(i):
    return aggregates.min_created(i.id_aliases, "pg_id", "created_date")


@check("first_row_group_doc", ["consents"], """
SELECT trace_id, arg_min(source_id, opt_id) AS source_id, arg_min(email, opt_id) AS email, count(*) AS n_rows, string_agg(service_name || ':' || CAST(opt_id AS STRING), ',' ORDER BY opt_id) AS items FROM consents GROUP BY trace_id
""")
def _(i):
    docs = aggregates.first_row_group_doc(i.consents, "trace_id", ["opt_id"], ["source_id", "email"], ["service_name"])
    items = F.array_join(F.transform("items", lambda x: F.concat(x["service_name"], F.lit(":"), x["opt_id"].cast("string"))), ",")
    return docs.select("trace_id", "source_id", "email", "n_rows", items.alias("items"))


@check("distinct", None, "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def _(i):
    return aggregates.distinct(i.lineitem, ["l_returnflag", "l_linestatus"])


# ---- windows, order, set operations ----------------------------------------------


@check("latest_row_per_user", ["identifies"], """
SELECT user_id, email FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, ok DESC) AS rn FROM identifies WHERE trim(email) <> '') WHERE rn = 1
""")
def _(i):
    return windows.latest_row_per_user(i.identifies, "email", [F.col("ts").desc(), F.col("ok").desc()])


def services(i):
    return i.changed_opts.filter("email_subscription_service_name IS NOT NULL").withColumnRenamed("email_subscription_service_name", "service_name")


@check("latest_opt_per_service", ["changed_opts"], """
SELECT user_id, CASE WHEN service_name IN ('S1', 'S2') THEN 'S1' ELSE service_name END AS service_name, ok FROM (SELECT *, email_subscription_service_name AS service_name,
  row_number() OVER (PARTITION BY user_id, email_subscription_service_name ORDER BY ts DESC, ok DESC) AS rn FROM changed_opts WHERE email_subscription_service_name IS NOT NULL) WHERE rn = 1
""")
def _(i):
    out = windows.latest_opt_per_service(services(i), [F.col("ts").desc(), F.col("ok").desc()], {"S2": "S1"})
    return out.select("user_id", "service_name", "ok")


@check("latest_trait_rank", ["profile_traits"], """
SELECT pg_id, trait_id, trait_value, trace_id FROM (SELECT *, rank() OVER (PARTITION BY pg_id, trait_id, trait_value ORDER BY last_updated_date DESC) AS rk FROM profile_traits) WHERE rk = 1
""")
def _(i):
    rows = i.profile_traits.select(
        F.col("pg_id").alias("consumerid_sourceid_mpn"), F.col("trait_id").alias("traitId"), "trait_value",
        F.col("last_updated_date").alias("trait_consumer_last_updated_date"), "trace_id")
    out = windows.latest_trait_rank(rows)
    return out.select(F.col("consumerid_sourceid_mpn").alias("pg_id"), F.col("traitId").alias("trait_id"), "trait_value", "trace_id")


@check("latest_consent_rank", ["consents"], """
SELECT trace_id, opt_status, service_name, opt_id FROM (SELECT *, rank() OVER (PARTITION BY consumer_id, opt_status, service_name ORDER BY opt_date DESC, trace_id DESC) AS rk FROM consents) WHERE rk = 1
""")
def _(i):
    rows = i.consents.select(
        F.col("consumer_id").alias("userId"), F.lit("x").alias("opt_date"), "opt_status", "service_name", "contact_point_type_name",
        F.col("opt_date").alias("created_date"), "trace_id", "opt_id")
    return windows.latest_consent_rank(rows).select("trace_id", "opt_status", "service_name", "opt_id")


@check("earliest_identity_rank", ["id_graphs", "id_aliases"], """
WITH c AS (SELECT pg_id, min(created_date) AS d FROM id_aliases GROUP BY pg_id)
SELECT id_value, pg_id FROM (SELECT g.id_value, g.pg_id, rank() OVER (PARTITION BY g.id_value ORDER BY d) AS rk FROM id_graphs g JOIN c ON c.pg_id = g.pg_id WHERE g.id_type = 'userId') WHERE rk = 1
""")
def _(i):
    created = aggregates.min_created(i.id_aliases, "pg_id", "created_date")
    users = i.id_graphs.filter("id_type = 'userId'").join(created, "pg_id")
    return windows.earliest_identity_rank(users).select("id_value", "pg_id")


@check("report_order", None, "SELECT event_type, count(*) AS n FROM events GROUP BY event_type ORDER BY n DESC, event_type")
def _(i):
    counts = i.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return windows.report_order(counts, [F.col("n").desc(), F.col("event_type")])


@check("top1_in_array", None, "SELECT l_orderkey, arg_max(l_linestatus, row(l_shipdate, l_linenumber)) AS status FROM lineitem GROUP BY l_orderkey")
def _(i):
    items = i.lineitem.groupBy("l_orderkey").agg(F.collect_list(F.struct("l_shipdate", "l_linenumber", "l_linestatus")).alias("items"))
    return windows.top1_in_array(items, "items", ["l_shipdate", "l_linenumber"], "l_linestatus", "status").select("l_orderkey", "status")


@check("union_all", None, """
SELECT c_custkey AS id, c_name AS name, NULL AS size FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier UNION ALL SELECT p_partkey, NULL, p_size FROM part
""")
def _(i):
    return windows.union_all(
        i.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")),
        i.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")),
        i.part.select(F.col("p_partkey").alias("id"), F.col("p_size").alias("size")))


@check("flatten_merge", ["pl_scalars"], "SELECT message_id FROM pl_scalars")
def _(i):
    opt, rest = route.split_changed_opt(i.payloads())
    return windows.flatten_merge(rest.select(message_id()), opt.select(message_id()))


# ---- reshape -----------------------------------------------------------------------


@check("unpivot_traits", ["canonical_ctas"], """
SELECT DISTINCT user_id, trait_name, trait_value FROM (SELECT user_id, unnest(['pet_kind', 'kids_count', 'car_colour']) AS trait_name, unnest([pet_kind, CAST(kids_count AS STRING), car_colour]) AS trait_value FROM canonical_ctas) WHERE trait_value IS NOT NULL
""")
def _(i):
    return reshape.unpivot_traits(i.canonical_ctas.select("user_id", "pet_kind", "kids_count", "car_colour"), "user_id")


@check("pivot_ecosystems", ["trait_map", "eco_system_trait"], """
SELECT m.marketingProgramId AS program, m.traitId AS trait, max(CASE WHEN m.ecoSystemId = 1 THEN ecoTraitName END) AS segment, max(CASE WHEN m.ecoSystemId = 4 THEN ecoTraitName END) AS okta, max(CASE WHEN m.ecoSystemId = 10 THEN ecoTraitName END) AS target
FROM trait_map m LEFT JOIN eco_system_trait s USING (traitId, ecoSystemId) GROUP BY 1, 2
""")
def _(i):
    name = F.when(F.col("ecoSystemId") == 1, "segment").when(F.col("ecoSystemId") == 4, "okta").when(F.col("ecoSystemId") == 10, "target").otherwise("none")
    rows = i.trait_map.join(i.eco_system_trait, ["traitId", "ecoSystemId"], "left").select(
        F.col("marketingProgramId").alias("program"), F.col("traitId").alias("trait"), name.alias("ecoSystemName"), "ecoTraitName")
    return reshape.pivot_ecosystems(rows, ["program", "trait"], ["segment", "okta", "target"])


@check("unnest_json_array", ["pl"], """
SELECT message_id, json_extract_string(x, '$.type') AS type, json_extract_string(x, '$.id') AS id FROM (SELECT message_id, unnest(CAST(json_extract(raw_payload, '$.context.externalIds') AS JSON[])) AS x FROM pl)
UNION ALL SELECT message_id, NULL, NULL FROM pl_blocks WHERE ext_json = '[]'
""")
def _(i):
    out = reshape.unnest_json_array(i.pl.select("raw_payload"), "raw_payload", "$.context.externalIds")
    field = lambda c, p: F.get_json_object(c, p)
    return out.select(field("raw_payload", "$.messageId").alias("message_id"), field("element", "$.type").alias("type"), field("element", "$.id").alias("id"))


@check("leaves_to_rows", ["pl_blocks"], """
WITH t AS (SELECT * FROM pl_blocks WHERE is_identify AND traits_state = 'object')
SELECT message_id, 'email' AS key, tmail AS val FROM t UNION ALL SELECT message_id, 'marketingProgramNumber', tmpn FROM t WHERE tmpn IS NOT NULL
UNION ALL SELECT message_id, 'sourceId', tsrc FROM t WHERE tsrc IS NOT NULL UNION ALL SELECT message_id, 'phoneNumber', tphone FROM t WHERE tphone IS NOT NULL
UNION ALL SELECT message_id, 'consumerId', tcons FROM t WHERE tcons IS NOT NULL UNION ALL SELECT message_id, 'offlineConsumerId', toff FROM t WHERE toff IS NOT NULL
UNION ALL SELECT message_id, unnest(['registrationDate', 'emailConsumerChoiceDate']), reg FROM t UNION ALL SELECT message_id, 'lastActivityDate', lad FROM t WHERE lad IS NOT NULL
UNION ALL SELECT message_id, unnest(['skin_score', 'ratio', 'blankTrait', 'spaceTrait', 'gender']), unnest(['3', '1.5', '', ' ', 'F']) FROM t
UNION ALL SELECT message_id, 'newsOptNumber', CAST(e % 50 AS STRING) FROM t UNION ALL SELECT message_id, 'petOptIndicator', CASE e % 4 WHEN 0 THEN 'true' WHEN 1 THEN 'false' WHEN 2 THEN 'TRUE' END FROM t
UNION ALL SELECT message_id, 'stdAddress', CASE e % 2 WHEN 0 THEN ' ' ELSE 'Main St' END FROM t UNION ALL SELECT message_id, 'sexAlias', CASE e % 3 WHEN 0 THEN 'F' ELSE 'M' END FROM t
UNION ALL SELECT message_id, unnest(['dependents.0.name', 'dependents.0.age', 'dependents.0.pets.0.kind', 'dependents.0.pets.1.kind', 'dependents.1.name', 'dependents.1.nick']),
   unnest(['k' || us, CAST(e % 9 AS STRING), 'cat', 'dog', 'j', NULL]) FROM t WHERE has_deps
""")
def _(i):
    rows = i.payloads().select(message_id(), F.to_variant_object("traits").alias("_t")).filter(F.col("_t").isNotNull())
    return reshape.leaves_to_rows(rows, F.col("_t")).select("message_id", "key", "val")


@check("split_to_rows", ["event_ref"], "SELECT eventName AS \"eventName\", unnest(string_split(eventNameAlias, '|')) AS value FROM event_ref WHERE length(eventNameAlias) > 1")
def _(i):
    return reshape.split_to_rows(i.event_ref.filter("length(eventNameAlias) > 1"), "eventNameAlias").select("eventName", "value")


BATCHED = f"""
bk AS (SELECT user_ids, pg_ids, {DUCK_BUCKET.format('user_ids', "(SELECT greatest(1, CAST(ceil(count(*) / 100.0) AS BIGINT)) FROM requests)")} AS bucket FROM requests),
bt AS (SELECT *, CAST(floor((row_number() OVER (PARTITION BY bucket ORDER BY user_ids) - 1) / 45) AS BIGINT) AS batch, (row_number() OVER (PARTITION BY bucket ORDER BY user_ids) - 1) % 45 AS position FROM bk)
"""


@check("batch_rows", ["requests"], f"WITH {BATCHED} SELECT user_ids, bucket, batch, position FROM bt")
def _(i):
    return reshape.batch_rows(i.requests, "user_ids", 45, 100).select("user_ids", "bucket", "batch", "position")


# ---- identity ---------------------------------------------------------------------------


MAP = """
map AS (SELECT old, max(new) AS new FROM (SELECT pre_prod_pg_id AS old, new_pg_id AS new FROM id_map1 UNION ALL SELECT pre_prod_pg_id, new_pg_id FROM id_map2) WHERE new IS NOT NULL GROUP BY old)
"""


@check("rewrite_pg_id", ["profile_aliases", "profile_traits", "profile_events", "id_map1", "id_map2"], f"""
WITH {MAP} SELECT 'profile_aliases' AS tbl, trace_id AS k, coalesce(new, pg_id) AS pg_id, coalesce(new, canonical_pg_id) AS canonical FROM profile_aliases LEFT JOIN map ON old = pg_id
UNION ALL SELECT 'profile_traits', trace_id || '/' || CAST(trait_id AS STRING), coalesce(new, pg_id), NULL FROM profile_traits LEFT JOIN map ON old = pg_id
UNION ALL SELECT 'profile_events', trace_id, coalesce(new, pg_id), NULL FROM profile_events LEFT JOIN map ON old = pg_id
""")
def _(i):
    tables = {"profile_aliases": i.profile_aliases, "profile_traits": i.profile_traits, "profile_events": i.profile_events}
    new = identity.rewrite_pg_id(tables, i.id_map1, i.id_map2)
    none = F.lit(None).cast("string").alias("canonical")
    return windows.union_all(
        new["profile_aliases"].select(F.lit("profile_aliases").alias("tbl"), F.col("trace_id").alias("k"), "pg_id", F.col("canonical_pg_id").alias("canonical")),
        new["profile_traits"].select(F.lit("profile_traits").alias("tbl"), F.concat("trace_id", F.lit("/"), F.col("trait_id").cast("string")).alias("k"), "pg_id", none),
        new["profile_events"].select(F.lit("profile_events").alias("tbl"), F.col("trace_id").alias("k"), "pg_id", none))


@check("rewrite_trace_id", ["profile_events", "event_properties"], """
SELECT 'profile_events' AS tbl, CASE WHEN trace_id IN (SELECT trace_id FROM event_properties) THEN trace_id || '-pp' ELSE trace_id END AS trace_id FROM profile_events
UNION ALL SELECT 'event_properties', trace_id || '-pp' FROM event_properties
""")
def _(i):
    out = identity.rewrite_trace_id({"profile_events": i.profile_events, "event_properties": i.event_properties}, i.event_properties)
    return windows.union_all(*[df.select(F.lit(n).alias("tbl"), "trace_id") for n, df in out.items()])


def consent_changes(i):
    return i.consents.filter("opt_id % 6 = 0").select(
        "id_value", "service_name", "marketing_program_number", "contact_point_type_name", F.expr("opt_date + INTERVAL 1 DAY").alias("opt_date"), F.lit("X").alias("opt_status"))


@check("update_consents", ["consents"], """
WITH ch AS (SELECT id_value, service_name, marketing_program_number, contact_point_type_name, max(opt_date + INTERVAL 1 DAY) AS d FROM consents WHERE opt_id % 6 = 0 GROUP BY 1, 2, 3, 4)
SELECT opt_id, coalesce(d, opt_date) AS opt_date, CASE WHEN d IS NULL THEN opt_status ELSE 'X' END AS opt_status FROM consents LEFT JOIN ch USING (id_value, service_name, marketing_program_number, contact_point_type_name)
""")
def _(i):
    return identity.update_consents(i.consents, consent_changes(i)).select("opt_id", "opt_date", "opt_status")


@check("null_literal_cleanup", ["consents"], """
SELECT opt_id, CASE WHEN marketing_program_number = '103' AND phone_number = 'NULL' THEN NULL ELSE phone_number END AS phone_number, CASE WHEN marketing_program_number = '103' AND opt_text = 'NULL' THEN NULL ELSE opt_text END AS opt_text FROM consents
""")
def _(i):
    return identity.null_literal_cleanup(i.consents, "103", ["phone_number", "opt_text"]).select("opt_id", "phone_number", "opt_text")


@check("copy_by_program", ["consents", "profile_consents", "users"], """
SELECT opt_id FROM consents WHERE marketing_program_number = '104' AND trace_id IN (SELECT trace_id FROM profile_consents) AND opt_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
""")
def _(i):
    done = i.orders.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("opt_id"))
    return identity.copy_by_program(i.consents, "104", [(i.profile_consents, ["trace_id"])], (done, ["opt_id"])).select("opt_id")


IDMAP = """
c AS (SELECT pg_id, min(created_date) AS d FROM id_aliases GROUP BY pg_id),
idm AS (SELECT pg_id AS pg_ids, id_value AS user_ids FROM (SELECT g.id_value, g.pg_id, rank() OVER (PARTITION BY g.id_value ORDER BY d) AS rk FROM id_graphs g JOIN c ON c.pg_id = g.pg_id
  WHERE g.id_type = 'userId' AND g.marketing_program_number IN (100, 101, 102, 103, 104, 105)) WHERE rk = 1)
"""
PROGRAMS = [100, 101, 102, 103, 104, 105]


@check("id_mapping", ["id_graphs", "id_aliases"], f"WITH {IDMAP} SELECT pg_ids, user_ids FROM idm")
def _(i):
    return identity.id_mapping(i.id_graphs, i.id_aliases, PROGRAMS)


@check("id_mapping_update", ["id_graphs", "id_aliases"], f"WITH {IDMAP} SELECT pg_ids, user_ids FROM idm")
def _(i):
    """The mapping of the alias rows of even trace ids, brought up to date with the others: equal to a full rebuild."""
    early = F.col("trace_id").substr(2, 20).cast("bigint") % 2 == 0
    old, new = i.id_aliases.filter(early), i.id_aliases.filter(~early)
    mapping = identity.id_mapping(i.id_graphs, old, PROGRAMS)
    return identity.updated_id_mapping(mapping, identity.first_created(old), i.id_graphs, new, PROGRAMS)[0]


def outcomes(i):
    """One call outcome per request of a batch of 45; errors are located by batch position."""
    batched = reshape.batch_rows(i.requests, "user_ids", 45, 100).withColumnRenamed("user_ids", "previousId")
    errors = batched.filter("position % 6 = 1").select("bucket", "batch", "position", F.concat(F.lit("error "), F.col("position").cast("string")).alias("error"))
    return identity.batch_outcomes(batched.filter("ck % 5 <> 0"), errors)


@check("apply_api_outcomes", ["requests"], f"""
WITH {BATCHED}, told AS (SELECT user_ids, CASE WHEN position % 6 = 1 THEN 'error ' || CAST(position AS STRING) END AS error FROM bt WHERE CAST(substr(user_ids, 2) AS BIGINT) % 5 <> 0)
SELECT r.user_ids AS "previousId", CASE WHEN t.user_ids IS NULL THEN 'ToBeTriggered' WHEN error IS NULL THEN 'Success' ELSE 'ToBeTriggered' END AS status, coalesce(error, '') AS response,
  CASE WHEN t.user_ids IS NULL THEN 0 ELSE 1 END AS retry_count, CASE WHEN t.user_ids IS NULL THEN NULL ELSE {NOW_SQL} END AS triggered_date
FROM requests r LEFT JOIN told t ON t.user_ids = r.user_ids
""")
def _(i):
    out = identity.apply_api_outcomes(identity.alias_request_rows(i.requests), outcomes(i), NOW)
    return out.select("previousId", "status", "response", "retry_count", F.col("triggered_date").cast("timestamp_ntz").alias("triggered_date"))


@check("retry_exhausted", ["requests"], """
SELECT user_ids AS "previousId", CASE WHEN ck % 5 >= 3 THEN 'ToBeAnalysed' ELSE 'ToBeTriggered' END AS status FROM requests
""")
def _(i):
    rows = i.requests.select(F.col("user_ids").alias("previousId"), (F.col("ck") % 5).alias("retry_count"), F.lit("ToBeTriggered").alias("status"))
    return identity.retry_exhausted(rows).select("previousId", "status")


MERGED = """
SELECT r.message_id, CASE WHEN u.message_id IS NOT NULL AND r.replay_status = 'ToBeReplayed' THEN u.replay_status ELSE r.replay_status END AS replay_status,
  CASE WHEN u.message_id IS NOT NULL AND r.replay_status = 'ToBeReplayed' THEN u.replay_time ELSE r.replay_time END AS replay_time
FROM replay_table r LEFT JOIN replay_updates u ON u.message_id = r.message_id AND u.trace_id = r.trace_id
"""


@check("merge_status", ["replay_table", "replay_updates"], MERGED)
def _(i):
    return identity.merge_status(i.replay_table, i.replay_updates).select("message_id", "replay_status", "replay_time")


@check("merge_status_partitions", ["replay_table", "replay_updates"], MERGED)
def _(i):
    """The same merge into a partitioned table, of which only the touched partitions are rewritten."""
    from checks.q_io import scratch

    path = scratch(i.spark) + "/replay"
    i.replay_table.withColumn("part", F.col("event_id") % 16).write.partitionBy("part").parquet(path)
    writers.merge_partitions(i.spark, path, i.replay_updates, identity.merge_status, ["message_id", "trace_id"], "part")
    return i.spark.read.parquet(path).select("message_id", "replay_status", "replay_time")
