"""Joins."""

from pyspark.sql import functions as F

from checks.q_enrich import LOOKUPS
from checks.q_routes import INVALID, SIGNATURE
from checks.registry import branches, check, message_id
from passerine.functions.values import root_text
from passerine.operators import aggregates, joins, reshape, route, windows
from passerine.plans import audience

OUT = """
WITH r AS (SELECT user_id, arg_max(email, row(ts, ok)) FILTER (WHERE email IS NOT NULL) AS a, arg_max(phone_number, row(ts, ok)) FILTER (WHERE phone_number IS NOT NULL) AS b,
   arg_max(address_line1, row(ts, ok)) FILTER (WHERE address_line1 IS NOT NULL) AS c, arg_max(address_line2, row(ts, ok)) FILTER (WHERE address_line2 IS NOT NULL) AS d,
   arg_max(address_line3, row(ts, ok)) FILTER (WHERE address_line3 IS NOT NULL) AS f
   FROM identifies WHERE context_personas_computation_class IS NULL GROUP BY user_id),
ret AS (SELECT user_id FROM r WHERE a = ' ' AND b = ' ' AND c = ' ' AND d = ' ' AND f = ' ')
"""


def retained(i):
    return audience.retention_out_users(i.identifies, ["ts", "ok"])


@check("retention_split", ["pl_scalars", "identifies"], OUT + """
SELECT coalesce(event_name, typ) AS event, CASE WHEN coalesce(user_txt, anon_txt) IN (SELECT user_id FROM ret) THEN 'blocked' ELSE 'kept' END AS branch, count(*) AS n
FROM pl_scalars GROUP BY 1, 2
""")
def _(i):
    """Flagship: events kept and blocked by retention, per event."""
    flagged = joins.retention_flag(route.with_user_key(i.payloads()), retained(i))
    name = F.coalesce(root_text("event"), root_text("type")).alias("event")
    branch = F.when(F.col("blocked"), "blocked").otherwise("kept").alias("branch")
    return flagged.select(name, branch).groupBy("event", "branch").agg(F.count(F.lit(1)).alias("n"))


@check("partial_retention_split", ["pl_scalars", "identifies"], """
SELECT message_id, CASE WHEN is_opt AND coalesce(user_txt, anon_txt) IN (SELECT user_id FROM identifies WHERE (email = ' ' OR phone_number = ' ') AND (address_line1 IS NULL OR address_line1 <> ' ')) THEN 'blocked' ELSE 'kept' END AS branch FROM pl_scalars
""")
def _(i):
    kept, blocked = joins.partial_retention_split(route.with_user_key(i.payloads()), route.partial_retention(i.identifies))
    return branches(kept=kept, blocked=blocked)


@check("lookup_enrich", ["pl_scalars", "identifies", "crs_program"], "WITH " + LOOKUPS + """
SELECT message_id, l_email AS email, l_src AS source, l_mpn AS mpn FROM pl_scalars LEFT JOIN lk ON lk.user_id = coalesce(user_txt, anon_txt)
""")
def _(i):
    newest = [F.col("ts").desc(), F.col("ok").desc()]
    known = i.known_mpns().withColumnRenamed("mpn", "marketing_program_number")
    email = windows.latest_row_per_user(i.identifies, "email", newest)
    source = windows.latest_row_per_user(i.identifies, "source_id", newest).withColumnRenamed("source_id", "sourceId")
    valid = i.identifies.join(known, "marketing_program_number", "left_semi")
    mpn = windows.latest_row_per_user(valid, "marketing_program_number", newest).withColumnRenamed("marketing_program_number", "marketingProgramNumber")
    out = joins.lookup_enrich(route.with_user_key(i.payloads()), email, source, mpn)
    return out.select(message_id(), F.col("lookup_email").alias("email"), F.col("lookup_sourceId").alias("source"), F.col("lookup_marketingProgramNumber").alias("mpn"))


@check("side_input_in", ["identifies", "crs_program"], INVALID + """
SELECT CASE WHEN marketing_program_number IN (SELECT m FROM inv) THEN 'in' ELSE 'out' END AS branch, count(*) AS n FROM identifies GROUP BY 1
""")
def _(i):
    invalid = joins.not_in_antijoin(i.identifies, "marketing_program_number", i.known_mpns()).withColumnRenamed("mpn", "marketing_program_number")
    inside, outside = joins.side_input_in(i.identifies, "marketing_program_number", invalid)
    both = inside.select(F.lit("in").alias("branch")).unionByName(outside.select(F.lit("out").alias("branch")))
    return both.groupBy("branch").agg(F.count(F.lit(1)).alias("n"))


@check("match_trace_ids", ["consents", "profile_consents"], "SELECT opt_id FROM consents WHERE trace_id IN (SELECT trace_id FROM profile_consents)")
def _(i):
    return joins.match_trace_ids(i.consents, i.profile_consents).select("opt_id")


SIG_DISTINCT = SIGNATURE + """,
ds AS (SELECT opt_id, subscription_opt_number, service_name, opt_type, contact_point_type_code, min(ts) AS first_at, max(ts) AS last_at, count(*) AS counts FROM sigs GROUP BY 1, 2, 3, 4, 5),
vm AS (SELECT DISTINCT ciam_opt_id, subscription_opt_number AS vn, service_name AS vs, contact_point_type_code AS vc FROM opt_map)
"""


@check("opts_null_tolerant_join", ["changed_opts", "opt_map"], SIG_DISTINCT + """
SELECT opt_id, subscription_opt_number, service_name, contact_point_type_code, counts, CASE WHEN vn IS NULL THEN 'false' ELSE 'true' END AS is_valid
FROM ds LEFT JOIN vm ON vn = coalesce(subscription_opt_number, vn) AND vs = service_name AND vc = contact_point_type_code AND ciam_opt_id = coalesce(opt_id, ciam_opt_id)
""")
def _(i):
    keys = ["opt_id", "subscription_opt_number", "service_name", "opt_type", "contact_point_type_code"]
    sigs = aggregates.min_max_count(route.with_opt_signature(i.changed_opts), keys, "ts")
    out = joins.opts_null_tolerant_join(sigs, i.opt_map)
    return out.select("opt_id", "subscription_opt_number", "service_name", "contact_point_type_code", "counts", "is_valid")


@check("opts_strict_join", ["changed_opts", "opt_map"], SIGNATURE + """,
ds AS (SELECT DISTINCT subscription_opt_number, service_name, contact_point_type_code FROM sigs), cn AS (SELECT subscription_opt_number AS n, service_name AS s, count(*) AS counts FROM sigs GROUP BY 1, 2),
vm AS (SELECT DISTINCT subscription_opt_number AS vn, service_name AS vs, contact_point_type_code AS vc FROM opt_map)
SELECT subscription_opt_number, service_name, contact_point_type_code, counts, CASE WHEN vn IS NULL THEN 'false' ELSE 'true' END AS is_valid
FROM ds LEFT JOIN vm ON vn = subscription_opt_number AND vs = service_name AND vc = contact_point_type_code LEFT JOIN cn ON n = subscription_opt_number AND s = service_name
""")
def _(i):
    sigs = route.with_opt_signature(i.changed_opts)
    counts = sigs.groupBy("subscription_opt_number", "service_name").agg(F.count(F.lit(1)).alias("counts"))
    out = joins.opts_strict_join(sigs.select("subscription_opt_number", "service_name", "contact_point_type_code").distinct(), i.opt_map, counts)
    return out.select("subscription_opt_number", "service_name", "contact_point_type_code", "counts", "is_valid")


SUGGEST = """
WITH cols AS (SELECT unnest(['trait_pet_kind', 'car_colour', 'score_web', 'email']) AS column_name),
tm AS (SELECT DISTINCT CAST(m.marketingProgramId AS STRING) AS mpn, m.traitId, t.traitName, s.ecoTraitName FROM trait_map m JOIN eco_system_trait s ON s.traitId = m.traitId AND s.ecoSystemId = m.ecoSystemId JOIN trait t ON t.traitId = m.traitId),
grid AS (SELECT DISTINCT q.mpn, column_name FROM crs_program q, cols),
sug AS (SELECT grid.mpn, column_name, x.traitId IS NOT NULL AS validation_result, y.traitId IS NOT NULL AS trait_match, coalesce(x.ecoTraitName, y.ecoTraitName) AS "ecoTraitName",
  coalesce(x.traitName, y.traitName) AS "traitName", coalesce(x.traitId, y.traitId) AS "traitId", z.traitName AS "suggested_traitName", z.traitId AS "suggested_traitId", z.ecoTraitName AS "suggested_ecoTraitName"
  FROM grid LEFT JOIN tm x ON x.mpn = grid.mpn AND lower(x.ecoTraitName) = column_name
  LEFT JOIN tm y ON y.mpn = grid.mpn AND replace(lower(y.ecoTraitName), '_', '') = replace(column_name, '_', '')
  LEFT JOIN tm z ON z.mpn = grid.mpn AND replace(lower(z.ecoTraitName), '_', '') LIKE '%' || replace(lower(substr(replace(column_name, 'trait_', ''), 1, 8)), '_', '') || '%')
"""
SUGGEST_VIEWS = ["trait_map", "eco_system_trait", "trait", "crs_program"]


def trait_catalogue(i):
    named = i.trait_map.join(i.eco_system_trait, ["traitId", "ecoSystemId"]).join(i.trait, "traitId")
    return named.select(F.col("marketingProgramId").cast("string").alias("mpn"), "traitId", "traitName", "ecoTraitName")


@check("trait_suggest_like", SUGGEST_VIEWS, SUGGEST + "SELECT * FROM sug")
def _(i):
    return joins.trait_suggest_like(["trait_pet_kind", "car_colour", "score_web", "email"], i.known_mpns(), trait_catalogue(i))


NAMES = "lower(trim(regexp_replace(x, '[^a-zA-Z ]', '', 'g')))"


@check("normalized_name_join", ["eco_system_trait"], """
WITH d AS (SELECT DISTINCT event_type || '_' || CAST(event_id % 3 AS STRING) AS col FROM events), r AS (SELECT DISTINCT 'View' AS prop UNION ALL SELECT DISTINCT 'c-l-i-c-k' )
SELECT col, prop, prop IS NOT NULL AS validation_result FROM d LEFT JOIN r ON lower(trim(regexp_replace(col, '[^a-zA-Z ]', '', 'g'))) = lower(trim(regexp_replace(prop, '[^a-zA-Z ]', '', 'g')))
""")
def _(i):
    left = i.events.select(F.concat("event_type", F.lit("_"), (F.col("event_id") % 3).cast("string")).alias("col")).distinct()
    right = i.spark.createDataFrame([("View",), ("c-l-i-c-k",)], "prop string")
    return joins.normalized_name_join(left, "col", right, "prop").select("col", "prop", "validation_result")


@check("not_in_antijoin", ["identifies", "crs_program"], INVALID + "SELECT m AS mpn FROM inv")
def _(i):
    return joins.not_in_antijoin(i.identifies, "marketing_program_number", i.known_mpns())


@check("anti_by_null_check", None, "SELECT c_custkey FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F') ON o_custkey = c_custkey WHERE o_custkey IS NULL")
def _(i):
    done = i.orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.anti_by_null_check(i.customer.select("c_custkey"), done, ["c_custkey"])


LATEST_ALIAS = "la AS (SELECT * FROM profile_aliases a WHERE last_updated_date = (SELECT max(last_updated_date) FROM profile_aliases b WHERE b.pg_id = a.pg_id))"


@check("latest_alias", ["profile_aliases"], f"WITH {LATEST_ALIAS} SELECT pg_id, canonical_pg_id, trace_id, last_updated_date FROM la")
def _(i):
    return joins.latest_alias(i.profile_aliases)


RESOLVED = """
cu AS (SELECT u.*, CASE WHEN mu.canonical_pg_id IS NOT NULL OR me.canonical_pg_id IS NOT NULL THEN coalesce(mu.canonical_pg_id, me.canonical_pg_id)
   WHEN u.id IN (SELECT id_value FROM unmerge) THEN u.id ELSE coalesce(c.canonical_user_id, u.id) END AS user_id
  FROM users u LEFT JOIN canon c ON c.previous_user_id = u.id LEFT JOIN merged_email me ON me.email = u.email LEFT JOIN merged_user mu ON mu.id = u.id)
"""
RESOLVED_VIEWS = ["users", "canon", "merged_email", "merged_user", "unmerge"]


def resolved(i):
    return joins.canonical_user(i.users, i.merged_email, i.merged_user, i.unmerge, i.canon)


@check("canonical_user", RESOLVED_VIEWS, f"WITH {RESOLVED} SELECT id, user_id FROM cu")
def _(i):
    return resolved(i).select("id", "user_id")


@check("channel_type_join", ["changed_opts", "contact_point_type"], SIGNATURE + """
SELECT ok, contact_point_type_code AS channel, t.contact_point_type_name FROM sigs JOIN contact_point_type t USING (contact_point_type_code)
""")
def _(i):
    rows = route.with_opt_signature(i.changed_opts).withColumnRenamed("contact_point_type_code", "channel")
    return joins.channel_type_join(rows, i.contact_point_type).select("ok", "channel", "contact_point_type_name")


COMPARED = """
WITH src AS (SELECT DISTINCT user_id, trait_name, trait_value FROM (
    SELECT user_id, unnest(['pet_kind', 'kids_count', 'car_colour', 'email']) AS trait_name, unnest([pet_kind, CAST(kids_count AS STRING), car_colour, email]) AS trait_value FROM canonical_ctas) WHERE trait_value IS NOT NULL),
g AS (SELECT DISTINCT id_value AS user_id, pg_id FROM id_graphs WHERE id_type = 'userId'), single AS (SELECT pg_id, max(user_id) AS user_id FROM g GROUP BY pg_id HAVING count(user_id) < 2),
cmp AS (SELECT DISTINCT src.user_id, src.trait_name, src.trait_value AS seg_trait_value, t.trait_value AS cdp_trait_value, t.trait_name AS cdp_trait_name, single.pg_id,
  CASE WHEN lower(trim(t.trait_value)) = lower(trim(src.trait_value)) THEN 1 END AS matched, CASE WHEN lower(trim(t.trait_value)) <> lower(trim(src.trait_value)) THEN 1 END AS un_matched
  FROM src LEFT JOIN single ON single.user_id = src.user_id LEFT JOIN (SELECT DISTINCT pg_id, trait_name, trait_value FROM tgt) t ON t.pg_id = single.pg_id AND lower(trim(t.trait_name)) = lower(trim(replace(src.trait_name, '_', ''))))
"""
TGT = """
WITH tgt AS (SELECT pg_id, 'email' AS trait_name, trait_value FROM profile_traits WHERE trait_name = 'email'
   UNION ALL SELECT pg_id, 'petkind', CASE WHEN trait_value = 'F' THEN 'Building' ELSE 'MACHINERY ' END FROM profile_traits WHERE trait_name = 'gender'
   UNION ALL SELECT pg_id, 'CarColour', 'blue' FROM profile_traits WHERE trait_name = 'countryCode'),
"""
COMPARED = TGT + COMPARED.lstrip()[5:]
COMPARED_VIEWS = ["canonical_ctas", "id_graphs", "profile_traits"]


def target_traits(i):
    t = i.profile_traits
    pets = F.when(F.col("trait_value") == "F", "Building").otherwise("MACHINERY ")
    return windows.union_all(
        t.filter("trait_name = 'email'").select("pg_id", "trait_name", "trait_value"),
        t.filter("trait_name = 'gender'").select("pg_id", F.lit("petkind").alias("trait_name"), pets.alias("trait_value")),
        t.filter("trait_name = 'countryCode'").select("pg_id", F.lit("CarColour").alias("trait_name"), F.lit("blue").alias("trait_value")),
    )


def source_traits(i):
    return reshape.unpivot_traits(i.canonical_ctas.select("user_id", "pet_kind", "kids_count", "car_colour", "email"), "user_id")


def single_users(i):
    graph = i.id_graphs.filter("id_type = 'userId'").select(F.col("id_value").alias("user_id"), "pg_id").distinct()
    return aggregates.having_filters(graph, ["pg_id"], {"user_id": F.max("user_id"), "n": F.count("user_id")}, F.col("n") < 2).select("user_id", "pg_id")


@check("seg_vs_cdp_join", COMPARED_VIEWS, COMPARED + "SELECT * FROM cmp")
def _(i):
    return joins.seg_vs_cdp_join(source_traits(i), single_users(i), target_traits(i))


@check("profile_users_join", ["identifies", "aliases_a", "aliases_b"], """
SELECT DISTINCT a.previous_id AS user_id, i.marketing_program_number, i.consumer_id FROM (SELECT * FROM aliases_a UNION SELECT * FROM aliases_b) a JOIN identifies i ON i.user_id = a.user_id
""")
def _(i):
    users = i.identifies.select("user_id", "marketing_program_number", "consumer_id").distinct()
    return joins.profile_users_join([i.aliases_a, i.aliases_b], users)


@check("date_range_join", ["profile_events", "profile_aliases"], f"""
WITH {LATEST_ALIAS} SELECT v.trace_id, p.canonical_pg_id, v.event_date FROM profile_events v JOIN (SELECT DISTINCT pg_id, canonical_pg_id FROM la) p ON p.pg_id = v.pg_id
WHERE v.event_name = 'Email Opened' AND CAST(v.event_date AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-21'
""")
def _(i):
    out = joins.date_range_join(i.profile_events, i.profile_aliases, "2024-01-03", "2024-01-21", "Email Opened")
    return out.select("trace_id", "canonical_pg_id", "event_date")


RESCI = """
WITH g AS (SELECT DISTINCT lower(id_value) AS email, pg_id FROM id_graphs WHERE id_type = 'email'), one AS (SELECT email, max(pg_id) AS record_id FROM g GROUP BY email HAVING count(*) = 1),
c AS (SELECT DISTINCT lower(email) AS email, account_created_on FROM contacts)
SELECT record_id, email, account_created_on FROM c JOIN one USING (email)
"""


@check("resci_mapping", ["id_graphs", "contacts"], RESCI)
def _(i):
    return joins.resci_mapping(i.contacts, i.id_graphs)


@check("id_rewrite_join", ["profile_traits", "id_map1"], """
SELECT coalesce(new_pg_id, pg_id) AS pg_id, count(*) AS n FROM profile_traits LEFT JOIN id_map1 ON pre_prod_pg_id = pg_id GROUP BY 1
""")
def _(i):
    from passerine.operators import identity

    mapping = i.id_map1.select(F.col("pre_prod_pg_id").alias("old"), F.col("new_pg_id").alias("new")).dropna()
    out = identity.id_rewrite_join(i.profile_traits, mapping, {"pg_id": "new"})
    return out.groupBy("pg_id").agg(F.count(F.lit(1)).alias("n"))


@check("computed_opt_traits", ["trait_map", "trait", "eco_system_trait"], """
SELECT DISTINCT s.ecoTraitName AS "traitName", m.traitId AS "traitId", s.ecoTraitName LIKE '%Corporate%' AS is_corporate, s.ecoTraitName LIKE '%Family%' AS is_family, s.ecoTraitName LIKE '%Profiling%' AS is_profiling
FROM trait_map m JOIN trait t ON t.traitId = m.traitId JOIN eco_system_trait s ON s.traitId = m.traitId AND s.ecoSystemId = m.ecoSystemId
WHERE m.ecoSystemId = 1 AND m.marketingProgramId IN (100, 101, 104) AND lower(t.traitName) LIKE 'email%opt%ind%'
""")
def _(i):
    return joins.computed_opt_traits(i.trait_map, i.trait, i.eco_system_trait, [100, 101, 104], ecosystem=1)
