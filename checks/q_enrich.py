"""Payload enrichment."""

from pyspark.sql import functions as F

from checks.registry import NOW, check, message_id
from passerine.functions.values import ext_id, ext_text, ext_type, has_key, is_text, kind, root_text, text
from passerine.operators import enrich, identity, joins, route, service_payloads
from passerine.operators.route import MPN
from passerine.plans import staging

S = """
WITH s AS (SELECT *, is_identify AND traits_state = 'object' AS t, NOT is_identify AS p,
  (is_identify AND traits_state = 'object') OR NOT is_identify AS tp, ext_json <> '[]' AS has_ids,
  coalesce(event_name = 'Signed Up for Promotion', FALSE) AS signup FROM pl_blocks)
"""


def tr(key):
    return text(F.col("traits")[key])


def pr(key):
    return text(F.col("properties")[key])


def ext_count(kind_name):
    return F.size(F.filter("ext_ids", lambda x: ext_type(x) == kind_name))


@check("normalize_timestamps", ["pl_blocks"], S + """,
n AS (SELECT *, t OR (p AND tst IS NOT NULL) AS touched,
  CASE e % 4 WHEN 1 THEN reg || 'T00:00:00.000Z' WHEN 2 THEN substr(reg, 1, 10) || 'T' || substr(reg, 12, 8) || '.000Z' ELSE reg END AS reg_n FROM s)
SELECT message_id,
  CASE WHEN NOT touched THEN ots WHEN e % 19 = 1 THEN substr(ots, 1, 19) || '.000Z' WHEN e % 19 = 5 THEN substr(ots, 1, 10) || 'T' || substr(ots, 12, 8) || '.000Z' ELSE ots END AS original_ts,
  CASE WHEN touched AND e % 29 = 3 THEN '2024-01-15T00:00:00.000Z' ELSE tst END AS record_ts,
  CASE WHEN t THEN reg_n WHEN is_opt AND ch_email THEN CASE WHEN tst IS NULL THEN reg ELSE reg_n END END AS email_date
FROM n
""")
def _(i):
    out = enrich.normalize_timestamps(i.payloads())
    return out.select(
        message_id(), root_text("originalTimestamp").alias("original_ts"), root_text("timestamp").alias("record_ts"),
        F.coalesce(tr("emailConsumerChoiceDate"), pr("emailConsumerChoiceDate")).alias("email_date"),
    )


@check("lowercase_opt_flags", ["pl_blocks"], S + """
SELECT message_id, CASE WHEN t THEN CASE e % 4 WHEN 0 THEN 'true' WHEN 1 THEN 'false' WHEN 2 THEN 'true' ELSE 'none' END END AS pet,
  CASE WHEN t THEN CAST(e % 50 AS STRING) END AS news, CASE WHEN is_opt AND ch_email THEN eind END AS email_ind, CASE WHEN is_opt AND ch_email THEN enum END AS email_number,
  t OR (is_opt AND ch_email) AS all_text
FROM s
""")
def _(i):
    out = enrich.lowercase_opt_flags(i.payloads())
    flag = is_text(F.col("traits")["newsOptNumber"]) | is_text(F.col("properties")["emailSubscriptionOptIndicator"])
    return out.select(
        message_id(), tr("petOptIndicator").alias("pet"), tr("newsOptNumber").alias("news"),
        pr("emailSubscriptionOptIndicator").alias("email_ind"), pr("emailSubscriptionOptNumber").alias("email_number"), flag.alias("all_text"),
    )


LOOKUPS = """
lk AS (SELECT user_id, arg_max(email, row(ts, ok)) FILTER (WHERE trim(email) <> '') AS l_email,
   arg_max(source_id, row(ts, ok)) FILTER (WHERE trim(source_id) <> '') AS l_src,
   arg_max(marketing_program_number, row(ts, ok)) FILTER (WHERE marketing_program_number IN (SELECT mpn FROM crs_program)) AS l_mpn
  FROM identifies GROUP BY user_id)
"""


def lookups(i):
    return joins.user_lookups(i.identifies, i.known_mpns(), [F.col("ts"), F.col("ok")])


@check("fill_external_ids", ["pl_blocks", "identifies", "crs_program"], S + "," + LOOKUPS + """,
f AS (SELECT s.*, 
  CASE WHEN trim(xmail) <> '' THEN xmail WHEN tp AND trim(tmail) <> '' THEN tmail ELSE l_email END AS f_email,
  CASE WHEN trim(xsrc) <> '' THEN xsrc WHEN tp AND trim(tsrc) <> '' AND NOT tsrc_num THEN tsrc ELSE l_src END AS f_src,
  CASE WHEN xmpn IS NOT NULL THEN xmpn WHEN tp AND tmpn IS NOT NULL AND NOT tmpn_num THEN tmpn ELSE l_mpn END AS f_mpn,
  CASE WHEN xcc IS NOT NULL THEN xcc WHEN p AND pcc IS NOT NULL THEN pcc ELSE 'ZZ' END AS f_cc
  FROM s LEFT JOIN lk ON lk.user_id = coalesce(user_txt, anon_txt))
SELECT message_id, f_email AS email, f_src AS source_id, f_mpn AS mpn, f_cc AS country_code,
  CAST(f_email IS NOT NULL AS INT) + CAST(f_src IS NOT NULL AS INT) + CAST(f_mpn IS NOT NULL AS INT) + 1 + CAST(xcons IS NOT NULL AS INT)
  + CAST(xloy IS NOT NULL AS INT) + CAST(xphone IS NOT NULL AS INT) AS n_ids
FROM f
""")
def _(i):
    out = enrich.fill_external_ids(route.with_user_key(i.payloads()), lookups(i), "ZZ")
    return out.select(
        message_id(), ext_text("email").alias("email"), ext_text("sourceId").alias("source_id"), ext_text(MPN).alias("mpn"),
        ext_text("countryCode").alias("country_code"), F.size("ext_ids").alias("n_ids"),
    )


@check("consumer_id", ["pl_blocks"], S + """,
c AS (SELECT *, CASE WHEN tp THEN tcons END AS copied,
   has_ids AND (coalesce(xcons = '', FALSE) OR (xcons IS NULL AND NOT signup)) AND NOT (tp AND toff IS NOT NULL) AS may,
   sha256(coalesce(CASE WHEN trim(xmail) <> '' THEN xmail END, xphone, CASE WHEN tp THEN tphone END)) AS digest,
   coalesce(CASE WHEN trim(xsrc) <> '' THEN xsrc END, ots) AS suffix FROM s)
SELECT message_id, CASE WHEN xcons <> '' THEN xcons WHEN copied IS NOT NULL THEN copied WHEN may AND digest IS NOT NULL AND suffix IS NULL THEN xcons
   WHEN may THEN digest || suffix END AS consumer,
  CASE WHEN xcons <> '' OR copied IS NOT NULL THEN 1 WHEN may AND digest IS NOT NULL AND suffix IS NULL THEN CAST(xcons IS NOT NULL AS INT) WHEN may AND digest IS NOT NULL THEN 1 ELSE 0 END AS n
FROM c
""")
def _(i):
    return enrich.consumer_id(i.payloads()).select(message_id(), ext_text("consumerId").alias("consumer"), F.coalesce(ext_count("consumerId"), F.lit(0)).alias("n"))


@check("fix_consumer_id", ["pl_blocks"], S + """,
c AS (SELECT *, has_ids AND (xcons IS NULL OR (e % 6 = 0 AND NOT signup)) AND NOT (tp AND toff IS NOT NULL) AS rebuild, sha256(xmail) || ots AS made FROM s)
SELECT message_id, CASE WHEN rebuild THEN made WHEN e % 6 = 0 THEN NULL ELSE xcons END AS consumer FROM c
""")
def _(i):
    return enrich.fix_consumer_id(i.payloads()).select(message_id(), ext_text("consumerId").alias("consumer"))


@check("email_external_id", ["pl_blocks"], S + """
SELECT message_id, 'registration' AS kind, CASE WHEN tp AND tmail <> '' THEN tmail ELSE 'hashed' END AS email FROM s
UNION ALL SELECT message_id, 'clt', CASE WHEN p AND tmail <> '' THEN tmail ELSE 'hashed' END FROM s
""")
def _(i):
    last = text(F.element_at("ext_ids", -1)["id"])
    shown = F.when(last.rlike("^[0-9a-f]{32}@hash.test$"), "hashed").otherwise(last)
    payloads = staging.shared_stage(i.spark)(i.payloads().drop("raw_payload"), "payloads")  # built and parsed once for both kinds
    both = [
        enrich.email_external_id(payloads, k, "@hash.test").select(message_id(), F.lit(k).alias("kind"), shown.alias("email"))
        for k in ("registration", "clt")
    ]
    return both[0].unionByName(both[1])


@check("mpn_external_id", ["pl_blocks"], S + """
SELECT message_id, CASE WHEN tp AND tmpn IS NOT NULL THEN tmpn ELSE xmpn END AS mpn, CAST((tp AND tmpn IS NOT NULL) OR xmpn IS NOT NULL AS INT) AS n,
  CASE WHEN tp AND tmpn IS NOT NULL THEN NOT tmpn_num WHEN xmpn IS NULL THEN FALSE ELSE NOT xmpn_num END AS as_text FROM s
""")
def _(i):
    return enrich.mpn_external_id(i.payloads()).select(message_id(), ext_text(MPN).alias("mpn"), ext_count(MPN).alias("n"), is_text(ext_id(MPN)).alias("as_text"))


@check("last_activity_date", ["pl_blocks"], S + """
SELECT message_id, CASE WHEN NOT is_identify THEN NULL WHEN t AND lad IS NOT NULL THEN lad ELSE ots END AS last_activity,
  t AND (lad IS NOT NULL OR ots IS NULL) AS has_score FROM s
""")
def _(i):
    out = enrich.last_activity_date(i.payloads())
    return out.select(message_id(), tr("lastActivityDate").alias("last_activity"), has_key(F.col("traits"), "skin_score").alias("has_score"))


@check("flatten_dependents", ["pl_blocks"], S + """
SELECT message_id, CASE WHEN t AND has_deps THEN 'k' || us END AS name1, CASE WHEN t AND has_deps THEN CAST(e % 9 AS STRING) END AS age1,
  CASE WHEN t AND has_deps THEN 'cat' END AS pet1, CASE WHEN t AND has_deps THEN 'dog' END AS pet2, CASE WHEN t AND has_deps THEN 'j' END AS name2,
  CASE WHEN t AND has_deps THEN 6 WHEN is_identify AND traits_state <> 'null' THEN 0 ELSE -1 END AS n FROM s
""")
def _(i):
    out = enrich.flatten_dependents(i.payloads())
    n = F.coalesce(F.size(F.map_filter("traits", lambda k, _: k.startswith("dependent"))), F.lit(-1))
    return out.select(
        message_id(), tr("dependent1Name").alias("name1"), tr("dependent1Age").alias("age1"), tr("dependent1Pets1Kind").alias("pet1"),
        tr("dependent1Pets2Kind").alias("pet2"), tr("dependent2Name").alias("name2"), n.alias("n"),
    )


@check("split_channels", ["pl_blocks"], S + """,
k AS (SELECT *, coalesce(tmail <> '', FALSE) AS mail,
   CAST(tmpn IS NOT NULL AS INT) + CAST(tsrc IS NOT NULL AS INT) + CAST(tcons IS NOT NULL AS INT) + CAST(toff IS NOT NULL AS INT) + CAST(pcc IS NOT NULL AS INT) + 1
   + CAST(opt_id IS NOT NULL AS INT) + CAST(init_status IS NOT NULL AS INT) + CAST(opt_status IS NOT NULL AS INT) + CAST(legal_no IS NOT NULL AS INT) + CASE WHEN typed_ep THEN 2 ELSE 0 END AS common_n,
   CASE WHEN ch_email THEN 3 + CAST(enum IS NOT NULL AS INT) + CASE WHEN etyped THEN 2 ELSE 0 END ELSE 0 END AS email_n FROM s WHERE is_opt),
v AS (SELECT *, mail AND ch_email AND (etyped OR enum IS NULL) AS ve, ch_postal AS vp, ch_phone AND tphone IS NOT NULL AS vf, mail AND ch_social AS vs FROM k),
parts AS (
  SELECT e, message_id, 1 AS pos, 'email' AS channel, common_n + 1 + email_n AS n FROM v WHERE ve
  UNION ALL SELECT e, message_id, 2, 'postal', common_n + 2 + CAST(mail AS INT) FROM v WHERE vp
  UNION ALL SELECT e, message_id, 3, 'phone', common_n + 3 FROM v WHERE vf
  UNION ALL SELECT e, message_id, 4, 'social', common_n + 3 FROM v WHERE vs),
numbered AS (SELECT *, row_number() OVER (PARTITION BY e ORDER BY pos) AS rn, count(*) OVER (PARTITION BY e) AS c FROM parts)
SELECT CASE WHEN c > 1 THEN message_id || '-split' || CAST(rn AS STRING) ELSE message_id END AS message_id, n AS n_keys FROM numbered
UNION ALL SELECT message_id, common_n + 1 + CAST(tphone IS NOT NULL AS INT) + email_n + CASE WHEN ch_phone THEN 2 ELSE 0 END + CASE WHEN ch_postal THEN 2 ELSE 0 END + CASE WHEN ch_social THEN 2 ELSE 0 END
  FROM v WHERE NOT (ve OR vp OR vf OR vs)
UNION ALL SELECT message_id, CASE WHEN is_identify THEN -1 ELSE 2 + CAST(tphone IS NOT NULL AS INT) + CAST(tmpn IS NOT NULL AS INT) + CAST(tsrc IS NOT NULL AS INT)
   + CAST(tcons IS NOT NULL AS INT) + CAST(toff IS NOT NULL AS INT) + CAST(pcc IS NOT NULL AS INT) END FROM s WHERE NOT is_opt
""")
def _(i):
    return enrich.split_channels(i.payloads()).select(message_id(), F.coalesce(F.size("properties"), F.lit(-1)).alias("n_keys"))


@check("split_channels_contents", ["pl_blocks"], S + """,
v AS (SELECT *, coalesce(tmail <> '', FALSE) AS mail FROM s WHERE is_opt),
parts AS (
  SELECT e, message_id, tmpn, opt_id, typed_ep, 1 AS pos, tmail AS email, NULL AS phone, svc AS email_service, CASE WHEN etyped THEN 'E' END AS email_type, NULL AS phone_date, NULL AS postal_service, NULL AS social_choice
    FROM v WHERE mail AND ch_email AND (etyped OR enum IS NULL)
  UNION ALL SELECT e, message_id, tmpn, opt_id, typed_ep, 2, CASE WHEN mail THEN tmail END, NULL, NULL, NULL, NULL, 'S1', NULL FROM v WHERE ch_postal
  UNION ALL SELECT e, message_id, tmpn, opt_id, typed_ep, 3, NULL, tphone, NULL, NULL, iso, NULL, NULL FROM v WHERE ch_phone AND tphone IS NOT NULL
  UNION ALL SELECT e, message_id, tmpn, opt_id, typed_ep, 4, tmail, NULL, NULL, NULL, NULL, NULL, 'false' FROM v WHERE mail AND ch_social),
numbered AS (SELECT *, row_number() OVER (PARTITION BY e ORDER BY pos) AS rn, count(*) OVER (PARTITION BY e) AS c FROM parts)
SELECT CASE WHEN c > 1 THEN message_id || '-split' || CAST(rn AS STRING) ELSE message_id END AS message_id, tmpn AS program, opt_id, CASE WHEN typed_ep THEN 'E' END AS contact_type,
  email, phone, email_service, email_type, phone_date, postal_service, social_choice FROM numbered
UNION ALL SELECT message_id, tmpn, opt_id, CASE WHEN typed_ep THEN 'E' END, tmail, tphone, CASE WHEN ch_email THEN svc END, CASE WHEN ch_email AND etyped THEN 'E' END, CASE WHEN ch_phone THEN iso END,
  CASE WHEN ch_postal THEN 'S1' END, CASE WHEN ch_social THEN 'false' END FROM v WHERE e NOT IN (SELECT e FROM parts)
UNION ALL SELECT message_id, CASE WHEN p THEN tmpn END, NULL, NULL, CASE WHEN p THEN tmail END, CASE WHEN p THEN tphone END, NULL, NULL, NULL, NULL, NULL FROM s WHERE NOT is_opt
""")
def _(i):
    """What each part carries: the common values, its own channel's, and nothing of other channels."""
    return enrich.split_channels(i.payloads()).select(
        message_id(), pr("marketingProgramNumber").alias("program"), pr("optId").alias("opt_id"), pr("contactType").alias("contact_type"), pr("email").alias("email"),
        pr("phoneNumber").alias("phone"), pr("emailSubscriptionServiceName").alias("email_service"), pr("emailContactType").alias("email_type"),
        pr("phoneConsumerChoiceDate").alias("phone_date"), pr("postalSubscriptionServiceName").alias("postal_service"), pr("socialSubscriptionOptIndicator").alias("social_choice"))


@check("contact_indicator", ["pl_blocks"], S + """,
k AS (SELECT *, CAST(ch_email AS INT) + CAST(ch_phone AS INT) + CAST(ch_social AS INT) AS n FROM s)
SELECT message_id, CASE WHEN is_opt AND n = 1 THEN CASE WHEN ch_email THEN 'E' WHEN ch_phone THEN 'P' ELSE 'S' END WHEN is_opt AND typed_ep THEN 'E' END AS contact_type,
  CASE WHEN is_opt AND n = 1 THEN CASE WHEN ch_email THEN 'EP' WHEN ch_phone THEN 'PM' ELSE 'OT' END WHEN is_opt AND typed_ep THEN 'EP' END AS contact_category FROM k
""")
def _(i):
    return enrich.contact_indicator(i.payloads()).select(message_id(), pr("contactType").alias("contact_type"), pr("contactCategory").alias("contact_category"))


@check("ids_into_traits", ["pl_blocks"], S + """
SELECT message_id, CASE WHEN is_identify AND traits_state <> 'empty' THEN user_txt END AS trait_user, CASE WHEN is_identify AND traits_state <> 'empty' THEN anon_txt END AS trait_anon,
  CASE WHEN p THEN user_txt END AS prop_user, CASE WHEN p THEN anon_txt END AS prop_anon FROM s
""")
def _(i):
    return enrich.ids_into_traits(i.payloads()).select(
        message_id(), tr("userId").alias("trait_user"), tr("anonymousId").alias("trait_anon"), pr("userId").alias("prop_user"), pr("anonymousId").alias("prop_anon"))


@check("mpn_to_string", ["pl_blocks"], S + "SELECT message_id, CASE WHEN tp THEN tmpn END AS mpn, tp AND tmpn IS NOT NULL AS as_text FROM s")
def _(i):
    value = F.coalesce(F.col("traits")[MPN], F.col("properties")[MPN])
    return enrich.mpn_to_string(i.payloads()).select(message_id(), text(value).alias("mpn"), is_text(value).alias("as_text"))


@check("external_mpn_to_string", ["pl_blocks"], S + "SELECT message_id, xmpn AS mpn, xmpn IS NOT NULL AS as_text FROM s")
def _(i):
    return enrich.external_mpn_to_string(i.payloads()).select(message_id(), ext_text(MPN).alias("mpn"), is_text(ext_id(MPN)).alias("as_text"))


@check("drop_empty_traits", ["pl_blocks"], S + """
SELECT message_id, t AND tmail <> '' AND tmail IS NOT NULL AS has_email, FALSE AS has_blank, t AS has_space, t AND e % 2 = 1 AS has_std, t AS has_ratio, t AND e % 4 <> 3 AS has_pet FROM s
""")
def _(i):
    out = enrich.drop_empty_traits(i.payloads())
    flag = lambda key, name: has_key(F.col("traits"), key).alias(name)
    return out.select(
        message_id(), flag("email", "has_email"), flag("blankTrait", "has_blank"), flag("spaceTrait", "has_space"),
        flag("stdAddress", "has_std"), flag("ratio", "has_ratio"), flag("petOptIndicator", "has_pet"))


@check("drop_duplicate_aliases", ["pl_blocks"], S + "SELECT message_id, t AND e % 3 <> 0 AS has_alias, t AS has_gender FROM s")
def _(i):
    out = enrich.drop_duplicate_aliases(i.payloads(), i.crs_aliases)
    return out.select(message_id(), has_key(F.col("traits"), "sexAlias").alias("has_alias"), has_key(F.col("traits"), "gender").alias("has_gender"))


@check("legal_entity", ["pl_blocks"], S + """
SELECT message_id, CASE WHEN is_opt AND has_ids AND (coalesce(xmpn = '9999', FALSE) OR (ch_email AND svc = 'Universal')) THEN '42' WHEN is_opt THEN legal_no END AS legal FROM s
""")
def _(i):
    return enrich.legal_entity(i.payloads(), "42").select(message_id(), pr("legalEntityNumber").alias("legal"))


@check("universal_source_id", ["pl_blocks", "crs_source"], S + """,
k AS (SELECT *, coalesce(is_opt AND xmpn = '9999', FALSE) AS uni, (ch_email AND eind = 'false') OR ch_social AS said_no, (ch_email AND eind = 'true' AND NOT eind_bool) OR ch_phone AS said_yes FROM s)
SELECT message_id, CASE WHEN uni AND said_no THEN '1174' WHEN uni AND said_yes AND xsrc IS NULL THEN CAST(source_id AS STRING) ELSE xsrc END AS source
FROM k LEFT JOIN crs_source ON segment_source_id = protocol
""")
def _(i):
    segments = i.crs_source.select("segment_source_id", F.col("source_id").alias("pg_data_source_id"))
    return enrich.universal_source_id(i.payloads(), segments).select(message_id(), ext_text("sourceId").alias("source"))


@check("choice_date", ["pl_blocks"], S + """
SELECT message_id, CASE WHEN is_opt AND ch_email THEN coalesce(tst, reg) END AS email_date, CASE WHEN is_opt AND ch_postal THEN coalesce(tst, iso) END AS postal_date FROM s
""")
def _(i):
    return enrich.choice_date(i.payloads()).select(message_id(), pr("emailConsumerChoiceDate").alias("email_date"), pr("postalConsumerChoiceDate").alias("postal_date"))


@check("external_ids_to_traits", ["pl_blocks"], S + """
SELECT message_id, CASE WHEN t THEN coalesce(tmpn, xmpn) END AS mpn, CASE WHEN t THEN xcc END AS country, CASE WHEN t THEN coalesce(tsrc, xsrc) END AS source FROM s
""")
def _(i):
    return enrich.external_ids_to_traits(i.payloads()).select(message_id(), tr(MPN).alias("mpn"), tr("countryCode").alias("country"), tr("sourceId").alias("source"))


@check("id_service_payload", ["traces"], """
SELECT trace_id AS "traceId", account_id AS "accountId", '7' AS "legalEntity", strftime(received_date, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS "receivedTimestamp",
  CASE WHEN event_id % 3 = 0 THEN strftime(received_date, '%Y-%m-%dT%H:%M:%S') || '.000Z' ELSE strftime(received_date, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' END AS "requestTimestamp",
  'n' || CAST(user_id AS STRING) AS "firstName", CASE WHEN event_id % 2 = 0 THEN '2000-01-01' END AS "birthDate", 0 AS n_traits, 1 AS id_a
FROM traces
""")
def _(i):
    out = service_payloads.id_service_payload(i.traces.drop("event_id", "user_id"), "7")
    doc = lambda path: F.get_json_object("document", path)
    return out.select(
        "traceId", "accountId", "legalEntity", "receivedTimestamp", "requestTimestamp", "firstName", "birthDate",
        F.json_array_length(doc("$.rawPayload.data.traits")).alias("n_traits"), doc("$.rawPayload.data.ids.a").cast("int").alias("id_a"))


CRS = """
WITH sot AS (SELECT DISTINCT st.service_name AS s, substr(t1.traitName, 1, 5) AS pfx, t1.traitName AS ind, t2.traitName AS dt
   FROM service_traits st LEFT JOIN trait t1 ON t1.traitId = st.trait_id_opt_indicator LEFT JOIN trait t2 ON CAST(t2.traitId AS STRING) = st.trait_id_opt_date),
crs AS (SELECT m.contact_point_type_code, m.contact_point_category_code, m.cdp_marketing_program_number AS marketing_program_number, m.service_name,
   sot.ind AS trait_id_opt_indicator, sot.dt AS trait_id_opt_date, cpt.contact_point_type_name
   FROM opt_map m LEFT JOIN program_service ps ON ps.marketing_program_number = m.cdp_marketing_program_number AND ps.service_name = m.service_name
   LEFT JOIN contact_point_category cpc ON cpc.contact_point_category_code = m.contact_point_category_code
   LEFT JOIN contact_point_type cpt ON cpt.contact_point_type_code = cpc.contact_point_type_code
   LEFT JOIN sot ON ps.service_name = sot.s AND (substr(cpt.contact_point_type_name, 1, 5) = sot.pfx OR sot.pfx = 'regul'))
"""
CRS_VIEWS = ["service_traits", "trait", "opt_map", "program_service", "contact_point_category", "contact_point_type"]


def crs(i):
    return joins.crs_opt_lookup(i.opt_map, i.program_service, i.contact_point_category, i.contact_point_type, i.service_traits, i.trait)


@check("crs_opt_lookup", CRS_VIEWS, CRS + "SELECT * FROM crs")
def _(i):
    return crs(i)


MATCHED = CRS + """,
best AS (SELECT service_name, contact_point_type_name, marketing_program_number,
    min(trait_id_opt_indicator) FILTER (WHERE trait_id_opt_indicator IS NOT NULL AND trait_id_opt_indicator NOT LIKE '%Cdp%') AS ind, min(contact_point_type_code) AS ctype, min(contact_point_category_code) AS ccat
  FROM crs GROUP BY 1, 2, 3),
mc AS (SELECT c.*, best.ind AS trait_id_opt_indicator, ctype AS contact_type, ccat AS contact_category FROM consents c LEFT JOIN best USING (service_name, contact_point_type_name, marketing_program_number))
"""


@check("crs_row_match", CRS_VIEWS + ["consents"], MATCHED + "SELECT opt_id, trait_id_opt_indicator, contact_type, contact_category FROM mc")
def _(i):
    return joins.crs_row_match(i.consents, crs(i)).select("opt_id", "trait_id_opt_indicator", "contact_type", "contact_category")


def consent_documents(i):
    matched = joins.crs_row_match(joins.match_trace_ids(i.consents, i.profile_consents), crs(i))
    return service_payloads.consent_service_payload(matched, NOW)


CONSENT_SQL = MATCHED + """
SELECT trace_id, count(*) AS n_opts, arg_min(CAST(source_id AS STRING), opt_id) AS source_id, arg_min(email, opt_id) AS email, arg_min(marketing_program_number, opt_id) AS marketing_program_number,
  strftime(max(opt_date), '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS request_timestamp, count(*) AS doc_opts, CAST(min(opt_id) AS STRING) AS first_opt, arg_min_null(contact_type, opt_id) AS first_type
FROM mc WHERE trace_id IN (SELECT trace_id FROM profile_consents) GROUP BY trace_id
"""


@check("consent_service_payload", CRS_VIEWS + ["consents", "profile_consents"], CONSENT_SQL)
def _(i):
    doc = lambda path: F.get_json_object("document", path)
    return consent_documents(i).select(
        "trace_id", "n_opts", "source_id", "email", "marketing_program_number", "request_timestamp",
        F.json_array_length(doc("$.rawPayload.data.opts")).cast("bigint").alias("doc_opts"),
        doc("$.rawPayload.data.opts[0].optId").alias("first_opt"), doc("$.rawPayload.data.opts[0].contactType").alias("first_type"))


@check("alias_request_rows", ["requests"], """
SELECT user_ids AS "previousId", pg_ids AS "userId", 'alias' AS type, 'ToBeTriggered' AS status, '' AS response, 0 AS retry_count, CAST(NULL AS TIMESTAMP) AS triggered_date FROM requests
""")
def _(i):
    return identity.alias_request_rows(i.requests).withColumn("triggered_date", F.col("triggered_date").cast("timestamp_ntz"))


@check("export_shapes", ["requests"], """
SELECT 'ids' AS shape, user_ids || '_147@mail.test' AS a, pg_ids || '_147@mail.test' AS b FROM requests
UNION ALL SELECT 'emails', pg_ids || '_147@mail.test', pg_ids || '_147@mail.test' FROM requests
UNION ALL SELECT 'aliases', user_ids, pg_ids FROM requests
UNION ALL SELECT 'user_emails', pg_ids, pg_ids || '_147@mail.test' FROM requests
""")
def _(i):
    out = None
    for name, df in identity.export_shapes(i.requests, "147", "mail.test").items():
        part = df.toDF(*["a", "b", "c"][: len(df.columns)]).select(F.lit(name).alias("shape"), "a", "b")
        out = part if out is None else out.unionByName(part)
    return out


@check("person_key", ["pl_blocks"], S + """
SELECT message_id, coalesce(CASE WHEN trim(tcons) <> '' THEN tcons END, CASE WHEN trim(toff) <> '' THEN toff END, sha256(coalesce(tmail, tphone))) || '_' || tsrc || '_' || coalesce(tmpn, '0') AS person
FROM s WHERE p
""")
def _(i):
    flat = i.payloads().filter(F.col("properties").isNotNull()).select(
        message_id(), *[pr(k).alias(k) for k in ("consumerId", "offlineConsumerId", "email", "phoneNumber", "sourceId", MPN)])
    return enrich.person_key(flat, "0").select("message_id", F.col("consumerid_sourceid_mpn").alias("person"))
