"""Whole jobs."""

import datetime as dt

from pyspark.sql import functions as F

from checks.q_enrich import S, LOOKUPS, CONSENT_SQL, CRS_VIEWS, consent_documents, lookups
from checks.q_joins import (
    COMPARED, COMPARED_VIEWS, LATEST_ALIAS, OUT, RESCI, RESOLVED, RESOLVED_VIEWS, SUGGEST_VIEWS, retained,
    target_traits, trait_catalogue,
)
from checks.q_routes import CATALOGUE, INVALID, SIGNATURE
from checks.q_tables import IDMAP, PROGRAMS, RATE
from checks.registry import AS_OF, NOW, NOW_SQL, check, message_id
from passerine.functions.values import ext_text, root_text, text
from passerine.operators import identity, joins, route, service_payloads, windows
from passerine.operators.route import MPN
from passerine.payload import parse_payloads
from passerine.plans import audience, compression, migration, profiles, reports, staging

MPNS = [str(100 + n) for n in range(11)]
MPN_LIST = ", ".join(f"'{m}'" for m in MPNS)


@check("retention_out_users", ["identifies"], OUT + "SELECT user_id FROM ret")
def _(i):
    return retained(i)


@check("retention_job", ["pl_scalars", "identifies", "crs_program"], OUT + "," + INVALID.lstrip()[5:] + """
SELECT message_id, CASE WHEN coalesce(NOT xmpn_num AND xmpn IN (SELECT m FROM inv), FALSE) OR coalesce(NOT tmpn_num AND tmpn IN (SELECT m FROM inv) AND (NOT is_identify OR traits_state = 'object'), FALSE) THEN 'invalid'
  WHEN coalesce(user_txt, anon_txt) IN (SELECT user_id FROM ret) THEN 'blocked' ELSE 'kept' END AS branch FROM pl_scalars
""")
def _(i):
    invalid = joins.not_in_antijoin(i.identifies, "marketing_program_number", i.known_mpns())
    return migration.retention_flagged(i.payloads(), invalid, retained(i)).select(message_id(), "branch")


PARTIAL = "SELECT user_id FROM identifies WHERE (email = ' ' OR phone_number = ' ') AND (address_line1 IS NULL OR address_line1 <> ' ')"


@check("splitter_job", ["pl_scalars", "event_ref", "identifies", "crs_program"], CATALOGUE + """,
""" + LOOKUPS + f""",
rt AS (SELECT p.*, coalesce(cat.route, 'unmatched') AS route FROM pl_scalars p LEFT JOIN cat ON cat.event_name = CASE WHEN p.event_name IS NOT NULL THEN lower(p.event_name) ELSE typ END),
dd AS (SELECT *, CASE WHEN e % 19 IN (0, 1, 2, 5) THEN NULL ELSE CAST(substr(ots, 1, 10) AS DATE) END AS day,
  CASE WHEN route = 'registration' AND is_opt AND coalesce(user_txt, anon_txt) IN ({PARTIAL}) THEN 'blocked' ELSE route END AS branch,
  NOT is_identify OR traits_state = 'object' AS tp FROM rt),
kept AS (SELECT * FROM dd WHERE CASE WHEN branch = 'clickstream' AND anon_txt IS NULL THEN day > DATE '2024-01-31' - INTERVAL 1095 DAY WHEN branch = 'clickstream' THEN day > DATE '2024-01-31' - INTERVAL 180 DAY
   WHEN branch = 'clt' THEN anon_txt IS NULL AND day > DATE '2024-01-31' - INTERVAL 1095 DAY ELSE TRUE END)
SELECT message_id, branch, CASE WHEN branch IN ('blocked', 'unmatched') THEN CASE WHEN NOT xmail_absent THEN xmail END WHEN trim(xmail) <> '' THEN xmail WHEN tp AND trim(tmail) <> '' THEN tmail ELSE l_email END AS email
FROM kept LEFT JOIN lk ON lk.user_id = coalesce(user_txt, anon_txt)
""")
def _(i):
    catalogue = route.event_catalogue(i.event_ref)
    out = migration.splitter_job(i.payloads(), catalogue, route.partial_retention(i.identifies), lookups(i), AS_OF, "ZZ", staging.shared_stage(i.spark, ["route"]))
    return windows.union_all(*[df.select(message_id(), F.lit(n).alias("branch"), ext_text("email").alias("email")) for n, df in out.items()])


# Split registration records with the fields the rules look at.
REG = S + """,
k AS (SELECT *, coalesce(tmail <> '', FALSE) AS mail FROM s WHERE is_opt OR is_identify),
v AS (SELECT *, is_opt AND mail AND ch_email AND (etyped OR enum IS NULL) AS ve, is_opt AND ch_postal AS vp, is_opt AND ch_phone AND tphone IS NOT NULL AS vf, is_opt AND mail AND ch_social AS vs FROM k),
p0 AS (
  SELECT *, 1 AS pos, svc AS sv, enum AS nu, TRUE AS has_mail_key, FALSE AS has_phone_key, FALSE AS postal_key FROM v WHERE ve
  UNION ALL SELECT *, 2, 'S1', NULL, mail, FALSE, TRUE FROM v WHERE vp
  UNION ALL SELECT *, 3, NULL, NULL, FALSE, TRUE, FALSE FROM v WHERE vf
  UNION ALL SELECT *, 4, NULL, NULL, TRUE, FALSE, FALSE FROM v WHERE vs
  UNION ALL SELECT *, 0, CASE WHEN is_opt THEN CASE WHEN ch_email THEN svc WHEN ch_postal THEN 'S1' END END, CASE WHEN is_opt AND ch_email THEN enum END, tmail IS NOT NULL, tphone IS NOT NULL, is_opt AND ch_postal FROM v WHERE NOT (ve OR vp OR vf OR vs)),
rec AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY e) > 1 THEN message_id || '-split' || CAST(row_number() OVER (PARTITION BY e ORDER BY pos) AS STRING) ELSE message_id END AS mid FROM p0),
-- a postal record without any e-mail or phone is excluded
px AS (SELECT *, is_opt AND postal_key AND NOT has_mail_key AND NOT has_phone_key AS excluded FROM rec),
ok AS (SELECT *, coalesce(xmpn = '9999', FALSE) AS uni FROM px WHERE NOT excluded),
sf AS (SELECT mid, count(*) AS n FROM (
   SELECT mid FROM ok WHERE NOT uni AND e % 29 IN (1, 2, 3)
   UNION ALL SELECT mid FROM ok WHERE NOT uni AND xmpn IS NULL
   UNION ALL SELECT mid FROM ok WHERE NOT uni AND (xsrc IS NULL OR xsrc IN ('', 'S-x'))
   UNION ALL SELECT mid FROM ok WHERE NOT uni AND xcons = ''
   UNION ALL SELECT mid FROM ok WHERE NOT uni AND xcons IS NULL AND NOT (tp AND toff IS NOT NULL)
   UNION ALL SELECT mid FROM ok WHERE NOT uni AND xloy = 'bad#1'
   UNION ALL SELECT mid FROM ok WHERE NOT uni AND is_opt AND opt_id = 'bad'
   UNION ALL SELECT mid FROM ok WHERE NOT uni AND is_opt AND init_status = 'maybe'
   UNION ALL SELECT mid FROM ok WHERE NOT uni AND is_opt AND opt_status = 'no') GROUP BY mid),
m AS (SELECT DISTINCT * FROM opt_map),
hit AS (SELECT ok.mid, max(CAST(coalesce(ok.opt_id = m.ciam_opt_id, FALSE) AS INT) + CAST(coalesce(sv = m.service_name, FALSE) AS INT) + CAST(coalesce(nu = m.subscription_opt_number, FALSE) AS INT)) AS hits,
   max(CAST(ok.opt_id IS NOT NULL AS INT) + CAST(sv IS NOT NULL AS INT) + CAST(nu IS NOT NULL AS INT)) AS given
   FROM ok JOIN m ON m.cdp_marketing_program_number = tmpn WHERE is_opt AND (ok.opt_id IS NOT NULL OR sv IS NOT NULL OR nu IS NOT NULL) GROUP BY ok.mid),
rf AS (SELECT mid, 'VLD7' AS id FROM hit WHERE hits < given
   UNION ALL SELECT mid, 'VLD8' FROM ok WHERE has_ids AND (xcons IS NULL OR e % 6 = 0) AND e % 29 > 3
   UNION ALL SELECT mid, 'VLD9' FROM ok WHERE NOT uni AND (coalesce(xsrc <> '', FALSE) OR xmpn IS NOT NULL) AND NOT EXISTS (SELECT 1 FROM crs_source q WHERE CAST(q.source_id AS STRING) = xsrc AND q.mpn = xmpn)
   UNION ALL SELECT mid, 'VLD10' FROM ok WHERE ots IS NULL OR tst IS NULL OR tst = ''),
rn AS (SELECT mid, count(*) AS n, min(id) AS one FROM rf WHERE mid NOT IN (SELECT mid FROM sf) GROUP BY mid),
bad AS (SELECT mid, n FROM sf UNION ALL SELECT mid, n FROM rn WHERE n > 1 OR one <> 'VLD8')
"""


def registration_routes(i):
    """Registration records and the others, parsed once."""
    ours = F.coalesce(root_text("event") == "Changed Opt Status", F.lit(False)) | (root_text("type") == "identify")
    return migration.by_branch(i.payloads(), F.when(ours, "registration").otherwise("other"), ["registration", "other"], staging.shared_stage(i.spark, ["branch"]))


def registration_refs(i):
    segments = i.crs_source.select("segment_source_id", F.col("source_id").alias("pg_data_source_id"))
    return {"aliases": i.crs_aliases, "segment_sources": segments, "opt_map": i.opt_map, "source_map": i.crs_source.select("source_id", "mpn")}


@check("external_id_job", ["pl_blocks", "opt_map", "crs_source"], REG + """
SELECT mid AS message_id, 'passed' AS branch, CAST(1 AS BIGINT) AS n FROM ok WHERE mid NOT IN (SELECT mid FROM bad)
UNION ALL SELECT mid, 'failures', n FROM bad UNION ALL SELECT mid, 'postal_excluded', 1 FROM px WHERE excluded
UNION ALL SELECT message_id, 'other', 1 FROM s WHERE NOT (is_opt OR is_identify)
""")
def _(i):
    routes, refs = registration_routes(i), registration_refs(i)
    out = migration.external_id_job(routes, refs, "42", AS_OF, NOW, stage=staging.shared_stage(i.spark, ["branch"]))
    whole = [out[name].select(message_id(), F.lit(name).alias("branch"), F.lit(1).cast("bigint").alias("n")) for name in ("passed", "postal_excluded", "other")]
    failed = out["failures"].groupBy("message_id").agg(F.count(F.lit(1)).alias("n"))
    return windows.union_all(*whole, failed.select("message_id", F.lit("failures").alias("branch"), "n"))


def dated_routes(i, raw):
    """Three routes of payloads that are parsed once."""
    names = ["clickstream", "clt", "other"]
    parsed = parse_payloads(raw.select("raw_payload", F.element_at(F.array(*map(F.lit, names)), (F.col("e") % 3 + 1).cast("int")).alias("name")))
    routes = migration.by_branch(parsed, F.col("name"), names, staging.shared_stage(i.spark, ["branch"]))
    return {name: df.drop("name") for name, df in routes.items()}


@check("filter_date_job", ["pl_blocks"], S + """,
d AS (SELECT *, CASE WHEN e % 19 IN (0, 1, 2, 5) THEN NULL ELSE CAST(substr(ots, 1, 10) AS DATE) END AS day FROM s WHERE p)
SELECT message_id, 'clickstream' AS branch, coalesce(tmpn, xmpn) AS mpn FROM d WHERE e % 3 = 0 AND CASE WHEN anon_txt IS NULL THEN day > DATE '2024-01-31' - INTERVAL 1095 DAY ELSE day > DATE '2024-01-31' - INTERVAL 180 DAY END
UNION ALL SELECT message_id, 'clt', coalesce(tmpn, xmpn) FROM d WHERE e % 3 = 1 AND anon_txt IS NULL AND day > DATE '2024-01-31' - INTERVAL 1095 DAY
UNION ALL SELECT message_id, 'other', xmpn FROM d WHERE e % 3 = 2
""")
def _(i):
    out = migration.filter_date_job(dated_routes(i, i.pl.filter("NOT is_identify")), AS_OF, "@hash.test")
    return windows.union_all(*[df.select(message_id(), F.lit(n).alias("branch"), ext_text(MPN).alias("mpn")) for n, df in out.items()])


@check("filter_date_job_all", ["pl_blocks"], S + """,
d AS (SELECT *, CASE WHEN e % 19 IN (0, 1, 2, 5) THEN NULL ELSE CAST(substr(ots, 1, 10) AS DATE) END AS day, coalesce(CASE WHEN tp THEN tmpn END, xmpn) AS mpn,
  CASE e % 4 WHEN 1 THEN reg || 'T00:00:00.000Z' WHEN 2 THEN substr(reg, 1, 10) || 'T' || substr(reg, 12, 8) || '.000Z' ELSE reg END AS reg_n FROM s),
n AS (SELECT *, CASE WHEN t THEN reg_n WHEN is_opt AND ch_email THEN CASE WHEN tst IS NULL THEN reg ELSE reg_n END END AS email_date FROM d)
SELECT message_id, 'clickstream' AS branch, mpn, email_date FROM n WHERE e % 3 = 0 AND CASE WHEN anon_txt IS NULL THEN day > DATE '2024-01-31' - INTERVAL 1095 DAY ELSE day > DATE '2024-01-31' - INTERVAL 180 DAY END
UNION ALL SELECT message_id, 'clt', mpn, email_date FROM n WHERE e % 3 = 1 AND anon_txt IS NULL AND day > DATE '2024-01-31' - INTERVAL 1095 DAY
UNION ALL SELECT message_id, 'other', xmpn, email_date FROM n WHERE e % 3 = 2
""")
def _(i):
    """The job over all payloads, identify records too."""
    out = migration.filter_date_job(dated_routes(i, i.pl), AS_OF, "@hash.test")
    date = F.coalesce(text(F.col("traits")["emailConsumerChoiceDate"]), text(F.col("properties")["emailConsumerChoiceDate"])).alias("email_date")
    return windows.union_all(*[df.select(message_id(), F.lit(n).alias("branch"), ext_text(MPN).alias("mpn"), date) for n, df in out.items()])


@check("external_id_job_delta", ["pl_blocks", "opt_map", "crs_source"], REG + """
SELECT mid AS message_id, 'passed' AS branch, CAST(1 AS BIGINT) AS n FROM ok WHERE mid NOT IN (SELECT mid FROM bad)
UNION ALL SELECT mid, 'failures', n FROM bad UNION ALL SELECT mid, 'postal_excluded', 1 FROM px WHERE excluded
UNION ALL SELECT arg_max(message_id, row(coalesce(CASE WHEN tst IS NOT NULL THEN tst END, ''), message_id)), 'other', 1 FROM s WHERE NOT (is_opt OR is_identify) AND user_txt IS NOT NULL AND event_name IS NOT NULL GROUP BY user_txt, event_name
""")
def _(i):
    """The delta load: of the other records, the latest for each user and event."""
    out = migration.external_id_job(registration_routes(i), registration_refs(i), "42", AS_OF, NOW, delta=True, stage=staging.shared_stage(i.spark, ["branch"]))
    one = lambda df, name, key: df.select(key.alias("message_id"), F.lit(name).alias("branch"), F.lit(1).cast("bigint").alias("n"))
    failed = out["failures"].groupBy("message_id").agg(F.count(F.lit(1)).alias("n"))
    return windows.union_all(
        one(out["passed"], "passed", root_text("messageId")), one(out["postal_excluded"], "postal_excluded", root_text("messageId")),
        one(out["other"], "other", F.get_json_object("raw_payload", "$.messageId")), failed.select("message_id", F.lit("failures").alias("branch"), "n"),
    )


# ---- compression -------------------------------------------------------------------------

IDENT = S + f""",
im AS (SELECT user_txt AS uid, message_id AS tid, ots AS lad2, coalesce(CASE WHEN t THEN tmpn END, xmpn) AS mpn, coalesce(CASE WHEN t THEN tcons END, xcons) AS cons, coalesce(CASE WHEN t THEN tsrc END, xsrc) AS src,
   CASE WHEN t THEN toff END AS off, coalesce(CASE WHEN t THEN tmail END, xmail) AS mail, coalesce(CASE WHEN t THEN tphone END, xphone) AS phone, CASE WHEN t THEN reg END AS rd, t, s.tmail, s.tphone, s.reg FROM s WHERE is_identify),
im2 AS (SELECT *, coalesce(CASE WHEN trim(cons) <> '' THEN trim(cons) END, CASE WHEN trim(off) <> '' THEN trim(off) END, sha256(coalesce(mail, phone))) || '_' || src || '_' || mpn AS person FROM im WHERE mpn IN ({MPN_LIST})),
ids AS (SELECT DISTINCT uid, TRY_CAST(mpn AS BIGINT) AS mpn, cons, TRY_CAST(src AS BIGINT) AS src, off, mail, phone, rd, person FROM im2
   WHERE mpn IS NOT NULL AND src IS NOT NULL AND (coalesce(cons, off) IS NOT NULL OR (coalesce(mail, phone) IS NOT NULL AND rd IS NOT NULL)))
"""


@check("compress_ids", ["pl_blocks"], IDENT + """
SELECT uid AS "userId", mpn AS "marketingProgramNumber", cons AS "consumerId", src AS "sourceId", off AS "offlineConsumerId", mail AS email, phone AS "phoneNumber", rd AS "registrationDate", person AS consumerid_sourceid_mpn FROM ids
""")
def _(i):
    return compression.compress_ids(compression.identity_rows(i.payloads(), MPNS, "100"))


TRAITS = """,
lv AS (SELECT uid, tid, lad2, mpn, src, person, unnest(['email', 'phoneNumber', 'gender', 'ratio', 'registrationDate', 'spaceTrait']) AS key, unnest([tmail, tphone, 'F', '1.5', reg, ' ']) AS val FROM im2 WHERE t),
tt AS (SELECT DISTINCT coalesce(lv.person, ids.person) AS person, coalesce(c.traitId, ta.trait_id) AS trait_id, lv.val, lv.lad2 AS d, lv.tid FROM lv LEFT JOIN ids ON ids.uid = lv.uid
   LEFT JOIN eco_system_trait c ON c.ecoTraitName = lv.key AND c.ecoSystemId IN (1, 4, 10) LEFT JOIN trait_alias ta ON ta.alias = lv.key
   JOIN trait tr ON tr.traitId = coalesce(c.traitId, ta.trait_id) JOIN (SELECT DISTINCT mpn, source_id FROM crs_source) pm ON CAST(pm.mpn AS BIGINT) = coalesce(TRY_CAST(lv.mpn AS BIGINT), ids.mpn, 100) AND pm.source_id = coalesce(TRY_CAST(lv.src AS BIGINT), ids.src)
   WHERE coalesce(lv.person, ids.person) IS NOT NULL AND trim(coalesce(val, '')) <> ''),
tw AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY person, trait_id, val ORDER BY d DESC NULLS LAST) AS rk FROM tt) WHERE rk = 1)
"""
TRAIT_VIEWS = ["pl_blocks", "eco_system_trait", "trait_alias", "trait", "crs_source"]


def trait_winners(i, payloads, stage=staging.inline):
    identities = stage(compression.identity_rows(payloads, MPNS, "100"), "identities")
    ids = compression.compress_ids(identities)
    return compression.compress_traits(identities, ids, i.eco_system_trait, i.trait_alias, i.trait, i.crs_source, "100")


@check("trait_resolution", TRAIT_VIEWS, IDENT + TRAITS + """
SELECT person AS consumerid_sourceid_mpn, trait_id AS "traitId", val AS trait_value, d AS trait_consumer_last_updated_date, tid AS trace_id FROM tt
""")
def _(i):
    identities = staging.shared_stage(i.spark)(compression.identity_rows(i.payloads(), MPNS, "100"), "identities")
    ids = compression.compress_ids(identities)
    return joins.trait_resolution(
        compression.trait_leaves(identities), ids, i.eco_system_trait, i.trait_alias, i.trait, i.crs_source, "100")


@check("winner_join", ["pl_scalars", "replay_table", "profile_consents"], """
SELECT message_id FROM pl_scalars WHERE message_id IN (SELECT message_id FROM replay_table) OR message_id IN (SELECT 'm' || substr(trace_id, 2) FROM profile_consents)
""")
def _(i):
    raw = i.payloads().select("raw_payload", message_id())
    carriers = i.profile_consents.select(F.concat(F.lit("m"), F.col("trace_id").substr(2, 20)).alias("trace_id"))
    return joins.winner_join(raw, i.replay_table.select(F.col("message_id").alias("trace_id")), carriers).select("message_id")


@check("compress_traits", TRAIT_VIEWS, IDENT + TRAITS + """
SELECT person AS consumerid_sourceid_mpn, trait_id AS "traitId", val AS trait_value, d AS trait_consumer_last_updated_date, tid AS trace_id FROM tw
""")
def _(i):
    return trait_winners(i, i.payloads(), staging.shared_stage(i.spark))


CONSENTS = """,
cg AS (SELECT user_txt, ots, anon_txt, tcons, toff, pcc, tmail, init_status, legal_no, tmpn, opt_id, tphone, tsrc, ch_email, ch_phone, ch_postal, ch_social, svc, eind, enum, reg, iso,
    max(message_id) AS tid, max(xmpn) AS xmpn, max(xcons) AS xcons, max(xsrc) AS xsrc, max(xmail) AS xmail, max(xphone) AS xphone
  FROM (SELECT * REPLACE (CASE WHEN ch_email THEN svc END AS svc, CASE WHEN ch_email THEN eind END AS eind, CASE WHEN ch_email THEN enum END AS enum, CASE WHEN ch_email THEN reg END AS reg,
        CASE WHEN ch_phone OR ch_postal OR ch_social THEN iso END AS iso) FROM s WHERE is_opt AND (ch_email OR ch_postal)) GROUP BY ALL),
co AS (SELECT DISTINCT user_txt, CASE WHEN ots LIKE '%+02:00' THEN TRY_CAST(substr(ots, 1, 19) AS TIMESTAMP) - INTERVAL 2 HOUR ELSE TRY_CAST(ots AS TIMESTAMP) END AS created_date, tid, CASE WHEN coalesce(reg, iso, ots) LIKE '%+02:00' THEN TRY_CAST(substr(ots, 1, 19) AS TIMESTAMP) - INTERVAL 2 HOUR ELSE TRY_CAST(coalesce(reg, iso, ots) AS TIMESTAMP) END AS opt_date,
  coalesce(eind, CASE WHEN ch_phone THEN 'true' END, CASE WHEN ch_social THEN 'false' END) AS opt_status, TRY_CAST(enum AS BIGINT) AS opt_number, CASE WHEN ch_email THEN svc ELSE 'S1' END AS service_name,
  coalesce(init_status, 'false') AS initial, coalesce(TRY_CAST(legal_no AS BIGINT), 9) AS legal, TRY_CAST(coalesce(tmpn, xmpn) AS BIGINT) AS mpn, coalesce(tcons, xcons) AS cons,
  coalesce(TRY_CAST(coalesce(tsrc, xsrc) AS BIGINT), 0) AS src, coalesce(tmail, xmail) AS mail, coalesce(tphone, xphone) AS phone, CASE WHEN ch_email THEN 'E' ELSE 'A' END AS channel, coalesce(pcc, 'ZZ') AS cc, opt_id FROM cg),
cw AS (SELECT tid FROM (SELECT tid, rank() OVER (PARTITION BY user_txt, opt_date, opt_status, service_name, channel ORDER BY created_date DESC NULLS LAST, tid DESC NULLS LAST) AS rk FROM co) WHERE rk = 1)
"""


def consent_rows(i, payloads=None):
    return compression.compress_consents(payloads or i.payloads(), i.contact_point_type, "ZZ", 9)


@check("compress_consents", ["pl_blocks"], S + CONSENTS + """
SELECT tid AS trace_id, user_txt AS "userId", created_date, opt_date, opt_status, opt_number, service_name, initial AS initial_opt_status, legal AS legal_entity_id, mpn AS marketing_program_number, cons AS consumer_id, src AS source_id,
  mail AS email, phone AS phone_number, channel, CASE channel WHEN 'E' THEN 'email' ELSE 'postal' END AS contact_point_type_name, cc AS country_code, opt_id, channel AS "ContactType" FROM co
""")
def _(i):
    return consent_rows(i).select(
        "trace_id", "userId", "created_date", "opt_date", "opt_status", "opt_number", "service_name", "initial_opt_status", "legal_entity_id",
        "marketing_program_number", "consumer_id", "source_id", "email", "phone_number", "channel", "contact_point_type_name", "country_code", "opt_id", "ContactType")


@check("compress_final", TRAIT_VIEWS, IDENT + TRAITS + CONSENTS + """
SELECT message_id FROM s WHERE message_id IN (SELECT tid FROM tw UNION SELECT tid FROM cw)
""")
def _(i):
    payloads = staging.shared_stage(i.spark)(i.payloads(), "payloads")
    raw = payloads.select("raw_payload", message_id())
    return compression.compress_final(raw, trait_winners(i, payloads), consent_rows(i, payloads)).select("message_id")


# ---- reports --------------------------------------------------------------------------------


@check("trait_comparison", COMPARED_VIEWS, COMPARED + RATE)
def _(i):
    source = i.canonical_ctas.select("user_id", "pet_kind", "kids_count", "car_colour", "email", "source_id")
    out = reports.trait_comparison(source, i.id_graphs, target_traits(i), "user_id", ["source_id"])
    return out["rates"].withColumn("un_match_percent", F.round("un_match_percent", 6))


TRAIT_COLUMNS = ["ck_text", "email", "trait_pet_kind", "car_colour", "source_id", "consumer_id", "address_line2"]


@check("report_traits", SUGGEST_VIEWS + ["identifies", "trait_alias"], """
WITH idf AS (SELECT user_id, 'x' AS ck_text, email, trait_pet_kind, car_colour, source_id, consumer_id, address_line2, marketing_program_number, original_timestamp FROM identifies),
cols AS (SELECT unnest(['ck_text', 'email', 'trait_pet_kind', 'car_colour', 'source_id', 'consumer_id', 'address_line2', 'marketing_program_number']) AS column_name),
tm AS (SELECT DISTINCT CAST(m.marketingProgramId AS STRING) AS mpn, m.traitId, t.traitName, s.ecoTraitName FROM trait_map m JOIN eco_system_trait s ON s.traitId = m.traitId AND s.ecoSystemId = m.ecoSystemId JOIN trait t ON t.traitId = m.traitId),
grid AS (SELECT DISTINCT marketing_program_number AS mpn, column_name FROM idf, cols WHERE trim(marketing_program_number) <> ''),
sug AS (SELECT grid.mpn, grid.column_name, y.traitId IS NOT NULL AS trait_match, coalesce(x.ecoTraitName, y.ecoTraitName) AS eco, coalesce(x.traitName, y.traitName) AS nm, coalesce(x.traitId, y.traitId) AS tid,
   string_agg(DISTINCT z.traitName, ' | ' ORDER BY z.traitName) AS s1, string_agg(DISTINCT CAST(z.traitId AS STRING), ' | ' ORDER BY CAST(z.traitId AS STRING)) AS s2, string_agg(DISTINCT z.ecoTraitName, ' | ' ORDER BY z.ecoTraitName) AS s3
  FROM grid LEFT JOIN tm x ON x.mpn = grid.mpn AND lower(x.ecoTraitName) = lower(column_name) LEFT JOIN tm y ON y.mpn = grid.mpn AND replace(lower(y.ecoTraitName), '_', '') = replace(lower(column_name), '_', '')
  LEFT JOIN tm z ON z.mpn = grid.mpn AND contains(replace(lower(z.ecoTraitName), '_', ''), replace(lower(substr(replace(column_name, 'trait_', ''), 1, 8)), '_', ''))
  WHERE x.traitId IS NULL GROUP BY 1, 2, 3, 4, 5, 6),
vals AS (SELECT marketing_program_number AS mpn, original_timestamp AS ts, unnest(['ck_text', 'email', 'trait_pet_kind', 'car_colour', 'source_id', 'consumer_id', 'address_line2', 'marketing_program_number']) AS column_name,
   unnest([ck_text, email, trait_pet_kind, car_colour, source_id, consumer_id, address_line2, marketing_program_number]) AS v FROM idf),
cnt AS (SELECT mpn, column_name, count(v) AS overall, count(*) FILTER (WHERE trim(v) <> '') AS filled, max(CAST(ts AS DATE)) FILTER (WHERE trim(v) <> '') AS latest FROM vals GROUP BY 1, 2)
SELECT sug.mpn, sug.column_name, trait_match, sug.column_name IN ('source_id', 'consumer_id', 'marketing_program_number') AS mandatory_field, eco AS "ecoTraitName", nm AS "traitName", tid AS "traitId",
  CASE WHEN NOT trait_match THEN s1 END AS "suggested_traitName", CASE WHEN NOT trait_match THEN s2 END AS "suggested_traitId", CASE WHEN NOT trait_match THEN s3 END AS "suggested_ecoTraitName",
  overall AS overall_counts, filled AS non_blank_counts, latest FROM sug JOIN cnt ON cnt.mpn = sug.mpn AND cnt.column_name = sug.column_name
WHERE overall > 0 AND sug.column_name NOT IN (SELECT alias FROM trait_alias)
""")
def _(i):
    table = i.identifies.withColumn("ck_text", F.lit("x")).select("user_id", *TRAIT_COLUMNS, "marketing_program_number", "original_timestamp")
    return reports.report_traits(table, trait_catalogue(i), i.trait_alias, "original_timestamp")


@check("report_event_properties", ["identifies"], """
WITH known AS (SELECT unnest(['email', 'Phone Number', 'addressline']) AS n), cols AS (
  SELECT 'signup' AS event, unnest(['email', 'phone_number', 'trait_pet_kind', 'car_colour']) AS column_name, unnest([count(email), count(phone_number), count(trait_pet_kind), count(car_colour)]) AS count, max(received_at) AS latest_event FROM identifies
  UNION ALL SELECT 'order', unnest(['o_orderkey', 'o_orderstatus']), unnest([count(o_orderkey), count(o_orderstatus)]), max(o_orderdate) FROM orders)
SELECT event, column_name, count, latest_event FROM cols WHERE count > 0 AND lower(trim(regexp_replace(column_name, '[^a-zA-Z ]', '', 'g'))) NOT IN ('email', 'phonenumber', 'addressline')
  AND NOT (event = 'order' AND column_name = 'o_orderkey') AND NOT (event = 'order' AND column_name = 'email')
""".replace("'phonenumber', ", "'phone number', "))
def _(i):
    catalogue = i.spark.createDataFrame(
        [("signup", "email", None), ("signup", "Phone Number", "addressline"), ("order", "email", "oorderkey")], "eventName string, propertyName string, propertyNameAlias string")
    tables = {
        "signup": i.identifies.select("email", "phone_number", "trait_pet_kind", "car_colour", "received_at"),
        "order": i.orders.select("o_orderkey", "o_orderstatus", F.col("o_orderdate").alias("received_at")),
    }
    return reports.report_event_properties(tables, catalogue, "received_at")


@check("report_events", ["event_ref"], """
WITH t AS (SELECT CASE WHEN event_id % 50 = 0 THEN 'Odd-Event' WHEN event_id % 50 = 1 THEN 'Page_View' ELSE event_type END AS event, ts FROM events)
SELECT event, min(ts) AS first_at, max(ts) AS last_at, count(*) AS counts FROM t WHERE event = 'Odd-Event' GROUP BY event
""")
def _(i):
    name = F.when(F.col("event_id") % 50 == 0, "Odd-Event").when(F.col("event_id") % 50 == 1, "Page_View").otherwise(F.col("event_type"))
    return reports.report_events(i.events.select(name.alias("event"), "ts"), i.event_ref, "event", "ts")


@check("report_mpn", ["identifies", "crs_program"], INVALID + "SELECT m AS mpn, 'false' AS validation_result FROM inv")
def _(i):
    return reports.report_mpn(i.identifies, i.known_mpns())


@check("report_sources", ["identifies", "crs_program", "crs_source"], """
SELECT marketing_program_number, source_id, max(registration_date) AS registration_date, max(received_at) AS latest_event, count(*) AS counts FROM identifies
WHERE marketing_program_number IN (SELECT mpn FROM crs_program) AND source_id IN (SELECT CAST(source_id AS STRING) FROM crs_source)
  AND NOT EXISTS (SELECT 1 FROM crs_source q WHERE q.mpn = marketing_program_number AND CAST(q.source_id AS STRING) = identifies.source_id) GROUP BY 1, 2
""")
def _(i):
    return reports.report_sources(i.identifies, i.crs_program, i.crs_source, i.crs_source.select("mpn", "source_id"))


@check("report_opts", ["changed_opts", "opt_map"], SIGNATURE + """,
ds AS (SELECT opt_id, subscription_opt_number, service_name, opt_type, contact_point_type_code, min(ts) AS first_at, max(ts) AS last_at, count(*) AS counts FROM sigs GROUP BY 1, 2, 3, 4, 5),
vm AS (SELECT DISTINCT ciam_opt_id, cdp_marketing_program_number AS p, subscription_opt_number AS vn, service_name AS vs, contact_point_type_code AS vc FROM opt_map WHERE cdp_marketing_program_number IN ('101', '102', '103', '104'))
SELECT 'p1' AS persona_name, opt_id, subscription_opt_number, service_name, opt_type, contact_point_type_code, first_at, last_at, counts, CASE WHEN p IS NULL THEN 'false' ELSE 'true' END AS is_valid
FROM ds LEFT JOIN vm ON vn = coalesce(subscription_opt_number, vn) AND vs = coalesce(service_name, vs) AND vc = coalesce(contact_point_type_code, vc) AND ciam_opt_id = coalesce(opt_id, ciam_opt_id)
WHERE subscription_opt_number <> '9999' AND service_name <> 'Universal'
""")
def _(i):
    return reports.report_opts(i.changed_opts, i.opt_map, "ts", "p1", ["101", "102", "103", "104"])


@check("report_opts_strict", ["changed_opts", "opt_map"], SIGNATURE.replace("ELSE 'KEY NOT FOUND'", "ELSE 'NONE'") + """,
ds AS (SELECT subscription_opt_number, service_name, opt_type, contact_point_type_code, max(ts) AS latest_date FROM sigs GROUP BY 1, 2, 3, 4), cn AS (SELECT subscription_opt_number AS n, service_name AS s, count(*) AS counts FROM sigs GROUP BY 1, 2),
vm AS (SELECT DISTINCT subscription_opt_number AS vn, service_name AS vs, contact_point_type_code AS vc FROM opt_map WHERE cdp_marketing_program_number = '102')
SELECT 'p1' AS persona_name, subscription_opt_number, service_name, opt_type, contact_point_type_code, latest_date, counts, CASE WHEN vn IS NULL THEN 'false' ELSE 'true' END AS is_valid
FROM ds LEFT JOIN vm ON vn = subscription_opt_number AND vs = service_name AND vc = contact_point_type_code LEFT JOIN cn ON n = subscription_opt_number AND s = service_name WHERE subscription_opt_number <> '9999'
""")
def _(i):
    return reports.report_opts_strict(i.changed_opts, i.opt_map, "ts", "p1", "102")


@check("report_ecosystem_traits", ["trait_map", "eco_system_trait", "trait", "crs_program"], """
SELECT m.marketingProgramId AS "marketingProgramId", q.program_name AS "marketingProgramName", m.traitId AS "traitId", t.traitName AS "traitName", max(CASE WHEN m.ecoSystemId = 1 THEN ecoTraitName END) AS source, max(CASE WHEN m.ecoSystemId = 5 THEN ecoTraitName END) AS warehouse,
  max(CASE WHEN m.ecoSystemId = 10 THEN ecoTraitName END) AS target FROM trait_map m LEFT JOIN crs_program q ON q.mpn = CAST(m.marketingProgramId AS STRING) LEFT JOIN eco_system_trait s USING (traitId, ecoSystemId) LEFT JOIN trait t ON t.traitId = s.traitId
WHERE m.marketingProgramId IN (100, 101, 102) GROUP BY 1, 2, 3, 4
""")
def _(i):
    programs = i.crs_program.select(F.col("mpn").cast("bigint").alias("marketingProgramId"), F.col("program_name").alias("marketingProgramName"))
    names = F.when(F.col("ecoSystemId") == 1, "source").when(F.col("ecoSystemId") == 5, "wh").when(F.col("ecoSystemId") == 10, "target").otherwise("x")
    systems = i.eco_system_trait.select("ecoSystemId").distinct().withColumn("ecoSystemName", names)
    eco = i.eco_system_trait.join(i.trait, "traitId", "left")
    return reports.report_ecosystem_traits(i.trait_map, programs, systems, eco, [100, 101, 102], ["source", "warehouse", "target"], {"wh": "warehouse"})


# ---- audiences ---------------------------------------------------------------------------------

RET4 = """
rr AS (SELECT user_id, arg_max(email, row(ts, ok)) FILTER (WHERE email IS NOT NULL) AS a, arg_max(phone_number, row(ts, ok)) FILTER (WHERE phone_number IS NOT NULL) AS b,
   arg_max(address_line1, row(ts, ok)) FILTER (WHERE address_line1 IS NOT NULL) AS c, arg_max(address_line2, row(ts, ok)) FILTER (WHERE address_line2 IS NOT NULL) AS d
   FROM identifies WHERE context_personas_computation_class IS NULL GROUP BY user_id),
ret4 AS (SELECT 'w' || substr(user_id, 2) AS user_id FROM rr WHERE a = ' ' AND b = ' ' AND c = ' ' AND d = ' ')
"""
newest = lambda c: f"arg_max({c}, row(loaded_at, id)) FILTER (WHERE {c} IS NOT NULL) AS {c}"
DUMP = f"WITH {RESOLVED}, {RET4}, " + f"""
sd0 AS (SELECT coalesce(country_code, 'C0') AS country, user_id, {newest('registration_date')}, {newest('email_valid_contact_point_indicator')}, {newest('email')}, {newest('gender')}, {newest('source_id')}, {newest('opt_family')}, {newest('opt_corporate')}, {newest('trait_pet')}
  FROM cu WHERE (email_valid_contact_point_indicator IS NOT NULL OR marketing_program_number = '100') AND source_id NOT IN ('9') GROUP BY 1, 2),
sd AS (SELECT * REPLACE (lower(email) AS email) FROM sd0 WHERE user_id NOT IN (SELECT user_id FROM ret4))
"""
DUMP_VIEWS = RESOLVED_VIEWS + ["identifies"]


def retained4(i):
    out = audience.retention_out_users(i.identifies, ["ts", "ok"], ["email", "phone_number", "address_line1", "address_line2"])
    return out.select(F.concat(F.lit("w"), F.col("user_id").substr(2, 100)).alias("user_id"))


def merges(i):
    return {"email": i.merged_email, "user": i.merged_user, "unmerge": i.unmerge, "canonical": i.canon}


def segment_dump(i):
    return audience.segment_dump(i.users, merges(i), retained4(i), "100", "C0", ["opt_family", "opt_corporate"], extra=["trait_pet"], exclude_sources=["9"])


@check("segment_dump", DUMP_VIEWS, DUMP + "SELECT * FROM sd")
def _(i):
    return segment_dump(i)


@check("segment_dump_service_opts", DUMP_VIEWS + ["changed_opts"], DUMP + """,
nu AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, email_subscription_service_name ORDER BY ts DESC, ok DESC) AS rn FROM changed_opts WHERE email_subscription_service_name IS NOT NULL) WHERE rn = 1),
fl AS (SELECT coalesce(country_code, 'C0') AS country, cu.user_id, CASE WHEN email_subscription_service_name = 'S1' THEN opt_indicator WHEN lower(email_subscription_service_name) = 'universal' THEN 'false' END AS said, nu.ts, nu.ok
   FROM cu JOIN nu ON nu.user_id = cu.id WHERE (email_valid_contact_point_indicator IS NOT NULL OR marketing_program_number = '100')),
fa AS (SELECT country, user_id, arg_max(said, row(ts, ok)) FILTER (WHERE said IS NOT NULL) AS opt_news FROM fl GROUP BY 1, 2),
base AS (SELECT DISTINCT coalesce(country_code, 'C0') AS country, user_id FROM cu WHERE (email_valid_contact_point_indicator IS NOT NULL OR marketing_program_number = '100'))
SELECT country, user_id, opt_news FROM base LEFT JOIN fa USING (country, user_id) WHERE user_id NOT IN (SELECT user_id FROM ret4)
""")
def _(i):
    opts = i.changed_opts.filter("email_subscription_service_name IS NOT NULL").withColumnRenamed("email_subscription_service_name", "service_name")
    out = audience.segment_dump(
        i.users, merges(i), retained4(i), "100", "C0", ["opt_news"], opts=opts, service_flags={"opt_news": "S1"}, opt_order=["ts", "ok"])
    return out.select("country", "user_id", "opt_news")


SEG_COUNTS = """,
op AS (SELECT count(DISTINCT coalesce(c.canonical_user_id, o.user_id)) AS n FROM changed_opts o LEFT JOIN canon c ON c.previous_user_id = o.user_id WHERE CAST(o.ts AS DATE) > DATE '2000-01-31' AND CAST(o.ts AS DATE) <= DATE '2000-07-31'),
f AS (SELECT *, country IN ('C0') AS here, email IS NOT NULL AND email <> ' ' AS mail, coalesce(lower(opt_family) = 'true', FALSE) OR (coalesce(lower(opt_corporate) = 'true', FALSE) AND opt_family IS NULL) AS optin FROM sd),
seg AS (SELECT 'Email Contactable' AS audience_name, count(DISTINCT user_id) FILTER (WHERE here AND mail AND (email_valid_contact_point_indicator IS NULL OR email_valid_contact_point_indicator <> 'N') AND optin) AS count FROM f
 UNION ALL SELECT 'Email Optins', count(DISTINCT user_id) FILTER (WHERE here AND mail AND optin) FROM f
 UNION ALL SELECT 'Total Registered Consumers', count(DISTINCT user_id) FILTER (WHERE here AND CAST(registration_date AS DATE) < DATE '2000-07-31') FROM f
 UNION ALL SELECT 'Consumers Registered After Date', count(DISTINCT user_id) FILTER (WHERE here AND CAST(registration_date AS DATE) < DATE '2000-07-31' AND CAST(registration_date AS DATE) >= DATE '2000-01-01') FROM f
 UNION ALL SELECT 'Gender Counts F', count(DISTINCT user_id) FILTER (WHERE here AND gender = 'F' AND registration_date IS NOT NULL) FROM f
 UNION ALL SELECT 'Profiling Email Optins', count(DISTINCT user_id) FILTER (WHERE here AND mail AND lower(opt_corporate) = 'true') FROM f
 UNION ALL SELECT 'Pet Exists', count(DISTINCT user_id) FILTER (WHERE trait_pet IS NOT NULL) FROM f
 UNION ALL SELECT 'Pet contains dog', count(DISTINCT user_id) FILTER (WHERE lower(trait_pet) LIKE '%dog%') FROM f
 UNION ALL SELECT 'Email Opened in Past 6 Months', n FROM op)
"""


def segment_counts(i):
    optin = audience.opted_in(["opt_family", "opt_corporate"], "opt_family", "opt_corporate")
    specs = audience.segment_audiences(
        ["C0"], dt.date(2000, 7, 31), dt.date(2000, 1, 1), optin, profiling="opt_corporate", exists={"Pet Exists": "trait_pet"}, contains={"Pet contains dog": ("trait_pet", ["dog"])})
    return audience.segment_audience_counts(segment_dump(i), specs, i.changed_opts.select("user_id", "ts"), i.canon, dt.date(2000, 7, 31))


@check("segment_audience_counts", DUMP_VIEWS + ["changed_opts"], DUMP + SEG_COUNTS + "SELECT audience_name, count FROM seg")
def _(i):
    return segment_counts(i)


SEG_PROGRAMS = f"""
WITH me AS (SELECT email, max(canonical_pg_id) AS c FROM merged_email_programs WHERE marketing_program_number IN (100, 102) GROUP BY 1),
mu AS (SELECT id, max(canonical_pg_id) AS c FROM merged_user_programs WHERE marketing_program_number IN (100, 102) GROUP BY 1),
cn AS (SELECT previous_user_id AS id, max(canonical_user_id) AS c FROM canon GROUP BY 1),
cu AS (SELECT u.*, coalesce(mu.c, me.c, CASE WHEN u.id IN (SELECT id_value FROM unmerge) THEN u.id END, cn.c, u.id) AS user_id
  FROM users u LEFT JOIN mu ON mu.id = u.id LEFT JOIN me ON me.email = u.email LEFT JOIN cn ON cn.id = u.id WHERE CAST(u.loaded_at AS DATE) <= DATE '2001-06-30'),
{RET4},
sd0 AS (SELECT coalesce(country_code, 'C0') AS country, user_id, {newest('registration_date')}, {newest('email_valid_contact_point_indicator')}, {newest('email')}, {newest('gender')}, {newest('source_id')}, {newest('opt_family')}, {newest('trait_pet')}
  FROM cu WHERE email_valid_contact_point_indicator IS NOT NULL OR marketing_program_number = '100' GROUP BY 1, 2),
sd AS (SELECT * FROM sd0 WHERE user_id NOT IN (SELECT user_id FROM ret4)),
op AS (SELECT count(DISTINCT coalesce(cn.c, o.user_id)) AS n FROM opened_mails o LEFT JOIN cn ON cn.id = o.user_id
  WHERE CAST(ts AS DATE) > DATE '2000-01-31' AND CAST(ts AS DATE) <= DATE '2000-07-31' AND country_code IN ('C0') AND CAST(loaded_at AS DATE) <= DATE '2001-06-30'),
rc AS (SELECT count(DISTINCT coalesce(cn.c, o.user_id)) AS n FROM changed_opts o LEFT JOIN cn ON cn.id = o.user_id WHERE ts BETWEEN TIMESTAMP '1999-01-01' AND TIMESTAMP '1999-03-31')
SELECT 'Total Registered Consumers' AS audience_name, count(DISTINCT user_id) FILTER (WHERE country IN ('C0', 'C1') AND CAST(registration_date AS DATE) < DATE '2000-07-31') AS count FROM sd
UNION ALL SELECT 'Cat owners', count(DISTINCT user_id) FILTER (WHERE trait_pet IN ('cat', 'Cat')) FROM sd
UNION ALL SELECT 'Source 2', count(DISTINCT user_id) FILTER (WHERE (source_id IN ('7') AND registration_date IS NOT NULL) OR EXISTS (SELECT 1 FROM source_audiences a WHERE a.audience_name = 'Source 2'
  AND a.source_id = sd.source_id AND registration_date IS NOT NULL AND (first_at IS NULL OR registration_date >= first_at) AND (last_at IS NULL OR registration_date <= last_at))) FROM sd
UNION ALL SELECT 'Email Opened in Past 6 Months', n FROM op UNION ALL SELECT 'Receipts', n FROM rc
UNION ALL SELECT a.audience_name, count(DISTINCT user_id) FROM source_audiences a LEFT JOIN sd ON sd.source_id = a.source_id AND registration_date IS NOT NULL
  AND (first_at IS NULL OR registration_date >= first_at) AND (last_at IS NULL OR registration_date <= last_at) WHERE a.audience_name <> 'Source 2' GROUP BY 1
"""


@check("segment_audience_counts_programs", ["users", "canon", "merged_email_programs", "merged_user_programs", "unmerge", "identifies", "opened_mails", "changed_opts", "source_audiences"], SEG_PROGRAMS)
def _(i):
    """Two of several programs, two countries, a load day, values, events of a period, and sources with registration periods."""
    lists = {"email": i.merged_email_programs, "user": i.merged_user_programs, "unmerge": i.unmerge, "canonical": i.canon}
    last = dt.date(2001, 6, 30)
    dump = audience.segment_dump(i.users, lists, retained4(i), "100", "C0", ["opt_family"], extra=["trait_pet"], programs=["100", "102"], loaded_to=last)
    specs = audience.segment_audiences(
        ["C0", "C1"], dt.date(2000, 7, 31), dt.date(2000, 1, 1), audience.opted_in(["opt_family"]), equals={"Cat owners": ("trait_pet", ["cat", "Cat"])}, sources={"Source 2": ["7"]})
    names = ["Total Registered Consumers", "Cat owners", "Source 2"]
    events = {"Receipts": (i.changed_opts.select("user_id", "ts"), dt.datetime(1999, 1, 1), dt.datetime(1999, 3, 31))}
    return audience.segment_audience_counts(
        dump, {n: specs[n] for n in names}, i.opened_mails, i.canon, dt.date(2000, 7, 31), countries=["C0"], loaded_to=last, events=events, registrations=i.source_audiences)


def cdp_sql(traits: str) -> str:
    return OUT + f""",
{LATEST_ALIAS},
nret AS (SELECT DISTINCT g.pg_id FROM id_graphs g WHERE g.id_type = 'userId' AND g.id_value NOT IN (SELECT user_id FROM ret)),
outp AS (SELECT DISTINCT pg_id FROM id_graphs WHERE id_type = 'userId' AND pg_id NOT IN (SELECT pg_id FROM nret)),
pk AS (SELECT consumerid_sourceid_mpn, pg_id, trait_id, marketing_program_number, trait_name, max(trait_consumer_last_updated_date) AS d1, max(trait_expiration_date) AS d2, max(last_updated_date) AS d3, string_agg(trait_value, ',' ORDER BY trait_value) AS v
   FROM {traits} WHERE marketing_program_number IN (100, 101) GROUP BY 1, 2, 3, 4, 5),
pn AS (SELECT p.marketing_program_number, a.canonical_pg_id AS pg_id, trait_id, trait_name, d1, d2, d3, v FROM pk p JOIN (SELECT DISTINCT pg_id, canonical_pg_id FROM la) a ON a.pg_id = p.pg_id),
pb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY marketing_program_number, pg_id, trait_id, trait_name ORDER BY d1 DESC NULLS LAST, d2 DESC NULLS LAST, d3 DESC NULLS LAST, v DESC NULLS LAST) AS rn FROM pn) WHERE rn = 1 AND pg_id NOT IN (SELECT pg_id FROM outp)),
cd AS (SELECT pg_id, """ + ", ".join(
    f"max(CASE WHEN trait_name = '{n}' THEN v END) AS \"{n}\"" for n in [*audience.TARGET_TRAITS, "optCorporate", "optFamily"]) + " FROM pb GROUP BY pg_id)"


CDP = cdp_sql("profile_traits")
CDP_VIEWS = ["identifies", "profile_aliases", "id_graphs", "profile_traits"]


def cdp_dump(i, traits=None):
    graph = i.id_graphs.filter("id_type = 'userId'")
    return audience.cdp_dump(i.profile_traits if traits is None else traits, i.profile_aliases, graph, retained(i), [100, 101], ["optCorporate", "optFamily"])


@check("cdp_dump", CDP_VIEWS, CDP + " SELECT * FROM cd")
def _(i):
    return cdp_dump(i)


CDP_COUNTS = """,
ev AS (SELECT v.event_name, CAST(v.event_date AS DATE) AS day, a.canonical_pg_id FROM profile_events v JOIN (SELECT DISTINCT pg_id, canonical_pg_id FROM la) a ON a.pg_id = v.pg_id WHERE v.trace_id IN (SELECT trace_id FROM event_properties) AND v.marketing_program_number IN (100, 101)),
g AS (SELECT *, coalesce(email <> ' ', FALSE) AS mail, coalesce("optCorporate" = 'true', FALSE) OR coalesce("optFamily" = 'true', FALSE) AS optin FROM cd),
cdp AS (SELECT 'Email Contactable' AS audience_name, count(*) FILTER (WHERE mail AND optin AND ("emailValidContactPointIndicator" IS NULL OR "emailValidContactPointIndicator" = 'Y')) AS count FROM g
 UNION ALL SELECT 'Email Optins', count(*) FILTER (WHERE mail AND optin) FROM g
 UNION ALL SELECT 'Consumers Registered After Date', count(*) FILTER (WHERE "registrationDate" >= '2023-01-01') FROM g
 UNION ALL SELECT 'Total Registered Consumers', count(*) FILTER (WHERE "registrationDate" IS NOT NULL) FROM g
 UNION ALL SELECT 'Gender Counts F', count(*) FILTER (WHERE gender = 'F' AND "registrationDate" IS NOT NULL) FROM g
 UNION ALL SELECT 'Profiling Email Optins', count(*) FILTER (WHERE mail AND "optCorporate" = 'true') FROM g
 UNION ALL SELECT 'Opened', count(DISTINCT canonical_pg_id) FROM ev WHERE event_name = 'Email Opened' AND day > DATE '2024-01-10'
 UNION ALL SELECT 'Receipts', count(DISTINCT canonical_pg_id) FROM ev WHERE event_name = 'Receipt Verified' AND day BETWEEN DATE '2024-01-02' AND DATE '2024-01-09')
"""


def cdp_counts(i):
    specs = audience.cdp_audiences("2023-01-01", audience.opted_in(["optCorporate", "optFamily"]), "optCorporate")
    count = lambda name, **when: audience.event_audience(i.profile_events, i.event_properties, i.profile_aliases, [100, 101], name, **when)
    events = {"Opened": count("Email Opened", after=dt.date(2024, 1, 10)), "Receipts": count("Receipt Verified", between=("2024-01-02", "2024-01-09"))}
    return audience.cdp_audience_counts(cdp_dump(i), specs, events)


@check("cdp_audience_counts", CDP_VIEWS + ["profile_events", "event_properties"], CDP + CDP_COUNTS + "SELECT audience_name, count FROM cdp")
def _(i):
    return cdp_counts(i)


@check("cdp_audience_counts_sources", ["identifies", "profile_aliases", "id_graphs", "profile_traits_sources", "target_source_audiences"], cdp_sql("profile_traits_sources") + """
SELECT 'Total Registered Consumers' AS audience_name, count(*) FILTER (WHERE "registrationDate" IS NOT NULL) AS count FROM cd
UNION ALL SELECT 'Men', count(*) FILTER (WHERE gender IN ('M', 'm')) FROM cd
UNION ALL SELECT 'Registered by 9', count(*) FILTER (WHERE "sourceId" = '9' AND "registrationDate" IS NOT NULL) FROM cd
UNION ALL SELECT audience_name, count(DISTINCT pg_id) FROM target_source_audiences a LEFT JOIN cd ON "sourceId" = source_id AND "registrationDate" IS NOT NULL
  AND (first_at IS NULL OR TRY_CAST("registrationDate" AS TIMESTAMP) >= first_at) AND (last_at IS NULL OR TRY_CAST("registrationDate" AS TIMESTAMP) <= last_at) GROUP BY 1
""")
def _(i):
    """Values of a trait, sources, and sources with registration periods on the target side."""
    specs = audience.cdp_audiences("2023-01-01", audience.opted_in(["optCorporate", "optFamily"]), equals={"Men": ("gender", ["M", "m"])}, sources={"Registered by 9": ["9"]})
    wanted = {n: specs[n] for n in ("Total Registered Consumers", "Men", "Registered by 9")}
    return audience.cdp_audience_counts(cdp_dump(i, i.profile_traits_sources), wanted, registrations=i.target_source_audiences)


@check("audience_dashboard", DUMP_VIEWS + ["changed_opts"] + CDP_VIEWS + ["profile_events", "event_properties"], DUMP + SEG_COUNTS + "," + CDP.lstrip()[5:] + CDP_COUNTS + f"""
SELECT {NOW_SQL} AS timestamp, 'prog' AS "MP_Name", n AS audience_name, coalesce(seg.count, 0) AS count, 'Segment' AS application_name FROM (SELECT unnest(['Email Contactable', 'Email Optins', 'Never']) AS n) LEFT JOIN seg ON seg.audience_name = n
UNION ALL SELECT {NOW_SQL}, 'prog', n, coalesce(cdp.count, 0), 'CDP' FROM (SELECT unnest(['Email Contactable', 'Email Optins', 'Never']) AS n) LEFT JOIN cdp ON cdp.audience_name = n
""")
def _(i):
    out = audience.audience_dashboard(segment_counts(i), cdp_counts(i), "prog", NOW, ["Email Contactable", "Email Optins", "Never"])
    return out.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


# ---- exports and deliveries ---------------------------------------------------------------------


@check("resci_export", ["id_graphs", "contacts"], RESCI)
def _(i):
    return joins.resci_mapping(i.contacts, i.id_graphs)


@check("resci_export_file", ["id_graphs", "contacts"], RESCI.replace("SELECT record_id, email, account_created_on FROM c", "SELECT CAST(record_id AS VARCHAR) AS record_id, email, CAST(account_created_on AS VARCHAR) AS account_created_on FROM c"))
def _(i):
    """The mapping as a report file, read again as text."""
    from checks.q_io import scratch
    from passerine.sinks import writers

    path = scratch(i.spark) + "/resci"
    mapping = joins.resci_mapping(i.contacts, i.id_graphs)
    writers.export_csv(mapping.select(*[F.col(c).cast("string").alias(c) for c in mapping.columns]), path)
    return i.spark.read.option("header", True).csv(path)


@check("downstream_exports", ["id_graphs", "id_aliases"], f"""
WITH {IDMAP} SELECT 'ids' AS shape, count(*) AS n, count(DISTINCT user_ids) AS d FROM (SELECT DISTINCT user_ids, pg_ids FROM idm)
UNION ALL SELECT 'emails', count(*), count(DISTINCT pg_ids) FROM (SELECT DISTINCT user_ids, pg_ids FROM idm) UNION ALL SELECT 'aliases', count(*), count(DISTINCT user_ids) FROM (SELECT DISTINCT user_ids, pg_ids FROM idm)
UNION ALL SELECT 'user_emails', count(*), count(DISTINCT pg_ids) FROM (SELECT DISTINCT user_ids, pg_ids FROM idm) UNION ALL SELECT 'requests', count(*), count(DISTINCT user_ids) FROM idm
""")
def _(i):
    mapping = identity.id_mapping(i.id_graphs, i.id_aliases, PROGRAMS)
    shapes = identity.export_shapes(mapping, "147", "mail.test")
    shapes["requests"] = identity.alias_request_rows(mapping)
    return windows.union_all(*[
        df.toDF(*[f"c{k}" for k in range(len(df.columns))]).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("c0").alias("d")).select(F.lit(n).alias("shape"), "n", "d")
        for n, df in shapes.items()])


@check("downstream_exports_rows", ["id_graphs", "id_aliases"], f"""
WITH {IDMAP}, d AS (SELECT DISTINCT user_ids, pg_ids, CAST(user_ids AS VARCHAR) || '_147@mail.test' AS user_mail, CAST(pg_ids AS VARCHAR) || '_147@mail.test' AS pg_mail FROM idm)
SELECT 'ids' AS shape, user_mail AS first, pg_mail AS second, NULL AS third FROM d UNION ALL SELECT 'emails', pg_mail, pg_mail, NULL FROM d
UNION ALL SELECT 'aliases', user_ids, pg_ids, 'alias' FROM d UNION ALL SELECT 'user_emails', pg_ids, pg_mail, NULL FROM d UNION ALL SELECT 'requests', user_ids, pg_ids, 'alias' FROM idm
""")
def _(i):
    """The rows of the export files and of the alias requests."""
    mapping = identity.id_mapping(i.id_graphs, i.id_aliases, PROGRAMS)
    shapes = identity.export_shapes(mapping, "147", "mail.test")
    shapes["requests"] = identity.alias_request_rows(mapping)
    row = lambda df: [F.col(f"c{k}") if k < len(df.columns) else F.lit(None).cast("string") for k in range(3)]
    texts = lambda n, df: df.toDF(*[f"c{k}" for k in range(len(df.columns))]).select(F.lit(n).alias("shape"), *[c.cast("string").alias(a) for c, a in zip(row(df), ("first", "second", "third"))])
    return windows.union_all(*[texts(n, df) for n, df in shapes.items()])


@check("dlq_remediation", ["dlq"], """
WITH inner_rows AS (
  SELECT CAST(json_extract(data, '$.servicePayload') AS VARCHAR) AS inner_payload FROM dlq WHERE publish_time > TIMESTAMP '2024-01-10 00:00:00' AND publish_time <= TIMESTAMP '2024-01-12 00:00:00'
)
SELECT 'archive' AS output, inner_payload FROM inner_rows
UNION ALL SELECT 'failed', inner_payload FROM inner_rows WHERE regexp_extract(inner_payload, '([0-9])[^0-9]*$', 1) IN ('3', '7')
""")
def _(i):
    from checks.q_io import scratch
    from checks.senders import fail_when_last_digit_in
    from passerine.plans import delivery

    out = delivery.dlq_remediation(i.dlq, "2024-01-10 00:00:00", "2024-01-12 00:00:00", fail_when_last_digit_in("37"), scratch(i.spark))
    return windows.union_all(*(df.select(F.lit(n).alias("output"), "inner_payload") for n, df in out.items()))


@check("dlq_replay", ["replay_table"], f"""
SELECT message_id, CASE WHEN replay_status = 'ToBeReplayed' AND event_id % 5 <> 0 THEN 'Replayed' ELSE replay_status END AS replay_status,
  CASE WHEN replay_status = 'ToBeReplayed' AND event_id % 5 <> 0 THEN {NOW_SQL} ELSE replay_time END AS replay_time FROM replay_table
""")
def _(i):
    from checks.q_io import scratch
    from checks.senders import fail_when_last_digit_in
    from passerine.plans import delivery

    table = i.replay_table.drop("event_id")
    out = delivery.dlq_replay(table, fail_when_last_digit_in("05"), NOW, scratch(i.spark))
    return out.select("message_id", "replay_status", F.col("replay_time").cast("timestamp_ntz").alias("replay_time"))


@check("id_consent_payloads", CRS_VIEWS + ["consents", "profile_consents", "traces"], CONSENT_SQL.replace("SELECT trace_id, count(*) AS n_opts", "SELECT 'consent' AS kind, trace_id, count(*) AS n_opts").replace(
    "arg_min(CAST(source_id AS STRING), opt_id) AS source_id, arg_min(email, opt_id) AS email, arg_min(marketing_program_number, opt_id) AS marketing_program_number,", "").replace(
    ", count(*) AS doc_opts, CAST(min(opt_id) AS STRING) AS first_opt, arg_min_null(contact_type, opt_id) AS first_type", "") + """
UNION ALL SELECT 'id', trace_id, NULL, CASE WHEN event_id % 3 = 0 THEN strftime(received_date, '%Y-%m-%dT%H:%M:%S') || '.000Z' ELSE strftime(received_date, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' END FROM traces
""")
def _(i):
    consents = consent_documents(i).select(F.lit("consent").alias("kind"), "trace_id", "n_opts", "request_timestamp")
    ids = service_payloads.id_service_payload(i.traces.drop("event_id", "user_id"), "7")
    return consents.unionByName(ids.select(F.lit("id").alias("kind"), F.col("traceId").alias("trace_id"), F.lit(None).cast("bigint").alias("n_opts"), F.col("requestTimestamp").alias("request_timestamp")))


@check("latest_event_publish", ["pl_scalars"], """
SELECT user_txt AS user_id, event_name AS event, arg_max(message_id, row(coalesce(tst, ''), message_id)) AS message_id FROM pl_scalars WHERE user_txt IS NOT NULL AND event_name IS NOT NULL GROUP BY 1, 2
""")
def _(i):
    from passerine.operators.aggregates import latest_per_user_event

    out = latest_per_user_event(i.payloads())
    return out.select("user_id", "event", F.get_json_object("raw_payload", "$.messageId").alias("message_id"))


@check("latest_event_publish_failures", ["pl"], """
WITH w AS (SELECT user_txt AS user_id, event_name AS event, arg_max(message_id, row(coalesce(tst, ''), message_id)) AS message_id, arg_max(raw_payload, row(coalesce(tst, ''), message_id)) AS raw_payload
  FROM pl WHERE user_txt IS NOT NULL AND event_name IS NOT NULL GROUP BY 1, 2)
SELECT user_id, event, message_id, 'refused' AS error FROM w WHERE regexp_extract(raw_payload, '([0-9])[^0-9]*$', 1) IN ('3', '7')
""")
def _(i):
    """The latest record of each user and event, sent once by a ledger; the failures come back."""
    from checks.q_io import scratch
    from checks.senders import fail_when_last_digit_in
    from passerine.operators.aggregates import latest_per_user_event
    from passerine.plans import delivery

    sent = delivery.send_once(latest_per_user_event(i.payloads()), "raw_payload", fail_when_last_digit_in("37"), scratch(i.spark) + "/ledger", waves=4)
    return sent.where("error IS NOT NULL").select("user_id", "event", F.get_json_object("raw_payload", "$.messageId").alias("message_id"), "error")


@check("id_payload_publish", ["traces"], "SELECT trace_id, 'id' AS kind FROM traces")
def _(i):
    """Identity documents published in waves: each is sent, and its outcome is in the ledger once."""
    from checks.q_io import scratch
    from checks.senders import fail_when_last_digit_in
    from passerine.plans import delivery

    ids = service_payloads.id_service_payload(i.traces.drop("event_id", "user_id"), "7").select(F.col("traceId").alias("trace_id"), "document")
    sent = delivery.send_once(ids, "document", fail_when_last_digit_in(""), scratch(i.spark) + "/ledger", waves=4)
    return sent.where("error IS NULL").select("trace_id", F.lit("id").alias("kind"))


ATTR = "{0}.marketing_program_number, {0}.consumer_id, {0}.source_id, sha256(lower({0}.email)) AS email_sha256, strftime({0}.original_timestamp, '%Y-%m-%d %H:%M:%S') AS original_timestamp"


@check("profile_users", ["identifies", "canonical_ctas", "aliases_a", "aliases_b", "crs_program"], f"""
WITH fm AS (SELECT DISTINCT mpn FROM crs_program WHERE program_name LIKE '%1%'), can AS (SELECT *, TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(ck % 9 AS INT)) AS original_timestamp FROM canonical_ctas)
SELECT DISTINCT i.user_id, {ATTR.format('i')} FROM identifies i WHERE i.marketing_program_number NOT IN (SELECT mpn FROM fm)
UNION ALL SELECT DISTINCT c.user_id, {ATTR.format('c')} FROM can c
UNION ALL SELECT DISTINCT a.previous_id, {ATTR.format('c')} FROM (SELECT * FROM aliases_a UNION SELECT * FROM aliases_b) a JOIN can c ON c.user_id = a.user_id
""")
def _(i):
    foreign = i.crs_program.filter("program_name LIKE '%1%'").select("mpn")
    canonical = i.canonical_ctas.withColumn("original_timestamp", F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(CAST(ck % 9 AS INT))"))
    return profiles.profile_users(i.identifies, canonical, [i.aliases_a, i.aliases_b], foreign)
