"""Views in the shape the jobs expect, derived from the benchmark tables.

Each view is one SQL text that both engines run: the engine under test through
``view(spark, sf_dir, name)`` and the independent DuckDB check through ``with_views(names)``.
Only scalars derived from keys are used, so both see the same rows.  The payload view carries
its scalars beside the JSON text: Spark reads only the text, the check only the scalars.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]

VIEWS: dict[str, str] = {}

VIEWS["crs_program"] = """
SELECT CAST(CASE WHEN n_nationkey < 20 THEN 100 ELSE 7000 END + n_nationkey AS STRING) AS mpn, 'C' || CAST(n_nationkey AS STRING) AS country_code,
       CAST(n_regionkey + 1 AS STRING) AS legal_entity, n_name AS program_name
FROM @nation
"""

VIEWS["crs_source"] = """
SELECT 'seg' || CAST(s_suppkey AS STRING) AS segment_source_id, s_suppkey % 10 AS source_id,
       CAST(100 + s_nationkey AS STRING) AS mpn
FROM @supplier
"""

VIEWS["event_ref"] = """
SELECT DISTINCT event_type AS eventName,
       CASE WHEN event_type = 'error' THEN 'Email CLT' ELSE 'Web' END AS eventCategory,
       CASE WHEN event_type = 'view' THEN 'page view|product view' WHEN event_type = 'click' THEN 'NULL'
            WHEN event_type = 'error' THEN 'failure' ELSE '' END AS eventNameAlias,
       CASE WHEN event_type = 'view' THEN 'g_view' WHEN event_type = 'error' THEN 'g_err'
            WHEN event_type = 'click' THEN 'NULL' ELSE '' END AS gacaEventName
FROM @events
UNION ALL SELECT 'Changed Opt Status', 'Consent', 'NULL', ''
"""

VIEWS["opt_map"] = """
SELECT CAST(100 + s_nationkey AS STRING) AS cdp_marketing_program_number,
       CASE WHEN s_suppkey % 2 = 0 THEN '12_34' ELSE '77_1' END AS ciam_opt_id,
       'S' || CAST(s_suppkey % 4 AS STRING) AS service_name, CAST(s_suppkey % 50 AS STRING) AS subscription_opt_number,
       CASE WHEN s_suppkey % 5 = 4 THEN 'P' ELSE 'E' END AS contact_point_type_code,
       CASE WHEN s_suppkey % 5 = 4 THEN 'PM' ELSE 'EP' END AS contact_point_category_code
FROM @supplier
"""

VIEWS["pl_keys"] = """
SELECT event_id AS e, user_id AS u, ts, event_type, CAST(floor(event_id / 5) AS BIGINT) AS b,
       'm' || CAST(event_id AS STRING) AS message_id, CAST(event_id AS STRING) AS es, CAST(user_id AS STRING) AS us,
       CASE WHEN event_type = 'signup' THEN 'identify' ELSE 'track' END AS typ,
       CASE WHEN event_type = 'signup' THEN NULL WHEN event_id % 5 = 0 THEN 'Changed Opt Status'
            WHEN event_id % 10 = 3 THEN 'Signed Up for Promotion' ELSE event_type END AS event_name,
       CASE WHEN event_id % 17 = 0 THEN NULL ELSE 'u' || CAST(user_id AS STRING) END AS user_txt,
       CASE WHEN event_id % 17 = 0 OR event_id % 13 = 0 THEN 'a' || CAST(user_id AS STRING) END AS anon_txt,
       @iso(ts) AS iso
FROM @events
"""

VIEWS["pl_scalars"] = """
SELECT *, typ = 'identify' AS is_identify, coalesce(event_name = 'Changed Opt Status', FALSE) AS is_opt,
  CASE WHEN e % 19 = 0 THEN NULL WHEN e % 19 = 1 THEN substr(iso, 1, 19) || '+02:00' WHEN e % 19 = 2 THEN 'not a date'
       WHEN e % 19 = 3 THEN '2020-' || substr(iso, 6) WHEN e % 19 = 4 THEN '2023-05-' || substr(iso, 9)
       WHEN e % 19 = 5 THEN substr(iso, 1, 10) || ' ' || substr(iso, 12, 8) ELSE iso END AS ots,
  CASE WHEN e % 29 = 0 THEN NULL WHEN e % 29 = 1 THEN '' WHEN e % 29 = 2 THEN '5' WHEN e % 29 = 3 THEN '01/15/2024' ELSE iso END AS tst,
  e % 29 = 2 AS tst_num,
  CASE WHEN e % 31 = 0 THEN NULL WHEN e % 23 = 0 THEN '9999' ELSE CAST(100 + u % 25 AS STRING) END AS xmpn,
  e % 7 = 0 AND e % 23 <> 0 AND e % 31 <> 0 AS xmpn_num,
  CASE WHEN e % 3 = 0 THEN NULL WHEN e % 21 = 1 THEN '' WHEN e % 21 = 2 THEN 'S-x' ELSE CAST(e % 10 AS STRING) END AS xsrc,
  CASE WHEN e % 4 = 2 THEN ' ' WHEN e % 4 = 3 THEN 'c' || us || '@x.org' END AS xmail,
  e % 4 = 0 AS xmail_absent,
  CASE WHEN e % 6 = 0 THEN 'c' || us || '2024-01-01T00:00:00' WHEN e % 6 = 1 THEN '' WHEN e % 6 = 2 THEN 'c-' || us END AS xcons,
  CASE WHEN e % 8 = 0 THEN 'C' || CAST(u % 25 AS STRING) WHEN e % 8 = 1 THEN 'C99' END AS xcc,
  CASE WHEN e % 25 = 0 THEN 'AB-12' WHEN e % 25 = 1 THEN 'bad#1' END AS xloy,
  CASE WHEN e % 16 = 5 THEN '+49' || us END AS xphone,
  e % 11 = 0 AS has_empty_ext,
  CASE WHEN (e + u) % 4 = 1 THEN '' WHEN (e + u) % 4 = 2 THEN ' ' WHEN (e + u) % 4 = 3 THEN 'u' || us || '@mail.org' END AS tmail,
  CASE WHEN e % 14 = 5 THEN NULL ELSE CAST(100 + u % 25 AS STRING) END AS tmpn,
  e % 2 = 0 AS tmpn_num,
  CASE WHEN e % 5 < 2 THEN CAST(e % 10 AS STRING) WHEN e % 5 = 2 THEN '7' END AS tsrc,
  e % 5 = 2 AS tsrc_num,
  CASE WHEN e % 3 = 1 THEN '+1' || us END AS tphone,
  CASE WHEN e % 7 = 2 THEN 'tc' || us END AS tcons,
  CASE WHEN e % 9 = 0 THEN 'off' || us END AS toff,
  CASE WHEN e % 4 = 0 THEN iso WHEN e % 4 = 1 THEN substr(iso, 1, 10)
       WHEN e % 4 = 2 THEN substr(iso, 1, 10) || ' ' || substr(iso, 12, 8) ELSE 'soon' END AS reg,
  CASE WHEN e % 6 = 0 THEN iso END AS lad,
  CASE WHEN e % 41 = 0 THEN 'null' WHEN e % 43 = 0 THEN 'empty' ELSE 'object' END AS traits_state,
  e % 4 = 1 AS has_deps,
  CASE WHEN e % 8 = 2 THEN 'C5' END AS pcc,
  b % 2 = 1 AS ch_email, CAST(floor(b / 2) AS BIGINT) % 2 = 1 AS ch_phone, CAST(floor(b / 4) AS BIGINT) % 2 = 1 AS ch_postal,
  CAST(floor(b / 8) AS BIGINT) % 2 = 1 AS ch_social,
  CASE WHEN b % 6 = 1 THEN 'Universal' ELSE 'S' || CAST(b % 4 AS STRING) END AS svc,
  CASE WHEN b % 3 = 0 THEN 'true' WHEN b % 3 = 1 THEN 'false' ELSE 'true' END AS eind, b % 3 = 2 AS eind_bool,
  CASE WHEN b % 9 = 1 THEN CAST(b % 50 AS STRING) END AS enum, b % 9 = 1 OR b % 11 = 1 AS etyped,
  CASE WHEN b % 6 = 0 THEN '12_34' WHEN b % 3 = 0 THEN 'bad' END AS opt_id,
  CASE WHEN b % 4 = 0 THEN 'true' WHEN b % 4 = 1 THEN 'maybe' END AS init_status,
  CASE WHEN b % 5 = 0 THEN 'TRUE' WHEN b % 5 = 1 THEN 'no' END AS opt_status,
  CASE WHEN b % 10 = 3 THEN '5' END AS legal_no, b % 7 = 0 AS typed_ep,
  CASE WHEN e % 2 = 0 THEN 'seg' || CAST(e % 12 AS STRING) END AS protocol
FROM @pl_keys
"""

VIEWS["pl_blocks"] = """
SELECT *,
  '[' || substr(
    CASE WHEN has_empty_ext THEN ',{}' ELSE '' END
    || CASE WHEN xmpn IS NULL THEN '' WHEN xmpn_num THEN ',{"id":' || xmpn || ',"type":"marketingProgramNumber","collection":"users","encoding":"none"}'
            ELSE ',{"id":"' || xmpn || '","type":"marketingProgramNumber","collection":"users","encoding":"none"}' END
    || CASE WHEN xsrc IS NULL THEN '' ELSE ',{"id":"' || xsrc || '","type":"sourceId","collection":"users","encoding":"none"}' END
    || CASE WHEN xmail_absent THEN '' ELSE ',{"id":' || coalesce('"' || xmail || '"', 'null') || ',"type":"email","collection":"users","encoding":"none"}' END
    || CASE WHEN xcons IS NULL THEN '' ELSE ',{"id":"' || xcons || '","type":"consumerId","collection":"users","encoding":"none"}' END
    || CASE WHEN xcc IS NULL THEN '' ELSE ',{"id":"' || xcc || '","type":"countryCode","collection":"users","encoding":"none"}' END
    || CASE WHEN xloy IS NULL THEN '' ELSE ',{"id":"' || xloy || '","type":"loyaltyAccountNumber","collection":"users","encoding":"none"}' END
    || CASE WHEN xphone IS NULL THEN '' ELSE ',{"id":"' || xphone || '","type":"phoneNumber","collection":"users","encoding":"none"}' END,
    2) || ']' AS ext_json,
  ',"email":' || coalesce('"' || tmail || '"', 'null')
    || CASE WHEN tmpn IS NULL THEN '' WHEN tmpn_num THEN ',"marketingProgramNumber":' || tmpn ELSE ',"marketingProgramNumber":"' || tmpn || '"' END
    || CASE WHEN tsrc IS NULL THEN '' WHEN tsrc_num THEN ',"sourceId":' || tsrc ELSE ',"sourceId":"' || tsrc || '"' END
    || coalesce(',"phoneNumber":"' || tphone || '"', '')
    || coalesce(',"consumerId":"' || tcons || '"', '')
    || coalesce(',"offlineConsumerId":"' || toff || '"', '') AS shared_json
FROM @pl_scalars
"""

VIEWS["pl"] = """
SELECT *,
  '{"type":"' || typ || '","messageId":"' || message_id || '"'
    || coalesce(',"event":"' || event_name || '"', '')
    || coalesce(',"userId":"' || user_txt || '"', '')
    || coalesce(',"anonymousId":"' || anon_txt || '"', '')
    || coalesce(',"originalTimestamp":"' || ots || '"', '')
    || CASE WHEN tst IS NULL THEN '' WHEN tst_num THEN ',"timestamp":5' ELSE ',"timestamp":"' || tst || '"' END
    || CASE WHEN NOT is_identify THEN '' WHEN traits_state = 'null' THEN ',"traits":null' WHEN traits_state = 'empty' THEN ',"traits":{}'
       ELSE ',"traits":{' || substr(shared_json
         || ',"registrationDate":"' || reg || '","emailConsumerChoiceDate":"' || reg || '"'
         || coalesce(',"lastActivityDate":"' || lad || '"', '')
         || ',"skin_score":3,"petOptIndicator":' || CASE WHEN e % 4 = 0 THEN 'true' WHEN e % 4 = 1 THEN 'false' WHEN e % 4 = 2 THEN '"TRUE"' ELSE 'null' END
         || ',"newsOptNumber":' || CAST(e % 50 AS STRING) || ',"ratio":1.5,"blankTrait":"","spaceTrait":" ","stdAddress":"'
         || CASE WHEN e % 2 = 0 THEN ' ' ELSE 'Main St' END || '","gender":"F","sexAlias":"' || CASE WHEN e % 3 = 0 THEN 'F' ELSE 'M' END || '"'
         || CASE WHEN has_deps THEN ',"dependents":[{"name":"k' || us || '","age":' || CAST(e % 9 AS STRING)
              || ',"pets":[{"kind":"cat"},{"kind":"dog"}]},{"name":"j","nick":null}]' ELSE '' END, 2) || '}' END
    || CASE WHEN is_identify THEN '' ELSE ',"properties":{' || substr(shared_json
         || coalesce(',"countryCode":"' || pcc || '"', '') || ',"score":' || CAST(e % 100 AS STRING)
         || CASE WHEN NOT is_opt THEN '' ELSE
              CASE WHEN ch_email THEN ',"emailConsumerChoiceDate":"' || reg || '","emailSubscriptionOptIndicator":'
                   || CASE WHEN eind_bool THEN 'true' ELSE '"' || eind || '"' END || ',"emailSubscriptionServiceName":"' || svc || '"'
                   || coalesce(',"emailSubscriptionOptNumber":"' || enum || '"', '')
                   || CASE WHEN etyped THEN ',"emailContactType":"E","emailContactCategory":"EP"' ELSE '' END ELSE '' END
              || CASE WHEN ch_phone THEN ',"phoneConsumerChoiceDate":"' || iso || '","phoneSubscriptionOptIndicator":"true"' ELSE '' END
              || CASE WHEN ch_postal THEN ',"postalConsumerChoiceDate":"' || iso || '","postalSubscriptionServiceName":"S1"' ELSE '' END
              || CASE WHEN ch_social THEN ',"socialConsumerChoiceDate":"' || iso || '","socialSubscriptionOptIndicator":"false"' ELSE '' END
              || coalesce(',"optId":"' || opt_id || '"', '') || coalesce(',"initialOptStatus":"' || init_status || '"', '')
              || coalesce(',"optStatus":"' || opt_status || '"', '') || coalesce(',"legalEntityNumber":"' || legal_no || '"', '')
              || CASE WHEN typed_ep THEN ',"contactType":"E","contactCategory":"EP"' ELSE '' END
            END, 2) || '}' END
    || ',"context":{"externalIds":' || ext_json || coalesce(',"protocols":{"sourceId":"' || protocol || '"}', '') || '}}' AS raw_payload
FROM @pl_blocks
"""

VIEWS["identifies"] = """
SELECT o_orderkey AS ok, o_custkey AS ck, 'u' || CAST(CAST(floor(o_custkey / 10) AS BIGINT) AS STRING) AS user_id,
  CASE WHEN o_custkey % 7 = 0 THEN ' ' WHEN o_orderkey % 11 = 0 THEN NULL ELSE 'e' || CAST(o_custkey AS STRING) || '@mail.org' END AS email,
  CASE WHEN o_custkey % 7 = 0 THEN ' ' WHEN o_orderkey % 13 = 0 THEN NULL ELSE '+1' || CAST(o_custkey AS STRING) END AS phone_number,
  CASE WHEN o_custkey % 7 = 0 AND o_orderkey % 3 <> 0 THEN ' ' WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_custkey % 7 = 0 THEN ' ' ELSE 'line1' END AS address_line1,
  CASE WHEN o_custkey % 7 = 0 THEN ' ' ELSE 'line2' END AS address_line2,
  CASE WHEN o_custkey % 7 = 0 THEN ' ' ELSE 'line3' END AS address_line3,
  CASE WHEN o_orderkey % 37 = 0 THEN '' ELSE CAST(o_orderkey % 10 AS STRING) END AS source_id,
  CASE WHEN o_orderkey % 29 = 0 THEN ' ' ELSE CAST(100 + c_nationkey AS STRING) END AS marketing_program_number,
  'c' || CAST(o_custkey AS STRING) AS consumer_id, o_orderdate AS registration_date, o_orderdate AS ts,
  o_orderdate AS original_timestamp, o_orderdate AS received_at,
  CASE WHEN o_orderkey % 53 = 0 THEN 'audience' END AS context_personas_computation_class,
  CASE WHEN o_orderkey % 4 = 0 THEN '' WHEN o_orderkey % 4 = 1 THEN NULL ELSE o_orderpriority END AS trait_pet_kind,
  o_orderstatus AS car_colour, o_custkey % 5 AS score_web
FROM @orders JOIN @customer ON o_custkey = c_custkey
"""

VIEWS["canonical_ctas"] = """
SELECT 'u' || CAST(CAST(floor(c_custkey / 10) AS BIGINT) AS STRING) AS user_id, CAST(100 + c_nationkey AS STRING) AS marketing_program_number,
       'c' || CAST(c_custkey AS STRING) AS consumer_id, CAST(c_custkey % 10 AS STRING) AS source_id,
       'e' || CAST(c_custkey AS STRING) || '@mail.org' AS email, c_mktsegment AS pet_kind, c_custkey % 4 AS kids_count,
       CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'Blue' END AS car_colour, c_custkey AS ck
FROM @customer WHERE c_nationkey < 18
"""

# All nations; those that canonical_ctas leaves out miss the joins by another user id.
VIEWS["canonical_all"] = VIEWS["canonical_ctas"].replace("SELECT 'u' ||", "SELECT CASE WHEN c_nationkey < 18 THEN 'u' ELSE 'none' END ||").replace(" WHERE c_nationkey < 18", "")

VIEWS["last_orders"] = "SELECT o_custkey AS lo_ck, max(o_orderdate) AS loaded_at FROM @orders GROUP BY o_custkey"

VIEWS["users"] = """
SELECT 'w' || CAST(c_custkey AS STRING) AS id, c_custkey AS ck,
  CASE WHEN c_custkey % 13 = 0 THEN ' ' WHEN c_custkey % 17 = 0 THEN NULL ELSE 'E' || CAST(c_custkey AS STRING) || '@mail.org' END AS email,
  CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
  CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE 'C' || CAST(c_nationkey % 2 AS STRING) END AS country_code,
  CAST(c_custkey % 10 AS STRING) AS source_id,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE loaded_at END AS registration_date,
  CASE WHEN c_custkey % 4 = 0 THEN 'N' WHEN c_custkey % 4 = 1 THEN 'Y' END AS email_valid_contact_point_indicator,
  CAST(100 + c_nationkey % 2 AS STRING) AS marketing_program_number,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 'true' WHEN c_mktsegment = 'MACHINERY' THEN 'false' END AS opt_family,
  CASE WHEN c_custkey % 3 = 0 THEN 'True' WHEN c_custkey % 3 = 1 THEN 'false' END AS opt_corporate,
  CASE WHEN c_custkey % 7 = 0 THEN 'cat and dog' WHEN c_custkey % 7 = 1 THEN 'cat' END AS trait_pet,
  coalesce(loaded_at, TIMESTAMP '1995-01-01 00:00:00') AS loaded_at
FROM @customer LEFT JOIN @last_orders ON c_custkey = lo_ck
"""

VIEWS["canon"] = """
SELECT CASE WHEN c_custkey % 2 = 0 THEN 'w' ELSE 'none' END || CAST(c_custkey AS STRING) AS previous_user_id, 'w' || CAST(c_custkey - c_custkey % 3 AS STRING) AS canonical_user_id
FROM @customer
"""
VIEWS["merged_email"] = """
SELECT CASE WHEN c_custkey % 9 = 0 THEN 'E' ELSE 'none' END || CAST(c_custkey AS STRING) || '@mail.org' AS email, 'pm' || CAST(c_custkey AS STRING) AS canonical_pg_id FROM @customer
"""
VIEWS["merged_user"] = """
SELECT CASE WHEN c_custkey % 11 = 0 THEN 'w' ELSE 'none' END || CAST(c_custkey AS STRING) AS id, 'pu' || CAST(c_custkey AS STRING) AS canonical_pg_id FROM @customer
"""
# Merges of two programs, mails opened in two countries and loaded late, and audiences of sources with registration periods.
VIEWS["merged_email_programs"] = """
SELECT 'E' || CAST(c_custkey AS STRING) || '@mail.org' AS email, 'pm' || CAST(c_custkey - c_custkey % 2 AS STRING) AS canonical_pg_id, 100 + c_custkey % 4 AS marketing_program_number FROM @customer
"""
VIEWS["merged_user_programs"] = """
SELECT 'w' || CAST(c_custkey AS STRING) AS id, 'pu' || CAST(c_custkey - c_custkey % 5 AS STRING) AS canonical_pg_id, 100 + c_custkey % 3 AS marketing_program_number FROM @customer
"""
VIEWS["opened_mails"] = """
SELECT 'w' || CAST(o_custkey AS STRING) AS user_id, o_orderdate AS ts, 'C' || CAST(o_orderkey % 2 AS STRING) AS country_code,
  CASE WHEN o_orderkey % 5 = 0 THEN TIMESTAMP '2001-12-31 00:00:00' ELSE o_orderdate END AS loaded_at
FROM @orders
"""
VIEWS["source_audiences"] = """
SELECT 'Source ' || CAST(n_nationkey % 6 AS STRING) AS audience_name, CAST(n_nationkey % 10 AS STRING) AS source_id,
  CASE WHEN n_nationkey % 4 <> 1 THEN CAST(CAST(1997 + n_nationkey % 5 AS STRING) || '-03-01' AS TIMESTAMP) END AS first_at,
  CASE WHEN n_nationkey % 4 <> 2 THEN CAST(CAST(2000 + n_nationkey % 2 AS STRING) || '-11-15' AS TIMESTAMP) END AS last_at
FROM @nation
"""
VIEWS["target_source_audiences"] = """
SELECT 'Source ' || CAST(n_nationkey % 7 AS STRING) AS audience_name, CAST(n_nationkey % 10 AS STRING) AS source_id,
  CASE WHEN n_nationkey % 4 <> 1 THEN CAST(CAST(2020 + n_nationkey % 5 AS STRING) || '-05-01' AS TIMESTAMP) END AS first_at,
  CASE WHEN n_nationkey % 4 <> 2 THEN CAST(CAST(2022 + n_nationkey % 4 AS STRING) || '-05-01' AS TIMESTAMP) END AS last_at
FROM @nation
"""
VIEWS["unmerge"] = "SELECT CASE WHEN c_custkey % 8 = 0 THEN 'w' ELSE 'none' END || CAST(c_custkey AS STRING) AS id_value FROM @customer"

VIEWS["changed_opts"] = """
SELECT 'w' || CAST(o_custkey AS STRING) AS user_id, o_orderkey AS ok,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN '12_34' ELSE '77_1' END AS opt_id,
  CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 50 END AS email_subscription_opt_number,
  CASE WHEN o_orderkey % 3 = 0 THEN CASE WHEN o_orderkey % 21 = 0 THEN 'Universal' ELSE 'S' || CAST(o_orderkey % 4 AS STRING) END END AS email_subscription_service_name,
  CASE WHEN o_orderkey % 3 = 1 THEN o_orderkey % 7 END AS phone_subscription_opt_number,
  CASE WHEN o_orderkey % 6 = 1 THEN 'P' || CAST(o_orderkey % 2 AS STRING) END AS phone_subscription_service_name,
  CASE WHEN o_orderkey % 6 = 2 THEN CASE WHEN o_orderkey % 12 = 2 THEN 9999 ELSE o_orderkey % 5 END END AS postal_subscription_opt_number,
  CAST(NULL AS STRING) AS postal_subscription_service_name,
  CAST(NULL AS BIGINT) AS social_subscription_opt_number, CASE WHEN o_orderkey % 12 = 5 THEN 'SO' END AS social_subscription_service_name,
  CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END AS opt_indicator,
  o_orderdate AS ts, o_orderdate AS loaded_at
FROM @orders
"""

VIEWS["id_graphs"] = """
SELECT 'u' || CAST(CAST(floor(c_custkey / 10) AS BIGINT) AS STRING) AS id_value, 'userId' AS id_type,
       'p' || CAST(c_custkey - c_custkey % 3 AS STRING) AS pg_id, 100 + c_nationkey AS marketing_program_number
FROM @customer
UNION ALL
SELECT 'E' || CAST(c_custkey - c_custkey % 2 AS STRING) || '@Mail.org', 'email', 'p' || CAST(c_custkey - c_custkey % 3 AS STRING), 100 + c_nationkey
FROM @customer
"""
VIEWS["profile_aliases"] = """
SELECT 'p' || CAST(o_custkey AS STRING) AS pg_id, 'p' || CAST(o_custkey - o_custkey % 5 AS STRING) AS canonical_pg_id,
       't' || CAST(o_orderkey AS STRING) AS trace_id, date_trunc('month', o_orderdate) AS last_updated_date
FROM @orders
"""
VIEWS["id_aliases"] = """
SELECT 'p' || CAST(o_custkey AS STRING) AS pg_id, 'p' || CAST(o_custkey - o_custkey % 5 AS STRING) AS canonical_pg_id,
       't' || CAST(o_orderkey AS STRING) AS trace_id, date_trunc('year', o_orderdate) AS created_date
FROM @orders
"""
VIEWS["profile_traits"] = """
SELECT 'p' || CAST(o_custkey AS STRING) AS pg_id, l_partkey % 8 AS trait_id, o_custkey * 100 + l_linenumber AS consumerid_sourceid_mpn,
  CASE l_partkey % 8 WHEN 0 THEN 'email' WHEN 1 THEN 'userId' WHEN 2 THEN 'gender' WHEN 3 THEN 'registrationDate' WHEN 4 THEN 'countryCode'
    WHEN 5 THEN 'emailValidContactPointIndicator' WHEN 6 THEN 'optCorporate' ELSE 'optFamily' END AS trait_name,
  CASE l_partkey % 8 WHEN 0 THEN CASE WHEN o_custkey % 13 = 0 THEN ' ' ELSE 'e' || CAST(o_custkey AS STRING) || '@mail.org' END
    WHEN 1 THEN 'u' || CAST(CAST(floor(o_custkey / 10) AS BIGINT) AS STRING) WHEN 2 THEN CASE WHEN l_returnflag = 'R' THEN 'F' ELSE 'M' END
    WHEN 3 THEN CAST(2019 + l_linenumber AS STRING) || '-05-01' WHEN 4 THEN 'C1' WHEN 5 THEN CASE WHEN l_linestatus = 'O' THEN 'Y' ELSE 'N' END
    ELSE CASE WHEN l_returnflag = 'N' THEN 'true' ELSE 'false' END END AS trait_value,
  100 + o_custkey % 2 AS marketing_program_number, l_shipdate AS trait_consumer_last_updated_date,
  CASE WHEN l_linenumber % 2 = 0 THEN l_shipdate END AS trait_expiration_date, o_orderdate AS last_updated_date,
  't' || CAST(o_orderkey AS STRING) AS trace_id
FROM @lineitem JOIN @orders ON l_orderkey = o_orderkey
"""
# The same with the source id of every customer as one more trait.
VIEWS["profile_traits_sources"] = """
SELECT pg_id, trait_id, consumerid_sourceid_mpn, trait_name, trait_value, marketing_program_number, trait_consumer_last_updated_date, trait_expiration_date, last_updated_date, trace_id
FROM @profile_traits
UNION ALL
SELECT 'p' || CAST(c_custkey AS STRING), 8, c_custkey * 100, 'sourceId', CAST(c_custkey % 10 AS STRING), 100 + c_custkey % 2, TIMESTAMP '2000-01-01 00:00:00',
  CAST(NULL AS TIMESTAMP), TIMESTAMP '2000-01-01 00:00:00', 's' || CAST(c_custkey AS STRING)
FROM @customer
"""
VIEWS["profile_events"] = """
SELECT 't' || CAST(event_id AS STRING) AS trace_id, 'p' || CAST(user_id AS STRING) AS pg_id, 100 + user_id % 2 AS marketing_program_number,
  CASE event_type WHEN 'click' THEN 'Email Opened' WHEN 'purchase' THEN 'Receipt Verified' ELSE event_type END AS event_name, ts AS event_date
FROM @events
"""
VIEWS["event_properties"] = """
SELECT CASE WHEN event_id % 3 <> 0 THEN 't' ELSE 'none' END || CAST(event_id AS STRING) AS trace_id, 'countryCode' AS property_name, 'C1' AS property_value FROM @events
"""

VIEWS["trait"] = """
SELECT DISTINCT p_partkey % 40 AS traitId,
  CASE p_partkey % 5 WHEN 0 THEN 'email' WHEN 1 THEN 'phone' WHEN 2 THEN 'regul' ELSE 'pet' END || 'Trait'
    || CASE WHEN p_partkey % 40 % 3 = 0 THEN 'OptIndicator' WHEN p_partkey % 40 % 3 = 1 THEN 'Cdp' ELSE '' END || CAST(p_partkey % 40 AS STRING) AS traitName
FROM @part
"""
VIEWS["eco_system_trait"] = """
SELECT DISTINCT p_partkey % 40 AS traitId, CASE p_partkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 4 WHEN 2 THEN 5 ELSE 10 END AS ecoSystemId,
  CASE p_partkey % 40 WHEN 0 THEN 'email' WHEN 1 THEN 'phoneNumber' WHEN 4 THEN 'gender' WHEN 3 THEN 'ratio' WHEN 6 THEN 'car_colour'
    WHEN 10 THEN 'trait_petkind' WHEN 14 THEN 'carcolourtwo' ELSE 'eco' || CAST(p_partkey % 40 AS STRING) END
    || CASE WHEN p_partkey % 40 = 39 THEN 'Corporate' WHEN p_partkey % 40 = 27 THEN 'Family' ELSE '' END AS ecoTraitName
FROM @part
"""
VIEWS["trait_alias"] = """
SELECT DISTINCT CASE WHEN p_partkey % 40 < 20 THEN 0 ELSE 1000 END + p_partkey % 40 AS trait_id, CASE p_partkey % 40 WHEN 7 THEN 'spaceTrait' WHEN 9 THEN 'registrationDate' WHEN 12 THEN 'trait_pet_kind'
  ELSE 'alias' || CAST(p_partkey % 40 AS STRING) END AS alias
FROM @part
"""
VIEWS["crs_aliases"] = """
SELECT DISTINCT CASE p_partkey % 40 WHEN 0 THEN 'gender' ELSE 'name' || CAST(p_partkey % 40 AS STRING) END AS traitName,
  CASE p_partkey % 40 WHEN 0 THEN 'sexAlias' ELSE 'alias' || CAST(p_partkey % 40 AS STRING) END AS alias
FROM @part
"""
VIEWS["trait_map"] = """
SELECT DISTINCT p_partkey % 40 AS traitId, CASE p_partkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 4 WHEN 2 THEN 5 ELSE 10 END AS ecoSystemId,
  100 + p_partkey % 5 AS marketingProgramId
FROM @part
"""
VIEWS["contact_point_type"] = """
SELECT DISTINCT CASE r_regionkey % 5 WHEN 0 THEN 'E' WHEN 1 THEN 'P' WHEN 2 THEN 'A' WHEN 3 THEN 'S' ELSE 'R' END AS contact_point_type_code,
  CASE r_regionkey % 5 WHEN 0 THEN 'email' WHEN 1 THEN 'phone' WHEN 2 THEN 'postal' WHEN 3 THEN 'social' ELSE 'regulatory' END AS contact_point_type_name
FROM @region
"""
VIEWS["contact_point_category"] = """
SELECT DISTINCT CASE r_regionkey % 5 WHEN 0 THEN 'EP' WHEN 1 THEN 'PM' WHEN 2 THEN 'AR' WHEN 3 THEN 'OT' ELSE 'PS' END AS contact_point_category_code,
  CASE r_regionkey % 5 WHEN 0 THEN 'E' WHEN 1 THEN 'P' WHEN 2 THEN 'A' WHEN 3 THEN 'S' ELSE 'R' END AS contact_point_type_code
FROM @region
"""
VIEWS["program_service"] = """
SELECT DISTINCT cdp_marketing_program_number AS marketing_program_number, CASE WHEN CAST(subscription_opt_number AS INT) % 7 <> 0 THEN '' ELSE 'none' END || service_name AS service_name FROM @opt_map
"""
VIEWS["service_traits"] = """
SELECT DISTINCT 'S' || CAST(p_partkey % 4 AS STRING) AS service_name, p_partkey % 40 AS trait_id_opt_indicator, CAST((p_partkey + 3) % 40 AS STRING) AS trait_id_opt_date
FROM @part
"""
VIEWS["consents"] = """
SELECT 't' || CAST(o_custkey AS STRING) AS trace_id, o_orderkey AS opt_id, CAST(100 + o_custkey % 25 AS STRING) AS marketing_program_number,
  'c' || CAST(o_custkey AS STRING) AS consumer_id, o_custkey % 10 AS source_id, 'e' || CAST(o_custkey AS STRING) || '@mail.org' AS email,
  CASE WHEN o_orderkey % 9 = 0 THEN 'NULL' ELSE '+1' || CAST(o_custkey AS STRING) END AS phone_number, 'C1' AS country_code, '3' AS legal_entity_id,
  'email' AS contact_point_type_name, 'S' || CAST(o_orderkey % 4 AS STRING) AS service_name, o_orderkey % 50 AS opt_number,
  CASE WHEN o_orderkey % 9 = 0 THEN 'NULL' ELSE o_orderpriority END AS opt_text, o_orderdate AS opt_date, o_orderstatus AS opt_status,
  'false' AS initial_opt_status, 'x' || CAST(o_orderkey % 3 AS STRING) AS opt_reason, 'src' AS source_system,
  'i' || CAST(o_custkey AS STRING) AS id_value
FROM @orders
"""
VIEWS["profile_consents"] = "SELECT CASE WHEN c_custkey % 3 <> 1 THEN 't' ELSE 'none' END || CAST(c_custkey AS STRING) AS trace_id FROM @customer"
VIEWS["id_map1"] = """
SELECT CASE WHEN c_custkey % 4 = 0 THEN 'p' ELSE 'none' END || CAST(c_custkey AS STRING) AS pre_prod_pg_id, CASE WHEN c_custkey % 20 = 0 THEN NULL ELSE 'n' || CAST(c_custkey AS STRING) END AS new_pg_id
FROM @customer
"""
VIEWS["id_map2"] = """
SELECT CASE WHEN c_custkey % 6 = 0 THEN 'p' ELSE 'none' END || CAST(c_custkey AS STRING) AS pre_prod_pg_id, 'n' || CAST(c_custkey AS STRING) AS new_pg_id FROM @customer
"""
VIEWS["dlq"] = """
SELECT '{"servicePayload":{"id":' || CAST(event_id AS STRING) || ',"kind":"' || event_type || '"},"other":1}' AS data, ts AS publish_time, event_id
FROM @events WHERE event_type = 'error'
"""
VIEWS["replay_table"] = """
SELECT 'm' || CAST(event_id AS STRING) AS message_id, CAST(100 + user_id % 25 AS STRING) AS mpn, 't' || CAST(event_id AS STRING) AS trace_id,
  '{"servicePayload":{"id":' || CAST(event_id AS STRING) || '}}' AS raw_payload, 'topic' || CAST(event_id % 3 AS STRING) AS replay_topic,
  CASE WHEN event_id % 4 = 0 THEN 'Replayed' ELSE 'ToBeReplayed' END AS replay_status,
  CASE WHEN event_id % 4 = 0 THEN ts END AS replay_time, event_id
FROM @events WHERE event_type = 'error'
"""
VIEWS["replay_updates"] = """
SELECT CASE WHEN event_id % 3 = 0 THEN 'm' ELSE 'none' END || CAST(event_id AS STRING) AS message_id, 't' || CAST(event_id AS STRING) AS trace_id,
  CASE WHEN event_id % 5 = 0 THEN 'ToBeReplayed' ELSE 'Replayed' END AS replay_status, TIMESTAMP '2024-02-01 00:00:00' AS replay_time
FROM @events WHERE event_type = 'error'
"""
VIEWS["traces"] = """
SELECT 't' || CAST(event_id AS STRING) AS trace_id, 'web' AS pipeline_origin, ts AS received_date, 'acc' || CAST(user_id % 5 AS STRING) AS account_id,
  '{"requestTimestamp":"' || CASE WHEN event_id % 3 = 0 THEN substr(@iso(ts), 1, 19) || 'Z' ELSE substr(@iso(ts), 1, 23) || '123Z' END || '","data":{"traits":[{"traitName":"firstName","values":"n'
    || CAST(user_id AS STRING) || '"},{"traitName":"other","values":1}' || CASE WHEN event_id % 2 = 0 THEN ',{"traitName":"birthDate","values":"2000-01-01"}' ELSE '' END
    || '],"opts":[1],"ids":{"a":1}}}' AS raw_payload, event_id, user_id
FROM @events
"""
VIEWS["requests"] = """
SELECT 'u' || CAST(c_custkey AS STRING) AS user_ids, 'p' || CAST(c_custkey AS STRING) AS pg_ids, c_custkey AS ck FROM @customer
"""
VIEWS["contacts"] = """
SELECT 'r' || CAST(c_custkey AS STRING) AS record_id, 'E' || CAST(c_custkey AS STRING) || '@MAIL.org' AS email, DATE '2020-01-01' AS account_created_on FROM @customer
"""
VIEWS["aliases_a"] = "SELECT CASE WHEN c_custkey % 2 = 0 THEN 'u' ELSE 'none' END || CAST(c_custkey % 150 AS STRING) AS user_id, 'old' || CAST(c_custkey AS STRING) AS previous_id FROM @customer"
VIEWS["aliases_b"] = "SELECT CASE WHEN c_custkey % 3 = 0 THEN 'u' ELSE 'none' END || CAST(c_custkey % 150 AS STRING) AS user_id, 'old' || CAST(c_custkey AS STRING) AS previous_id FROM @customer"

_ISO = re.compile(r"@iso\((\w+)\)")
_REF = re.compile(r"@(\w+)")


def _order(names: list[str]) -> list[str]:
    """Views needed by ``names``, each after the views it reads."""
    done: list[str] = []

    def visit(name: str) -> None:
        if name in done or name not in VIEWS:
            return
        for ref in _REF.findall(_ISO.sub("", VIEWS[name])):
            visit(ref)
        done.append(name)

    for name in names:
        visit(name)
    return done


def _render(sql: str, iso, table) -> str:
    def resolve(match: re.Match) -> str:
        name = match[1]
        return name if name in VIEWS else table(name) if name in TABLES else match[0]

    return _REF.sub(resolve, _ISO.sub(lambda m: iso(m[1]), sql))


def with_views(names: list[str]) -> str:
    """DuckDB ``WITH`` clause (without trailing comma) defining the views."""
    iso = lambda c: f"(strftime({c}, '%Y-%m-%dT%H:%M:%S.%g') || 'Z')"
    return "WITH " + ",\n".join(f"{n} AS ({_render(VIEWS[n], iso, lambda t: t)})" for n in _order(names))


# Rows of an events table for each task that builds payload texts, some 45 MB of text.
PAYLOADS_PER_TASK = 50_000


def _spread(spark: SparkSession, path: str) -> str:
    """A table dealt over tasks whose number follows from its rows: its narrow rows move, not the texts built from them."""
    parts = max(spark.sparkContext.defaultParallelism, -(-spark.read.parquet(path).count() // PAYLOADS_PER_TASK))
    return f"(SELECT /*+ REPARTITION({parts}) */ * FROM parquet.`{path}`)"


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same view as a Spark DataFrame over the Parquet tables."""
    iso = lambda c: f"date_format({c}, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\")"
    table = lambda t: f"parquet.`{sf_dir}/{t}.parquet`"
    spread = lambda t: _spread(spark, f"{sf_dir}/{t}.parquet")
    needed = _order([name])
    if not needed:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    ctes = ",\n".join(f"{n} AS ({_render(VIEWS[n], iso, spread if n == 'pl_keys' else table)})" for n in needed)
    return spark.sql(f"WITH {ctes} SELECT * FROM {name}")
