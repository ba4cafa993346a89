"""Validation rules and failure routing."""

from pyspark.sql import functions as F

from checks.q_enrich import S
from checks.registry import AS_OF, NOW, branches, check, message_id
from passerine.functions.values import root_text
from passerine.operators import validate
from passerine.plans import staging

COLS = "message_id, mpn, dq_validation_id, dq_validation_description, error_details"
MCPC = "'MCPC' AS dq_validation_id"
# Program number as the schema rules see it: the first one that is text.
SV = S + ", v AS (SELECT *, CASE WHEN NOT xmpn_num THEN xmpn END AS smpn FROM s WHERE NOT coalesce(xmpn = '9999', FALSE))"


def shape(df):
    return df.select("message_id", "mpn", "dq_validation_id", "dq_validation_description", "error_details")


STRINGS = """
SELECT message_id, smpn AS mpn, 'MCPC' AS dq_validation_id, 'Validate If timestamp is null in Payload' AS dq_validation_description, 'FIELD_NULL timestamp name is null or not with string datatype' AS error_details FROM v WHERE e % 29 = 1
UNION ALL SELECT message_id, smpn, 'MCPC', 'Validate If timestamp is having valid datatype in Payload', 'INVALID_DATATYPE: timestamp is having invalid datatype' FROM v WHERE e % 29 = 2
UNION ALL SELECT message_id, smpn, 'MCPC', 'Validate If timestamp is in valid format in Payload', 'INVALID_FORMAT: timestamp name is not present in proper string format' FROM v WHERE e % 29 = 3
"""


@check("vld_schema_strings", ["pl_blocks"], SV + STRINGS)
def _(i):
    return shape(validate.vld_schema_strings(i.payloads(), NOW))


EXTERNAL = """
SELECT message_id, smpn AS mpn, 'MCPC' AS dq_validation_id, 'Validate If marketingProgramNumber is having valid datatype in Payload' AS dq_validation_description, 'INVALID DATATYPE: marketingProgramNumber is having invalid datatype' AS error_details FROM v WHERE xmpn_num
UNION ALL SELECT message_id, smpn, 'MCPC', 'Validate if marketingProgramNumber exists in Payload', 'FIELD_NOT_FOUND: marketingProgramNumber Missing in External Id Block' FROM v WHERE xmpn IS NULL
UNION ALL SELECT message_id, smpn, 'MCPC', 'Validate If sourceId is null in Payload', 'FIELD_NULL: sourceId is null' FROM v WHERE xsrc = ''
UNION ALL SELECT message_id, smpn, 'MCPC', 'Validate If sourceId is in valid format in Payload', 'INVALID_FORMAT: sourceId with value S-x is not expected value for this field' FROM v WHERE xsrc = 'S-x'
UNION ALL SELECT message_id, smpn, 'MCPC', 'Validate if sourceId exists in Payload', 'FIELD_NOT_FOUND: sourceId Missing in External Id Block' FROM v WHERE xsrc IS NULL
UNION ALL SELECT message_id, smpn, 'MCPC', 'Validate If consumerId is null in Payload', 'FIELD_NULL: consumerId is null' FROM v WHERE xcons = ''
UNION ALL SELECT message_id, smpn, 'MCPC', 'Validate if consumerId exists in Payload', 'FIELD_NOT_FOUND: consumerId Missing in External Id Block' FROM v WHERE xcons IS NULL AND NOT (tp AND toff IS NOT NULL)
UNION ALL SELECT message_id, smpn, 'MCPC', 'Validate If loyaltyAccountNumber is in valid format in Payload', 'INVALID_FORMAT: loyaltyAccountNumber with value bad#1 is not expected value for this field' FROM v WHERE xloy = 'bad#1'
"""


@check("vld_schema_external_ids", ["pl_blocks"], SV + EXTERNAL)
def _(i):
    return shape(validate.vld_schema_external_ids(i.payloads(), NOW))


PROPS = """
SELECT message_id, smpn AS mpn, 'OCPC' AS dq_validation_id, 'Validate If optId is in valid format in Payload' AS dq_validation_description, 'INVALID_FORMAT: optId with value bad is not expected value for this field' AS error_details FROM v WHERE is_opt AND opt_id = 'bad'
UNION ALL SELECT message_id, smpn, 'OCPC', 'Validate If initialOptStatus is in valid format in Payload', 'INVALID_FORMAT: initialOptStatus with value maybe is not expected value for this field' FROM v WHERE is_opt AND init_status = 'maybe'
UNION ALL SELECT message_id, smpn, 'OCPC', 'Validate If optStatus is in valid format in Payload', 'INVALID_FORMAT: optStatus with value no is not expected value for this field' FROM v WHERE is_opt AND opt_status = 'no'
"""


@check("vld_schema_properties", ["pl_blocks"], SV + PROPS)
def _(i):
    return shape(validate.vld_schema_properties(i.payloads(), NOW))


VLD2 = """
SELECT message_id, '147' AS mpn, 'VLD2' AS dq_validation_id, 'Validate if mpn and country combination exists in CRS' AS dq_validation_description,
  'marketingProgramNumber-' || xmpn || ' And countryCode-' || xcc AS error_details
FROM s WHERE xmpn IS NOT NULL AND xcc IS NOT NULL AND NOT EXISTS (SELECT 1 FROM crs_program q WHERE q.mpn = xmpn AND q.country_code = xcc)
"""
VLD3 = """
SELECT message_id, '147' AS mpn, 'VLD3' AS dq_validation_id, 'Validate if mpn is Active from CRS (active means available)' AS dq_validation_description, 'marketingProgramNumber-' || xmpn AS error_details
FROM s WHERE xmpn IS NOT NULL AND xmpn NOT IN (SELECT mpn FROM crs_program)
"""
VLD4 = """
SELECT message_id, '147' AS mpn, 'VLD4' AS dq_validation_id, 'Loyalty account number can be alpha numeric and opt Ip address is optional field' AS dq_validation_description, 'loyaltyAccountNumber ' || xloy AS error_details
FROM s WHERE xloy = 'bad#1'
"""
VLD5 = """
SELECT message_id, '147' AS mpn, 'VLD5' AS dq_validation_id, 'Either of optId , opt number or opt service name is required field' AS dq_validation_description,
  'optId/SubscriptionOptNumber/SubscriptionServiceName is either missing /wrong ' AS error_details
FROM s WHERE is_opt AND opt_id IS NULL AND NOT (typed_ep AND ch_email)
"""
VLD6 = """
SELECT message_id, '147' AS mpn, 'VLD6' AS dq_validation_id, 'The Universal request with mpn 9999 should have legalEntity trait' AS dq_validation_description, 'legalEntity trait is missing' AS error_details
FROM (SELECT *, unnest(range(CASE WHEN typed_ep AND ch_email AND svc = 'Universal' THEN CAST(has_empty_ext AS INT) + CAST(xmpn IS NOT NULL AS INT) + CAST(xsrc IS NOT NULL AS INT) + CAST(NOT xmail_absent AS INT)
   + CAST(xcons IS NOT NULL AS INT) + CAST(xcc IS NOT NULL AS INT) + CAST(xloy IS NOT NULL AS INT) + CAST(xphone IS NOT NULL AS INT) ELSE CAST(coalesce(xmpn = '9999', FALSE) AS INT) END)) AS k FROM s WHERE is_opt AND legal_no IS NULL)
"""


def refs(i):
    return {"program": i.crs_program}


@check("vld2_mpn_country", ["pl_blocks", "crs_program"], S + VLD2)
def _(i):
    return shape(validate.vld2_mpn_country(i.payloads(), i.crs_program, "147", NOW))


@check("vld3_mpn_active", ["pl_blocks", "crs_program"], S + VLD3)
def _(i):
    return shape(validate.vld3_mpn_active(i.payloads(), i.crs_program, "147", NOW))


@check("vld4_loyalty_alnum", ["pl_blocks"], S + VLD4)
def _(i):
    return shape(validate.vld4_loyalty_alnum(i.payloads(), "147", NOW))


@check("vld5_opt_identity", ["pl_blocks"], S + VLD5)
def _(i):
    return shape(validate.vld5_opt_identity(i.payloads(), "147", NOW))


@check("vld6_universal_legal_entity", ["pl_blocks"], S + VLD6)
def _(i):
    return shape(validate.vld6_universal_legal_entity(i.payloads(), "147", NOW))


# Supplied opt fields of the fixture: opt id, e-mail service and number (category and type keys are absent).
VLD7 = """
o AS (SELECT *, CASE WHEN ch_email THEN svc END AS sv, CASE WHEN ch_email THEN enum END AS nu FROM s WHERE is_opt AND tmpn IS NOT NULL AND NOT tmpn_num),
m AS (SELECT DISTINCT * FROM opt_map),
sc AS (SELECT o.e, o.message_id, o.xmpn, o.opt_id, sv, nu, m.*, coalesce(o.opt_id = m.ciam_opt_id, FALSE) AS h1, coalesce(sv = m.service_name, FALSE) AS h2, coalesce(nu = m.subscription_opt_number, FALSE) AS h3
   FROM o JOIN m ON m.cdp_marketing_program_number = tmpn WHERE (o.opt_id IS NOT NULL OR sv IS NOT NULL OR nu IS NOT NULL)),
rk AS (SELECT *, CAST(h1 AS INT) + CAST(h2 AS INT) + CAST(h3 AS INT) AS hits, CAST(opt_id IS NOT NULL AS INT) + CAST(sv IS NOT NULL AS INT) + CAST(nu IS NOT NULL AS INT) AS given,
   row_number() OVER (PARTITION BY e ORDER BY CAST(h1 AS INT) + CAST(h2 AS INT) + CAST(h3 AS INT) DESC, ciam_opt_id, service_name, subscription_opt_number, contact_point_category_code, contact_point_type_code) AS rn FROM sc),
v7 AS (SELECT message_id, coalesce(xmpn, '') AS mpn, 'VLD7' AS dq_validation_id, 'Validate if MPN Opts combination exists In CRS' AS dq_validation_description,
  '{"matched_values":[' || array_to_string(list_filter([CASE WHEN h1 THEN '"ciam_opt_id"' END, CASE WHEN h2 THEN '"service_name"' END, CASE WHEN h3 THEN '"subscription_opt_number"' END], lambda x: x IS NOT NULL), ',')
  || '],"unmatched_values":[' || array_to_string(list_filter([CASE WHEN NOT h1 AND opt_id IS NOT NULL THEN '"ciam_opt_id"' END, CASE WHEN NOT h2 AND sv IS NOT NULL THEN '"service_name"' END, CASE WHEN NOT h3 AND nu IS NOT NULL THEN '"subscription_opt_number"' END], lambda x: x IS NOT NULL), ',') || ']}' AS error_details
 FROM rk WHERE rn = 1 AND hits < given)
"""


@check("vld7_opts_combination", ["pl_blocks", "opt_map"], S + "," + VLD7 + f"SELECT {COLS} FROM v7")
def _(i):
    return shape(validate.vld7_opts_combination(i.payloads(), i.opt_map, NOW))


VLD8 = """
SELECT message_id, coalesce(xmpn, '') AS mpn, 'VLD8' AS dq_validation_id, 'Validate if Consumer ID exists in Payload or not(Payloads wont be blocked)' AS dq_validation_description,
  coalesce(xsrc, 'Source Id Not Found In Payload') AS error_details
FROM s WHERE has_ids AND (xcons IS NULL OR e % 6 = 0) AND e % 29 > 3 AND CAST(substr(iso, 1, 10) AS DATE) >= DATE '2024-01-01'
"""


@check("vld8_consumer_id", ["pl_blocks"], S + VLD8)
def _(i):
    return shape(validate.vld8_consumer_id(i.payloads(), AS_OF, NOW))


VLD9 = """
SELECT message_id, xmpn AS mpn, 'VLD9' AS dq_validation_id, 'Validate if Source Id MPN Combination exists in CRS' AS dq_validation_description,
  '{"sourceId":' || coalesce('"' || xsrc || '"', 'null') || ',"marketingProgramNumber":' || coalesce('"' || xmpn || '"', 'null') || '}' AS error_details
FROM s WHERE NOT coalesce(xmpn = '9999', FALSE) AND (coalesce(xsrc <> '', FALSE) OR xmpn IS NOT NULL)
  AND NOT EXISTS (SELECT 1 FROM crs_source q WHERE CAST(q.source_id AS STRING) = xsrc AND q.mpn = xmpn AND NOT xmpn_num)
"""


def source_map(i):
    return i.crs_source.select("source_id", "mpn")


@check("vld9_source_mpn", ["pl_blocks", "crs_source"], S + VLD9)
def _(i):
    return shape(validate.vld9_source_mpn(i.payloads(), source_map(i), NOW))


VLD10 = """
SELECT message_id, coalesce(xmpn, '') AS mpn, 'VLD10' AS dq_validation_id, 'Validate if originalTimestamp or timestamp exists in Payload' AS dq_validation_description,
  CASE WHEN ots IS NULL THEN 'originalTimestamp Not Found' ELSE 'timestamp Not Found' END AS error_details
FROM s WHERE ots IS NULL OR tst IS NULL OR tst = ''
"""


@check("vld10_timestamps", ["pl_blocks"], S + VLD10)
def _(i):
    return shape(validate.vld10_timestamps(i.payloads(), NOW))


CHAIN = SV + "," + VLD7 + f""",
schema_f AS ({STRINGS} UNION ALL {EXTERNAL} UNION ALL {PROPS}),
rule_f AS (SELECT {COLS} FROM v7 UNION ALL {VLD8} UNION ALL {VLD9} UNION ALL {VLD10}),
rules_only AS (SELECT * FROM rule_f WHERE message_id NOT IN (SELECT message_id FROM schema_f)),
blocking AS (SELECT message_id FROM rules_only GROUP BY message_id HAVING count(*) > 1 OR min(dq_validation_id) <> 'VLD8'),
failed AS (SELECT * FROM schema_f UNION ALL SELECT r.* FROM rules_only r JOIN blocking USING (message_id))
"""


@check("validation_chain", ["pl_blocks", "opt_map", "crs_source"], CHAIN + f"""
SELECT {COLS} FROM failed UNION ALL SELECT message_id, NULL, 'passed', NULL, NULL FROM s WHERE message_id NOT IN (SELECT message_id FROM failed)
""")
def _(i):
    passed, failed = validate.validation_chain(i.payloads(), i.opt_map, source_map(i), AS_OF, NOW, staging.shared_stage(i.spark))
    none = lambda n: F.lit(None).cast("string").alias(n)
    ok = passed.select(message_id(), none("mpn"), F.lit("passed").alias("dq_validation_id"), none("dq_validation_description"), none("error_details"))
    return shape(failed).unionByName(ok)


@check("split_by_validation", ["pl_blocks", "opt_map", "crs_source"], CHAIN + """
SELECT message_id, CASE WHEN message_id IN (SELECT message_id FROM failed) THEN 'failed' ELSE 'passed' END AS branch FROM s
""")
def _(i):
    passed, failed = validate.validation_chain(i.payloads(), i.opt_map, source_map(i), AS_OF, NOW, staging.shared_stage(i.spark))
    return branches(passed=passed).unionByName(failed.select("message_id", F.lit("failed").alias("branch")).distinct())


@check("clean_insert", ["pl_blocks", "crs_program"], S + f", bad AS ({VLD2} UNION ALL {VLD3}) SELECT message_id FROM s WHERE message_id NOT IN (SELECT message_id FROM bad)")
def _(i):
    table = i.payloads().withColumn("message_id", root_text("messageId"))
    bad = validate.batch_rules(table.drop("message_id"), refs(i), "147", NOW, ("vld2", "vld3"))
    return validate.clean_insert(table.select("message_id"), bad)


@check("run_rule", ["pl_blocks", "crs_program"], S + " ".join(
    (" UNION ALL " if n else "") + f"SELECT * FROM ({sql})" for n, sql in enumerate((VLD2, VLD3, VLD4, VLD5, VLD6))))
def _(i):
    return shape(validate.batch_rules(i.payloads(), refs(i), "147", NOW, ("vld2", "vld3", "vld4", "vld5", "vld6")))
