"""Hand-written cases of rules, identity, delivery and staging."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from checks.registry import AS_OF, NOW, Inputs
from checks.senders import fail_when_last_digit_in
from passerine.operators import identity, joins, route, service_payloads, validate
from passerine.payload import parse_payloads
from passerine.plans import audience, delivery, migration, staging
from passerine.sinks import writers
from passerine.sources import readers
from tests.helpers import ext, payloads


def rules(df):
    return sorted((r["dq_validation_id"], r["error_details"]) for r in df.collect())


def test_schema_rules_look_at_entries_before_the_first_good_one(spark):
    doc = {"messageId": "m", "event": "a b", "timestamp": "2024-01-01T00:00:00.1Z",
           "context": ext(("marketingProgramNumber", "x1"), ("marketingProgramNumber", ""), ("marketingProgramNumber", "5"), ("marketingProgramNumber", 6),
                          ("sourceId", 5), ("consumerId", "ok"))}
    got = rules(validate.vld_schema_external_ids(payloads(spark, doc), NOW))
    assert got == [
        ("MCPC", "FIELD_NULL: marketingProgramNumber is null"),
        ("MCPC", "INVALID DATATYPE: sourceId is having invalid datatype"),
        ("MCPC", "INVALID_FORMAT: marketingProgramNumber with value x1 is not expected value for this field"),
    ]
    assert rules(validate.vld_schema_strings(payloads(spark, doc), NOW)) == []


def test_schema_rules_skip_the_universal_program(spark):
    doc = {"messageId": "m", "event": "", "context": ext(("marketingProgramNumber", "9999"))}
    for rule in (validate.vld_schema_strings, validate.vld_schema_external_ids, validate.vld_schema_properties):
        assert rule(payloads(spark, doc), NOW).count() == 0


def test_property_families(spark):
    doc = {"messageId": "m", "type": "track", "context": ext(("marketingProgramNumber", "1")), "properties": {
        "emailSubscriptionOptNumber": "12", "xOptNumber": 12, "optId": "1_2", "optChoiceDate": "2024-01-01", "collectedDate": "2024-01-01T00:00:00.0Z",
        "optStatus": "True", "initialOptStatus": None}}
    got = [r["error_details"] for r in validate.vld_schema_properties(payloads(spark, doc), NOW).collect()]
    assert len(got) == 3 and any("xOptNumber with value 12" in g for g in got) and any("optChoiceDate" in g for g in got) and any("None" in g for g in got)


def test_best_opt_match_is_reported_first_wins(spark):
    opt_map = spark.createDataFrame(
        [("501", "1_1", "A", "1", "E", "EP"), ("501", "1_2", "B", "1", "E", "EP")],
        "cdp_marketing_program_number string, ciam_opt_id string, service_name string, subscription_opt_number string, contact_point_type_code string, contact_point_category_code string")
    doc = lambda **p: {"messageId": "m", "event": "Changed Opt Status", "properties": {"marketingProgramNumber": "501", **p}, "context": ext(("marketingProgramNumber", "501"))}
    run = lambda d: rules(validate.vld7_opts_combination(payloads(spark, d), opt_map, NOW))
    assert run(doc(optId="1_2", emailSubscriptionServiceName="B")) == []
    assert run(doc(optId="1_1", emailSubscriptionServiceName="B")) == [
        ("VLD7", json.dumps({"matched_values": ["ciam_opt_id"], "unmatched_values": ["service_name"]}, separators=(",", ":")))]
    assert run(doc()) == [] and run(doc(optId="9", emailSubscriptionOptNumber="9999")) == []
    unknown = doc(optId="9")
    unknown["properties"]["marketingProgramNumber"] = "1"
    assert run(unknown) == []


def test_best_opt_match_equals_comparing_every_row(spark):
    """Random signatures and opt rows with nulls, ties and repeats; a program of 100,000 rows that share a service."""
    import random

    fields = validate.OPT_MAP_FIELDS
    draw = random.Random(8)
    value = lambda: draw.choice([None, "a", "b", "c"])
    rows = [(draw.choice(["1", "2", None]), *(value() for _ in fields)) for _ in range(150)]
    sigs = list({(draw.choice(["1", "2", "9", None]), *(value() for _ in fields)) for _ in range(400)})
    big = spark.range(100_000).selectExpr("'77' as cdp_marketing_program_number", "cast(id as string) as ciam_opt_id", "'S' as service_name", "cast(id % 10 as string) as subscription_opt_number", "'E' as contact_point_category_code", "cast(null as string) as contact_point_type_code")
    opt_map = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in ["cdp_marketing_program_number", *fields])).unionByName(big)
    sigs += [("77", None, "S", None, None, None), ("77", "5", "S", "6", "E", "x"), ("77", "none", None, None, None, None)]
    asked = spark.createDataFrame([(str(n), *s) for n, s in enumerate(sigs)], ", ".join(f"{c} string" for c in ["_opt_sig", "program", *fields]))
    got = {int(r._opt_sig): r._opt_matched for r in validate.best_opt_matches(asked, opt_map).collect()}
    order = lambda r: [(x is not None, x or "") for x in r]
    for n, (program, *values) in enumerate(sigs[:-3]):
        known = sorted({r[1:] for r in rows if r[0] == program is not None}, key=order)
        best = max(([k for k, v, x in zip(fields, values, r) if v is not None and v == x] for r in known), key=len, default=None)
        assert got.get(n) == best, (program, values)
    tail = [got[len(sigs) - k] for k in (3, 2, 1)]
    assert tail == [["service_name"], ["service_name", "subscription_opt_number", "contact_point_category_code"], []]


def test_lone_consumer_failure_passes(spark):
    opt_map = spark.createDataFrame([], "cdp_marketing_program_number string, ciam_opt_id string, service_name string, subscription_opt_number string, contact_point_type_code string, contact_point_category_code string")
    source_map = spark.createDataFrame([(7, "501")], "source_id bigint, mpn string")
    doc = {"messageId": "m", "event": "x", "timestamp": "2024-01-20T00:00:00.0Z", "originalTimestamp": "2024-01-20T00:00:00.0Z", "traits": {"offlineConsumerId": "o"},
           "context": ext(("marketingProgramNumber", "501"), ("sourceId", "7"))}
    passed, failed = validate.validation_chain(payloads(spark, doc), opt_map, source_map, AS_OF, NOW)
    assert (passed.count(), failed.count()) == (1, 0)
    late = {**doc, "context": ext(("marketingProgramNumber", "501"), ("sourceId", "8"))}
    passed, failed = validate.validation_chain(payloads(spark, late), opt_map, source_map, AS_OF, NOW)
    assert [r[0] for r in rules(failed)] == ["VLD8", "VLD9"] and passed.count() == 0


def test_clean_insert_keeps_rows_without_id(spark):
    rows = spark.createDataFrame([("a",), (None,), ("b",)], "message_id string")
    bad = spark.createDataFrame([("a",), (None,)], "message_id string")
    assert sorted(str(r[0]) for r in validate.clean_insert(rows, bad).collect()) == ["None", "b"]


def test_run_rule_rejects_unknown(spark):
    with pytest.raises(ValueError):
        validate.run_rule("vld99", payloads(spark, {"a": 1}), {}, "1", NOW)


def test_rewrites_and_merge_are_idempotent(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    once_ = identity.rewrite_pg_id({"profile_aliases": i.profile_aliases}, i.id_map1, i.id_map2)["profile_aliases"]
    twice = identity.rewrite_pg_id({"profile_aliases": once_}, i.id_map1, i.id_map2)["profile_aliases"]
    assert same(once_, twice)
    tagged = identity.rewrite_trace_id({"t": i.profile_events}, i.event_properties)["t"]
    assert same(tagged, identity.rewrite_trace_id({"t": tagged}, i.event_properties)["t"])
    merged = identity.merge_status(i.replay_table, i.replay_updates)
    assert same(merged, identity.merge_status(merged, i.replay_updates))
    assert same(identity.null_literal_cleanup(i.consents, "103", ["opt_text"]), identity.null_literal_cleanup(
        identity.null_literal_cleanup(i.consents, "103", ["opt_text"]), "103", ["opt_text"]))


def test_generated_columns_are_left_out(spark):
    table = spark.createDataFrame([("p1", "h")], "pg_id string, email_sha1_hash string")
    lookup = spark.createDataFrame([("p1", "n1")], "pre_prod_pg_id string, new_pg_id string")
    out = identity.rewrite_pg_id({"profiles": table}, lookup, lookup)["profiles"]
    assert out.columns == ["pg_id"] and out.first()[0] == "n1"


def test_empty_mapping_fails(spark):
    with pytest.raises(ValueError):
        identity.require_rows(spark.range(0), "id mapping")


def test_canonical_precedence(spark):
    users = spark.createDataFrame([("u1", "e1"), ("u2", "e2"), ("u3", None), ("u4", None)], "id string, email string")
    merged = lambda rows, key: spark.createDataFrame(rows, f"{key} string, canonical_pg_id string")
    canon = spark.createDataFrame([(u, "c" + u) for u in ("u1", "u2", "u3")], "previous_user_id string, canonical_user_id string")
    unmerge = spark.createDataFrame([("u2",), ("u3",)], "id_value string")
    out = joins.canonical_user(users, merged([("e1", "pe1"), ("e2", "pe2")], "email"), merged([("u1", "pu1")], "id"), unmerge, canon)
    assert dict(out.select("id", "user_id").collect()) == {"u1": "pu1", "u2": "pe2", "u3": "u3", "u4": "u4"}


def test_sender_failures_come_back_and_batches_are_bounded(spark, tmp_path):
    log = str(tmp_path)

    def factory():
        import os
        import uuid

        def send(items, topic):
            with open(os.path.join(log, uuid.uuid4().hex), "w") as f:
                f.write(f"{topic}:{len(items)}")
            return ["no" if x.endswith("3") else None for x in items]
        return send

    rows = spark.range(0, 2500, 1, 2).select(F.concat(F.lit("m"), F.col("id").cast("string")).alias("raw_payload"))
    failed = delivery.publish(rows, factory, batch=100)
    assert failed.count() == 250
    sizes = [int(p.read_text().split(":")[1]) for p in tmp_path.iterdir()]
    assert max(sizes) <= 100 and sum(sizes) == 2500


def test_observed_counts(spark):
    from pyspark.sql import Observation

    seen = Observation("sent")
    rows = spark.range(100).select(F.col("id").cast("string").alias("raw_payload"))
    sent = delivery.send_status(rows, "raw_payload", fail_when_last_digit_in("7"))
    delivery.observed(sent, seen).write.format("noop").mode("overwrite").save()
    assert seen.get == {"sent": 90, "failed": 10}


def test_consent_documents_of_a_hot_trace_come_in_parts(spark):
    rows = spark.range(50).select(
        F.lit("t").alias("trace_id"), F.col("id").alias("opt_id"), F.lit("501").alias("marketing_program_number"), F.lit("c").alias("consumer_id"), F.lit(1).alias("source_id"),
        F.lit("e").alias("email"), F.lit("p").alias("phone_number"), F.lit("DE").alias("country_code"), F.lit("3").alias("legal_entity_id"),
        F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(CAST(id AS INT))").alias("opt_date"))
    docs = [json.loads(r["document"]) for r in service_payloads.consent_service_payload(rows, NOW, max_opts=10).collect()]
    opts = [o["optId"] for d in docs for o in d["rawPayload"]["data"]["opts"]]
    assert len(docs) > 1 and sorted(map(int, opts)) == list(range(50))
    assert {d["rawPayload"]["requestTimestamp"] for d in docs} == {"2024-02-19T00:00:00.000Z"}


def test_staged_splitter_equals_inline(spark, sf_dir, tmp_path):
    from checks.q_enrich import lookups

    i = Inputs(spark, sf_dir)
    args = (i.payloads(), route.event_catalogue(i.event_ref), route.partial_retention(i.identifies), lookups(i), AS_OF, "ZZ")
    inline = migration.splitter_job(*args)
    staged = migration.splitter_job(*args, stage=staging.table_stage(spark, str(tmp_path), ["route"]))
    assert {k: v.count() for k, v in inline.items()} == {k: v.count() for k, v in staged.items()}


def test_splitter_does_not_shuffle_payloads_to_find_their_routes(spark, tmp_path):
    """The names' routes are a written table, so that a small one is met without dealing the payloads by name."""
    plans, write = {}, staging.table_stage(spark, str(tmp_path), ["route"])

    def stage(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    texts = spark.createDataFrame([('{"type": "track", "event": "E", "messageId": "m"}',), ('{"type": "track", "event": "x", "messageId": "n"}',)], "raw_payload string")
    reference = spark.createDataFrame([("E", "Email CLT", "NULL", "NULL")], "eventName string, eventCategory string, eventNameAlias string, gacaEventName string")
    partial = spark.createDataFrame([], "user_id string")
    known = spark.createDataFrame([], "user_key string, email string, sourceId string, marketingProgramNumber string")
    out = migration.splitter_job(parse_payloads(texts), route.event_catalogue(reference), partial, known, AS_OF, "ZZ", stage)
    assert "hashpartitioning" not in plans["routed"] and "BroadcastHashJoin" in plans["routed"]
    assert [r.raw_payload for r in out["unmatched"].collect()] == ['{"type": "track", "event": "x", "messageId": "n"}']


def test_delta_mode_keeps_the_latest_event(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    refs = {"aliases": i.crs_aliases, "segment_sources": i.crs_source.select("segment_source_id", F.col("source_id").alias("pg_data_source_id")),
            "opt_map": i.opt_map, "source_map": i.crs_source.select("source_id", "mpn")}
    frame = i.payloads()
    out = migration.external_id_job({"registration": frame.limit(5), "clt": frame}, refs, "42", AS_OF, NOW, delta=True)
    assert out["clt"].columns == ["user_id", "event", "raw_payload"]
    assert out["clt"].count() == out["clt"].select("user_id", "event").distinct().count()


def test_landing_schema_and_missing_export_columns(spark, tmp_path):
    landing = route.to_landing(payloads(spark, {"type": "x"}), NOW)
    assert writers.conform(landing, writers.LANDING_SCHEMA).columns == landing.columns
    writers.replace(spark.range(3), str(tmp_path / "a"))
    with pytest.raises(ValueError):
        writers.import_export_files(spark, str(tmp_path / "a"), str(tmp_path / "b"), "other bigint")


def test_gzip_lines_are_spread_and_blank_lines_skipped(spark, tmp_path):
    import gzip

    (tmp_path / "sub").mkdir()
    with gzip.open(tmp_path / "sub" / "x.gz", "wt") as f:
        f.write('{"a":1}\n\n{"a":2}\n')
    df = readers.read_payloads(spark, str(tmp_path), "*.gz", tasks=spark.sparkContext.defaultParallelism)
    assert df.count() == 2 and df.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    alone = readers.read_payloads(spark, str(tmp_path), "*.gz")
    assert alone.count() == 2 and alone.rdd.getNumPartitions() == 1


def test_corporate_rule(spark):
    rows = spark.createDataFrame([(1, "true", None), (2, None, "true"), (3, "false", "true"), (4, None, None)], "id int, fam string, corp string")
    hit = rows.filter(audience.opted_in(["fam", "corp"], "fam", "corp"))
    assert [r[0] for r in hit.orderBy("id").collect()] == [1, 2]
    assert rows.filter(audience.opted_in(["fam", "corp"])).count() == 3


def test_checkpoint_folder_comes_from_the_session(spark, tmp_path):
    from passerine.session import checkpoint_dir

    assert checkpoint_dir(spark, str(tmp_path / "ck")) in (spark.conf.get("spark.checkpoint.dir", None), str(tmp_path / "ck"))


def test_unregistered_pairs_need_an_id_that_is_not_falsy(spark):
    known = spark.createDataFrame([("1", "100")], "source_id string, mpn string")
    some, none = ["x", 1, True, 1.5, {"a": 1}, " "], ["", 0, False, None, {}, [], 0.0]
    docs = [{"messageId": f"{k}", "context": ext(("sourceId", v))} for k, v in enumerate([*some, *none])]
    docs += [{"messageId": "none", "context": ext(("email", "e"))}, {"messageId": "bare"}, {"messageId": "ok", "context": ext(("sourceId", "1"), ("marketingProgramNumber", "100"))}]
    docs += [{"messageId": "program", "context": ext(("sourceId", ""), ("marketingProgramNumber", 5))}]
    got = {r.message_id for r in validate.vld9_source_mpn(payloads(spark, *docs), known, NOW).collect()}
    assert got == {"program", *(str(k) for k in range(len(some)))}
