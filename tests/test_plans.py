"""Plan shape, skew, and conservation of rows."""

import io
import re
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

import checks.catalogue  # noqa: F401
from checks.registry import AS_OF, NOW, QUERIES, Inputs
from passerine.operators import aggregates, joins, route, skew, validate, windows
from passerine.plans import audience, migration
from tests.helpers import ext, payloads


def plan_of(df, mode="formatted"):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


PAYLOAD_QUERIES = [
    "normalize_timestamps", "fill_external_ids", "consumer_id", "split_channels", "flatten_dependents", "universal_source_id",
    "drop_duplicate_aliases", "split_invalid_mpn", "route_by_event", "retention_split", "validation_chain", "vld7_opts_combination",
    "external_id_job", "compress_traits",
]


@pytest.mark.parametrize("key", PAYLOAD_QUERIES)
def test_no_python_on_the_hot_path_and_no_cross_join(spark, sf_dir, key):
    plan = plan_of(QUERIES[key](spark, sf_dir), "simple")
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan, node


def test_every_batch_query_is_free_of_cross_joins(spark, sf_dir):
    for key in ("opts_null_tolerant_join", "trait_suggest_like", "crs_opt_lookup", "report_traits", "segment_audience_counts", "cdp_audience_counts"):
        plan = plan_of(QUERIES[key](spark, sf_dir), "simple")
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, key


def test_payload_is_parsed_once(spark, sf_dir):
    df = route.filter_backdated(Inputs(spark, sf_dir).payloads(), AS_OF).select("raw_payload")
    assert plan_of(df, "simple").count("from_json(") == 1


def test_newest_row_windows_are_limited_before_the_shuffle(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    for df in (
        windows.latest_row_per_user(i.identifies, "email", [F.col("ts").desc(), F.col("ok").desc()]),
        joins.latest_alias(i.profile_aliases),
    ):
        plan = plan_of(df, "simple")
        assert plan.count("WindowGroupLimit") >= 2, plan


def test_audience_counts_scan_the_base_once(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    specs = {f"a{n}": F.col("o_custkey") % 7 == n for n in range(7)}
    plan = plan_of(aggregates.count_distinct_union(i.orders, "o_custkey", specs), "simple")
    assert plan.count("FileScan") == 1 and "Expand" not in plan


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    plan = plan_of(QUERIES["read_federated"](spark, sf_dir))
    assert "PushedFilters: [In(c_nationkey" in plan or "c_nationkey" in plan.split("PushedFilters")[1][:200]
    assert "c_name" not in plan.split("ReadSchema")[1][:200]
    pruned = plan_of(QUERIES["partition_pruned_scan"](spark, sf_dir))
    assert "LessThan(o_orderdate" in pruned


@pytest.fixture
def tiny_limits(spark):
    """Force shuffled joins and treat small partitions as skewed."""
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    }
    old = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_key_is_split_even_when_the_right_side_is_aggregated(spark, tiny_limits, tmp_path):
    rows = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot")).when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("user"),
        "id", F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    right = rows.dropna().groupBy("user").agg(F.max("id").alias("newest"))
    joined = skew.adaptive_join(rows, right, ["user"])
    count = joined.agg(F.count(F.lit(1)), F.count("newest"), F.sum("newest"))
    got = count.collect()[0]
    plain = rows.join(right, "user", "left").agg(F.count(F.lit(1)), F.count("newest"), F.sum("newest")).collect()[0]
    assert tuple(got) == tuple(plain)
    written = joined.select("id", "newest")
    written.collect()
    assert "skewed" in plan_of(written, "simple").lower() or "skew=true" in plan_of(written, "simple").lower()


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_adaptive_join_equals_plain_join(spark, tiny_limits, how):
    left = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, "b"), (5, "z")], "id int, k string")
    right = spark.createDataFrame([("a", 10), ("b", 20), (None, 30)], "k string, v int")
    got = sorted(map(str, skew.adaptive_join(left, right, ["k"], how).collect()))
    assert got == sorted(map(str, left.join(right, "k", how).collect()))


def test_adaptive_join_with_different_key_types(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1, "x")], "k bigint, v string")
    assert skew.adaptive_join(left, right, ["k"]).filter("v = 'x'").count() == 1


def test_groups_form_runs_in_order_whatever_their_size(spark):
    rows = spark.range(1000).select(F.when(F.col("id") < 700, F.lit("hot")).when(F.col("id") < 998, F.lit("cold")).otherwise(F.lit("two")).alias("k"), "id")
    docs = aggregates.first_row_group_doc(rows, "k", ["id"], [], ["id"], limit=100).collect()
    for key, ids in (("hot", range(700)), ("cold", range(700, 998)), ("two", range(998, 1000))):
        parts = sorted((d for d in docs if d["k"] == key), key=lambda d: d["part"])
        assert [d["part"] for d in parts] == list(range(-(-len(ids) // 100)))
        assert all(len(d["items"]) == 100 for d in parts[:-1])
        assert [x["id"] for d in parts for x in d["items"]] == list(ids)
    same = spark.range(1000).select(F.lit("k").alias("k"), F.lit(1).alias("id"))
    assert sorted(len(d["items"]) for d in aggregates.first_row_group_doc(same, "k", ["id"], [], ["id"], limit=100).collect()) == [100] * 10


def test_splits_conserve_rows(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    frame = route.with_user_key(i.payloads())
    total = frame.count()
    partial = route.partial_retention(i.identifies)
    retained = audience.retention_out_users(i.identifies, ["ts", "ok"])
    invalid = joins.not_in_antijoin(i.identifies, "marketing_program_number", i.known_mpns())
    for parts in (
        route.split_invalid_mpn(frame, invalid), route.split_changed_opt(frame), route.split_postal_only(frame), route.split_keyless(frame),
        joins.retention_split(frame, retained), joins.partial_retention_split(frame, partial),
    ):
        assert sum(p.count() for p in parts) == total
    job = migration.retention_job(i.payloads(), invalid, retained)
    assert sum(p.count() for p in job.values()) == total


def test_validation_conserves_records(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    frame = i.payloads()
    passed, failed = validate.validation_chain(frame, i.opt_map, i.crs_source.select("source_id", "mpn"), AS_OF, NOW)
    assert passed.count() + failed.select("message_id").distinct().count() == frame.count()
    assert failed.columns == validate.FAILURE_COLUMNS


def test_every_module_avoids_local_checkpoint_and_collect():
    import pathlib
    import re

    for path in pathlib.Path(__file__).parent.parent.glob("passerine/**/*.py"):
        if "llm" in path.parts:  # an optional part with rules of its own
            continue
        text = path.read_text()
        assert "localCheckpoint" not in text, path
        assert not re.search(r"\.(collect|toPandas|toLocalIterator)\(", text), path
        assert "F.broadcast(" not in text and "crossJoin" not in text, path


def test_opt_matches_meet_payloads_without_shuffling_them(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    plan = plan_of(validate.vld7_opts_combination(i.payloads(), i.opt_map, NOW), "simple")
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan, plan


def test_payload_texts_are_built_after_rows_are_dealt(spark, sf_dir):
    plan = plan_of(Inputs(spark, sf_dir).payloads(), "simple")
    assert "messageId" in plan and "messageId" not in plan.split("RoundRobinPartitioning")[1], plan


def test_batch_rules_parse_payloads_once(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    out = validate.batch_rules(i.payloads(), {"program": i.crs_program}, "147", NOW, ("vld2", "vld3", "vld4", "vld5", "vld6"))
    assert plan_of(out, "simple").count("from_json(") == 1


def test_trait_resolution_parses_identities_once(spark, sf_dir):
    assert "from_json(" not in plan_of(QUERIES["trait_resolution"](spark, sf_dir), "simple")


def test_profile_users_deals_rows_before_they_are_made_distinct(spark, sf_dir):
    assert plan_of(QUERIES["profile_users"](spark, sf_dir), "simple").count("REPARTITION_BY_COL") >= 4


def test_long_generated_methods_are_left_to_shorter_ones(spark):
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000  # HotSpot compiles no longer ones


def test_rules_read_types_of_external_ids_once(spark):
    df = validate.with_failures(payloads(spark, {"messageId": "m", "context": ext(("sourceId", "5"))}), *(spark.createDataFrame([], s) for s in (
        "cdp_marketing_program_number string, ciam_opt_id string, service_name string, subscription_opt_number string, contact_point_category_code string, contact_point_type_code string",
        "source_id string, mpn string")), AS_OF, NOW)
    assert df.columns == [*payloads(spark, {}).columns, "failures"]
    assert len(re.findall(r"lambda x_\d+#\d+\[type\]", plan_of(df, "simple"))) == 3  # once for all rules, and for the two ids that may be falsy


def test_email_external_id_reads_staged_payloads(spark, sf_dir):
    assert "from_json(" not in plan_of(QUERIES["email_external_id"](spark, sf_dir), "simple")
