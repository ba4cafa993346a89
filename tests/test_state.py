"""Tables and sends that are brought up to date: merges, ledgers, mappings, bucketed tables."""

import json
import os

import pytest
from pyspark.sql import functions as F

from passerine.operators import identity
from passerine.plans import delivery
from passerine.sinks import writers
from test_plans import plan_of


def files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_a_merge_rewrites_only_the_partitions_it_touches(spark, tmp_path):
    path = str(tmp_path / "t")
    table = spark.range(1000).selectExpr("concat('m', id) as message_id", "concat('t', id) as trace_id", "'ToBeReplayed' as replay_status", "cast(null as timestamp) as replay_time", "nullif(id % 20, 19) as part")
    table.write.partitionBy("part").parquet(path)
    updates = spark.createDataFrame([(f"m{k}", f"t{k}") for k in (3, 23, 43, 107, 119)] + [("none", "t5"), (None, None)], "message_id string, trace_id string").selectExpr("*", "'Replayed' as replay_status", "timestamp'2024-01-01 00:00:00' as replay_time")
    before = files(path)
    merge = lambda: writers.merge_partitions(spark, path, updates, identity.merge_status, ["message_id", "trace_id"], "part")
    assert sorted(merge(), key=str) == [3, 7, None]
    after = files(path)
    same = {f for f in before if before[f] == after.get(f)}
    assert {f.split("part=")[1].split("/")[0] for f in before.keys() - same} == {"3", "7", "__HIVE_DEFAULT_PARTITION__"}
    read = lambda: sorted(map(tuple, spark.read.parquet(path).select("message_id", "replay_status", "part").collect()), key=str)
    first = read()
    assert len(first) == 1000 and {m for m, s, _ in first if s == "Replayed"} == {"m3", "m23", "m43", "m107", "m119"}
    merge()  # as after a run that failed half-way
    assert read() == first
    with pytest.raises(ValueError):
        writers.merge_partitions(spark, path, updates, identity.merge_status, ["message_id", "trace_id"], "part", most=2)
    assert writers.merge_partitions(spark, path, updates.limit(0), identity.merge_status, ["message_id", "trace_id"], "part") == []


def test_a_send_that_failed_half_way_sends_only_the_rest(spark, tmp_path):
    log, broken = str(tmp_path / "log"), str(tmp_path / "broken")
    os.makedirs(log)

    def factory():
        def send(payloads, topic):
            import uuid

            if os.path.exists(broken) and len(os.listdir(log)) >= 3:
                raise OSError("the service is away")
            with open(f"{log}/{uuid.uuid4().hex}", "w") as f:
                f.write("\n".join(payloads))
            return ["refused" if p.endswith("9") else None for p in payloads]

        return send

    df = spark.range(200).selectExpr("concat('p', id % 150) as payload", "id % 2 as other").repartition(4)  # 50 rows are repeated
    open(broken, "w").close()
    run = lambda: delivery.send_once(df, "payload", factory, str(tmp_path / "ledger"), waves=6)
    with pytest.raises(Exception):
        run()
    sent_before = [line for f in os.listdir(log) for line in open(f"{log}/{f}").read().split("\n") if line]
    committed = spark.read.parquet(str(tmp_path / "ledger")).count()
    os.remove(broken)
    out = run().collect()
    lines = [line for f in os.listdir(log) for line in open(f"{log}/{f}").read().split("\n") if line]
    assert len(out) == 200 and sum(r.error is not None for r in out) == sum(r.payload.endswith("9") for r in out)
    assert 0 < committed < 200 and len(lines) - len(sent_before) == 200 - committed
    assert run().count() == 200 and len([1 for f in os.listdir(log) for line in open(f"{log}/{f}").read().split("\n") if line]) == len(lines)


def test_an_updated_mapping_equals_a_rebuilt_one(spark):
    import random

    draw = random.Random(3)
    graph = spark.createDataFrame([(f"p{draw.randrange(60)}", "userId", f"u{draw.randrange(40)}", draw.choice([1, 2, 3])) for _ in range(200)], "pg_id string, id_type string, id_value string, marketing_program_number int").distinct()
    rows = [(f"p{draw.randrange(60)}", draw.choice([None, *range(20)])) for _ in range(150)]
    make = lambda r: spark.createDataFrame(r, "pg_id string, d int").selectExpr("pg_id", "timestamp_seconds(d * 86400) as created_date")
    mapping, created = identity.id_mapping(graph, make(rows[:60]), [1, 2]), identity.first_created(make(rows[:60]))
    for cut in (60, 100):
        mapping, created = identity.updated_id_mapping(mapping, created, graph, make(rows[cut : cut + 50 - (cut == 60) * 10]), [1, 2])
    want = identity.id_mapping(graph, make(rows), [1, 2])
    assert sorted(map(tuple, mapping.distinct().collect())) == sorted(map(tuple, want.distinct().collect()))
    with pytest.raises(ValueError):
        identity.updated_id_mapping(mapping.limit(0), created.limit(0), graph, make(rows).limit(0), [1, 2])


def test_bucketed_tables_join_without_an_exchange(spark, sf_dir):
    from checks.q_io import bucketed_clean
    from checks.registry import Inputs

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(bucketed_clean(Inputs(spark, sf_dir)), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "Exchange" not in plan, plan


def test_alias_pairs_that_occur_are_bounded(spark):
    from helpers import documents, payloads
    from passerine.operators import enrich

    aliases = spark.createDataFrame([("gender", "sex"), ("gender", "gen"), ("mail", "post"), ("sex", "sex")], "traitName string, alias string")
    docs = [{"traits": {"gender": "F", "sex": "F", "gen": "M"}}, {"traits": {"gender": 1, "gen": 1}}, {"traits": {"mail": "x"}}, {}]
    got = documents(enrich.drop_duplicate_aliases(payloads(spark, *docs), aliases))
    key = lambda d: json.dumps(d, sort_keys=True)
    assert sorted(map(key, got)) == sorted(map(key, [{"traits": {"gender": "F", "gen": "M"}}, {"traits": {"gender": 1}}, {"traits": {"mail": "x"}}, {}]))
    with pytest.raises(ValueError):
        enrich.drop_duplicate_aliases(payloads(spark, *docs), aliases, most=1)
    plan = plan_of(enrich.drop_duplicate_aliases(payloads(spark, *docs), aliases), "simple")
    assert "Exchange" not in plan and plan.count("from_json(") == 1
