"""What is sent is sent once, and streams free their state."""

import json

from checks.registry import NOW
from passerine.plans import delivery
from passerine.streaming import streams


def counting(folder):
    """A sender that leaves a file for every payload it gets."""
    def factory():
        def send(payloads, topic):
            import os
            import uuid

            for _ in payloads:
                open(os.path.join(folder, uuid.uuid4().hex), "w").close()
            return [None] * len(payloads)

        return send

    return factory


def test_two_actions_send_once(spark, tmp_path):
    rows = [(f"m{k}", json.dumps({"servicePayload": {"k": k}}), "t", "ToBeReplayed" if k % 2 else "Replayed", None, f"t{k}", "147") for k in range(10)]
    table = spark.createDataFrame(rows, "message_id string, raw_payload string, replay_topic string, replay_status string, replay_time timestamp_ntz, trace_id string, mpn string")
    (tmp_path / "sent").mkdir()
    out = delivery.dlq_replay(table, counting(str(tmp_path / "sent")), NOW, str(tmp_path / "status"))
    assert out.count() == 10 and out.filter("replay_status = 'Replayed'").count() == 10
    assert len(list((tmp_path / "sent").iterdir())) == 5


def test_remediation_sends_its_archive_once(spark, tmp_path):
    rows = [(json.dumps({"servicePayload": {"k": k}}), f"2024-01-1{k} 00:00:00") for k in range(5)]
    dlq = spark.createDataFrame(rows, "data string, t string").selectExpr("data", "cast(t as timestamp_ntz) as publish_time")
    (tmp_path / "sent").mkdir()
    out = delivery.dlq_remediation(dlq, "2024-01-10 00:00:00", "2024-01-13 00:00:00", counting(str(tmp_path / "sent")), str(tmp_path / "dlq"))
    assert out["archive"].count() == 3 and out["failed"].count() == 0 and out["failed"].collect() == []
    assert len(list((tmp_path / "sent").iterdir())) == 3


def test_stream_drops_late_rows_and_frees_state(spark, tmp_path):
    source, lines = tmp_path / "in", tmp_path / "lines"
    source.mkdir(), lines.mkdir()
    states = []

    def batch(n, *days):
        docs = [{"type": "track", "event": "e", "userId": f"u{d}", "messageId": f"{n}-{d}", "timestamp": f"2024-01-{d:02d}T12:00:00.000Z"} for d in days]
        (source / f"{n}.txt").write_text("\n".join(map(json.dumps, docs)))
        query = streams.stream_latest_per_user_event(streams.payload_stream(spark, str(source)), str(tmp_path / "out"), str(tmp_path / "ck"), "1 hour")
        query.awaitTermination()
        states.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])

    batch(1, 2, 3, 4)
    batch(2, 20)
    batch(3, 2, 21)  # the second of January is long over
    found = {r.raw_payload for r in streams.read_latest(spark, str(tmp_path / "out")).collect()}
    assert {json.loads(x)["messageId"] for x in found} == {"1-2", "1-3", "1-4", "2-20", "3-21"}
    assert states[-1] < 3


def test_stream_keeps_rows_without_readable_timestamp_in_later_batches(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()

    def batch(n, *stamps):
        docs = [{"type": "track", "event": "e", "userId": f"u{n}{k}" if k else "u", "messageId": f"{n}-{k}"} | ({"timestamp": t} if t is not None else {}) for k, t in enumerate(stamps)]
        (source / f"{n}.txt").write_text("\n".join(map(json.dumps, docs)))
        streams.stream_latest_per_user_event(streams.payload_stream(spark, str(source)), str(tmp_path / "out"), str(tmp_path / "ck"), "1 hour").awaitTermination()

    batch(1, None, "2024-01-15T12:00:00.000Z")
    batch(2, "soon", None, "", "2024/01/15", "15 January 2024", 5, "2024-01-02T12:00:00.000Z")  # only the last one is late
    batch(3, None, "2024/01/16", "2024-01-02", "01/02/2024")  # late are the last two
    found = {json.loads(r.raw_payload)["messageId"] for r in streams.read_latest(spark, str(tmp_path / "out")).collect()}
    assert found == {"1-1", "2-0", "2-1", "2-2", "2-3", "2-4", "2-5", "3-1"}
