"""Edge cases the benchmark tables cannot produce; expected rows written by hand."""

import json

import pytest

from passerine.operators import enrich, route
from tests.helpers import documents, ext, ids_of, payloads


def test_round_trip_keeps_unknown_keys_and_types(spark):
    docs = [
        {"type": "track", "n": 1, "f": 1.5, "b": True, "x": None, "list": [1, {"a": None}], "traits": {"k": 9, "s": "9"},
         "context": {"ip": "1", "externalIds": [{"id": 5, "type": "t", "extra": {"z": 1}}, {}], "traits": {"q": 1}}},
        {"type": "x", "traits": None, "context": "text", "properties": [1]},
        {"type": "x", "context": {"externalIds": "bad"}},
        {},
    ]
    assert documents(payloads(spark, *docs)) == docs


def test_corrupt_lines_are_split_off(spark):
    from passerine.payload import split_corrupt

    good, bad = split_corrupt(payloads(spark, {"a": 1}, "not json", "[1]"))
    assert good.count() == 1 and bad.count() == 2


def test_user_key_presence_rule(spark):
    df = route.with_user_key(payloads(
        spark, {"userId": None, "anonymousId": "a"}, {"anonymousId": "a"}, {"userId": "u", "anonymousId": "a"}, {"type": "x"}))
    assert [r[0] for r in df.select("user_key").collect()] == [None, "a", "u", None]
    keyed, keyless = route.split_keyless(df)
    assert (keyed.count(), keyless.count()) == (3, 1)


def test_numeric_mpn_is_not_text(spark):
    invalid = spark.createDataFrame([("9",)], "mpn string")
    df = payloads(
        spark, {"properties": {"marketingProgramNumber": 9}}, {"properties": {"marketingProgramNumber": "9"}},
        {"context": {"traits": {"marketingProgramNumber": "9"}}}, {"context": ext(("marketingProgramNumber", "8"), ("marketingProgramNumber", "9"))})
    flags = [r[0] for r in route.flag_invalid_mpn(df, invalid).orderBy("raw_payload").select("invalid_mpn").collect()]
    assert sorted(flags) == [False, False, True, True]




def test_fill_external_ids_cases(spark):
    lookups = spark.createDataFrame([("u1", "l@x", "77", "501")], "user_key string, email string, sourceId string, marketingProgramNumber string")
    df = route.with_user_key(payloads(
        spark,
        {"userId": "u1", "context": {"externalIds": [{}, {"type": "email", "id": "  "}, {"type": "sourceId", "id": 5}]}},
        {"userId": "u1", "traits": {"email": 12, "sourceId": "9"}, "properties": {"email": "p@x"}},
        {"userId": "u2", "context": {"externalIds": [{"type": "email", "id": None}, {"type": "email", "id": "second"}]}},
    ))
    first, second, third = sorted(
        documents(enrich.fill_external_ids(df, lookups, "DE")), key=lambda d: (d["userId"], "traits" in d))
    assert ids_of(first, "email") == ["l@x"] and ids_of(first, "sourceId") == [5]
    assert ids_of(first, "marketingProgramNumber") == ["501"] and ids_of(first, "countryCode") == ["DE"]
    assert {} not in first["context"]["externalIds"]
    # a number found in traits blocks the properties, but only text is copied: the lookup is used
    assert ids_of(second, "email") == ["l@x"] and ids_of(second, "sourceId") == ["9"]
    # the blank first entry is removed, later ones stay
    assert ids_of(third, "email") == ["second"]


@pytest.mark.parametrize("doc, expected", [
    ({"traits": {"consumerId": 7}, "context": {}}, ["7"]),
    ({"event": "Signed Up for Promotion", "originalTimestamp": "T", "context": ext(("email", "a@x"))}, []),
    ({"event": "x", "originalTimestamp": "T", "context": ext(("email", "a@x"), ("sourceId", "3"))}, ["sha3"]),
    ({"event": "x", "originalTimestamp": "T", "traits": {"offlineConsumerId": "o"}, "context": ext(("email", "a@x"))}, []),
    ({"event": "x", "context": ext(("email", "a@x"), ("consumerId", ""))}, [""]),
    ({"event": "Signed Up for Promotion", "originalTimestamp": "T", "context": ext(("email", "a@x"), ("consumerId", " "))}, ["shaT"]),
])
def test_consumer_id(spark, doc, expected):
    import hashlib

    sha = hashlib.sha256(b"a@x").hexdigest()
    out = documents(enrich.consumer_id(payloads(spark, doc)))[0]
    assert ids_of(out, "consumerId") == [e.replace("sha", sha) for e in expected]


def test_dependents_any_depth(spark):
    doc = {"type": "identify", "traits": {"dependents": [{"a": {"b": {"c": {"d": [1, [2, {"e": "x"}]]}}}, "n": None, "t": "}{[\""}], "k": 1}}
    out = documents(enrich.flatten_dependents(payloads(spark, doc)))[0]["traits"]
    flat = {k: v for k, v in out.items() if k not in ("dependents", "k")}
    assert flat == {"dependent1ABCD1": 1, "dependent1ABCD21": 2, "dependent1ABCD22E": "x", "dependent1T": "}{[\""}
    assert out["dependents"] == doc["traits"]["dependents"]


def test_last_activity_of_null_traits(spark):
    out = documents(enrich.last_activity_date(payloads(
        spark, {"type": "track", "traits": None, "originalTimestamp": "T"}, {"type": "identify", "traits": {}, "originalTimestamp": "T"},
        {"type": "identify", "traits": {"score": 1}})))
    assert [d["traits"] for d in out] == [{"lastActivityDate": "T"}, {"lastActivityDate": "T"}, {"score": 1}]


def test_split_channels_common_keys_win_and_number_is_kept(spark):
    props = {
        "email": "e", "emailConsumerChoiceDate": "d", "emailSubscriptionOptIndicator": "true", "phoneNumber": "1",
        "phoneConsumerChoiceDate": "d", "phoneContactType": "P", "phoneContactCategory": "PM", "optId": "1_2",
        "postalConsumerChoiceDate": "d", "postalSubscriptionOptNumber": "3",
    }
    out = documents(enrich.split_channels(payloads(spark, {"event": "Changed Opt Status", "messageId": "m", "properties": props})))
    assert [d["messageId"] for d in out] == ["m-split1", "m-split2"]
    assert set(out[0]["properties"]) == {"email", "emailConsumerChoiceDate", "emailSubscriptionOptIndicator", "optId"}
    assert set(out[1]["properties"]) == {"phoneNumber", "phoneConsumerChoiceDate", "phoneContactType", "phoneContactCategory", "optId"}


def test_timestamps(spark):
    stamps = ["2024-01-02T03:04:05.678901Z", "2024-01-02T03:04:05Z", "2024-01-02 03:04:05+05:30", "1/2/2024", "13/2/2024", "2 Jan 2024", "soon", "2024"]
    docs = [{"traits": {"k": 1}, "timestamp": s, "n": n} for n, s in enumerate(stamps)]
    out = sorted(documents(enrich.normalize_timestamps(payloads(spark, *docs))), key=lambda d: d["n"])
    assert [d["timestamp"] for d in out] == [
        "2024-01-02T03:04:05.678Z", "2024-01-02T03:04:05.000Z", "2024-01-02T03:04:05.000Z", "2024-01-02T00:00:00.000Z",
        "2024-02-13T00:00:00.000Z", "2024-01-02T00:00:00.000Z", "soon", "2024"]


@pytest.mark.parametrize("step", [
    enrich.normalize_timestamps, enrich.mpn_to_string, enrich.external_mpn_to_string, enrich.choice_date, enrich.external_ids_to_traits,
    enrich.lowercase_opt_flags, enrich.drop_empty_traits,
])
def test_steps_are_idempotent(spark, sf_dir, step):
    from checks.registry import Inputs

    frame = Inputs(spark, sf_dir).payloads().limit(200)
    once_, twice = step(frame), step(step(frame))
    key = lambda d: json.dumps(d, sort_keys=True)
    assert sorted(map(key, documents(once_))) == sorted(map(key, documents(twice)))


def test_alias_drop_does_not_depend_on_the_broadcast_limit(spark, sf_dir):
    from checks.registry import Inputs

    i = Inputs(spark, sf_dir)
    small = documents(enrich.drop_duplicate_aliases(i.payloads(), i.crs_aliases))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = documents(enrich.drop_duplicate_aliases(i.payloads(), i.crs_aliases))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    key = lambda d: json.dumps(d, sort_keys=True)
    assert sorted(map(key, small)) == sorted(map(key, large))


def test_universal_lookup_miss_changes_nothing(spark):
    doc = {"type": "track", "properties": {"aOptIndicator": "true"}, "context": {**ext(("marketingProgramNumber", "9999")), "protocols": {"sourceId": "nope"}}}
    segments = spark.createDataFrame([("seg", 4)], "segment_source_id string, pg_data_source_id bigint")
    assert documents(enrich.universal_source_id(payloads(spark, doc), segments)) == [doc]
