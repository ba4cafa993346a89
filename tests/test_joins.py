"""Joins by pieces, by lists met first, and by distinct sets of keys."""

import random
import re

from checks.registry import Inputs
from passerine.operators import joins, route
from passerine.plans import compression, staging
from tests.helpers import payloads
from tests.test_plans import plan_of


def bare(text):
    return text.lower().replace("_", "")


def test_names_are_found_by_their_rarest_piece(spark):
    """As by comparing every head with every name of its program: short and empty heads, nulls, repeats, one hot program."""
    draw = random.Random(3)
    word = lambda n: "".join(draw.choice("abC_") for _ in range(n))
    columns = sorted({"trait_", "trait_a", "ab", "", "Trait_x", "trait_trait_abc", *(word(draw.randrange(1, 14)) for _ in range(40))})
    ref = [(draw.choice([1, 1, 1, 2, 3, None]), k % 150, f"n{k}", draw.choice([None, "", word(draw.randrange(1, 16))])) for k in range(400)]
    trait_map = spark.createDataFrame(ref + ref[:20], "mpn long, traitId long, traitName string, ecoTraitName string")
    mpns = spark.createDataFrame([("1",), ("2",), ("9",), (None,), ("1",)], "mpn string")
    got = joins.trait_suggest_like(columns, mpns, trait_map).select("mpn", "column_name", "suggested_traitId", "suggested_traitName", "suggested_ecoTraitName").distinct()
    want = set()
    for mpn in ("1", "2", "9"):
        for column in columns:
            head = bare(column.replace("trait_", "")[:8])
            found = {(mpn, column, i, n, e) for m, i, n, e in ref if str(m) == mpn and e is not None and head in bare(e)}
            want |= found or {(mpn, column, None, None, None)}
    assert {tuple(r) for r in got.collect()} == want
    plan = plan_of(joins.trait_suggest_like(columns, mpns, trait_map), "simple")
    assert not re.search(r"Join \[mpn#\d+\], ", plan)  # no join on the program alone
    assert joins.trait_suggest_like(columns, mpns, trait_map.limit(0)).count() == 3 * len(columns)


def test_traits_of_a_name_from_ecosystems_and_aliases(spark):
    """An ecosystem's id before an alias's; all ids of a name; a null id gives way to the alias; unknown ids drop out."""
    leaf = "key string, val string, userId string, marketingProgramNumber string, sourceId string, consumerid_sourceid_mpn string, lastActivityDate string, traceId string"
    keys = ["both", "two", "nulled", "alias", "unknown", "absent", None]
    leaves = spark.createDataFrame([(k, "v", "u", "100", "5", f"p{n}", "d", f"t{n}") for n, k in enumerate(keys)] * 2 + [("both", " ", "u", "100", "5", "p", "d", "t")], leaf)
    ids = spark.createDataFrame([], "userId string, consumerid_sourceid_mpn string, marketingProgramNumber string, sourceId string")
    eco = spark.createDataFrame([("both", 1, 1), ("two", 2, 1), ("two", 3, 4), ("nulled", None, 1), ("unknown", 99, 1), ("alias", 7, 5), (None, 1, 1)], "ecoTraitName string, traitId long, ecoSystemId long")
    aliases = spark.createDataFrame([("both", 4), ("nulled", 5), ("alias", 6)], "alias string, trait_id long")
    traits = spark.createDataFrame([(n,) for n in range(1, 10)], "traitId long")
    sources = spark.createDataFrame([("100", "5")], "mpn string, source_id string")
    out = joins.trait_resolution(leaves, ids, eco, aliases, traits, sources, "100")
    assert sorted((r.consumerid_sourceid_mpn, r.traitId) for r in out.collect()) == [("p0", 1), ("p1", 2), ("p1", 3), ("p2", 5), ("p3", 6)]


def identify(message, user, at, **traits):
    own = {} if user is None else {"userId": user}
    return {"type": "identify", "messageId": message, "originalTimestamp": at, "traits": {"marketingProgramNumber": "100", **traits}, **own}


def staged_traits(spark, folder):
    """Arguments of ``compress_traits`` over identities that a stage has written; m2 and m4 know their source from the user's other records only."""
    rows = payloads(
        spark, identify("m1", "u1", "2024-01-01", sourceId="5", consumerId="c1", gender="F"), identify("m2", "u1", "2024-01-02", gender="M"),
        identify("m3", "u1", "2024-01-03", sourceId=5, consumerId="c2", gender=" ", sexAlias="M"), identify("m4", "u1", "2024-01-04", gender="M"),
        identify("m5", "u2", "2024-01-05", gender="F"), identify("m6", None, "2024-01-06", gender="F"),
        identify("m7", "u3", "2024-01-07", sourceId="9", consumerId="c3", gender="F"), identify("m8", "u1", "2024-01-08", sourceId="5", consumerId="c1", gender="F", other="F"),
    )
    identities = staging.table_stage(spark, str(folder))(compression.identity_rows(rows, ["100"], "100"), "identities")
    eco = spark.createDataFrame([("gender", 1, 1), ("gender", 2, 4), ("gender", 8, 1)], "ecoTraitName string, traitId long, ecoSystemId long")
    aliases = spark.createDataFrame([("sexAlias", 1)], "alias string, trait_id long")
    traits = spark.createDataFrame([(1,), (2,)], "traitId long")
    sources = spark.createDataFrame([("100", "5")], "mpn string, source_id string")
    return identities, compression.compress_ids(identities), eco, aliases, traits, sources, "100"


def test_neither_staged_leaves_nor_their_persons_go_through_the_driver(spark, tmp_path):
    """A staged table is small by its files, not by its rows: no broadcast may rest on them."""
    out = compression.compress_traits(*staged_traits(spark, tmp_path))
    plan = plan_of(out, "simple")
    assert "BuildLeft" not in plan and "BroadcastHashJoin [userId" not in plan and "SortMergeJoin [userId" in plan, plan
    got = sorted((r.consumerid_sourceid_mpn, r.traitId, r.trait_value, r.trace_id) for r in out.collect())
    newest = [("c1_5_100", "F", "m8"), ("c1_5_100", "M", "m4"), ("c2_5_100", "M", "m4")]
    assert got == sorted((person, trait, value, trace) for person, value, trace in newest for trait in (1, 2))


def test_trait_resolution_of_staged_identities_trusts_no_size_of_files(spark, tmp_path):
    """No threshold makes it gather leaves or persons; what a user's other records know is filled in, for each person of the user."""
    identities, *others = staged_traits(spark, tmp_path)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8g")
    try:
        out = joins.trait_resolution(compression.trait_leaves(identities), *others)
        plan = plan_of(out, "simple")
        got = sorted((r.consumerid_sourceid_mpn, r.traitId, r.trait_value, r.trace_id) for r in out.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "BuildLeft" not in plan and "BroadcastHashJoin [userId" not in plan and "SortMergeJoin [userId" in plan, plan
    both = [(person, trait, "M", trace) for person in ("c1_5_100", "c2_5_100") for trait in (1, 2) for trace in ("m2", "m4")]
    own = [("c1_5_100", trait, "F", trace) for trait in (1, 2) for trace in ("m1", "m8")] + [("c2_5_100", 1, "M", "m3")]
    assert got == sorted(both + own)


def test_users_are_joined_once_by_id_and_once_by_email(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    plan = plan_of(joins.canonical_user(i.users.drop("registration_date", "loaded_at"), i.merged_email, i.merged_user, i.unmerge, i.canon), "simple")
    own = spark.read.parquet(f"{sf_dir}/customer.parquet")
    assert plan.count("Join [") - plan_of(i.users.drop("registration_date", "loaded_at"), "simple").count("Join [") == 2 and own.count() == i.users.count()


def test_payloads_meet_the_invalid_programs_in_one_join(spark, sf_dir):
    """Two joins: of the distinct sets of numbers with the list, and of the payloads with the sets that hit it."""
    invalid = spark.createDataFrame([("7",), ("7",), (None,)], "mpn string")
    plan = plan_of(route.flag_invalid_mpn(Inputs(spark, sf_dir).payloads(), invalid).select("raw_payload", "invalid_mpn"), "simple")
    assert len(re.findall(r"(?:SortMerge|BroadcastHash|ShuffledHash)Join", plan)) == 2
