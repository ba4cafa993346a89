"""Audience counts of tables that hold two programs and foreign countries."""

import datetime as dt

from pyspark.sql import functions as F

from passerine.plans import audience


def test_programs_countries_load_days_and_kinds(spark):
    day, late = dt.datetime(2024, 1, 10), dt.datetime(2024, 3, 1)
    users = spark.createDataFrame(
        [("a", "a@x", "F", "C0", "13718", day, "Y", "100", "true", day), ("b", "b@x", "M", "C0", "5", None, "Y", "100", "true", day), ("c", "c@x", "F", "C0", "13718", day, "Y", "100", "true", late)],
        "id string, email string, gender string, country_code string, source_id string, registration_date timestamp, email_valid_contact_point_indicator string, marketing_program_number string, opt string, loaded_at timestamp")
    by_mail = spark.createDataFrame([("a@x", "pa", 100), ("b@x", "other", 200)], "email string, canonical_pg_id string, marketing_program_number long")
    by_user = spark.createDataFrame([("a", "other", 200)], "id string, canonical_pg_id string, marketing_program_number long")
    merges = {"email": by_mail, "user": by_user, "unmerge": spark.createDataFrame([], "id_value string"), "canonical": spark.createDataFrame([], "previous_user_id string, canonical_user_id string")}
    none = spark.createDataFrame([], "user_id string")
    dump = audience.segment_dump(users, merges, none, "100", "C0", ["opt"], programs=["100"], loaded_to=dt.date(2024, 1, 31))
    assert {r.user_id for r in dump.collect()} == {"pa", "b"}
    specs = audience.segment_audiences(["C0"], dt.date(2024, 1, 31), dt.date(2023, 1, 1), F.lit(True), equals={"men": ("gender", ["M"])}, sources={"source": ["13718", "5"]})
    opened = spark.createDataFrame([("a", day, "C0", day), ("b", day, "C1", day), ("c", day, "C0", late)], "user_id string, ts timestamp, country_code string, loaded_at timestamp")
    receipts = spark.createDataFrame([("a", day), ("b", late), ("c", day)], "user_id string, ts timestamp")
    out = audience.segment_audience_counts(
        dump, {k: specs[k] for k in ("men", "source")}, opened, merges["canonical"], dt.date(2024, 1, 31), "opened", ["C0"], dt.date(2024, 1, 31), {"receipts": (receipts, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 31))})
    assert {r.audience_name: r["count"] for r in out.collect()} == {"men": 1, "source": 1, "opened": 1, "receipts": 2}


def test_sources_with_registration_periods(spark):
    """As by comparing every row with every audience: open and empty periods, both ends, unreadable dates, a hot source, names of predicates."""
    import random

    draw = random.Random(9)
    day = lambda: dt.datetime(draw.choice([2019, 2020, 2021, 2024]), draw.randrange(1, 13), draw.choice([1, 15]))
    listed = [(draw.choice("ABCDE"), draw.choice(["s", "s", "t", "x"]), draw.choice([None, day()]), draw.choice([None, day()])) for _ in range(40)]
    listed += [("even", "t", None, None), ("nobody", "none", None, None), ("A", None, None, None), (None, "s", None, None), *listed[:3]]
    rows = [(f"u{draw.randrange(60)}", draw.choice(["s", "s", "s", "t", None]), draw.choice([None, "soon", str(day())]), k) for k in range(300)] + [(None, "s", "2020-01-01", 1)]
    dump = spark.createDataFrame(rows, "user_id string, src string, reg string, k long")
    audiences = spark.createDataFrame(listed, "audience_name string, source_id string, first_at timestamp, last_at timestamp")
    specs = {"even": F.col("k") % 2 == 0, "null": F.lit(None).cast("boolean")}
    got = {r.audience_name: r["count"] for r in audience.count_with_sources(dump, "user_id", specs, audiences, "src", "reg").collect()}
    want = {"null": set(), "even": {u for u, _, _, k in rows if u and k % 2 == 0}}
    for name, source, first, last in listed:
        if name is None:
            continue
        mine = want.setdefault(name, set())
        for user, src, reg, _ in rows:
            at = dt.datetime.fromisoformat(reg) if reg and reg != "soon" else None
            if user and at and src and src == source and (first is None or at >= first) and (last is None or at <= last):
                mine.add(user)
    assert got == {n: len(users) for n, users in want.items()} and got["nobody"] == 0
    assert audience.count_with_sources(dump, "user_id", {}, audiences.limit(0), "src", "reg").count() == 0
