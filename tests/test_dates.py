"""Spellings of dates that are read, and texts that stay as they are."""

import pytest

from passerine.functions.dates import normalized

SPELLINGS = {
    "2024/01/15": "2024-01-15T00:00:00.000Z", "15 January 2024": "2024-01-15T00:00:00.000Z", "Jan 15 2024": "2024-01-15T00:00:00.000Z",
    "Jan 15, 2024": "2024-01-15T00:00:00.000Z", "January 15, 2024 3:04 pm": "2024-01-15T15:04:00.000Z", "1/15/2024 3:04 PM": "2024-01-15T15:04:00.000Z",
    "01/15/2024 10:00": "2024-01-15T10:00:00.000Z", "01-15-2024": "2024-01-15T00:00:00.000Z", "15-01-2024": "2024-01-15T00:00:00.000Z",
    "Mon, 15 Jan 2024 10:00:05 +0200": "2024-01-15T10:00:05.000Z", "Mon, 15 Jan 2024 10:00:05 GMT": "2024-01-15T10:00:05.000Z",
    "20240115T100000": "2024-01-15T10:00:00.000Z", "20240115": "2024-01-15T00:00:00.000Z", "20240115T100000Z": "2024-01-15T10:00:00.000Z",
    "1/2/2024 1:2:3": "2024-01-02T01:02:03.000Z", "25/12/2024": "2024-12-25T00:00:00.000Z", "12/25/2024 12:30 AM": "2024-12-25T00:30:00.000Z",
    "2024-01-15": "2024-01-15T00:00:00.000Z", "2024-01-15 10:00:00+01:00": "2024-01-15T10:00:00.000Z", "2024-01-15T10:00:00.5Z": "2024-01-15T10:00:00.500Z",
    "01/15/2024 10:00:00.25": "2024-01-15T10:00:00.250Z", "2024-01-15T10:00:00.123Z": "2024-01-15T10:00:00.123Z",
}
UNREAD = ["", "soon", "13/13/2024", "01/15/2024 25:00", "99999999", "15 Foo 2024", "1/15/2024 13:00 PM", "2024-13-01"]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_spellings(spark, ansi):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(t,) for t in [*SPELLINGS, *UNREAD, None]], "t string")
        got = {r.t: r.n for r in df.select("t", normalized(df.t).alias("n")).collect()}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
    assert got == {**SPELLINGS, **{t: t for t in UNREAD}, None: None}
