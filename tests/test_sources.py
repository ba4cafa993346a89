"""Reads by predicates that are packed from key counts."""

import datetime as dt
import random

import pytest

from passerine.sources import readers


def table(spark, seed, n, hot):
    draw = random.Random(seed)
    rows = []
    for k in range(n):
        if draw.random() < hot:
            rows.append((k, "101", dt.datetime(2024, 1, 2, 3, 4, 5), 7))
        else:
            mpn = draw.choice([None, "", "o'neil", "a\\\\b", *(str(100 + x) for x in range(12))])
            at = draw.choice([None, dt.datetime(2024, 1, draw.randint(1, 3), draw.randint(0, 23), draw.randint(0, 59))])
            rows.append((k, mpn, at, draw.choice([None, 1, 2, 3, 7])))
    return spark.createDataFrame(rows, "id long, mpn string, loaded timestamp, source_id int").repartition(4)


@pytest.mark.parametrize("seed,n,hot,reads", [(1, 3000, 0.0, 7), (2, 2000, 0.4, 10), (3, 300, 0.0, 1), (4, 200, 0.0, 500)])
def test_reads_take_every_row_once_in_even_shares(spark, seed, n, hot, reads):
    df = table(spark, seed, n, hot).cache()
    predicates = readers.batch_predicates(df, "mpn", "loaded", "source_id", reads)
    assert 1 <= len(predicates) <= reads
    parts = [[r.id for r in part.select("id").collect()] for part in readers.read_batches(df, predicates)]
    assert sorted(i for p in parts for i in p) == list(range(n))
    largest_key = max(r.n for r in readers.batch_keys(df, "mpn", "loaded", "source_id").collect())
    assert max(map(len, parts)) < max(2 * -(-n // reads), largest_key + -(-n // reads))
    df.unpersist()


def test_no_rows_need_no_reads(spark):
    assert readers.batch_predicates(table(spark, 1, 5, 0.0).limit(0), "mpn", "loaded", "source_id", 4) == []
