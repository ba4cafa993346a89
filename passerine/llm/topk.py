"""Exact top-k search by inner product: exhaustive, one term (vector position) at a time.

Candidates are dealt into blocks of ``BLOCK_ROWS`` and queries into blocks of ``QUERY_ROWS``; each task scores one block of
queries against one block of candidates. There the candidates' components lie as postings by term. A query row goes
through its nonzero terms and scatters weight times component into a dense array of scores, from which a partition
selects its k best; Spark merges the blocks' winners. Memory of a task is bounded by the two block sizes, and the
number of blocks follows from the numbers of rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS, QUERY_ROWS = 8192, 1024


def quantized(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of every component, computed in double; null for a vector that takes no part."""
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    # An exists that meets a null answers null, hence the two tests.
    usable = vector.isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(usable, whole)


def _matrix(lists: pd.Series) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
    """Postings by term: for each vector position the rows that have it, and their nonzero components."""
    lengths = lists.map(len).to_numpy(np.int64) if len(lists) else np.zeros(0, np.int64)
    flat = np.concatenate([*lists, np.zeros(0, np.int64)]).astype(np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    term = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    order = np.argsort(term, kind="stable")
    order = order[flat[order] != 0]
    width = int(lengths.max()) if len(lengths) else 0
    ends = np.searchsorted(term[order], np.arange(width + 1))
    return [(row[order[a:b]], flat[order[a:b]]) for a, b in zip(ends, ends[1:])], len(lengths)


def _best(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    rows = rows.loc[rows.index.repeat(rows["times"])].reset_index(drop=True)
    postings, n = _matrix(rows["v"])
    ids = rows["id"].to_numpy(np.int64)
    order = np.argsort(ids, kind="stable")  # the smaller id wins a tie: it comes first
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    postings = [(place[r], values) for r, values in postings]
    ids, found = ids[order], []
    for q, key, vector in zip(queries["id"], queries["key"], queries["v"]):
        scores = np.zeros(n, np.int64)
        for term, weight in enumerate(vector):
            if weight and term < len(postings):
                at, values = postings[term]
                scores[at] += int(weight) * values
        allowed = np.flatnonzero(ids != q)
        own = scores[allowed]
        if len(own) > k:
            least = np.partition(own, len(own) - k)[len(own) - k]
            over, equal = np.flatnonzero(own > least), np.flatnonzero(own == least)
            pick = np.concatenate([over, equal[: k - len(over)]])
        else:
            pick = np.arange(len(own))
        found.append(pd.DataFrame({"query_id": q, "key": key, "vec_id": ids[allowed[pick]], "score": own[pick]}))
    return pd.concat(found) if found else pd.DataFrame({"query_id": [], "key": [], "vec_id": [], "score": []}, dtype="int64")


def search(df: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row that ``is_query`` holds for, its ``k`` best other rows.

    Ties go to the smaller id. Rows with a null id, a null vector or a component that is null or not finite take no part.
    An id that occurs in several rows is searched for once for each distinct vector it has, with ``k`` places for each, and
    its rows are its own, never candidates; as candidates of others, repeated rows count once each. Vectors of unequal length
    meet in the positions that both have. With fewer than ``k`` others all are returned; an empty table gives no rows. Scores
    that might not fit 64 bits are an error.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), quantized(F.col(vector_col), scale).alias("v"), is_query.alias("q")).where("id is not null and v is not null")
    size = F.greatest(F.array_max("v"), -F.array_min("v"), F.lit(0))
    counts = rows.agg(F.count("*").alias("n"), F.count_if("q").alias("m"), F.max(size).alias("most"), F.max(F.size("v")).alias("dims")).first()
    if (counts.most or 0) ** 2 * (counts.dims or 0) >= 2**63:
        raise ValueError(f"scores of {counts.dims} components of up to {counts.most} may not fit 64 bits")
    blocks, asks = max(1, -(-counts.n // BLOCK_ROWS)), max(1, -(-counts.m // QUERY_ROWS))
    # After a shuffle rows have no fixed order; only what they hold gives a task that runs again the same blocks.
    deal = lambda n, seed: F.pmod(F.xxhash64("id", "v", F.lit(seed)), F.lit(n)).cast("int")
    others = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    candidates = rows.groupBy("id", "v").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("times"))  # more copies of a row than k can't be among the best
    candidates = candidates.select("id", "v", "times", deal(blocks, 1).alias("block")).select("*", others(asks).alias("ask"))
    queries = rows.where("q").select(F.col("id").alias("id"), F.col("v").alias("v")).distinct().select("id", "v", F.xxhash64("v").alias("key"), deal(asks, 2).alias("ask")).select("*", others(blocks).alias("block"))
    found = queries.groupBy("ask", "block").cogroup(candidates.groupBy("ask", "block")).applyInPandas(lambda a, b: _best(a, b, k), "query_id long, key long, vec_id long, score long")
    order = Window.partitionBy("query_id", "key").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
