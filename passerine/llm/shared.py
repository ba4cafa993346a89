"""Results kept in the folder that the whole cluster shares, filters of bounded size, and connected components."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from passerine.operators.skew import adaptive_join


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``. Only a local session without one, as in tests, gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    folder = tempfile.mkdtemp(prefix="passerine-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, and safe from lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slots(df: DataFrame, key: Column, bits: int) -> np.ndarray:
    """A bit for every slot of ``2 ** bits`` that a 64-bit key of ``df`` falls in: little-endian bytes, of fixed size.

    A filter for rows that may have one of the keys: it lets through all that do and, the fuller it is, others besides.
    """
    slot = F.shiftrightunsigned(key, 64 - bits)
    words = df.select(slot.alias("s")).groupBy(F.shiftright("s", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 63 as int))")).alias("b")).toPandas()
    out = np.zeros(2 ** (bits - 6), np.int64)
    out[words["w"].to_numpy(np.int64)] = words["b"].to_numpy(np.int64)
    return out


def in_slots(filled: np.ndarray, keys: np.ndarray, bits: int) -> np.ndarray:
    """Whether each 64-bit key falls in a filled slot."""
    slot = (keys.astype(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)
    return (filled[slot >> 6] >> (slot & 63)) & 1 == 1


def components(edges: DataFrame, limit: int = 60) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); a component is named by its least node.

    Alternates large-star and small-star: each node's neighbours are linked to the least of them, until every component
    is a star. A round aggregates by node and joins, so a node with very many neighbours is split like any hot key.
    """
    spark = edges.sparkSession
    spark.sparkContext.setCheckpointDir(shared_dir(spark))
    edges = edges.select("a", "b").where("a <> b").distinct().checkpoint()
    state = None
    for _ in range(limit):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = adaptive_join(both.where("b > a"), least, ["a"], "inner").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        near = adaptive_join(down, least, ["a"], "inner").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = near.unionByName(least.select("a", F.col("m").alias("b"))).distinct().checkpoint()
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {limit} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
