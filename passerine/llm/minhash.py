"""Near-duplicate documents by BagMinHash: weighted-Jaccard signatures, bands, and a check of the multisets.

A document is the multiset of its five-word shingles. Every shingle has Poisson processes over time and weight: the weight
axis is cut into the blocks (0, 1], (1, 2], (2, 4], (4, 8] ..., each with a process of its own, and a point's place within
its block is drawn level by level of the block's halves. Points above the shingle's count don't belong to the document.
Each point goes to one of ``COMPONENTS`` components; a component of the signature is the time of its first point. Two
signatures agree in a component with the probability of their weighted Jaccard similarity. Points later than the time by
which all components are filled are never made, so the work hardly depends on the document's length.

Documents with the same multiset are one node from the start. Nodes meet in buckets of equal bands. No bucket is expanded
into all its pairs. First every node is checked against its bucket's leader, the node that meets most others in all its
buckets: the original of a group of near copies. Links found so give components. Then only nodes outside their leader's
component are compared with the other components that have the same leader, and only where the numbers allow a link: two
nodes share at most what both share with the leader, and beyond it no more than either has that occurs in another node at
all. Pairs within a component need no comparison, so no link between components is lost.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passerine.llm.arrow import hash_strings, map_slices, mix, owners, plain, texts_of, words
from passerine.llm.shared import components, in_slots, slots, written
from passerine.operators.skew import adaptive_join

SHINGLE_WORDS, SIMILARITY = 5, 0.8
#: Size of a signature; bands, and components in each, drawn once and for all. A pair of similarity 0.8 misses all
#: bands about once in 200,000 times.
COMPONENTS, BANDS, BAND_ROWS = 128, 48, 5
#: Bits of the filter that finds the candidates' texts again (2 MB).
FILTER_BITS = 24

_DRAW = np.random.Generator(np.random.PCG64(7))
_BAND = np.stack([_DRAW.choice(COMPONENTS, BAND_ROWS, replace=False) for _ in range(BANDS)])
_FOLD = _DRAW.integers(0, 2**63, BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SALT = _DRAW.integers(0, 2**64, BANDS, dtype=np.uint64)
_PLACE = _DRAW.integers(0, 2**63, SHINGLE_WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP, _BLOCK, _OTHER, _AGAIN = (np.uint64(x) for x in _DRAW.integers(0, 2**63, 4) * 2 + 1)
_MORE = 3.0


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's shingles, sorted within the text, and offsets. One to four words are one shingle."""
    vocabulary, codes, at = words(texts)
    word, n = hash_strings(vocabulary)[codes], np.diff(at)
    counts = np.where(n >= SHINGLE_WORDS, n - SHINGLE_WORDS + 1, n > 0).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(counts)])
    starts = np.repeat(at[:-1], counts) + np.arange(ends[-1]) - np.repeat(ends[:-1], counts)
    length = np.repeat(np.minimum(n, SHINGLE_WORDS), counts)
    padded = np.concatenate([word, np.zeros(SHINGLE_WORDS, np.uint64)])
    total = length.astype(np.uint64)
    for k in range(SHINGLE_WORDS):
        total += np.where(k < length, padded[starts + k] * _PLACE[k], np.uint64(0))
    total = mix(total)
    for a, b in zip(ends[:-1], ends[1:]):
        total[a:b].sort()
    return total, ends


def content_keys(hashed: np.ndarray, at: np.ndarray) -> pa.Array:
    """126-bit name of each multiset, as decimal(38, 0); null for texts without words."""
    raw = b"".join(hashlib.blake2b(hashed[a:b].tobytes(), digest_size=16).digest() for a, b in zip(at[:-1], at[1:]))
    pairs = np.frombuffer(raw, np.uint64).reshape(-1, 2).copy()
    pairs[:, 1] &= np.uint64(2**62 - 1)
    valid = np.packbits(np.diff(at) > 0, bitorder="little").tobytes()
    return pa.Array.from_buffers(pa.decimal128(38), len(at) - 1, [pa.py_buffer(valid), pa.py_buffer(pairs.tobytes())])


def counted(hashed: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text with their counts: (text, shingle, count), and each element's occurrence number."""
    own = owners(at)
    new = np.ones(len(hashed), bool)
    new[1:] = (hashed[1:] != hashed[:-1]) | (own[1:] != own[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(hashed)))
    return own[first], hashed[first], count, np.arange(len(hashed)) - np.repeat(first, count)


def signatures(own: np.ndarray, shingle: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
    """The times of first points, one row of ``COMPONENTS`` for each of ``n`` texts; infinite for texts without shingles."""
    times = np.full(n * COMPONENTS, np.inf)
    weight = np.bincount(own, count, minlength=n)
    until = COMPONENTS * (math.log(COMPONENTS) + _MORE) / np.maximum(weight, 1)
    todo = weight > 0
    while todo.any():
        low, high = 0, 1
        some = np.flatnonzero(todo[own])
        while len(some):
            _points(times, own[some], shingle[some], count[some], until, low, high)
            low, high = high, 2 * high
            some = some[count[some] > low]
        todo &= ~np.isfinite(times.reshape(n, COMPONENTS)).all(axis=1)
        until[todo] *= 2  # points already made are made again, and change nothing
    return times.reshape(n, COMPONENTS)


def _wrapped(a: np.uint64, b: int) -> np.uint64:
    """a * b in 64 bits."""
    return np.uint64(int(a) * b % 2**64)


def _points(times, own, shingle, count, until, low: int, high: int) -> None:
    """Put the points of one block of the weight axis into the components, up to each text's last time."""
    state, time, last = mix(shingle + _wrapped(_BLOCK, high)), np.zeros(len(own)), until[own]
    number = 0
    while len(own):
        number += 1
        drawn = mix(state + _wrapped(_STEP, number))
        time = time - np.log(((drawn >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / (high - low)
        keep = time <= last
        own, state, time, last, count, drawn = own[keep], state[keep], time[keep], last[keep], count[keep], drawn[keep]
        second = mix(drawn ^ _OTHER)
        component = ((second >> np.uint64(32)) * np.uint64(COMPONENTS) >> np.uint64(32)).astype(np.int64)
        level = low + ((second & np.uint64(2**32 - 1)) * np.uint64(high - low) >> np.uint64(32)).astype(np.int64)
        inside = level < count
        np.minimum.at(times, own[inside] * COMPONENTS + component[inside], time[inside])


def band_keys(times: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    parts = times.view(np.uint64)[:, _BAND] * _FOLD
    return mix(parts.sum(axis=2, dtype=np.uint64) + _SALT).astype(np.int64)


def _lists(values: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values.view(np.int64)))


def sign(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, key, n, bands) of each row of (doc_id, text); key and bands are null for texts without words."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashed, at = shingles(plain(batch.column("text")))
        own, shingle, count, _ = counted(hashed, at)
        keys = band_keys(signatures(own, shingle, count, batch.num_rows))
        n = np.diff(at)
        bands = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.where(n > 0, BANDS, 0))]), pa.int32()), pa.array(keys[n > 0].ravel()))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), content_keys(hashed, at), pa.array(n), bands], names=["doc_id", "text_hash", "key", "n", "bands"])

    return map_slices(docs.withColumn("text_hash", F.xxhash64("text")), "text", work, "doc_id long, text_hash long, key decimal(38,0), n long, bands array<long>")


def _elements(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, elements) of the documents with the ids of ``wanted``: every occurrence of a shingle is an element."""
    filled = docs.sparkSession.sparkContext.broadcast(slots(wanted, F.xxhash64("doc_id"), FILTER_BITS))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        batch = batch.filter(pa.array(in_slots(filled.value, batch.column("hash").to_numpy(zero_copy_only=False), FILTER_BITS)))
        hashed, at = shingles(plain(batch.column("text")))
        occurrence = counted(hashed, at)[3]
        return pa.RecordBatch.from_arrays([content_keys(hashed, at), _lists(mix(hashed + occurrence.astype(np.uint64) * _AGAIN), at)], names=["key", "elements"])

    return map_slices(docs.withColumn("hash", F.xxhash64("doc_id")), "text", work, "key decimal(38,0), elements array<long>")


def _close(a: Column, b: Column) -> Column:
    """Length filter: multisets whose sizes differ too much can't be similar."""
    return F.least(a, b) >= SIMILARITY * F.greatest(a, b)


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) with the sizes of their multisets, and of what they share."""
    left, right = (sets.select(F.col("key").alias(x), F.col("elements").alias(f"e{x}")) for x in "ab")
    found = adaptive_join(adaptive_join(pairs, left, ["a"], "inner"), right, ["b"], "inner")
    return found.select("a", "b", F.size("ea").alias("an"), F.size("eb").alias("bn"), F.size(F.array_intersect("ea", "eb")).alias("both"))


def _links(overlaps: DataFrame) -> DataFrame:
    return overlaps.where(F.col("both") >= SIMILARITY * (F.col("an") + F.col("bn") - F.col("both")) - 1e-9).select("a", "b")


def classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, class_id) for every row of ``df``: documents linked by similarity 0.8 or more share a class.

    A class is named by its least id. Null and empty texts, and others without words, are classes of their own (class_id is
    the row's id, even null). Texts of the same multiset are in one class whatever their ids; repeated rows stay repeated.
    Null ids are allowed and never name a class that has another. An empty table gives no rows.
    """
    signed, grouped = _grouped(texts_of(df, id_col, text_col))
    names = grouped.groupBy("component").agg(F.min("doc_id").alias("class_id"))
    named = adaptive_join(grouped, names, ["component"], "inner").select("doc_id", "class_id")
    return named.unionByName(signed.where("key is null").select("doc_id", F.col("doc_id").alias("class_id")))


def _grouped(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The signed documents, and (doc_id, text_hash, component) of those with words."""
    signed = written(sign(docs), "minhash")
    known = signed.where("key is not null")
    nodes = known.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    rows = nodes.select("key", "n", F.explode("bands").alias("bucket"))
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    met = written(adaptive_join(rows, sizes, ["bucket"], "inner"), "minhash-met")
    degrees = met.groupBy("key").agg(F.sum("size").alias("degree"))
    leaders = adaptive_join(met, degrees, ["key"], "inner").groupBy("bucket").agg(F.max(F.struct("degree", "key", "n")).alias("top"))
    leaders = leaders.select("bucket", F.col("top.key").alias("leader"), F.col("top.n").alias("leader_n"))
    led = written(adaptive_join(met.select("bucket", "key", "n"), leaders, ["bucket"], "inner"), "minhash-led")

    first = led.where("key <> leader").where(_close(F.col("n"), F.col("leader_n"))).select(F.least("leader", "key").alias("a"), F.greatest("leader", "key").alias("b")).distinct()
    first = written(first, "minhash-pairs")
    ids = known.groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    shared = written(_overlaps(first, _sets(docs, first.select(F.explode(F.array("a", "b")).alias("key")).distinct(), ids)), "minhash-overlaps")
    links = _links(shared)
    found = components(links)

    # A node and its bucket's leader, each with its component so far; nodes without a link are their own.
    part = lambda name: found.select(F.col("node").alias(name), F.col("component").alias(f"{name}_part"))
    parted = adaptive_join(adaptive_join(led, part("key"), ["key"]), part("leader"), ["leader"])
    parted = parted.select("bucket", "key", "n", "leader", F.coalesce("key_part", "key").alias("part"), F.coalesce("leader_part", "leader").alias("leader_part"))
    parted = written(parted, "minhash-parted")
    mixed = parted.where("part <> leader_part").select("bucket").distinct()
    crowd = written(adaptive_join(parted, mixed, ["bucket"], "left_semi"), "minhash-crowd")
    sets = _sets(docs, crowd.select("key").distinct(), ids)
    alone = sets.select("key", F.explode("elements").alias("element")).groupBy("element").agg(F.count("*").alias("c"), F.min("key").alias("key")).where("c = 1")
    # Of each node: with: shared with the leader (unknown where their lengths differ too much); most: occurs elsewhere.
    crowd = crowd.where("key <> leader").select("leader", "key", "n", "part", (F.col("part") != F.col("leader_part")).alias("out")).distinct()
    crowd = adaptive_join(crowd, alone.groupBy("key").agg(F.count("*").alias("alone")), ["key"]).withColumn("most", F.col("n") - F.coalesce("alone", F.lit(0)))
    both = shared.select(F.col("a").alias("key"), F.col("b").alias("leader"), "both").unionByName(shared.select(F.col("b").alias("key"), F.col("a").alias("leader"), "both"))
    crowd = written(adaptive_join(crowd, both, ["key", "leader"]).select("leader", "key", "n", "part", "out", "most", F.col("both").alias("with")), "minhash-crowd")
    side = lambda x: crowd.select("leader", *(F.col(c).alias(f"{x}_{c}") for c in ("key", "n", "part", "out", "most", "with")))
    need = SIMILARITY / (1 + SIMILARITY) * (F.col("a_n") + F.col("b_n")) - 1e-9
    beside = F.least("a_with", "b_with") + F.least(F.col("a_most") - F.col("a_with"), F.col("b_most") - F.col("b_with"))
    unknown = F.col("a_with").isNull() | F.col("b_with").isNull()
    possible = (F.least("a_most", "b_most") >= need) & (unknown | (beside >= need))
    second = side("a").where("a_out").join(side("b"), "leader").where("a_part <> b_part and (not b_out or a_key < b_key)").where(_close(F.col("a_n"), F.col("b_n")) & possible)
    second = second.select(F.least("a_key", "b_key").alias("a"), F.greatest("a_key", "b_key").alias("b")).distinct().join(first, ["a", "b"], "left_anti")
    second = written(second, "minhash-pairs")
    if not second.isEmpty():
        found = components(links.unionByName(_links(_overlaps(second, sets))))

    grouped = adaptive_join(known.select("doc_id", "text_hash", "key"), found.withColumnRenamed("node", "key"), ["key"])
    return signed, grouped.select("doc_id", "text_hash", F.coalesce("component", "key").alias("component"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``df``, unchanged, without those of which another document of their class stays.

    The document with the least id stays (of equal ids, the one with the least hash of its text); of repeated rows, one.
    Rows without words all stay. Only rows that a filter of fixed size takes for candidates are shuffled.
    """
    _, grouped = _grouped(texts_of(df, id_col, text_col))
    grouped = written(grouped, "minhash-classes")
    best = grouped.groupBy("component").agg(F.min(F.struct("doc_id", "text_hash")).alias("best"))
    rows = grouped.groupBy("component", "doc_id", "text_hash").agg(F.count("*").alias("rows"))
    judged = adaptive_join(rows, best, ["component"], "inner").withColumn("stays", F.struct("doc_id", "text_hash").eqNullSafe(F.col("best")))
    at = F.xxhash64("doc_id", "text_hash")
    judged = written(judged.where("not stays or rows > 1").select(at.alias("__at"), "stays"), "minhash-judged")
    filled = df.sparkSession.sparkContext.broadcast(slots(judged, F.col("__at"), FILTER_BITS))  # 2 MB

    @F.pandas_udf("boolean")
    def candidate(keys: pd.Series) -> pd.Series:
        return pd.Series(in_slots(filled.value, keys.to_numpy(), FILTER_BITS))

    # Rows are carried as one column, so that names can't clash.
    held = df.select(F.struct("*").alias("row"), F.xxhash64(F.col(id_col).cast("long"), F.xxhash64(text_col)).alias("__at"))
    held = held.withColumn("maybe", candidate("__at"))
    decided = adaptive_join(held.where("maybe"), judged, ["__at"]).where("stays is null or stays")
    free, contested = decided.where("stays is null"), decided.where("stays is not null").dropDuplicates(["__at"])
    return held.where("not maybe").select("row.*").unionByName(free.select("row.*")).unionByName(contested.select("row.*"))


def _sets(docs: DataFrame, wanted: DataFrame, ids: DataFrame) -> DataFrame:
    """(key, elements), once for each wanted key."""
    wanted = written(wanted.join(ids, "key"), "minhash-wanted")
    made = _elements(docs, wanted).join(wanted.select("key"), "key", "left_semi")
    return written(made.groupBy("key").agg(F.first("elements").alias("elements")), "minhash-sets")
