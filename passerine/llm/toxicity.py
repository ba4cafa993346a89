"""Toxicity: logistic regression by FTRL-proximal over hashed word n-grams and skip-grams.

Features of a text are its words, their stems (first bytes), pairs of neighbours and pairs with one word between, hashed
to ``2 ** BITS`` coordinates; a feature counts once a text. Per-coordinate rates and the L1 term leave few weights.

The model is fitted on a bounded sample of labelled rows, ``SHARDS * SHARD_ROWS`` at most. Texts become coordinates before
they are dealt into shards, one row for each id. Each shard is fitted in a task of its own and the shards' weights are
averaged, so what reaches the driver and is broadcast has at most ``2 ** BITS`` entries whatever the size of the corpus. Scoring goes over every text whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passerine.llm.arrow import hash_strings, map_slices, mix, owners, plain, release, slices, texts_of, words
from passerine.llm.shared import written

BITS, STEM_BYTES = 20, 5
SHARDS, SHARD_ROWS, EPOCHS = 8, 5000, 4
ALPHA, BETA, L1, L2 = 1.0, 1.0, 4.0, 0.1
THRESHOLD = 0.3
#: Text bytes of a slice: a word becomes four features of several numbers each.
FEATURE_BYTES = 1 << 20

_EDGE = ".,;:!?\"'()[]#*$%&|<>"
_NEXT, _SKIP, _STEM = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_DOWN = np.uint64(64 - BITS)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text number, coordinate) of every feature of the texts, repeated as often as it occurs."""
    vocabulary, codes, at = words(texts)
    forms = pc.utf8_trim(pc.utf8_lower(vocabulary), _EDGE)
    stems = pc.binary_slice(forms.cast(pa.binary()), 0, STEM_BYTES)
    word, own = hash_strings(forms)[codes], owners(at)
    stem = mix(hash_strings(stems) + _STEM)[codes]
    near, far = own[:-1] == own[1:], own[:-2] == own[2:]
    pair = mix(word[:-1][near] * _NEXT + word[1:][near])
    skip = mix(word[:-2][far] * _SKIP + word[2:][far])
    hashed = np.concatenate([word, stem, pair, skip])
    return np.concatenate([own, own, own[:-1][near], own[:-2][far]]), (hashed >> _DOWN).astype(np.int64)


class Ftrl:
    """FTRL-proximal with per-coordinate rates; the last coordinate is the bias, which L1 leaves alone."""

    def __init__(self):
        self.z, self.n = np.zeros(2**BITS + 1), np.zeros(2**BITS + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(at == 2**BITS, 0.0, L1)
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def _coordinates(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The distinct coordinates of every text, packed: at most two bytes for each, whatever the length of the text."""
    own, at = features(plain(batch.column("text")))
    key = np.unique(own * 2**BITS + at)
    ends = np.searchsorted(key, np.arange(batch.num_rows + 1) * 2**BITS)
    counts = np.bincount(key >> 16, minlength=batch.num_rows << (BITS - 16)).astype(np.uint32).reshape(batch.num_rows, -1)
    low = key.astype(np.uint16)  # the low 16 bits; the counts tell how many of them have each value of the high bits
    packed = pa.array([c.tobytes() + low[x:y].tobytes() for c, x, y in zip(counts, ends[:-1], ends[1:])], pa.binary())
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), packed], names=["doc_id", "toxic", "at"])


def _unpacked(packed: bytes) -> np.ndarray:
    counts = np.frombuffer(packed, np.uint32, 2 ** (BITS - 16))
    return np.repeat(np.arange(len(counts), dtype=np.int32) << 16, counts) + np.frombuffer(packed, np.uint16, offset=counts.nbytes)


def _fit_shard(table: pa.Table) -> pa.Table:
    """Fit one shard's rows, by the hash of their ids, and give the weights that aren't zero."""
    order = pc.sort_indices(table, [("order", "ascending"), ("doc_id", "ascending")]).to_pylist()
    texts, labels = table.column("at"), table.column("toxic").to_pylist()
    model = Ftrl()
    for _ in range(EPOCHS):
        for k in order:
            model.learn(np.append(_unpacked(texts[k].as_py()), np.int32(2**BITS)), labels[k])
    w = model.weights(np.arange(2**BITS + 1))
    some = np.flatnonzero(w)
    return pa.table({"at": some, "w": w[some]})


def is_held_out(id_column) -> F.Column:
    return F.crc32(id_column.cast("string").cast("binary")) % 4 == 2


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", held_out=is_held_out) -> tuple[np.ndarray, np.ndarray]:
    """(coordinates, weights) learned from the labelled rows that aren't held out.

    Rows with a null id or label teach nothing; a row labelled twice counts as toxic if one label says so. Of more than
    ``SHARDS * SHARD_ROWS`` rows, those with the lowest hash of their id are used; of documents that share an id, the one
    whose text has the least hash. What a shard gets are coordinates, not texts. Without rows there are no weights.
    """
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("toxic"))
    known = known.dropna().where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = written(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SHARDS * SHARD_ROWS), "toxicity-sample")
    n = sample.count()
    if not n:
        return np.zeros(0, np.int64), np.zeros(0)
    shards = min(SHARDS, -(-n // SHARD_ROWS))
    # Bounded by the limit above, so that only the sample's coordinates are shuffled.
    found = texts_of(docs, id_col, text_col).join(F.broadcast(sample), "doc_id").withColumn("content", F.xxhash64("text"))
    least = found.groupBy("doc_id").agg(F.min("content").alias("content"))
    some = found.join(F.broadcast(least), ["doc_id", "content"]).select("doc_id", "toxic", "text").dropDuplicates(["doc_id"])
    taught = map_slices(some, "text", _coordinates, "doc_id long, toxic int, at binary", FEATURE_BYTES).withColumn("order", F.xxhash64("doc_id", F.lit(1)))
    each = taught.groupBy(F.pmod("order", F.lit(shards)).alias("shard")).applyInArrow(_fit_shard, "at long, w double")
    table = each.groupBy("at").agg((F.sum("w") / shards).alias("w")).toPandas().sort_values("at")
    return table["at"].to_numpy(np.int64), table["w"].to_numpy(np.float64)


def scorer(df: DataFrame, model: tuple[np.ndarray, np.ndarray]):
    """A function from texts to scores, for use inside tasks."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # at most 2 ** BITS + 1 weights
    dense: dict = {}

    def score(texts: pa.Array) -> np.ndarray:
        if not dense:
            dense[0] = np.zeros(2**BITS + 1)
            dense[0][shared.value[0]] = shared.value[1]
        w = dense[0]
        own, at = features(texts)
        value = w[at]
        some = np.flatnonzero(value)
        key = np.unique(own[some] * 2**BITS + at[some])
        margin = w[-1] + np.bincount(key // 2**BITS, w[key % 2**BITS], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(margin, -35, 35)))

    return score


def rate(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Null texts count as empty and get the score of a text without words. Repeated rows stay repeated. A null id is not
    held out. Without labelled rows every score is one half. An empty table gives no rows.
    """
    score = scorer(docs, fit(docs, labels, id_col, text_col))
    rows = texts_of(docs, id_col, text_col)
    rows = rows.withColumn("held_out", F.coalesce(is_held_out(F.col("doc_id")), F.lit(False)))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        p = score(plain(batch.column("text")))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return map_slices(rows, "text", work, "doc_id long, held_out boolean, score double, predicted int", FEATURE_BYTES)


def reject(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs``, unchanged, whose score is under ``threshold``; cases as in :func:`rate`."""
    score = scorer(docs, fit(docs, labels, id_col, text_col))
    names, place = docs.columns, docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            named = pa.RecordBatch.from_arrays(batch.columns, names=[f"c{k}" for k in range(batch.num_columns)])
            for part in slices([named], f"c{place}", FEATURE_BYTES):
                keep = pa.array(score(plain(part.column(place))) < threshold)
                yield pa.RecordBatch.from_arrays(part.filter(keep).columns, names=names)
        release()

    return docs.mapInArrow(run, docs.schema)
