"""Hard negatives by exact inner products, scored with Four-Russians tables.

A candidate's integer components are kept as bit planes (two's complement), eight dimensions to a byte. For each group of
eight dimensions an anchor has a table of the sums of every subset of its components there, so a plane's byte looks up
what it adds to the score; the planes are shifted by their weight and added, the sign's plane taken off.

Blocks of anchors meet blocks of candidates twice: first to find every anchor's positives among rows of its label, then,
with the bands that the positives' scores give, its negatives among the others. A block gives the few best of each
anchor or band, which Spark merges. Block sizes bound a task's memory; their number follows from the number of rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from passerine.llm.shared import written
from passerine.operators.skew import adaptive_join

#: Rows of a block of candidates and of one of anchors.
BLOCK_ROWS, ANCHOR_ROWS = 16_384, 4096
#: Scores that a task holds at once.
SCORES = 1 << 20
POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these hundredths of the positive's.
LEAST, MOST = 30, 90

_SUBSETS = ((np.arange(256)[:, None] >> np.arange(7, -1, -1)) & 1).astype(np.int64)  # of a byte's bits, first dimension first


def quantized(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component, computed in double; null for a vector that takes no part."""
    usable = vector.isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(usable, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


class _Vectors:
    """Rows of any lengths, longest first, by groups of eight dimensions; a group has the rows that reach it."""

    def __init__(self, lists: pd.Series):
        lengths = lists.map(len).to_numpy(np.int64)
        self.order = np.argsort(-lengths, kind="stable")
        self.lists = [np.asarray(lists.iloc[k], np.int64) for k in self.order]
        lengths = lengths[self.order]
        groups = -(-int(lengths[0]) // 8) if len(lengths) else 0
        self.reach = [int(np.searchsorted(-lengths, -8 * g, side="left")) for g in range(groups)]  # rows longer than 8 * g

    def group(self, g: int) -> np.ndarray:
        out = np.zeros((self.reach[g], 8), np.int64)
        for row, values in enumerate(self.lists[: self.reach[g]]):
            part = values[8 * g : 8 * g + 8]
            out[row, : len(part)] = part
        return out


def planes(values: np.ndarray, bits: int) -> np.ndarray:
    """(bits, rows): a byte of each row's eight components for every bit plane, the sign's last."""
    return np.stack([np.packbits(((values >> b) & 1).astype(np.uint8), axis=1)[:, 0] for b in range(bits)])


class Scorer:
    """Full scores of every anchor of a block with all its candidates, a few anchors at a time."""

    def __init__(self, anchors: pd.Series, candidates: pd.Series, bits: int):
        self.anchors, self.candidates, self.bits = _Vectors(anchors), _Vectors(candidates), bits
        self.groups = min(len(self.anchors.reach), len(self.candidates.reach))
        self.bytes = [planes(self.candidates.group(g), bits) for g in range(self.groups)]
        self.tables = [self.anchors.group(g) @ _SUBSETS.T for g in range(self.groups)]

    def __call__(self, numbers: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Scores of the anchors at ``numbers`` with the candidates at ``rows``; both ascend and count from the longest."""
        out = np.zeros((len(numbers), len(rows)), np.int64)
        for packed, table in zip(self.bytes, self.tables):
            reached, own = int(np.searchsorted(numbers, len(table))), int(np.searchsorted(rows, packed.shape[1]))
            if not reached or not own:
                break
            sums, found = table[numbers[:reached]], np.zeros((reached, own), np.int64)
            for b in range(self.bits - 1, -1, -1):  # shift and add, from the sign down
                looked_up = sums.take(packed[b][rows[:own]], axis=1)
                if b == self.bits - 1:
                    np.negative(looked_up, out=found)
                else:
                    found <<= 1
                    found += looked_up
            out[:reached, :own] += found
        return out


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties by smaller id, in no order."""
    if len(scores) <= k:
        return np.arange(len(scores))
    least = np.partition(scores, len(scores) - k)[len(scores) - k]
    over, equal = np.flatnonzero(scores > least), np.flatnonzero(scores == least)
    return np.concatenate([over, equal[np.argsort(ids[equal], kind="stable")][: k - len(over)]])


def _sorted(anchors: pd.DataFrame, candidates: pd.DataFrame, bits: int) -> tuple[Scorer, pd.DataFrame, pd.DataFrame]:
    """The scorer of two blocks, and the blocks as it numbers their rows."""
    scorer = Scorer(anchors["v"], candidates["v"], bits)
    a, c = anchors.iloc[scorer.anchors.order].reset_index(drop=True), candidates.iloc[scorer.candidates.order].reset_index(drop=True)
    return scorer, a, c


def _scored(scorer: Scorer, a: pd.DataFrame, c: pd.DataFrame, same: bool):
    """(anchor number, its scores, candidate places) for every anchor, with candidates of its label or of all others."""
    labels = c["label"].to_numpy()
    # Each label of the anchors is gone through once, in runs that SCORES bounds.
    for label, numbers in a.groupby("label").indices.items():
        rows = np.flatnonzero(labels == label if same else labels != label)
        if not len(rows):
            continue
        step = max(1, SCORES // len(rows))
        numbers = np.sort(numbers)
        for k in range(0, len(numbers), step):
            some = numbers[k : k + step]
            yield from zip(some.tolist(), scorer(some, rows), [rows] * len(some))


def _positives(anchors: pd.DataFrame, candidates: pd.DataFrame, bits: int, k: int) -> pd.DataFrame:
    scorer, a, c = _sorted(anchors, candidates, bits)
    ids, own, key, found = c["id"].to_numpy(np.int64), a["id"].to_numpy(np.int64), a["key"].to_numpy(np.int64), []
    for n, scores, rows in _scored(scorer, a, c, True):
        other = np.flatnonzero(ids[rows] != own[n])
        pick = other[best(scores[other], ids[rows][other], k)]
        found.append((np.full(len(pick), own[n]), np.full(len(pick), key[n]), ids[rows[pick]], scores[pick]))
    return _frame(found, ["anchor_id", "key", "positive_id", "positive_score"])


def _negatives(anchors: pd.DataFrame, candidates: pd.DataFrame, bits: int, k: int, least: int, most: int) -> pd.DataFrame:
    scorer, a, c = _sorted(anchors, candidates, bits)
    ids, own, key, bands, found = c["id"].to_numpy(np.int64), a["id"].to_numpy(np.int64), a["key"].to_numpy(np.int64), a["bands"].tolist(), []
    for n, scores, rows in _scored(scorer, a, c, False):
        for positive in bands[n]:
            high, low = most * positive // 100, -(-least * positive // 100)
            inside = np.flatnonzero((scores >= low) & (scores <= high) & (ids[rows] != own[n]))
            pick = inside[best(scores[inside], ids[rows][inside], k)]
            found.append((np.full(len(pick), key[n]), np.full(len(pick), positive), ids[rows[pick]], scores[pick]))
    return _frame(found, ["key", "positive_score", "negative_id", "negative_score"])


def _frame(found: list[tuple], names: list[str]) -> pd.DataFrame:
    columns = zip(*found) if found else [[np.zeros(0, np.int64)]] * len(names)
    return pd.DataFrame({n: np.concatenate(list(c)) for n, c in zip(names, columns)}, columns=names).astype("int64")


def mine(
    df: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = 256, positives: int = POSITIVES,
    negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST, block_rows: int = BLOCK_ROWS, anchor_rows: int = ANCHOR_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): each anchor's ``negatives`` best rows
    of other labels, for each of its ``positives`` best rows of its own, whose score is ``least`` to ``most`` hundredths
    of the positive's. Ties go to the smaller id; with fewer rows all are returned.

    Rows with a null id, label or vector, or a component that is null or not finite, take no part. Repeated rows count
    once; rows that share an id but differ are rows of their own, and no row is a positive or negative of its own id.
    An anchor id with several rows is mined for each; then their ranks stand beside each other. Vectors of unequal length
    meet in the positions that both have. A positive with a negative score has no negatives, one of 0 those of 0. An
    empty table gives no rows. Scores that might not fit 64 bits are an error.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), quantized(F.col(vector_col), scale).alias("v"), F.col(label_col).cast("long").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    rows = rows.dropna(subset=["id", "v", "label"]).distinct()  # a row that a third of all rows repeat is one row from here on
    rows = written(rows.withColumn("key", F.xxhash64("id", "v", "label")), "negatives-rows")
    # Bounds a component and its place in two's complement: floor(-1) needs one bit, floor(1) two.
    size = F.greatest(F.array_max("v"), -F.array_min("v") - 1, F.lit(0))
    facts = rows.agg(F.count("*").alias("n"), F.count_if("anchor").alias("m"), F.max(size).alias("most"), F.max(F.size("v")).alias("dims")).first()
    bits = int(facts.most or 0).bit_length() + 1
    if ((facts.most or 0) + 1) ** 2 * max(1, facts.dims or 0) * max(100, most) >= 2**63:
        raise ValueError(f"scores of {facts.dims} components of up to {facts.most} may not fit 64 bits")
    blocks, asks = max(1, -(-facts.n // block_rows)), max(1, -(-facts.m // anchor_rows))
    # Dealt by what the rows hold: a task that runs again deals them alike.
    deal = lambda n, seed: F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(n)).cast("int")
    others = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    candidates = rows.select("id", "v", "label", deal(blocks, 1).alias("block")).select("*", others(asks).alias("ask")).groupBy("ask", "block")
    # Columns of their own, for the two sides come from one table.
    anchors = rows.where("anchor").select(*(F.col(c).alias(c) for c in ("id", "key", "v", "label")), deal(asks, 2).alias("ask")).select("*", others(blocks).alias("block"))

    near = anchors.groupBy("ask", "block").cogroup(candidates).applyInPandas(lambda a, c: _positives(a, c, bits, positives), "anchor_id long, key long, positive_id long, positive_score long")
    order = Window.partitionBy("anchor_id", "key").orderBy(F.col("positive_score").desc(), "positive_id")
    near = written(near.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= positives).select("anchor_id", "key", "positive_id", "positive_score"), "negatives-positives")

    # Positives of one score have one band; a positive below 0 has none.
    bands = near.where("positive_score >= 0").groupBy("key").agg(F.collect_set("positive_score").alias("bands"))  # POSITIVES at most
    banded = adaptive_join(anchors, bands, ["key"], "inner")
    far = banded.groupBy("ask", "block").cogroup(candidates).applyInPandas(lambda a, c: _negatives(a, c, bits, negatives, least, most), "key long, positive_score long, negative_id long, negative_score long")
    order = Window.partitionBy("key", "positive_score").orderBy(F.col("negative_score").desc(), "negative_id")
    far = far.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    found = adaptive_join(near, far, ["key", "positive_score"], "inner")
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
