"""Mixing sources to target weights by temperature, realised as budgeted block permutations.

Source weights are the sources' token shares to a power between 0 and 1, normalised. The exponent is bisected: the largest
that reaches the target entropy, raised where a source would repeat more often than the limit. Every source then has a
budget of tokens: whole passes over it, and a part of one more.

Each pass orders a source anew: its documents are dealt into blocks by a hash, blocks are ordered by a hash of the pass,
documents within a block too. The last pass ends where the budget does, in the middle of one block. That place is all that
has to be known about a source, so rows are chosen by comparing hashes, without shuffling them, whatever a source's size.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from passerine.llm.shared import written

#: Entropy to reach, as a share of the highest possible, and passes over a source at most.
TARGET_ENTROPY, MAX_REPEATS = 0.95, 4.0
#: Tokens of a block, blocks of a source at most (a source's blocks grow beyond that), sources at most (their totals are
#: gathered on the driver; more is an error).
BLOCK_TOKENS, MAX_BLOCKS, MAX_SOURCES = 1 << 20, 1 << 16, 100_000
BISECTIONS = 60
#: Makes up for rounding, so that a share that is a source's own tokens takes the source whole.
ROUNDING = 1e-12


@dataclass(frozen=True)
class Share:
    """What is taken of a source: ``passes`` whole passes, and tokens of one more up to ``rest``."""

    source: str
    tokens: int
    weight: float
    passes: int
    rest: int
    blocks: int


def weights(tokens: list[int], exponent: float) -> list[float]:
    total = sum(tokens)
    raised = [(t / total) ** exponent if t else 0.0 for t in tokens]
    return [r / sum(raised) for r in raised]


def entropy(shares: list[float]) -> float:
    return -sum(s * math.log(s) for s in shares if s)


def exponent(tokens: list[int], budget: int, target_entropy: float = TARGET_ENTROPY, max_repeats: float = MAX_REPEATS) -> float:
    """The largest exponent up to 1 that reaches the entropy; a larger one if the repetition limit needs it."""
    some = [t for t in tokens if t]
    if not some:
        return 1.0
    if budget > max_repeats * sum(some):
        raise ValueError(f"a budget of {budget} tokens repeats the corpus more than {max_repeats} times")
    goal = target_entropy * math.log(len(some))

    def largest(holds) -> float:
        low, high = 0.0, 1.0
        if holds(high):
            return high
        for _ in range(BISECTIONS):
            middle = (low + high) / 2
            low, high = (middle, high) if holds(middle) else (low, middle)
        return low

    by_entropy = largest(lambda a: entropy(weights(some, a)) >= goal)
    repeats_too_much = lambda a: max(w * budget / t for w, t in zip(weights(some, a), some)) > max_repeats
    if not repeats_too_much(by_entropy):
        return by_entropy
    low, high = by_entropy, 1.0
    for _ in range(BISECTIONS):
        middle = (low + high) / 2
        low, high = (middle, high) if repeats_too_much(middle) else (low, middle)
    return high


def shares(totals: dict[str, int], budget: int | None = None, target_entropy: float = TARGET_ENTROPY, max_repeats: float = MAX_REPEATS) -> list[Share]:
    """What to take of each source. A source without tokens is taken once: it costs nothing."""
    names = sorted(totals)
    tokens = [totals[n] for n in names]
    budget = sum(tokens) if budget is None else budget
    out = []
    for name, t, w in zip(names, tokens, weights(tokens, exponent(tokens, budget, target_entropy, max_repeats)) if any(tokens) else [0.0] * len(names)):
        goal = math.floor(w * budget * (1 + ROUNDING))
        out.append(Share(name, t, w, goal // t if t else 1, goal % t if t else 0, min(MAX_BLOCKS, max(1, -(-t // BLOCK_TOKENS)))))
    return out


def _md5(*parts: Column | str) -> Column:
    return F.md5(F.concat_ws(":", *(F.lit(p) if isinstance(p, str) else p for p in parts)))


def _names(df: DataFrame, id_col: str, source_col: str) -> tuple[Column, Column]:
    return F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.coalesce(F.col(source_col).cast("string"), F.lit(""))


def _keys(name: Column, source: Column, blocks: Column, number: Column) -> tuple[Column, Column, Column]:
    """(block, order of the block, order of the document in it) in a pass."""
    block = (F.conv(F.substring(_md5("block", name), 1, 8), 16, 10).cast("long") % blocks).cast("int")
    return block, _md5("order", source, block, number), _md5("place", name, number)


def token_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` as tokens; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def plan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", budget: int | None = None, target_entropy: float = TARGET_ENTROPY, max_repeats: float = MAX_REPEATS) -> list[tuple]:
    """(share, cut_block, cut_place) for each source: the last pass takes what comes at or before the cut."""
    name, source = _names(df, id_col, source_col)
    sized = written(df.select(name.alias("name"), source.alias("source"), token_count(F.col(text_col)).alias("n")), "mixing")
    totals = sized.groupBy("source").agg(F.sum("n").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    found = shares({r.source: r.n for r in totals}, budget, target_entropy, max_repeats)
    if not found:
        return []
    spark = df.sparkSession
    table = spark.createDataFrame([(s.source, s.passes, s.rest, s.blocks) for s in found if s.rest], "source string, passes long, rest long, blocks int")
    block, order, place = _keys(F.col("name"), F.col("source"), F.col("blocks"), F.col("passes"))
    rows = sized.join(F.broadcast(table), "source").select("source", "rest", "n", block.alias("block"), order.alias("block_key"), place.alias("doc_key"))  # MAX_SOURCES rows at most
    blocks = rows.groupBy("source", "block_key", "rest").agg(F.sum("n").alias("n"))
    upto = Window.partitionBy("source").orderBy("block_key")  # MAX_BLOCKS rows of a source at most
    cut = blocks.withColumn("before", F.sum("n").over(upto) - F.col("n")).where("before <= rest").groupBy("source").agg(F.max("block_key").alias("block_key"), F.max_by("before", "block_key").alias("before"))
    inside = Window.partitionBy("source").orderBy("doc_key")  # one block of each source; equal places go together
    taken = rows.join(F.broadcast(cut), ["source", "block_key"]).withColumn("sum", F.col("before") + F.sum("n").over(inside)).where("sum <= rest")
    last = taken.groupBy("source").agg(F.max("doc_key").alias("doc_key"))
    cuts = {r.source: (r.block_key, r.doc_key or "") for r in cut.join(last, "source", "left").collect()}
    return [(s, *cuts.get(s.source, ("", ""))) for s in found]


def taken(df: DataFrame, found: list[tuple], id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """(row, epoch, block, block_key, doc_key): the rows of ``df`` as often as ``found`` (of :func:`plan`) takes them, each
    whole as one struct, so that columns of any name go along. Sorted by epoch, block key and document key they are the permutation."""
    name, source = _names(df, id_col, source_col)
    table = df.sparkSession.createDataFrame([(s.source, s.passes, s.blocks, a, b) for s, a, b in found], "source string, passes long, blocks int, cut_block string, cut_doc string")
    rows = df.select(F.struct("*").alias("row"), name.alias("name"), source.alias("source")).join(F.broadcast(table), "source")  # MAX_SOURCES rows at most
    block, order, place = _keys(F.col("name"), F.col("source"), F.col("blocks"), F.col("passes"))
    more = (order < F.col("cut_block")) | ((order == F.col("cut_block")) & (place <= F.col("cut_doc")))
    times = F.col("passes") + more.cast("long")
    rows = rows.withColumn("epoch", F.explode(F.when(times > 0, F.sequence(F.lit(0), (times - 1).cast("int"))).otherwise(F.array().cast("array<int>"))))
    block, order, place = _keys(F.col("name"), F.col("source"), F.col("blocks"), F.col("epoch"))
    return rows.select("row", "epoch", block.alias("block"), order.alias("block_key"), place.alias("doc_key"))


def mix(df: DataFrame, found: list[tuple], id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """Rows of ``df`` as often as ``found`` takes them, with ``df``'s columns and no others, whatever their names."""
    return taken(df, found, id_col, source_col).select("row.*")


def mixture(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **limits) -> DataFrame:
    """(doc_id, source, n_tokens, epoch, block, block_key, doc_key): a row for every time a document is taken.

    A source's documents are taken in the order of its passes until its budget ends; the last that would exceed it is left
    out, so a source falls short by less than one document. A null source is the source named by the empty string; null
    and empty texts have no tokens and come with the blocks they lie in; a null id has an empty name. Repeated rows, and
    rows that share an id, have the same place and are taken together. An empty table gives no rows.
    """
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"), F.col(text_col).alias("text"))
    mixed = taken(rows, plan(rows, "doc_id", "text", "source", **limits), "doc_id", "source")
    return mixed.select("row.doc_id", "row.source", token_count(F.col("row.text")).alias("n_tokens"), "epoch", "block", "block_key", "doc_key")
