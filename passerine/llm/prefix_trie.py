"""Prefix trie of conversations, from padded matrices of turn ids.

Conversations are cut into segments of ``WIDTH`` turns, so that one of any length is many rows of bounded width. Segments
are dealt by ranges of (depth of the segment, hash of the turns before, turn ids, conversation). A range is one task: its
rows are a padded matrix, lexsorted; a cell that differs from the row above starts a node, and so do all cells to its
right (OR accumulated); ``reduceat`` between the starts aggregates every depth. Only nodes at a range's two borders, or
above a conversation's next segment, are known in part. These few are joined by the hash of their turns, what is counted
twice is taken off, and sums go up from segment to segment by doubling the distance.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passerine.llm.shared import written
from passerine.operators.skew import adaptive_join, running

#: Turns of a segment, segments of a range (about), and turns at most that a conversation takes over from its base.
WIDTH, RANGE_ROWS, HEAD = 16, 65_536, 5
#: Characters of a piece of a list of ids that is digested piece by piece.
PIECE = 4096
_PAD = np.iinfo(np.int64).min
_NO_IDS = hashlib.sha256(b"").hexdigest()

_NODE = {
    "depth": pa.int64(), "k1": pa.int64(), "k2": pa.int64(), "q1": pa.int64(), "q2": pa.int64(), "conv_id": pa.int64(), "parent_conv_id": pa.int64(),
    "n_convs": pa.int64(), "n_children": pa.int64(), "n_leaves": pa.int64(), "saved_tokens": pa.int64(), "size": pa.int64(), "leaf": pa.int64(),
    "goes_on": pa.bool_(), "real": pa.bool_(), "open": pa.bool_(), "path1": pa.list_(pa.int64()), "path2": pa.list_(pa.int64()), "ends_sha256": pa.string(), "pieces": pa.list_(pa.string()), "first_end": pa.int64(),
}
_SQL = {pa.int64(): "long", pa.bool_(): "boolean", pa.string(): "string", pa.list_(pa.int64()): "array<long>", pa.list_(pa.string()): "array<string>"}


def head_length(conv_id: Column) -> Column:
    """How many turns a conversation takes over from its base, the conversation ``conv_id - conv_id % 100``."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % (HEAD + 1)).cast("int")


def rebuilt(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(turns, conversations): (conv_id, place, h1, h2, size) of every rebuilt turn, and (conv_id, length) of all.

    The order of a conversation's turns is computed over many tasks, however many turns it has.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), text.alias("text"),
    ).where("conv_id is not null")
    rows = rows.select("conv_id", "turn", "role", F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(17), "text", "role").alias("h2"), F.length("text").cast("long").alias("size"))
    own = written(running(rows, ["conv_id"], ["turn", "role", "h1"], {"place": ("count", F.lit(1))}).drop("turn", "role"), "trie-turns")
    counts = own.groupBy("conv_id").agg(F.count("*").alias("n"))
    base = F.col("conv_id") - F.col("conv_id") % 100
    is_base = F.col("conv_id") % 100 == 0
    heads = written(counts.where(is_base).select(F.col("conv_id").alias("base"), F.least(F.lit(HEAD).cast("long"), "n").alias("n_base")), "trie-bases")
    taken = lambda d: adaptive_join(d.withColumns({"base": base, "h": F.when(is_base, 0).otherwise(head_length(F.col("conv_id"))).cast("long")}), heads, ["base"]).withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0).cast("long"))))
    convs = taken(counts).withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0).cast("long")))
    tail = taken(own).where("place >= h").withColumn("place", F.col("place") - F.col("h") + F.col("taken"))
    first = own.where(is_base & (F.col("place") < HEAD)).select(F.col("conv_id").alias("base"), "place", "h1", "h2", "size")
    head = adaptive_join(convs.where("taken > 0").select("conv_id", "base", "taken"), first, ["base"], "inner").where("place < taken")  # 99 conversations a base, HEAD turns each
    columns = ["conv_id", "place", "h1", "h2", "size"]
    return tail.select(*columns).unionByName(head.select(*columns)), convs.select("conv_id", "length")


def segments(turns: DataFrame, convs: DataFrame, width: int) -> DataFrame:
    """(seg, p1, p2, ids, sizes, goes_on, conv_id): runs of ``width`` turns, with a hash of all turns before the run."""
    keyed = turns.select("conv_id", F.floor(F.col("place") / width).cast("long").alias("seg"), "place", F.xxhash64("place", "h1", "h2").alias("g1"), F.xxhash64("h2", "h1", "place").alias("g2"), "size")
    listed = F.array_sort(F.collect_list(F.struct("place", "g1", "g2", "size")))  # width at most
    runs = keyed.groupBy("conv_id", "seg").agg(listed.alias("l"), F.bit_xor("g1").alias("x1"), F.bit_xor("g2").alias("x2"))
    runs = written(runs.select("conv_id", "seg", F.flatten(F.transform("l", lambda t: F.array(t["g1"], t["g2"]))).alias("ids"), F.transform("l", lambda t: t["size"]).alias("sizes"), "x1", "x2"), "trie-runs")
    zero = F.lit(0).cast("long")
    full = (F.size("sizes") == width) | (F.col("seg") > 0)
    columns = ["seg", "p1", "p2", "ids", "sizes", "goes_on", "conv_id"]
    short = runs.where(~full).select("seg", zero.alias("p1"), zero.alias("p2"), "ids", "sizes", F.lit(False).alias("goes_on"), "conv_id")
    long = running(runs.where(full), ["conv_id"], ["seg"], {"p1": ("bit_xor", F.col("x1")), "p2": ("bit_xor", F.col("x2"))})
    long = adaptive_join(long, convs, ["conv_id"], "inner").withColumn("goes_on", F.col("length") > (F.col("seg") + 1) * width)
    empty = convs.where("length = 0").select(zero.alias("seg"), zero.alias("p1"), zero.alias("p2"), F.array().cast("array<long>").alias("ids"), F.array().cast("array<long>").alias("sizes"), F.lit(False).alias("goes_on"), "conv_id")
    return short.unionByName(long.select(*columns)).unionByName(empty)


def _pieces(ids: np.ndarray) -> list[str]:
    """The ids' decimals, comma-joined, in pieces of about ``PIECE`` characters; every piece but the last ends in a comma."""
    step = PIECE // 8
    parts = [",".join(map(str, ids[k : k + step].tolist())) for k in range(0, len(ids), step)]
    return [p + "," for p in parts[:-1]] + parts[-1:]


def _nodes(rows: pa.Table, width: int) -> pa.Table:
    """The nodes of one range's segments; those that reach its borders, or go on into a next segment, are open."""
    n = rows.num_rows
    column = lambda name: rows.column(name).to_numpy()
    sizes = rows.column("sizes").combine_chunks()
    depth = np.diff(sizes.offsets.to_numpy()).astype(np.int64)
    inside = np.arange(width) < depth[:, None]
    size = np.zeros((n, width), np.int64)
    size[inside] = sizes.flatten().to_numpy()
    ids = np.full((n, width, 2), _PAD)
    ids[inside] = rows.column("ids").combine_chunks().flatten().to_numpy().reshape(-1, 2)
    seg, p1, p2, conv, more = (column(c) for c in ("seg", "p1", "p2", "conv_id", "goes_on"))

    order = np.lexsort((conv, *ids.reshape(n, 2 * width).T[::-1], p2, p1, seg))
    ids, size, depth, seg, p1, p2, conv, more = (x[order] for x in (ids, size, depth, seg, p1, p2, conv, more.astype(np.int64)))
    change = np.ones((n, width + 1), bool)
    change[1:, 0] = (seg[1:] != seg[:-1]) | (p1[1:] != p1[:-1]) | (p2[1:] != p2[:-1])
    change[1:, 1:] = (ids[1:] != ids[:-1]).any(2)
    start = np.logical_or.accumulate(change, axis=1)
    is_node = start & (np.arange(width + 1) <= depth[:, None])

    # Keys of the nodes on every row: the hash of the turns before, and of one more turn from column to column.
    real_ids = np.where((np.arange(width) < depth[:, None])[:, :, None], ids, 0)
    key1 = np.bitwise_xor.accumulate(np.column_stack([p1, real_ids[:, :, 0]]), axis=1)
    key2 = np.bitwise_xor.accumulate(np.column_stack([p2, real_ids[:, :, 1]]), axis=1)

    groups = [np.flatnonzero(start[:, d]) for d in range(width + 1)]
    members = [np.diff(g, append=n) for g in groups]
    going = [np.add.reduceat(more, g) for g in groups]
    children = [np.add.reduceat(is_node[:, d + 1].astype(np.int64), g) if d < width else np.zeros(len(g), np.int64) for d, g in enumerate(groups)]
    least = [np.minimum.reduceat(conv, g) for g in groups]
    leaf, saved = np.zeros((n, width + 1), np.int64), np.zeros((n, width + 1), np.int64)
    for d, g in enumerate(groups):
        here = is_node[g, d]
        leaf[g, d] = here & (children[d] == 0) & ((going[d] == 0) | (d < width))
        if d:
            saved[g, d] = here * (members[d] - 1) * size[g, d - 1]
    virtual = seg[groups[0]] > 0  # the top of a later segment is the last node of the one before
    leaf[groups[0][virtual], 0] = 0
    leaves_below, saved_below = (np.cumsum(x[:, ::-1], axis=1)[:, ::-1] for x in (leaf, saved))

    out: dict[str, list] = {c: [] for c in _NODE}
    for d, g in enumerate(groups):
        keep = is_node[g, d]
        at, count = g[keep], members[d][keep]
        real = (seg[at] == 0) | (d > 0)
        ends = (depth[at] == d) & real  # a node's own rows come first
        border = (at == 0) | (at + count == n)
        opened = border | (going[d][keep] > 0) | ~real
        up = np.searchsorted(groups[d - 1], at, side="right") - 1 if d else None
        parent, known = np.zeros(len(at), np.int64), np.zeros(len(at), bool)
        if d:
            above, over = groups[d - 1][up], members[d - 1][up]
            parent = least[d - 1][up]
            known = ~((above == 0) | (above + over == n) | (going[d - 1][up] > 0) | ((d == 1) & (seg[at] > 0)))
        shas, pieces, first_end = [], [], []
        for a, c, some, is_open in zip(at.tolist(), count.tolist(), ends.tolist(), opened.tolist()):
            mine = np.zeros(0, np.int64)
            if some:
                mine = conv[a : a + c][(depth[a : a + c] == d) & (more[a : a + c] == 0)]
            pieces.append(_pieces(mine) if is_open else None)
            first_end.append(int(mine[0]) if is_open and len(mine) else None)
            shas.append(None if is_open else hashlib.sha256(",".join(map(str, mine.tolist())).encode()).hexdigest() if len(mine) else _NO_IDS)
        out["depth"].append(pa.array(seg[at] * width + d))
        out["k1"].append(pa.array(key1[at, d]))
        out["k2"].append(pa.array(key2[at, d]))
        out["q1"].append(pa.array(key1[at, max(0, d - 1)]))
        out["q2"].append(pa.array(key2[at, max(0, d - 1)]))
        out["conv_id"].append(pa.array(least[d][keep]))
        out["parent_conv_id"].append(pa.array(parent, mask=~known))
        out["n_convs"].append(pa.array(count * real))
        out["n_children"].append(pa.array(children[d][keep]))
        out["n_leaves"].append(pa.array(np.add.reduceat(leaves_below[:, d], g)[keep]))
        out["saved_tokens"].append(pa.array(np.add.reduceat(saved_below[:, d], g)[keep]))
        out["size"].append(pa.array(size[at, d - 1] if d else np.zeros(len(at), np.int64)))
        out["leaf"].append(pa.array(leaf[at, d]))
        out["goes_on"].append(pa.array((going[d][keep] > 0) & (d == width)))
        out["real"].append(pa.array(real))
        out["open"].append(pa.array(opened))
        for name, key in (("path1", key1), ("path2", key2)):
            out[name].append(pa.array([key[a, :d].tolist() if o else None for a, o in zip(at, opened)], pa.list_(pa.int64())))
        out["ends_sha256"].append(pa.array(shas, pa.string()))
        out["pieces"].append(pa.array(pieces, pa.list_(pa.string())))
        out["first_end"].append(pa.array(first_end, pa.int64()))
    return pa.table({c: pa.chunked_array(v, _NODE[c]) for c, v in out.items()})


def _digests(batches):
    """(depth, k1, k2, ends_sha256) of pieces sorted by node and place, gone through one after the other."""
    state, rows = {"node": None, "sha": None}, []
    for batch in batches:
        for depth, k1, k2, piece in zip(*(batch.column(c).to_pylist() for c in ("depth", "k1", "k2", "piece"))):
            if (depth, k1, k2) != state["node"]:
                if state["node"]:
                    rows.append((*state["node"], state["sha"].hexdigest()))
                state = {"node": (depth, k1, k2), "sha": hashlib.sha256()}
            elif not state["comma"]:
                state["sha"].update(b",")
            state["sha"].update(piece.encode())
            state["comma"] = piece.endswith(",")
        if len(rows) >= 10_000:
            yield _digest_batch(rows)
            rows = []
    if state["node"]:
        rows.append((*state["node"], state["sha"].hexdigest()))
    if rows:
        yield _digest_batch(rows)


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    names, kinds = ["depth", "k1", "k2", "ends_sha256"], [pa.int64()] * 3 + [pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], names=names)


def trie(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", width: int = WIDTH, range_rows: int = RANGE_ROWS) -> DataFrame:
    """A row for every node of the trie of rebuilt conversations.

    Columns: conv_id (its smallest member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256 (digest of the ids of the conversations that end there).

    Turns are ordered by number (null first), then role, then a hash of role and text; rows without a conversation id
    take no part; a null role or text is empty; a repeated row is a turn of its own. Conversations left without a turn end
    at the root. An empty table has no nodes. Very long texts count by their code points and only travel as hashes. A
    sequence of turns that a third of all conversations share lies in as many ranges as it needs; its nodes meet in a
    row for each range. Only the digest of the ids that end at one node goes through one task, piece by piece, as
    SHA-256 has to. Turns and nodes are known by two 64-bit hashes.
    """
    spark = df.sparkSession
    rows = written(segments(*(written(x, "trie-rebuilt") for x in rebuilt(df, conv_col, turn_col, role_col, text_col)), width), "trie-segments")
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // range_rows))

    def work(batches):
        table = pa.Table.from_batches(batches) if (batches := list(batches)) else None  # one range: about range_rows segments of bounded width
        if table is not None and table.num_rows:
            yield from _nodes(table, width).to_batches(max_chunksize=10_000)

    schema = ", ".join(f"{c} {_SQL[t]}" for c, t in _NODE.items())
    nodes = written(rows.repartitionByRange(ranges, "seg", "p1", "p2", "ids", "conv_id").mapInArrow(work, schema), "trie-nodes")
    key = ["depth", "k1", "k2"]
    parts = nodes.where("open").drop("open", "ends_sha256", "parent_conv_id")
    real, tops = parts.where("real"), parts.where("not real")
    whole = real.groupBy(*key).agg(
        F.max("q1").alias("q1"), F.max("q2").alias("q2"), F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
        F.max("size").alias("size"), F.sum("leaf").alias("leaf"), F.bool_or("goes_on").alias("goes_on"), F.count("*").alias("times"), F.max("path1").alias("path1"), F.max("path2").alias("path2"),
    )
    whole = written(whole, "trie-open")
    # A node that several ranges have was counted in each: as its parent's child, as a leaf, and once too little as saved.
    zero = F.lit(0).cast("long")
    one_leaf = F.when((F.col("n_children") == 0) & ~F.col("goes_on"), 1).otherwise(0)
    off = whole.select("depth", *key[1:], "path1", "path2", (1 - F.col("times")).alias("children"), (one_leaf - F.col("leaf")).alias("leaves"), ((F.col("times") - 1) * F.col("size")).alias("saved")).where("children <> 0 or leaves <> 0")
    pairs = F.zip_with(F.concat("path1", F.array("k1")), F.concat("path2", F.array("k2")), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    steps = lambda d: d.select("*", F.size("path1").alias("length"), F.posexplode(pairs).alias("at", "e")).select(
        (F.col("depth") - F.col("length") + F.col("at")).alias("depth"), F.col("e.a").alias("k1"), F.col("e.b").alias("k2"), (F.col("length") - F.col("at")).alias("above"),
        # The top of a later segment gets its sums in one go, with those of the segments below.
        ((F.col("at") == 0) & (F.col("depth") > F.col("length")) & (F.col("length") > 0)).alias("top"), "children", "leaves", "saved",
    )
    mended = steps(off).withColumn("children", F.when(F.col("above") == 1, F.col("children")).otherwise(0).cast("long"))
    below = mended.groupBy(*key).agg(*(F.sum(c).alias(c) for c in ("children", "leaves", "saved")))
    # What lies under the top of a later segment, then under all segments below it.
    top_sums = tops.groupBy(*key).agg(F.sum("n_children").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    under = whole.where("goes_on").select(*key, "path1", "path2")
    own = adaptive_join(adaptive_join(under, top_sums, key, "inner"), below.select(*key, F.col("children").alias("c"), F.col("leaves").alias("l"), F.col("saved").alias("s")), key)
    # The corrections at a segment's top come from below it and from the node itself, as the last of its own segment.
    self_off = off.select(*key, F.col("leaves").alias("l0"), F.col("saved").alias("s0"))
    own = adaptive_join(own, self_off, key).select(
        *key, F.col("path1")[0].alias("u1"), F.col("path2")[0].alias("u2"), "path1", "path2", F.col("children").alias("children"),
        (F.col("leaves") + F.coalesce("l", zero) - F.coalesce("l0", zero)).alias("leaves"), (F.col("saved") + F.coalesce("s", zero) - F.coalesce("s0", zero)).alias("saved"),
    )
    totals = _summed_up(written(own, "trie-tops"), width)
    carried = steps(totals).withColumn("children", F.when(F.col("above") == 0, F.col("children")).otherwise(0).cast("long"))
    counted = lambda c: F.sum(c) if c == "children" else F.sum(F.when(~F.col("top"), F.col(c)))
    added = mended.unionByName(carried).groupBy(*key).agg(*(counted(c).alias(c) for c in ("children", "leaves", "saved")))
    fixed = adaptive_join(whole, added, key).select(
        *key, "q1", "q2", "conv_id", F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", (F.col("n_children") + F.coalesce("children", zero)).alias("n_children"),
        (F.col("n_leaves") + F.coalesce("leaves", zero)).alias("n_leaves"), (F.col("saved_tokens") + F.coalesce("saved", zero)).alias("saved_tokens"),
    )
    pieces = real.where("first_end is not null").select(*key, "first_end", F.posexplode("pieces").alias("nth", "piece"))
    digests = pieces.repartition(*key).sortWithinPartitions(*key, "first_end", "nth").drop("first_end", "nth").mapInArrow(_digests, "depth long, k1 long, k2 long, ends_sha256 string")
    fixed = written(adaptive_join(fixed, digests, key).fillna({"ends_sha256": _NO_IDS}), "trie-fixed")
    closed = nodes.where("not open").select(*fixed.columns)
    parents = fixed.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("conv_id").alias("parent"))
    orphans = closed.where("parent_conv_id is null").unionByName(fixed)
    placed = adaptive_join(orphans, parents, ["depth", "q1", "q2"]).withColumn("parent_conv_id", F.col("parent"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return closed.where("parent_conv_id is not null").select(*columns).unionByName(placed.select(*columns))


def _summed_up(own: DataFrame, width: int) -> DataFrame:
    """``own`` with leaves and savings of all segments below: each adds its sums to the one 1, 2, 4, ... segments above."""
    spark = own.sparkSession
    deepest = own.agg(F.max("depth")).first()[0] or 0
    state = own
    for k in itertools.count():
        step = width * 2**k
        if step > deepest - width:
            return state
        # (u1, u2) is the top ``step`` turns above; the sums of those that are exactly so far below are still to come.
        from_below = state.where(F.col("depth") > step).groupBy((F.col("depth") - step).alias("depth"), F.col("u1").alias("k1"), F.col("u2").alias("k2")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        jumps = state.select((F.col("depth") + step).alias("depth"), F.col("k1").alias("u1"), F.col("k2").alias("u2"), F.col("u1").alias("v1"), F.col("u2").alias("v2"))
        joined = adaptive_join(adaptive_join(state, from_below, ["depth", "k1", "k2"]), jumps, ["depth", "u1", "u2"])
        state = written(joined.select(
            "depth", "k1", "k2", F.col("v1").alias("u1"), F.col("v2").alias("u2"), "path1", "path2", "children",
            (F.col("leaves") + F.coalesce("l", F.lit(0).cast("long"))).alias("leaves"), (F.col("saved") + F.coalesce("s", F.lit(0).cast("long"))).alias("saved"),
        ), "trie-tops")
