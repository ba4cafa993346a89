"""Line dedup: an exact set-similarity join of all lines, after which later matches go.

A line is the set of its words. Lines of equal sets are found by grouping; other pairs by prefix filtering. Tokens are
ordered by rarity, as far as a table of ``2 ** SLOT_BITS`` counters tells it (any order gives right results): lines of
similarity t or more share a token among their first n - ceil(t n) + 1. Short lines, whose rare tokens are common words, are
met by three tokens instead of one: similar lines share three among the first n - ceil(t n) + 3. Candidates then pass the
length filter, the positional filter and a filter on a bitmap of the tokens before the sets themselves are compared.

Buckets are dealt into parts of bounded size, and shuffled as one row for each part that a slice of texts has rows for. No
bucket of a token is expanded into all its pairs. A part's rows are sorted by bucket and name, and a task walks over them, holding
each line against the ``WINDOW`` before it in its bucket, as far as their lengths allow a match. A line needs one earlier
match to go, so of a row's candidates only the oldest is put out: pairs grow with the lines, not with the square of a group
of near copies. Rows with further candidates, or whose bucket exceeds the window, are marked. What is verified so settles
most lines of such groups. Only those that are still unsettled are joined with the other marked rows of their bucket, so no
match is lost. Buckets that the counters show to be hot are salted.

Whole texts are read twice: once for the counters and the names of all lines, once for the buckets. The sets to compare are
read from the places of the candidates alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import chain, combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passerine.llm.arrow import hash_strings, map_slices, mix, owners, plain, release, slices, texts_of, words
from passerine.llm.shared import in_slots, slots, written
from passerine.operators.skew import adaptive_join

#: Jaccard similarity of matching lines, as a fraction of whole numbers.
SIMILAR, OF = 4, 5
#: Counters of the rarity table (1 MB), bits of the filter that finds candidate lines again (4 MB), rows of one salt.
SLOT_BITS, FILTER_BITS, HOT_ROWS = 18, 25, 1 << 17
#: Lines up to this many tokens are met by three tokens.
SHORT = 12
#: Rows of a bucket that a row is held against, and rows that a task looks at together.
WINDOW, STEP = 512, 1 << 16
#: Rows that a part of the buckets has at most, about; and at least, if there are ``PARTS`` for each partition, so that these
#: are even. Counters in a row of the rarity table.
PART_ROWS, LEAST_ROWS, PARTS, CHUNK = 1 << 19, 1 << 14, 8, 1 << 12

_LEAST = 4  # fewer tokens match equal sets only
_WIDEST = SHORT * OF // SIMILAR  # the longest line that a short one can match
_ONE, _A, _B, _C = (np.uint64(x) for x in np.random.Generator(np.random.PCG64(11)).integers(0, 2**63, 4) * 2 + 1)
_N_SHIFT, _N_MOST = 54, 511
_POS_MOST = 127
_AGE = 2**63 - 1  # bits of ``rest`` beside its sign, which marks rows with more candidates than were put out
_LINE = 1_640_531_527  # spreads the numbers of lines


def _distinct(*columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct rows of the columns, sorted by the first, then the second and so on."""
    if len(columns) == 1:
        columns = (np.sort(columns[0]),)
    else:
        order = np.lexsort(columns[::-1])
        columns = tuple(c[order] for c in columns)
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return tuple(c[new] for c in columns)


def _overlap_least(n: np.ndarray) -> np.ndarray:
    """ceil(t * n): tokens that a line of n shares with any match at least."""
    return -(-n * SIMILAR // OF)


#: Where a line stands: its document's name, and the rest of that name (31 bits) with the line's number (32 bits).
_PLACE = "struct<doc: decimal(38,0), at: bigint>"
_PLACE_ARROW = pa.struct([("doc", pa.decimal128(38)), ("at", pa.int64())])


def with_names(docs: DataFrame) -> DataFrame:
    """(doc, rest, text) of (doc_id, text): ``doc`` orders documents by id and then by 62 bits of a hash of the text; ``rest``
    has 31 more bits, above the 32 for a line's number. Rows that share an id, or have none, are told apart by 93 bits."""
    number = "(cast(coalesce(cast(doc_id as decimal(20,0)), -9223372036854775808BD) as decimal(20,0)) + 9223372036854775808BD)"
    name = F.expr(f"{number} * {2**62}BD + (xxhash64(text) & {2**62 - 1}L)")
    return docs.withColumns({"doc": name.cast("decimal(38,0)"), "rest": F.expr(f"shiftleft(xxhash64(7, text) & {2**31 - 1}L, 32)")})


class Lines:
    """The lines with words of a slice of documents: their distinct tokens, by rarity if ``counts`` is given.

    ``some`` takes documents and numbers of lines, and tells which of them are wanted.
    """

    def __init__(self, texts: pa.Array, counts: np.ndarray | None = None, some: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None):
        lists = pc.split_pattern(texts, "\n")
        at = lists.offsets.to_numpy().astype(np.int64)
        doc = owners(at - at[0])
        number = np.arange(len(doc)) - (at - at[0])[doc]
        text = lists.flatten()
        if some is not None:
            wanted = np.flatnonzero(some(doc, number))
            text, doc, number = text.take(pa.array(wanted)), doc[wanted], number[wanted]
        vocabulary, codes, ends = words(text)
        hashed = hash_strings(vocabulary)
        self.slot = (hashed >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        self.times = np.bincount(codes, minlength=len(hashed))
        width = max(1, len(hashed))
        if counts is not None:
            count = counts[self.slot]
            order = np.lexsort((hashed, count))
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            codes, hashed, count = rank[codes], hashed[order], count[order]
        (unique,) = _distinct(owners(ends) * width + codes)
        line, token = unique // width, unique % width
        self.tokens = hashed[token]
        if counts is not None:
            self.count = count[token]
        n = np.bincount(line, minlength=len(doc))
        full = n > 0
        self.doc, self.number, self.n = doc[full], number[full], n[full]
        self.at = np.concatenate([[0], np.cumsum(self.n)])
        first, more = (np.add.reduceat(mix(hashed ^ c)[token], self.at[:-1]) if len(self.n) else hashed[:0] for c in (_A, _B))  # in any order of tokens
        #: Name of a line in two halves of 63 and 62 bits, of which the first also holds its length.
        self.names = (np.minimum(self.n, _N_MOST) << _N_SHIFT) | (mix(first) & np.uint64(2**_N_SHIFT - 1)).astype(np.int64)
        self.more = (mix(more) & np.uint64(2**62 - 1)).astype(np.int64)

    def places(self, docs: pa.Array, rests: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Document (two words) and the rest of the place: the order of age."""
        return _decimal_words(docs)[self.doc], rests.to_numpy(zero_copy_only=False)[self.doc] + self.number


def _decimal_words(values: pa.Array) -> np.ndarray:
    whole = pa.concat_arrays([values])
    return np.frombuffer(whole.buffers()[1], np.uint64)[: 2 * len(whole)].reshape(-1, 2).copy()


def _decimals(pairs: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.decimal128(38), len(pairs), [None, pa.py_buffer(np.ascontiguousarray(pairs).tobytes())])


def _structs(docs: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.StructArray.from_arrays([_decimals(docs), pa.array(at)], names=["doc", "at"])


def _most_postings(n: np.ndarray) -> np.ndarray:
    """How many buckets lines of n tokens are put into at most."""
    return np.where(n > SHORT, n - _overlap_least(n) + 1, 0) + _THREES[np.minimum(n, _WIDEST + 1)]


_THREES = np.array([comb(n - int(_overlap_least(np.int64(n))) + 3, 3) if _LEAST <= n <= _WIDEST else 0 for n in range(_WIDEST + 2)])


def _added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the rows of each chunk of counters."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts")):
            total[chunk] = total.get(chunk, 0) + np.frombuffer(counts.as_buffer(), np.int64)
    yield _chunks(total)


def _chunks(total: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["chunk", "counts"])


def _read(docs: DataFrame) -> tuple[DataFrame, np.ndarray, int]:
    """(doc_id, doc, rest, name, more, number) of every document, the last three with an element for each line with words;
    the occurrences of all words in ``2 ** SLOT_BITS`` slots of their hash; and how many rows the buckets have at most."""

    def read(batches):
        total, most = np.zeros(2**SLOT_BITS, np.int64), 0
        for part in slices(batches, "text"):
            lines = Lines(plain(part.column("text")))
            total += np.bincount(lines.slot, lines.times, minlength=2**SLOT_BITS).astype(np.int64)
            most += int(_most_postings(lines.n).sum())
            at = pa.array(np.concatenate([[0], np.cumsum(np.bincount(lines.doc, minlength=part.num_rows))]), pa.int32())
            lists = [pa.ListArray.from_arrays(at, pa.array(x, t)) for x, t in ((lines.names, pa.int64()), (lines.more, pa.int64()), (lines.number, pa.int32()))]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names[:3]), *lists, *(pa.nulls(part.num_rows, t) for t in (pa.int32(), pa.binary()))], names=names)
        counted = _chunks({-1: np.array([most])} | {k: x for k, x in enumerate(total.reshape(-1, CHUNK)) if x.any()})
        none = pa.int64(), pa.decimal128(38), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32())
        yield pa.RecordBatch.from_arrays([*(pa.nulls(counted.num_rows, t) for t in none), *counted.columns], names=names)
        release()

    names = ["doc_id", "doc", "rest", "name", "more", "number", "chunk", "counts"]
    kind = "doc_id long, doc decimal(38,0), rest long, name array<long>, more array<long>, number array<int>, chunk int, counts binary"
    kept = written(docs.select("doc_id", "doc", "rest", "text").mapInArrow(read, kind), "lines-names")
    counted = kept.where("chunk is not null").select("chunk", "counts")
    found = {r.chunk: np.frombuffer(r.counts, np.int64) for r in counted.mapInArrow(_added, counted.schema).repartition("chunk").mapInArrow(_added, counted.schema).collect()}
    most = int(found.pop(-1, np.zeros(1, np.int64))[0])
    counts = np.zeros((2**SLOT_BITS // CHUNK, CHUNK), np.int64)
    for chunk, times in found.items():
        counts[chunk] = times
    return kept.where("chunk is null").drop("chunk", "counts"), counts.ravel(), most


def _first_of(keys: tuple[np.ndarray, ...], age: tuple[np.ndarray, ...]) -> np.ndarray:
    """Marks one of the rows of each key: the one of least age."""
    order = np.lexsort((*age, *keys))
    first = np.zeros(len(order), bool)
    first[order[:1]] = True
    for key in keys:
        first[order[1:]] |= key[order][1:] != key[order][:-1]
    return first


def _postings(lines: Lines, doc_ids: np.ndarray) -> tuple[np.ndarray, ...]:
    """(bucket, name, more, rest, bits) for every bucket of every line that can match an unequal one.

    The bucket's low bits hold whether three tokens made it, and the power of two of its salts; ``rest`` holds age (as far
    as 24 bits tell it), the position of the bucket's last token, and the first 32 of the 96 parities of the tokens' bitmap. Those
    of two sets differ in no more places than the sets in tokens, whatever their lengths. A token that occurs once makes no bucket.
    """
    place = (lines.tokens & np.uint64(2**32 - 1)) * np.uint64(96) >> np.uint64(32)
    low = np.where(place < 32, np.uint64(1) << (place & np.uint64(31)), np.uint64(0)).astype(np.int64)
    high = np.where(place >= 32, np.uint64(1) << (place & np.uint64(63)), np.uint64(0)).astype(np.int64)  # 32..95: each bit once
    bitmap, bits = (np.bitwise_xor.reduceat(b, lines.at[:-1]) if len(lines.n) else b[:0] for b in (low, high))
    age = np.maximum(doc_ids, 0).astype(np.float32).view(np.int32).astype(np.int64)[lines.doc] >> 7
    rest = (age << 39) | bitmap
    oldest = _first_of((lines.names, lines.more), (age,))  # copies of a line within the slice stand behind their oldest
    found: list[tuple] = []

    def put(line, hashed, position, count, three):
        met = count > 1
        line, hashed, position, count = line[met], hashed[met], position[met], count[met]
        salts = np.ceil(np.log2(np.maximum(1, -(-count // HOT_ROWS)))).astype(np.int64)
        bucket = (mix(hashed).astype(np.int64) & ~np.int64(63)) | (salts << 1) | three
        found.append((bucket, lines.names[line], lines.more[line], rest[line] | (np.minimum(position, _POS_MOST) << 32), bits[line]))

    long = np.flatnonzero(oldest & (lines.n > SHORT))
    prefix = lines.n[long] - _overlap_least(lines.n[long]) + 1
    line = np.repeat(long, prefix)
    position = np.arange(len(line)) - np.repeat(np.cumsum(prefix) - prefix, prefix)
    at = lines.at[line] + position
    put(line, lines.tokens[at] + _ONE, position, lines.count[at], 0)
    for n in range(_LEAST, _WIDEST + 1):
        line = np.flatnonzero(oldest & (lines.n == n))
        some = np.array(list(combinations(range(n - int(_overlap_least(np.int64(n))) + 3), 3)))
        at = lines.at[line][:, None, None] + some
        t, c = lines.tokens[at], lines.count[at].min(axis=2)
        hashed = t[:, :, 0] * _A + t[:, :, 1] * _B + t[:, :, 2] * _C
        put(np.repeat(line, len(some)), hashed.ravel(), np.tile(some[:, 2], len(line)), c.ravel(), 1)
    return tuple(np.concatenate(x) for x in zip(*found))


_ROW = ["bucket", "name", "more", "rest", "bits"]


def _packed(found: tuple[np.ndarray, ...], parts: int) -> pa.RecordBatch:
    """(part, rows): the postings of each part, five numbers a row. All rows of a bucket and salt are of one part."""
    bucket, name = (x.view(np.uint64) for x in found[:2])
    salts = np.uint64(1) << (bucket >> np.uint64(1) & np.uint64(31))
    part = (mix(bucket + (mix(name) & (salts - np.uint64(1))) * _ONE) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
    order = np.argsort(part.astype(np.min_scalar_type(parts)), kind="stable")
    rows = np.stack(found, axis=1)[order]
    size = np.bincount(part.astype(np.int64), minlength=parts)
    some = np.flatnonzero(size)
    ends = np.concatenate([[0], np.cumsum(size[some])]) * (8 * len(_ROW))
    packed = pa.Array.from_buffers(pa.large_binary(), len(some), [None, pa.py_buffer(ends), pa.py_buffer(rows)]).cast(pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), packed], names=["part", "rows"])


def _unpacked(batches: Iterable[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """For rows sorted by part: the postings of each part, sorted by bucket."""
    held, last = [], None
    for batch in chain(batches, [None]):
        for part, rows in zip(batch.column("part").to_pylist(), batch.column("rows")) if batch is not None else [(None, None)]:
            if part != last and held:
                whole = np.concatenate(held)
                held = []
                yield whole[np.argsort(whole[:, 0])]
            last = part
            if rows is not None:
                held.append(np.frombuffer(rows.as_buffer(), np.int64).reshape(-1, len(_ROW)))


def _passes(name_a, name_b, rest_a, rest_b, bits_a, bits_b, bucket):
    """Length, positional and bitmap filter for pairs of different lines of a bucket, on numpy arrays."""
    n, m = name_a >> _N_SHIFT, name_b >> _N_SHIFT
    known = (n < _N_MOST) & (m < _N_MOST)
    length = np.minimum(n, m) * OF >= np.maximum(n, m) * SIMILAR
    need = -(-(n + m) * SIMILAR // (SIMILAR + OF))
    p, q = (rest_a >> 32) & _POS_MOST, (rest_b >> 32) & _POS_MOST
    position = (1 + 2 * (bucket & 1) + np.minimum(n - p - 1, m - q - 1) >= need) | (p == _POS_MOST) | (q == _POS_MOST)
    differ = np.bitwise_count((rest_a ^ rest_b) & (2**32 - 1)).astype(np.int64) + np.bitwise_count((bits_a ^ bits_b).view(np.uint64)) <= n + m - 2 * need
    return length & (~known | (position & differ))


def _passes_sql(a: str, b: str) -> Column:
    """The same filters as a join condition."""
    n, m = f"shiftright({a}.name, {_N_SHIFT})", f"shiftright({b}.name, {_N_SHIFT})"
    need = f"ceil(({n} + {m}) * {SIMILAR} / {SIMILAR + OF}D - 1e-9)"
    p, q = f"(shiftright({a}.rest, 32) & {_POS_MOST})", f"(shiftright({b}.rest, 32) & {_POS_MOST})"
    return F.expr(f"""
        ({a}.name <> {b}.name OR {a}.more <> {b}.more) AND least({n}, {m}) * {OF} >= greatest({n}, {m}) * {SIMILAR}
        AND ({n} >= {_N_MOST} OR {m} >= {_N_MOST} OR (
            (1 + 2 * ({a}.bucket & 1) + least({n} - {p} - 1, {m} - {q} - 1) >= {need} OR {p} = {_POS_MOST} OR {q} = {_POS_MOST})
            AND bit_count(({a}.rest ^ {b}.rest) & {2**32 - 1}L) + bit_count({a}.bits ^ {b}.bits) <= {n} + {m} - 2 * {need}))
    """)


def _oldest(name, rest, bits, bucket, k) -> tuple[np.ndarray, ...]:
    """For different lines sorted by bucket and length, with their place in the bucket: the number of candidates that may be older, the oldest
    of them, whether the row is one of another's, and whether rows beyond the window may be candidates too."""
    n, age, length = len(name), (rest & _AGE) >> 39, name >> _N_SHIFT
    found, best, who, met, far = np.zeros(n, np.int64), np.full(n, 1 << 62), np.zeros(n, np.int64), np.zeros(n, bool), np.zeros(n, bool)
    at = np.arange(n)
    for d in range(1, WINDOW + 2):
        at = at[k[at] >= d]
        at = at[length[at - d] * OF >= length[at] * SIMILAR]  # rows before are shorter still
        if not len(at):
            break
        if d > WINDOW:
            far[at] = far[at - d] = True
            break
        b = at[_passes(name[at], name[at - d], rest[at], rest[at - d], bits[at], bits[at - d], bucket[at])]
        for new, old in ((b, b - d), (b - d, b)):
            older = age[old] <= age[new]  # of equal age, as far as it is known: either may be
            new, old = new[older], old[older]
            found[new] += 1
            met[old] = True
            better = age[old] < best[new]
            best[new[better]], who[new[better]] = age[old[better]], old[better]
    return found, who, met, far


def _walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by bucket: marked rows for the join, and candidate pairs. A pair has no bucket; (name, more) and (rest, bits) are its two lines. The sign of a marked row's ``rest`` tells that it has candidates
    which were not put out; other marked rows are such candidates.

    Whole buckets are looked at together; of one that exceeds ``HOT_ROWS``, so many rows at once, and all of them are marked.
    """
    held, cut = [np.zeros(0, np.int64) for _ in _ROW], None  # ``cut``: the bucket that goes on from what was looked at
    for batch in chain(batches, [None]):
        if batch is not None:
            held = [np.concatenate([x, batch.column(c).to_numpy(zero_copy_only=False)]) for x, c in zip(held, _ROW)]
        total = len(held[0])
        if not total or batch is not None and total < STEP:
            continue
        stop = total if batch is None else int(np.searchsorted(held[0], held[0][-1]))
        last = None
        if total - stop >= HOT_ROWS:
            stop, last = total, held[0][-1]
        if not stop:
            continue
        bucket = held[0][:stop]
        group = np.cumsum(np.append(True, bucket[1:] != bucket[:-1]))
        # By bucket, length, and 28 bits of the name; salts of a bucket that meet in a task may as well be held against each other.
        order = np.argsort(group << 37 | held[1][:stop] >> (_N_SHIFT - 28), kind="stable")
        bucket, name, more, rest, bits = (x[:stop][order] for x in held)
        held = [x[stop:].copy() for x in held]
        own = np.append(True, (bucket[1:] != bucket[:-1]) | (name[1:] != name[:-1]) | (more[1:] != more[:-1]))
        rest = np.minimum.reduceat(rest, np.flatnonzero(own))  # copies of a line differ in age: they stand behind their oldest
        bucket, name, more, bits = (x[own] for x in (bucket, name, more, bits))
        start = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        size = np.diff(np.append(start, len(bucket)))
        found, who, met, seeks = _oldest(name, rest, bits, bucket, np.arange(len(bucket)) - np.repeat(start, size))
        seeks |= (bucket >> 1 & 31) > 0  # other salts have rows of the bucket too
        for part in {cut, last} - {None}:
            seeks |= bucket == part
        cut = last
        seeks |= found > 1
        row = np.flatnonzero(seeks | met & np.repeat(np.logical_or.reduceat(seeks, start), size))
        new = np.flatnonzero(found)
        a, b = np.minimum(new, who[new]), np.maximum(new, who[new])  # in the order of (name, more)
        pairs = _distinct(name[a], more[a], name[b], more[b])
        marked = name[row], more[row], np.where(seeks[row], rest[row] | ~_AGE, rest[row]), bits[row]
        no = np.concatenate([np.ones(len(pairs[0]), bool), np.zeros(len(row), bool)])
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([np.zeros(len(pairs[0]), np.int64), bucket[row]]), mask=no),
            *(pa.array(np.concatenate(x)) for x in zip(pairs, marked)),
        ], names=_ROW)


def _walk_parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by part: what :func:`_walk` gives for each part."""
    for rows in _unpacked(batches):
        steps = (rows[k : k + STEP].T for k in range(0, len(rows), STEP))
        yield from _walk(pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in step], names=_ROW) for step in steps)
    release()


def _matches(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(place, name, more) of the newer line of every verified pair."""
    side = lambda x: sets.select(*(F.col(c).alias(f"{c}_{x}") for c in ("name", "more", "tokens", "place")))
    both = F.size(F.array_intersect("tokens_a", "tokens_b"))
    found = pairs.join(side("a"), ["name_a", "more_a"]).join(side("b"), ["name_b", "more_b"])
    found = found.where(both * (SIMILAR + OF) >= SIMILAR * (F.size("tokens_a") + F.size("tokens_b"))).where("place_a <> place_b")
    return found.select(*(F.when(F.col("place_a") > F.col("place_b"), F.col(f"{c}_a")).otherwise(F.col(f"{c}_b")).alias(c) for c in ("place", "name", "more")))


def later_matches(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc, rest, line) of every line of (doc, rest, doc_id, text) that matches an earlier one; and what :func:`_read` kept."""
    every, total, most = _read(docs)
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(most // PART_ROWS, min(PARTS * partitions, most // LEAST_ROWS)) + 1
    counts = docs.sparkSession.sparkContext.broadcast(total)  # 2 ** SLOT_BITS counters
    line_key = ["name", "more"]
    again = written(_named(every, every.select(F.explode("name").alias("name")).groupBy("name").count().where("count > 1").select("name")), "lines-again")
    oldest = again.groupBy(*line_key).agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    copies = adaptive_join(again, oldest, line_key, "inner").where("place <> first").select("place")

    def postings(batch):
        lines = Lines(plain(batch.column("text")), counts.value)
        found = _postings(lines, batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False))
        return _packed(found, parts)

    rows = map_slices(docs.select("doc_id", "text"), "text", postings, "part int, rows binary")
    dealt = rows.repartition("part").sortWithinPartitions("part")
    walked = written(dealt.mapInArrow(_walk_parts, ", ".join(f"{c} long" for c in _ROW)), "lines-walked")

    both = ["name_a", "more_a", "name_b", "more_b"]
    first = written(walked.where("bucket is null").select("name", "more", "rest", "bits").toDF(*both).distinct(), "lines-pairs")
    near = written(_matches(first, _sets(docs, first, every)), "lines-matches")
    crowd = walked.where("bucket is not null")
    open_ = adaptive_join(crowd.where("rest < 0"), near.select(*line_key).distinct(), line_key, "left_anti")
    u, v = open_.alias("u"), crowd.alias("v")
    older = F.expr(f"(shiftright(v.rest, 39) & {_AGE >> 39}L) <= (shiftright(u.rest, 39) & {_AGE >> 39}L)")
    second = u.join(v, F.expr("u.bucket = v.bucket") & _passes_sql("u", "v") & older)
    ends = [F.struct(f"{x}.name", f"{x}.more") for x in "uv"]
    second = second.select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b")).select("a.name", "a.more", "b.name", "b.more").toDF(*both).distinct()
    second = written(second.join(first, both, "left_anti"), "lines-pairs")
    if not second.isEmpty():
        near = near.unionByName(_matches(second, _sets(docs, second, every)))
    gone = copies.unionByName(near.select("place")).distinct().select("place.doc", "place.at")
    return gone.select("doc", F.expr(f"at & {~(2**32 - 1)}L").alias("rest"), F.expr(f"at & {2**32 - 1}L").cast("int").alias("line")), every


def _named(every: DataFrame, names: DataFrame) -> DataFrame:
    """(name, more, place) of all lines that have one of the names, and a few more: told by a filter instead of a join."""
    filled = every.sparkSession.sparkContext.broadcast(slots(names, F.shiftleft("name", 64 - _N_SHIFT), FILTER_BITS))  # the hashed part

    def some(batches):
        for batch in batches:
            lists = batch.column("name")
            name, more, number = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("name", "more", "number"))
            met = np.flatnonzero(in_slots(filled.value, name << (64 - _N_SHIFT), FILTER_BITS))
            doc = owners(lists.offsets.to_numpy())[met]
            place = _structs(_decimal_words(batch.column("doc"))[doc], batch.column("rest").to_numpy(zero_copy_only=False)[doc] + number[met])
            yield pa.RecordBatch.from_arrays([pa.array(name[met]), pa.array(more[met]), place], names=["name", "more", "place"])

    return every.select("doc", "rest", "name", "more", "number").mapInArrow(some, f"name long, more long, place {_PLACE}")


def _sets(docs: DataFrame, pairs: DataFrame, every: DataFrame) -> DataFrame:
    """(name, more, tokens, place) of every set that is named in the pairs, with its oldest place."""
    line = ["name", "more"]
    names = pairs.select(F.col("name_a").alias("name")).unionByName(pairs.select(F.col("name_b").alias("name")))
    wanted = written(_named(every, names).groupBy(*line).agg(F.min("place").alias("place")).select("place"), "lines-wanted")
    # What tells documents apart, and above it, spread, what tells their lines apart.
    key = F.expr(f"xxhash64(place.doc) ^ shiftleft((place.at & {2**32 - 1}L) * {_LINE}L, 24)")
    filled = docs.sparkSession.sparkContext.broadcast(slots(wanted, key, FILTER_BITS))

    def find(batch):
        marks = batch.column("mark").to_numpy(zero_copy_only=False).astype(np.uint64)
        some = lambda doc, number: in_slots(filled.value, marks[doc] ^ ((number.astype(np.uint64) * np.uint64(_LINE)) << np.uint64(24)), FILTER_BITS)
        lines = Lines(plain(batch.column("text")), some=some)
        tokens = pa.ListArray.from_arrays(pa.array(lines.at, pa.int32()), pa.array(lines.tokens.view(np.int64)))
        place = _structs(*lines.places(batch.column("doc"), batch.column("rest")))
        return pa.RecordBatch.from_arrays([pa.array(lines.names), pa.array(lines.more), tokens, place], names=["name", "more", "tokens", "place"])

    read = docs.select("doc", "rest", F.xxhash64("doc").alias("mark"), "text")
    made = map_slices(read, "text", find, f"name long, more long, tokens array<long>, place {_PLACE}")
    return written(made.groupBy(*line).agg(F.first("tokens").alias("tokens"), F.min("place").alias("place")), "lines-sets")


def removed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_removed, removed) for every row of ``df``.

    ``n_lines`` counts the lines with a word; ``removed`` lists the numbers (from 0) of those that match an earlier line
    (order: doc_id, then text, then line number), joined by commas. A line without words never goes. Equal sets of words
    match whatever their order. Null texts have no lines. A null id comes before all others. Rows that repeat an id
    and text are one document: its lines match neither each other's copies nor go twice, and each row gets the same result.
    """
    docs = with_names(texts_of(df, id_col, text_col))
    found, every = later_matches(docs)
    gone = found.groupBy("doc", "rest").agg(F.sort_array(F.collect_set("line")).alias("lines"))  # at most the document's lines
    sized = adaptive_join(every.select("doc_id", "doc", "rest", F.size("name").cast("long").alias("n_lines")), gone, ["doc", "rest"])
    return sized.select("doc_id", "n_lines", F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_removed"), F.coalesce(F.array_join("lines", ","), F.lit("")).alias("removed"))


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``df`` with later matches cut out of their texts; a document of which no word is left goes.

    Cases as in :func:`removed`; documents without words stay as they are. Columns of any name are carried along.
    """
    gone = later_matches(with_names(texts_of(df, id_col, text_col)))[0].groupBy("doc", "rest").agg(F.collect_set("line").alias("lines"))
    held = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.struct("*").alias("row"))
    joined = adaptive_join(with_names(held).select("doc", "rest", "row"), gone, ["doc", "rest"]).select("row.*", "lines").toDF(*(f"c{k}" for k in range(len(df.columns) + 1)))  # names may clash
    names, place = df.columns, df.columns.index(text_col)

    def cut(batches):
        for batch in batches:
            for part in slices([batch], f"c{place}"):
                texts, keep = [], []
                for text, lines in zip(part.column(place).to_pylist(), part.column(part.num_columns - 1).to_pylist()):
                    if lines:
                        drop = set(lines)
                        text = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in drop)
                    texts.append(text)
                    keep.append(not lines or bool(text.strip(" \t\n\r\x0b\x0c")))
                columns = part.columns[:-1]
                columns[place] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep)) for c in columns], names=names)
        release()

    return joined.mapInArrow(cut, df.schema)
