"""Bounded slices, words and hashes of Arrow text columns."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Text bytes that a task works on at once; a longer single text is a slice of its own.
SLICE_BYTES = 4 << 20

_RANDOM = np.random.Generator(np.random.PCG64(20240131))
_BYTE = _RANDOM.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = int(_RANDOM.integers(0, 2**62)) * 4 + 3

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches by the bytes of a text column: balanced work and bounded memory whatever the row lengths are."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(lengths, dtype=np.int64), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def release() -> None:
    """Give freed memory back to the system: a Python worker stays after its task, and others need the executor's memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU C library has it
    if trim:
        trim(0)


def map_slices(df: DataFrame, column: str, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, limit: int = SLICE_BYTES) -> DataFrame:
    """Apply ``work`` to bounded slices of ``df``, inside Spark's tasks."""

    def run(batches):
        for part in slices(batches, column, limit):
            yield work(part)
        release()

    return df.mapInArrow(run, schema)


def texts_of(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator needs, under fixed names: other columns may have any name."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def plain(texts: pa.Array) -> pa.Array:
    """Texts with null as empty, starting at offset zero."""
    return pa.concat_arrays([pc.fill_null(texts, "")])


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string array."""
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]] if len(at) else raw[:0], at - (at[0] if len(at) else 0)


def split(lists: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct parts, and for every part in order its code; with the offsets of each text: (distinct, codes, offsets)."""
    at = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), at - at[0]


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+``: distinct words, the code of every word in order, and the offsets of each text."""
    vocabulary, codes, at = split(pc.ascii_split_whitespace(plain(texts)))
    full = pc.binary_length(vocabulary).to_numpy(zero_copy_only=False) > 0
    keep = full[codes] if len(codes) else np.zeros(0, bool)
    total = np.concatenate([[0], np.cumsum(keep)])
    return vocabulary, codes[keep], total[at]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> _S33)
    x = x * _M1
    x = x ^ (x >> _S33)
    x = x * _M2
    return x ^ (x >> _S33)


def hash_strings(values: pa.Array) -> np.ndarray:
    """64-bit hashes of strings, from the bytes alone: the same in every task."""
    raw, at = buffers(values)
    lengths = np.diff(at)
    out = np.zeros(len(values), np.uint64)
    if len(raw):
        power = np.ones(int(lengths.max()), np.uint64)
        power[1:] = np.uint64(_BASE)
        power = np.multiply.accumulate(power)
        part = _BYTE[raw] * power[np.arange(len(raw)) - np.repeat(at[:-1], lengths)]
        some = lengths > 0
        out[some] = np.add.reduceat(part, at[:-1][some])
    return mix(out + lengths.astype(np.uint64))


def owners(at: np.ndarray) -> np.ndarray:
    """For every element, the number of the text that it belongs to."""
    return np.repeat(np.arange(len(at) - 1), np.diff(at))


def sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum of each text's elements."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[at[1:]] - total[at[:-1]]
