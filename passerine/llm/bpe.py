"""Byte-level BPE encoding and decoding as a tree reduction.

A text is halved until a part is short. Parts are encoded on their own and joined pairwise: at the seam a window grows
to both sides until it meets a place where the pattern must split, whatever stands beyond it. Only the window is encoded
again; the tokens outside it are proven to be those of the whole text.

Such a place lies between a character that is not white space and one that is: no alternative of the pattern matches
white space after something else, and none looks back. So the matches before it and after it don't depend on each other.
"""

from __future__ import annotations

import base64
import hashlib
import re
import sys
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passerine.llm.arrow import map_slices, plain, texts_of

# The characters with the Unicode property White_Space.
WHITE = "\t-\r \x85\xa0  -     　"

_SEAM = re.compile(f"(?<=[^{WHITE}])(?=[{WHITE}])")
#: White space of this length is not given to the library's pattern, which runs out of stack on it.
LONG_RUN = 1024
_RUN = re.compile(f"[{WHITE}]{{{LONG_RUN},}}")

#: Characters of a part that is not halved further, and the first width of a window at a seam.
LEAF_CHARS, WINDOW_CHARS = 8192, 64


class Codec:
    """Encodes and decodes whole texts by a rank file, as the tiktoken library does without special tokens."""

    def __init__(self, rank_file: str, pattern: str, leaf: int = LEAF_CHARS, window: int = WINDOW_CHARS):
        import tiktoken

        with open(rank_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.base = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.leaf, self.window = max(2, leaf), max(1, window)
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)

    def encode(self, text: str) -> list[int]:
        if len(text) <= self.leaf:
            return self._leaf(text)
        middle = len(text) // 2
        start, stop = self._seams(text, middle)
        if start == 0 and stop == len(text):
            return self._leaf(text)  # no place to cut: one stretch, or the ends of two
        left, right = self.encode(text[:middle]), self.encode(text[middle:])
        keep = len(left) - self._spelling(left[::-1], text[start:middle])
        return left[:keep] + self.encode(text[start:stop]) + right[self._spelling(right, text[middle:stop]) :]

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= self.leaf:
            return self.base.decode_bytes(ids)
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])

    def _seams(self, text: str, middle: int) -> tuple[int, int]:
        """The last proven place before the middle and the first after it; the text's ends where there is none."""
        width = self.window
        while True:
            low = max(0, middle - width)
            start = max((m.start() for m in _SEAM.finditer(text, low, middle) if m.start() > low), default=0)
            if start or not low:
                break
            width *= 2
        width = self.window
        while True:
            high = min(len(text), middle + width)
            # The character before the place must be the right part's own.
            stop = next((m.start() for m in _SEAM.finditer(text, middle, high) if m.start() > middle), None)
            if stop or high == len(text):
                return start, stop or len(text)
            width *= 2

    def _spelling(self, ids: list[int], text: str) -> int:
        """How many ids from the front spell ``text``."""
        size = len(text.encode())
        ends = np.cumsum(self.sizes[ids[:size]])  # a token has a byte at least
        return int(np.searchsorted(ends, size)) + 1 if size else 0

    def _leaf(self, text: str) -> list[int]:
        ids, at = [], 0
        for run in _RUN.finditer(text):
            # Long white space is a piece of its own, but for the last character if something else follows.
            cut = run.end() - (run.end() < len(text))
            ids += self.base.encode_ordinary(text[at : run.start()]) + self.base._encode_single_piece(text[run.start() : cut])
            at = cut
        return ids + self.base.encode_ordinary(text[at:]) if at else self.base.encode_ordinary(text)


def _packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    values = array("I", ids)
    if sys.byteorder == "big":
        values.byteswap()
    return values.tobytes()


def _id_lists(ids: list[list[int]]) -> pa.Array:
    at = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
    values = np.frombuffer(b"".join(map(_packed, ids)), "<u4").astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values))


def _digests(codecs: dict, rank_file: str, pattern: str, leaf: int, with_ids: bool):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not codecs:
            codecs[0] = Codec(rank_file, pattern, leaf)
        codec, rows, every = codecs[0], [], []
        for text in plain(batch.column("text")).to_pylist():
            ids = codec.encode(text)
            rows.append((len(ids), hashlib.sha256(_packed(ids)).hexdigest(), hashlib.sha256(codec.decode(ids)).hexdigest()))
            if with_ids:
                every.append(ids)
        n, a, b = zip(*rows)
        columns = {"doc_id": batch.column("doc_id"), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(a), "decoded_sha256": pa.array(b)}
        if with_ids:
            columns["ids"] = _id_lists(every)
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return work


def encode_texts(df: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", leaf: int = LEAF_CHARS) -> DataFrame:
    """Token ids of every text: (doc_id, ids). Null counts as empty and has no ids; repeated rows stay repeated."""
    codecs: dict = {}

    def work(batch):
        if not codecs:
            codecs[0] = Codec(rank_file, pattern, leaf)
        ids = [codecs[0].encode(t) for t in plain(batch.column("text")).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), _id_lists(ids)], names=["doc_id", "ids"])

    return map_slices(texts_of(df, id_col, text_col), "text", work, "doc_id long, ids array<int>")


def decode_ids(df: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Bytes that the ids spell: (doc_id, data). Null ids give empty bytes; an id outside the ranks is an error."""
    codecs: dict = {}

    def run(batches):
        for batch in batches:
            if not codecs:
                codecs[0] = Codec(rank_file, pattern)
            for part in (batch.slice(k, 256) for k in range(0, batch.num_rows, 256)):
                data = [codecs[0].decode(ids or []) for ids in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(data, pa.binary())], names=["doc_id", "data"])

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(run, "doc_id long, data binary")


def round_trip(df: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", leaf: int = LEAF_CHARS, with_ids: bool = False) -> DataFrame:
    """Digest of each text's ids and of the bytes decoded from them, and the ids if wanted: one row per row of ``df``.

    Null counts as empty: no tokens, and the digests of no bytes. Repeated rows give repeated results; no row depends
    on another, so hot keys don't matter.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        schema += ", ids array<int>"
    return map_slices(texts_of(df, id_col, text_col), "text", _digests({}, rank_file, pattern, leaf, with_ids), schema)
