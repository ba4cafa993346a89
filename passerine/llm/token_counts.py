"""Token counts of whole texts: batch encoding in Arrow functions that return lengths only.

Texts are cut at ASCII white space, where no token of a white-space-dropping tokenizer can cross: its pattern matches no
white space, its normalizer composes nothing across it. A plain word is cut once more before its closing punctuation.
A slice's distinct parts are encoded as one batch by the tokenizers library; a text's count is the sum over its parts.
So a very long text needs no more memory than its parts, and common words are encoded once.
"""

from __future__ import annotations

import os
import string

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from passerine.llm.arrow import map_slices, plain, sums, texts_of, words

#: Parts whose counts a task remembers, and the length of a part that is still remembered.
MEMO_ENTRIES, MEMO_CHARS = 800_000, 40
#: Bytes of text whose distinct parts are looked up at once.
SLICE = 16 << 20
#: Plain words of one call.
JOINED = 2000
_CLOSING = ".,;:!?"
# Letters that are one code point in every normal form used, and have one lower case.
_PLAIN = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"
_LETTERS = string.ascii_letters + "".join(chr(c) for c in range(0xC0, 0x100) if chr(c).isalpha())


class PartCounter:
    """Counts tokens of texts with a tokenizer file of the tokenizers library."""

    def __init__(self, tokenizer_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer, self.memo = Tokenizer.from_file(tokenizer_file), {}

    def _encoded(self, parts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    def _plain_words(self, parts: list[str]) -> list[int]:
        """Counts of parts of Latin letters. One call encodes many of them, and says which word each token is of."""
        out = []
        for k in range(0, len(parts), JOINED):
            some = parts[k : k + JOINED]
            of = self.tokenizer.encode(" ".join(some), add_special_tokens=False).word_ids
            out += np.bincount(np.array(of, np.int64), minlength=len(some)).tolist()
        return out

    def _counted(self, values: pa.Array, encode) -> np.ndarray:
        """Count of every value; each distinct one that isn't remembered is encoded once."""
        if not len(values):
            return np.zeros(0, np.int64)
        coded, memo = values.dictionary_encode(), self.memo
        parts = coded.dictionary.to_pylist()
        new = [p for p in parts if p not in memo]
        if len(memo) + len(new) > MEMO_ENTRIES:
            memo.clear()
            new = parts
        got = dict(zip(new, encode(new)))
        memo.update((p, n) for p, n in got.items() if len(p) <= MEMO_CHARS)
        each = np.array([got[p] if p in got else memo[p] for p in parts], np.int64)
        return each[coded.indices.to_numpy(zero_copy_only=False)]

    def counts(self, texts: pa.Array) -> np.ndarray:
        vocabulary, codes, at = words(texts)
        core = pc.ascii_rtrim(vocabulary, _CLOSING)
        simple = pc.match_substring_regex(core, _PLAIN)  # other words stay whole
        per_word, is_simple = np.zeros(len(vocabulary), np.int64), simple.to_numpy(zero_copy_only=False)
        per_word[is_simple] = self._counted(pc.utf8_lower(core.filter(simple)), self._plain_words)
        per_word[is_simple] += self._counted(pc.utf8_ltrim(vocabulary.filter(simple), _LETTERS), self._encoded)
        per_word[~is_simple] = self._counted(vocabulary.filter(pc.invert(simple)), self._encoded)
        return sums(per_word[codes], at)


def count_tokens(df: DataFrame, tokenizer_file: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``df``, without added special tokens.

    The tokenizer must drop white space, as described above. Special strings inside a text count as the library's default
    has them. Null counts as empty: no bytes, no tokens. Repeated rows stay repeated; no row depends on another.
    """
    counters: dict = {}

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not counters:
            counters[0] = PartCounter(tokenizer_file)
        texts = plain(batch.column("text"))
        n = counters[0].counts(texts)
        size = pc.cast(pc.binary_length(texts), pa.int64())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), size, pa.array(n), pa.array(n > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return map_slices(texts_of(df, id_col, text_col), "text", work, "doc_id long, n_bytes long, n_tokens long, over_limit boolean", SLICE)
