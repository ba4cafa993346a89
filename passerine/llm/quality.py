"""Quality rules: base counts and the distance of a document's histograms from those of its language.

Every document has a histogram of character classes and one of common words. The references are the same histograms
summed over all documents of a language that pass for text: at least ``MIN_WORDS`` words, and at most
``MAX_SYMBOL_SHARE`` symbols a word. A document whose Jensen-Shannon distance from a reference is too large is
rejected, unless it is too short for the histogram to say much.

References are of bounded size: words are counted in ``WORD_BUCKETS`` buckets of their hash, the fullest ``COMMON`` of
them stand for the common words, and the ``MAX_LANGUAGES`` languages with most documents have a reference each, all
others (and a null language) one together.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passerine.llm.arrow import buffers, hash_strings, map_slices, owners, plain, slices, split, sums, words
from passerine.llm.shared import written

WORD_BUCKETS, COMMON, MAX_LANGUAGES = 4096, 64, 200

#: Longest distance kept of a very long text; a text of n words may be farther by NOISE / sqrt(n), as short ones scatter.
MAX_CLASS_DISTANCE, CLASS_NOISE, MAX_WORD_DISTANCE, WORD_NOISE = 0.12, 1.5, 0.20, 1.8
#: Words and characters below which a histogram says nothing, and symbols a word above which a text is no reference.
MIN_WORDS, MIN_CHARS = 50, 200
MAX_SYMBOL_SHARE = 0.1

SYMBOLS = b"#*$%&|<>"


def _classes() -> np.ndarray:
    """Class of every byte; bytes that continue a character have none (-1)."""
    kind = np.full(256, 7, np.int8)  # other printable ASCII
    for k, chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\x0b\x0c\r", b"\n", b".,;:!?'\"-()", SYMBOLS)):
        kind[list(chars)] = k
    kind[0xC0:] = 8  # first byte of a character beyond ASCII
    kind[0x80:0xC0] = -1
    return kind


_CLASS = _classes()
CLASSES = 9
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def class_histograms(texts: pa.Array) -> np.ndarray:
    raw, at = buffers(texts)
    kind = _CLASS[raw]
    own = owners(at)
    seen = kind >= 0
    return np.bincount(own[seen] * CLASSES + kind[seen], minlength=len(texts) * CLASSES).reshape(-1, CLASSES)


def repeated_window_words(codes: np.ndarray, at: np.ndarray, n_distinct: int) -> np.ndarray:
    """Words of each text that lie in a three-word window found twice or more in it."""
    n = len(codes)
    covered = np.zeros(n + 2, bool)
    if n >= 3:
        pair = codes[:-2] * n_distinct + codes[1:-1]
        if n_distinct >= 2_000_000:  # keeps the next product within 64 bits
            pair = np.unique(pair, return_inverse=True)[1]
        key, own = pair * n_distinct + codes[2:], owners(at)
        starts = np.flatnonzero(own[:-2] == own[2:])
        order = starts[np.argsort(key[starts], kind="stable")]  # within a key, texts stay in order
        same = (key[order[1:]] == key[order[:-1]]) & (own[order[1:]] == own[order[:-1]])
        twice = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
        for k in range(3):
            covered[twice + k] = True
    return sums(covered[:n], at)


def repeated_lines(texts: pa.Array) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    distinct, codes, at = split(pc.split_pattern(texts, "\n"))
    full = pc.binary_length(pc.ascii_trim_whitespace(distinct)).to_numpy(zero_copy_only=False) > 0
    own, keep = owners(at), full[codes]
    first = np.unique(own[keep] * len(distinct) + codes[keep])
    return np.bincount(own[keep], minlength=len(texts)) - np.bincount(first // max(1, len(distinct)), minlength=len(texts))


def base_counts(texts: pa.Array) -> tuple[dict[str, np.ndarray], tuple]:
    """The counts of the base rules for each text, and its words."""
    vocabulary, codes, at = found = words(texts)
    raw, ends = buffers(texts)
    return {
        "n_words": np.diff(at),
        "word_chars": sums(pc.utf8_length(vocabulary).to_numpy(zero_copy_only=False)[codes], at),
        "n_symbols": sums(_SYMBOL[raw], ends),
        "n_dup_lines": repeated_lines(texts),
        "n_repeat_words": repeated_window_words(codes, at, max(1, len(vocabulary))),
    }, found


def _buckets(vocabulary: pa.Array) -> np.ndarray:
    return (hash_strings(vocabulary) % np.uint64(WORD_BUCKETS)).astype(np.int64)


def distance(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2, 0 to 1) of each row from its reference row; 0 where either is empty."""
    p = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    q = reference / np.maximum(reference.sum(axis=1, keepdims=True), 1e-300)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=1)
        b = np.where(q > 0, q * np.log2(q / m), 0).sum(axis=1)
    some = (counts.sum(axis=1) > 0) & (reference.sum(axis=1) > 0)
    return np.where(some, np.sqrt(np.clip((a + b) / 2, 0, 1)), 0.0)


def language_references(df: DataFrame) -> dict:
    """{language or None: (class counts, word bucket counts)} over all documents that pass for text; None pools the rest.

    Tasks add up their own documents, so few rows are shuffled whatever the number of documents of a language.
    """
    width = CLASSES + WORD_BUCKETS

    def count(batches):
        totals: dict = {}

        def flush():
            keys = list(totals)
            block = np.stack([totals[k] for k in keys]) if keys else np.zeros((0, width + 1), np.int64)
            totals.clear()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * (width + 1), pa.int32()), pa.array(block.ravel()))
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), lists], names=["lang", "counts"])

        for part in slices(batches, "text"):
            texts = plain(part.column("text"))
            coded = part.column("lang").dictionary_encode(null_encoding="encode")
            langs, of = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
            vocabulary, codes, at = words(texts)
            bucket, classes, own = _buckets(vocabulary)[codes], class_histograms(texts), of[owners(at)]
            n, symbols = np.diff(at), sums(_SYMBOL[buffers(texts)[0]], buffers(texts)[1])
            counts_as_text = (n >= MIN_WORDS) & (symbols <= MAX_SYMBOL_SHARE * n)
            of, own = np.where(counts_as_text, of, -1), np.where(counts_as_text[owners(at)], own, -1)
            by_text, by_word, of_each = np.argsort(of, kind="stable"), np.argsort(own, kind="stable"), np.arange(len(langs) + 1)
            texts_to, words_to = np.searchsorted(of[by_text], of_each), np.searchsorted(own[by_word], of_each)
            for k in np.unique(of[of >= 0]).tolist():
                mine = by_text[texts_to[k] : texts_to[k + 1]]
                row = totals.setdefault(langs[k], np.zeros(width + 1, np.int64))
                row[0] += len(mine)
                row[1 : CLASSES + 1] += classes[mine].sum(axis=0)
                row[CLASSES + 1 :] += np.bincount(bucket[by_word[words_to[k] : words_to[k + 1]]], minlength=WORD_BUCKETS)
                if len(totals) > 256:
                    yield flush()
        yield flush()

    parts = df.select("lang", "text").mapInArrow(count, "lang string, counts array<long>")
    each = parts.select("lang", F.posexplode("counts").alias("at", "n")).where("n > 0").groupBy("lang", "at").agg(F.sum("n").alias("n"))
    each = written(each, "quality-counts")  # read twice below, counted once
    by_lang = each.groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("at", "n"))).alias("counts"))  # at most width + 1 entries
    largest = by_lang.where("lang is not null").orderBy(F.col("counts")[0].desc(), "lang").limit(MAX_LANGUAGES)
    own, total = largest.collect(), each.groupBy("at").agg(F.sum("n").alias("n")).collect()

    def dense(pairs):
        row = np.zeros(width + 1)
        for at, n in pairs:
            row[at] = n
        return row

    rows = {r.lang: dense(r.counts.items()) for r in own}
    rest = dense((r["at"], r["n"]) for r in total) - (sum(rows.values()) if rows else 0)
    if not rest.any():
        rest = sum(rows.values()) if rows else rest  # no other language: what is new is compared with all
    return {k: (v[1 : CLASSES + 1], v[CLASSES + 1 :]) for k, v in {**rows, None: rest}.items()}


def rate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_class_distance: float = MAX_CLASS_DISTANCE, max_word_distance: float = MAX_WORD_DISTANCE, min_words: int = MIN_WORDS, min_chars: int = MIN_CHARS) -> DataFrame:
    """Base counts, distances and verdict for every row of ``df``.

    Distances and guards are those of the module's parameters. Null texts count as empty; texts without words fail the base rules (fewer than ``min_words`` words). A null or rare
    language is compared with the pooled reference. Repeated rows count as often as they occur and stay repeated.
    An empty table gives no rows.
    """
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    found = language_references(docs)
    names = list(found)
    class_refs = np.stack([found[n][0] for n in names])
    common = [np.argsort(-found[n][1], kind="stable")[:COMMON] for n in names]
    word_refs = np.stack([np.append(found[n][1][c], found[n][1].sum() - found[n][1][c].sum()) for n, c in zip(names, common)])
    place = np.full((len(names), WORD_BUCKETS), COMMON, np.int16)
    for k, c in enumerate(common):
        place[k, c] = np.arange(len(c))
    shared = df.sparkSession.sparkContext.broadcast((names, class_refs, word_refs, place))  # at most 201 languages of some 9 kB

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, class_refs, word_refs, place = shared.value
        number = {n: k for k, n in enumerate(names)}
        texts = plain(batch.column("text"))
        counts, (vocabulary, codes, at) = base_counts(texts)
        ref = np.array([number.get(x, number[None]) for x in batch.column("lang").to_pylist()], np.int64)
        classes, own = class_histograms(texts), owners(at)
        bins = place[ref[own], _buckets(vocabulary)[codes]].astype(np.int64)
        common = np.bincount(own * (COMMON + 1) + bins, minlength=len(texts) * (COMMON + 1)).reshape(-1, COMMON + 1)
        class_distance, word_distance = distance(classes, class_refs[ref]), distance(common, word_refs[ref])
        n = counts["n_words"]
        failed = (n < min_words) | (100 * counts["n_repeat_words"] > 50 * n)
        long_enough = (n >= min_words) & (classes.sum(axis=1) >= min_chars)
        noise = 1 / np.sqrt(np.maximum(n, 1))
        far = long_enough & ((class_distance > max_class_distance + CLASS_NOISE * noise) | (word_distance > max_word_distance + WORD_NOISE * noise))
        columns = {"doc_id": batch.column("doc_id"), **{k: pa.array(v.astype(np.int64)) for k, v in counts.items()}, "base_failed": pa.array(failed), "kept": pa.array(~failed & ~far), "class_distance": pa.array(class_distance), "word_distance": pa.array(word_distance)}
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, class_distance double, word_distance double"
    return map_slices(docs, "text", work, schema)
