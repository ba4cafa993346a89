"""Byte-level BPE and token counts against the libraries."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from passerine.llm import bpe, token_counts

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = [" ", "  ", "\n", "a", "The", "'s", "12", "!", "é", "é", "́", "　", "\x1c", "\xa0", "I'll", "日本", "🙂", "\t", " don't", "Σ", "ΣΑΣ", "<|endoftext|>", "<|ENDOFTEXT|>", "<", "|", ".", "İ", "ſ", "K", "\x85", "foo,", "\x00"]


def random_texts(n, longest=40):
    draw = random.Random(1)
    return ["".join(draw.choice(PIECES) for _ in range(draw.randint(0, longest))) for _ in range(n)]


@pytest.fixture(scope="module", params=[(2, 1), (7, 3), (8192, 64)], ids=str)
def codec(request):
    return bpe.Codec(RANKS, public_tokenizers.PATTERN, *request.param)


def test_tree_gives_the_library_s_ids_and_text(codec):
    for text in random_texts(3000):
        want = codec.base.encode_ordinary(text)
        assert codec.encode(text) == want, text
        assert codec.decode(want) == text.encode()


def test_long_runs(codec):
    for text in (" " * 5000 + "a", "a" * 20_000, " " * 3000, "x " * 5000, "\n" * 2000 + " b" + " " * 2500 + "\n c", "1" * 9000, " \n" * 1500 + "é"):
        assert codec.encode(text) == codec.base.encode_ordinary(text), text[:5]


def test_white_space_beyond_the_library_s_stack():
    codec = bpe.Codec(RANKS, public_tokenizers.PATTERN)
    text = "x" + " " * 400_000 + "y"
    assert codec.decode(codec.encode(text)) == text.encode()


def test_round_trip_of_edge_rows(docs, edge_rows):
    base = bpe.Codec(RANKS, public_tokenizers.PATTERN).base
    want = []
    for i, text in edge_rows:
        ids = base.encode_ordinary(text or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    got = [tuple(r) for r in bpe.round_trip(docs(edge_rows), RANKS, public_tokenizers.PATTERN, leaf=64).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert bpe.round_trip(docs([]), RANKS, public_tokenizers.PATTERN).count() == 0


def test_encoded_ids_decode_to_the_texts(docs, edge_rows):
    ids = bpe.encode_texts(docs(edge_rows), RANKS, public_tokenizers.PATTERN)
    back = [(r.doc_id, bytes(r.data)) for r in bpe.decode_ids(ids, RANKS, public_tokenizers.PATTERN).collect()]
    assert sorted(map(str, back)) == sorted(str((i, (t or "").encode())) for i, t in edge_rows)


def test_counts_equal_the_library_s():
    counter = token_counts.PartCounter(public_tokenizers.path("word_bpe_49k.json"))
    texts = [*random_texts(4000, 30), None, "", "a" * 20_000, "Straße ÀÉÎ ñandú über, naïve."]
    want = [len(counter.tokenizer.encode(t or "", add_special_tokens=False).ids) for t in texts]
    assert counter.counts(pa.array(texts)).tolist() == want
    counter.memo.clear()
    assert [int(counter.counts(pa.array([t], pa.string()))[0]) for t in texts[:300]] == want[:300]


def test_token_counts_of_edge_rows(docs, edge_rows):
    got = token_counts.count_tokens(docs(edge_rows), public_tokenizers.path("word_bpe_49k.json"), limit=100).collect()
    tokenizer = token_counts.PartCounter(public_tokenizers.path("word_bpe_49k.json")).tokenizer
    want = [(i, len((t or "").encode()), n := len(tokenizer.encode(t or "", add_special_tokens=False).ids), n > 100) for i, t in edge_rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
