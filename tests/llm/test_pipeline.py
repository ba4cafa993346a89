"""Every stage of the corpus pipeline on its own input, against a brute-force version."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from passerine.llm import bpe, mixing, toxicity
from test_similarity import WORD, components_of, lines_gone, shingles, similar

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The input of each stage, and the last output."""
    folder, docs = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF}/documents.parquet")
    frames = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        frames.append(docs)
    return frames


def rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_order_and_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "near duplicates", "mixing", "byte-level BPE"]
    assert all(f.columns == steps[0].columns for f in steps[:5])


def test_toxic_documents_go(spark, steps):
    rated = toxicity.rate(steps[0], spark.read.parquet(f"{SF}/labels.parquet")).collect()
    assert sorted(r.doc_id for r in steps[1].select("doc_id").collect()) == sorted(r.doc_id for r in rated if r.predicted == 0)


def test_later_lines_go(steps):
    before = rows(steps[1])
    gone, _ = lines_gone(before)
    want = {}
    for i, text in before:
        kept = "\n".join(x for k, x in enumerate(text.split("\n")) if (i, k) not in gone)
        if WORD.search(kept) or not WORD.search(text):
            want[i] = kept
    assert dict(rows(steps[2])) == want
    assert all(r.n_chars == len(r.text) for r in steps[2].collect())


def test_one_of_each_class_stays(steps):
    before = sorted(rows(steps[2]))
    sets = [shingles(t) for _, t in before]
    links = [(a, b) for b in range(len(sets)) for a in range(b) if sets[a] and sets[b] and similar(sets[a], sets[b])]
    top = components_of(len(sets), links)
    assert sorted(rows(steps[3])) == [before[k] for k in range(len(before)) if top[k] == k]


def test_mixture_takes_what_the_plan_says(steps):
    taken = Counter(r.doc_id for r in mixing.mixture(steps[3]).collect())
    assert Counter(i for i, _ in rows(steps[4])) == taken and taken


def test_ids_are_the_library_s(steps):
    base = bpe.Codec(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).base
    want = Counter()
    for i, text in rows(steps[4]):
        ids = base.encode_ordinary(text)
        want[i, tuple(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, tuple(r.ids), r.ids_sha256, r.decoded_sha256) for r in steps[5].collect()) == want


def test_run_gives_the_last_stage(spark, steps):
    got, want = corpus_pipeline.run(spark, SF), steps[5]
    assert got.columns == want.columns
    assert sorted((r.doc_id, r.ids_sha256) for r in got.collect()) == sorted((r.doc_id, r.ids_sha256) for r in want.collect())


@pytest.mark.parametrize("name", list(STAGES))
def test_stages_take_edge_rows_and_empty_tables(spark, docs, edge_rows, name):
    assert STAGES[name](spark, docs([]), SF).count() == 0
    out = STAGES[name](spark, docs(edge_rows), SF)
    assert out.count() > 0
    if name != "byte-level BPE":
        assert out.columns == docs([]).columns
