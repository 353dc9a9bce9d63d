"""The corpus pipeline against its stages done plainly."""

import random

import pytest

import corpus_pipeline
from cohortflow.llm import minhash
from test_llm import DOCS, brute_components, check_packing, edited, prose


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(1)
    texts = [prose(i, rng.randrange(20, 300)) for i in range(40)]
    texts += [texts[3], texts[3], edited(texts[5], 1, 1), "", None, "   "]
    texts += [prose(100 + i, 30) + "\nthis notice recurs in every one of these documents" for i in range(9)]
    rows = [(i, t, "en", f"src{i % 2}", len(t or "")) for i, t in enumerate(texts)]
    return texts, spark.createDataFrame(rows, DOCS)


def test_stages_in_order(spark, corpus):
    texts, docs = corpus
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "minhash_dedup", "packing"]
    blank = {i for i, t in enumerate(texts) if not (t or "").strip()}

    first = corpus_pipeline.STAGES[0][1](spark, docs, "")
    assert first.columns == docs.columns and {r.doc_id for r in first.collect()} == set(range(len(texts))) - blank

    second = corpus_pipeline.STAGES[1][1](spark, first, "")
    cleaned = {r.doc_id: r for r in second.collect()}
    assert second.columns == docs.columns and set(cleaned) == set(range(len(texts))) - blank
    assert all(r.n_chars == len(r.text) for r in cleaned.values())
    assert sum("this notice" in r.text for r in cleaned.values()) == 1

    third = corpus_pipeline.STAGES[2][1](spark, second, "")
    order = sorted(cleaned)
    groups = brute_components([cleaned[i].text for i in order])
    assert third.columns == docs.columns
    assert {r.doc_id for r in third.collect()} == {order[root] for _, _, root in groups}

    packed = corpus_pipeline.STAGES[3][1](spark, third, "").collect()
    check_packing(packed, 1024)
    assert {r.doc_id for r in packed} == {order[root] for _, _, root in groups}


def test_run_over_a_folder(spark, corpus, tmp_path):
    _, docs = corpus
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert rows and check_packing(rows, 1024)
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_words_are_those_of_the_contract():
    assert minhash.words_of("AÄb\x0bC D\x1fe  f\n") == ["aÄb".encode(), "c d\x1fe".encode(), b"f"]
