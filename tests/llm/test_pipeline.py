"""The pipeline against its stages by plainer means, on a small table."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_helpers import near_groups as first_of_group, read
from tokenizers import Tokenizer

import corpus_pipeline
from pingloom.llm import decontaminate, mixing, rules
from pingloom.session import scratch_path

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage returns, written and read again."""
    docs, out = read(spark, SF, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, "stage")
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_all_but_the_last_return_documents(spark, stages):
    columns = read(spark, SF, "documents").dtypes
    assert [s.dtypes == columns for s in stages] == [True] * 4 + [False]


def test_every_stage_does_what_it_says(spark, stages):
    texts = [{r["doc_id"]: r["text"] for r in s.collect()} for s in [read(spark, SF, "documents"), *stages[:4]]]
    verdict = rules.judge(read(spark, SF, "documents"), read(spark, SF, "labels"))
    assert set(texts[1]) == {r["doc_id"] for r in verdict.filter("kept").collect()}
    _, first = first_of_group(texts[1].items(), 5)
    assert set(texts[2]) == {i for i, c in first.items() if i == c}
    dirty = {r["doc_id"] for r in decontaminate.matches(stages[1], read(spark, SF, "benchmark")).collect()}
    assert dirty and set(texts[3]) == set(texts[2]) - dirty
    assert texts[4] == texts[3]


def test_token_files_follow_the_mix(stages):
    laid = sorted(mixing.mix(stages[2]).collect(), key=lambda r: (r["slot"], r["place"], r["doc_id"]))
    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    found = stages[4].orderBy("start").collect()
    assert [r["doc_id"] for r in found] == [r["doc_id"] for r in laid]
    start = 0
    for row, source in zip(found, laid):
        ids = tokenizer.encode(source["text"], add_special_tokens=False).ids + [0]
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_run_gives_the_rows_of_the_last_stage(spark, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, stages[4].collect()))


def test_odd_rows_pass_through_every_stage(spark, odd_documents, empty_documents):
    for documents in (odd_documents, empty_documents):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            done = stage(spark, documents, SF)
            assert set(done.columns) <= set(documents.columns) and done.count() <= documents.count()
        assert corpus_pipeline.STAGES[-1][1](spark, documents, SF).count() == documents.count()
