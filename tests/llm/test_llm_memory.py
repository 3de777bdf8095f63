"""What Python workers hold at once, and between tasks."""

from __future__ import annotations

import ctypes
import re
import tracemalloc
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

import corpus_pipeline
from tidegate.llm import byte_bpe, ngram_join, quality
from tidegate.session import arrow_rows, give_back

ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_hashing_words_takes_little_memory():
    text = "some words of a long text " * 80_000
    column = pa.array([text])
    list(ngram_join.batch_sets(pa.array(["one two three"]), 5))
    tracemalloc.start()
    n = sum(len(grams) for _, grams in ngram_join.batch_sets(column, 5))
    held = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 6
    # Blocks of 1 MiB took 40 MB, those of 128 KiB take 22 MB.
    assert held < 30e6


@pytest.mark.parametrize("before, inside", [("10000", "512"), ("0", "512"), ("100", "100")])
def test_batches_of_texts_are_bounded(spark, monkeypatch, before, inside):
    usual = spark.conf.get(ROWS)
    spark.conf.set(ROWS, before)
    seen = []
    try:
        run = ngram_join._components
        monkeypatch.setattr(
            ngram_join, "_components", lambda *args: (seen.append(spark.conf.get(ROWS)), run(*args))[1]
        )
        docs = spark.createDataFrame([(2, "a b c d e f"), (5, "a b c d e f")], "doc_id BIGINT, text STRING")
        out = ngram_join.near_duplicates(docs)
        assert spark.conf.get(ROWS) == before
        assert {tuple(r) for r in out.collect()} == {(2, 2, 2), (5, 2, 2)}
        with pytest.raises(ZeroDivisionError), arrow_rows(spark, 7):
            1 / 0
        assert spark.conf.get(ROWS) == before
    finally:
        spark.conf.set(ROWS, usual)
    assert seen == [inside]


def _own_mb() -> float:
    status = Path("/proc/self/status").read_text()
    return int(re.search(r"RssAnon:\s+(\d+)", status)[1]) / 1024


@pytest.mark.skipif(not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="needs glibc")
def test_freed_memory_goes_back_after_a_task():
    kept = []

    def run(batches):
        # Blocks too small to be mapped one by one, and one above them that stays.
        blocks = [np.ones(8_000) for _ in range(3_000)]
        kept.append(np.ones(8_000))
        yield from batches
        del blocks

    before = _own_mb()
    batch = pa.record_batch([pa.array([1, 2])], ["x"])
    assert [b.num_rows for b in run([batch, batch])] == [2, 2]
    plain = _own_mb() - before
    assert [b.num_rows for b in give_back(run)([batch, batch])] == [2, 2]
    assert plain > 100
    assert _own_mb() - before < 50


def test_workers_of_the_pipeline_give_memory_back(spark, monkeypatch):
    given = []

    def noted(run):
        given.append(run.__qualname__.split(".")[0])
        return give_back(run)

    for module in (quality, ngram_join, byte_bpe):
        monkeypatch.setattr(module, "give_back", noted)
    rows = [(i, f"some words of text {i}") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    quality.filter_quality(docs, quality.Model(np.zeros((1 << quality.BITS) + 1, np.float32)))
    ngram_join.near_duplicates(docs)
    corpus_pipeline._encoding(spark, docs, "")
    wanted = ["filter_quality", "_profiles", "_sum_blocks", "_prefixes", "_sets", "_encoder", "_decoder"]
    assert sorted(given) == sorted(wanted)


def test_encoding_takes_one_python_worker_a_task(spark):
    docs = spark.createDataFrame([(1, "some words"), (2, None), (None, "é")], "doc_id BIGINT, text STRING")
    out = corpus_pipeline._encoding(spark, docs, "")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    ranks = byte_bpe.read_ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    straight = byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    wanted = {(r["doc_id"], tuple(r["tokens"]), len(r["tokens"])) for r in straight.collect()}
    assert {(r["doc_id"], tuple(r["tokens"]), r["n_tokens"]) for r in out.collect()} == wanted
