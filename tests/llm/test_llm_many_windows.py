"""Decontamination against benchmarks of more windows than the literal set holds."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidegate.llm import decontamination


def _items(spark, n):
    """``n`` items of eleven words: two windows each; all of them share their first four words."""
    words = [F.concat(F.lit(f"w{k}x"), F.col("id").cast("string")) for k in range(7)]
    text = F.concat_ws(" ", F.lit("answer the question below"), *words)
    return spark.range(n).select(F.concat(F.lit("i"), "id").alias("item_id"), text.alias("text"))


def _text(i, first=0, last=11):
    return " ".join(["answer", "the", "question", "below", *(f"w{k}x{i}" for k in range(7))][first:last])


@pytest.mark.parametrize("broadcast_codes", [0, decontamination.BROADCAST_CODES])
def test_many_items(spark, monkeypatch, broadcast_codes):
    monkeypatch.setattr(decontamination, "BROADCAST_CODES", broadcast_codes)
    items = _items(spark, 200_000)
    rows = [
        (1, f"so {_text(7)} and more"), (2, f"{_text(7)} then {_text(199_999)}"), (3, _text(12, 1)), (4, _text(12, 2)),
        (5, "clean words only here and nothing of the kind at all"), (6, None), (7, _text(200_000)), (8, ""),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: (r["n_hit"], r["items"]) for r in decontamination.scan(docs, items).collect()}
    assert found == {
        1: (11, ["i7"]), 2: (22, ["i199999", "i7"]), 3: (10, ["i12"]), 4: (0, []), 5: (0, []), 6: (0, []), 7: (0, []), 8: (0, []),
    }
    clean = decontamination.remove_documents(docs, items)
    assert sorted(r["doc_id"] for r in clean.collect()) == [4, 5, 6, 7, 8]


@pytest.mark.parametrize("set_windows", [0, 3, 6, 40, 1000])
def test_every_tier_finds_the_same(spark, set_windows):
    items = _items(spark, 20)
    rows = [(i, f"intro {_text(i % 25)} {_text((i * 7) % 25, 0, 9)} outro") for i in range(30)] + [(None, _text(3)), (3, _text(4))]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id bigint, text string, code string")
    want = decontamination.scan(docs, items).orderBy("doc_id", "n_words").collect()
    assert any(r["contaminated"] for r in want)
    got = decontamination.scan(docs, items, set_windows=set_windows).orderBy("doc_id", "n_words").collect()
    assert got == want
    kept = decontamination.remove_documents(docs, items, set_windows=set_windows)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not r["contaminated"] for r in want)
