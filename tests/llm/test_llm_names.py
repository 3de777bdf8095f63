"""Columns of the user that are called as an operator's helpers, and ids that repeat without bound."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidegate.llm import decontamination, language_id, line_dedup
from tidegate.llm.sqltext import unused

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"


def test_unused_names():
    assert unused(["a", "__x", "__X_"], "__x") == "__x__"
    assert unused(["a"], "__x") == "__x"


@pytest.mark.parametrize("set_windows", [0, 50_000])
def test_decontamination_keeps_columns_of_any_name(spark, set_windows):
    rows = [(1, f"so {ITEM}", "w", 5), (2, "clean text", "v", 6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, __words string, __row int")
    items = spark.createDataFrame([("i", ITEM)], "item_id string, text string")
    clean = decontamination.remove_documents(docs, items, set_windows=set_windows)
    assert clean.columns == docs.columns
    assert [tuple(r) for r in clean.collect()] == [rows[1]]


def test_line_dedup_keeps_columns_of_any_name(spark):
    passage = "\n".join(" ".join(f"w{i}x{j}" for j in range(20)) for i in range(3))
    rows = [(i, f"own {i}\n{passage}\nend {i}", "l", "r", i, "s") for i in (1, 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, __left string, __runs string, __doc bigint, __SIG string")
    out = line_dedup.dedup(docs).orderBy("doc_id").collect()
    assert [r["text"] for r in out] == [rows[0][1], "own 2\nend 2"]
    assert [(r["__left"], r["__runs"], r["__doc"], r["__SIG"]) for r in out] == [("l", "r", 1, "s"), ("l", "r", 2, "s")]


def test_an_id_on_many_rows_is_one_sampled_text(spark):
    many = spark.range(5000).selectExpr("7L AS doc_id", "concat('the quick fox ', id) AS text", "'en' AS lang")
    few = spark.createDataFrame([(8, "der schnelle Fuchs springt", "de"), (9, "ein Hund", "de")], "doc_id bigint, text string, lang string")
    model = language_id.train(many.unionByName(few), F.lit(True))
    assert set(model.dictionaries) == {"en", "de"}
    assert len(model.dictionaries["en"]) < 30
