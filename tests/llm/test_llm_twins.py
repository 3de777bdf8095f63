"""Classifiers against plain Python: compressed sizes of op6, updates and scores of op7."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import zstandard
from pyspark.sql import functions as F

from tidegate.llm import language_id, quality
from tidegate.llm.queries import QUERIES, fold


def _sizes(dictionary, data):
    settings = zstandard.ZstdCompressionParameters.from_level(
        6, source_size=2048, dict_size=1 << 15, write_content_size=0, write_checksum=0, write_dict_id=0
    )
    total = 0
    while data:
        piece, data = data[:2048], data[2048:]
        own = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        total += len(zstandard.ZstdCompressor(dict_data=own, compression_params=settings).compress(piece))
    return total


def test_languages_are_the_smallest_sizes(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    dictionaries = language_id.train(docs, fold(5) != 0).dictionaries
    got = {r["doc_id"]: r for r in QUERIES["op6_language_id"](spark, sf_dir).collect()}
    for doc_id, text in docs.where("doc_id % 7 = 0").select("doc_id", "text").collect():
        row = got[doc_id]
        if not text or not any(map(str.isalpha, text)):
            assert (row["lang_pred"], row["score"]) == ("und", 0.0)
            continue
        sizes = sorted((_sizes(d, text.lower().encode()), name) for name, d in dictionaries.items())
        assert row["lang_pred"] == sizes[0][1]
        assert math.isclose(row["score"], (sizes[1][0] - sizes[0][0]) / sizes[1][0], abs_tol=1e-12)


def _features(text):
    """Words, pairs of words and repeats by name: no hashing."""
    words = re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+|[!-/:-@\[-`{-~]+", text or "")
    plain = [w for w in words if re.match(r"[0-9A-Za-z\u0080-\U0010ffff]", w)]
    grams = Counter([(w,) for w in words] + list(zip(words, words[1:])))
    again = sum(a == b for a, b in zip(plain, plain[1:]))
    if again:
        grams["again"] = again
    size = math.sqrt(sum(grams.values()))
    return {**{g: math.sqrt(n) / size for g, n in grams.items()}, "bias": 0.3}


def _learn(examples, epochs=3, alpha=1.0, beta=1.0, l1=0.01, l2=1e-4):
    z, n = Counter(), Counter()

    def weight(i):
        return 0.0 if abs(z[i]) <= l1 else -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(epochs):
        for text, label in examples:
            x = _features(text)
            w = {i: weight(i) for i in x}
            error = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x.items()))) - label
            for i, v in x.items():
                g = error * v
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha * w[i]
                n[i] += g * g
    return weight


def test_quality_follows_the_updates(spark):
    rng = random.Random(12)
    vocabulary = ["sea", "Sea", "tide", "gate", "é", "日本", "--", "x1", "...", "the"]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 5, 30])))) for i in range(80)]
    rows += [(100, ""), (101, None), (102, "\n\t"), (103, "the the the")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labelled = [(i, int("tide" in (t or "") or rng.random() < 0.2)) for i, t in rows]
    labels = spark.createDataFrame(labelled, "doc_id bigint, quality int")
    order = docs.join(labels, "doc_id").orderBy(F.xxhash64(F.col("doc_id").cast("string"))).select("text", "quality").collect()
    weight = _learn([tuple(r) for r in order])
    model = quality.train(docs, labels, F.lit(True))
    for doc_id, got in quality.score(docs, model).collect():
        margin = sum(weight(i) * v for i, v in _features(dict(rows)[doc_id]).items())
        assert abs(got - 1 / (1 + math.exp(-margin))) < 1e-4
