"""Similarity joins against brute force: op1, op9 and their components."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from tidegate.llm import embedding_dedup, ngram_join
from tidegate.llm.components import connected_components


def _smallest(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {i: find(i) for i in ids}


def test_components_of_paths_hubs_and_repeats(spark):
    rng = random.Random(3)
    nodes = rng.sample(range(10_000), 300)
    edges = list(zip(nodes[:60], nodes[1:60]))
    edges += [(nodes[100], n) for n in nodes[101:200]]
    edges += [(nodes[250], nodes[250]), (nodes[251], nodes[252]), (nodes[252], nodes[251])]
    df = spark.createDataFrame([*edges, *edges[:5], (None, 1), (2, None)], "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in connected_components(df).collect()}
    want = _smallest(nodes, edges)
    touched = {n for a, b in edges if a != b for n in (a, b)}
    assert got == {n: want[n] for n in touched}


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def _shingles(text, n):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lowered)
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


@pytest.mark.parametrize("n, similar", [(5, (80, 100)), (4, (85, 100))])
def test_near_duplicates_match_brute_force(spark, n, similar):
    rng = random.Random(n)
    vocabulary = [f"w{i}" for i in range(400)]
    shared = " ".join(rng.choices(vocabulary, k=25))
    texts = []
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.choice([3, 8, 40, 120]))
        texts.append(" ".join(base))
        for _ in range(rng.choice([1, 6])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 5])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary).upper()
            texts.append(" \n".join(copy))
        texts.append(f"{shared} {' '.join(rng.choices(vocabulary, k=4))}")
    texts += [None, "", " \t\n", "é É", "É é", "One", "one", "two words", texts[0], "x " * 5000]
    rows = [(i, t, "a", i, 0.5) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(
        rows, "doc_id bigint, text string, component_id string, n bigint, id double"
    )
    got = sorted(map(tuple, ngram_join.near_duplicates(docs, n=n, similar=similar).collect()))
    sets = [_shingles(t, n) for t in texts]
    links = [
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if sets[i]
        and sets[j]
        and similar[1] * len(sets[i] & sets[j]) >= similar[0] * len(sets[i] | sets[j])
    ]
    component = _smallest(range(len(sets)), links)
    assert got == [(i, len(s), component[i]) for i, s in enumerate(sets)]


def test_near_duplicates_with_null_and_repeated_ids(spark):
    text = "one two three four five six"
    rows = [(7, text), (7, text), (None, text), (5, text), (9, "other words"), (9, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    groups = ngram_join.near_duplicates(docs)
    got = sorted(map(tuple, groups.collect()), key=repr)
    assert got == sorted(
        [(7, 2, 5), (7, 2, 5), (None, 2, 5), (5, 2, 5), (9, 1, 9), (9, 0, 9), (None, 0, None)], key=repr
    )
    kept = ngram_join.keep_one(docs, groups)
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 0, 5, 9, 9]
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert ngram_join.near_duplicates(empty).count() == 0


def test_texts_of_one_id_tie_their_classes(spark):
    one, two = ("alpha beta gamma delta epsilon zeta eta", "one two three four five six seven")
    rows = [(1, one), (5, one), (5, two), (9, two), (5, None), (7, ""), (12, "own words of a text alone"), (None, two)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.near_duplicates(df).collect()]
    want = [(1, 3, 1), (5, 3, 1), (5, 3, 1), (9, 3, 1), (5, 0, 1), (7, 0, 7), (12, 2, 12), (None, 3, 1)]
    assert sorted(got, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("list_rows", [100_000, 1])
def test_lists_hold_sets_that_could_link(spark, monkeypatch, list_rows):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(5000)]
    # Beginnings of one text share all their grams; sizes alone tell which can link.
    far, near = (rng.choices(vocabulary, k=400) for _ in range(2))
    texts = [far[:k] for k in (20, 40, 80, 160, 320)]
    texts += [near[:k] for k in (14, 40, 44, 45, 46, 60, 70, 76, 140, 141, 200, 230, 231, 300, 399)]
    texts += [near[k:] for k in (1, 30, 90)] + [far[160:]]
    rows = [(7 * i, " ".join(words)) for i, words in enumerate(texts)] + [(1, " ".join(near[:44]))]
    monkeypatch.setattr(ngram_join, "LIST_ROWS", list_rows)
    listed, make = set(), ngram_join._sets

    def noted(docs, postings, n):
        listed.update(r["node"] for r in postings.select("node").distinct().collect())
        return make(docs, postings, n)

    monkeypatch.setattr(ngram_join, "_sets", noted)
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    got = sorted(map(tuple, ngram_join.near_duplicates(docs, n=4, similar=(85, 100)).collect()))
    sets = {i: _shingles(text, 4) for i, text in rows}
    links = [
        (i, j) for i in sets for j in sets
        if i < j and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])
    ]
    component = _smallest(sets, links)
    assert got == sorted((i, len(grams), component[i]) for i, grams in sets.items())
    assert {k for i, j in links if sets[i] != sets[j] for k in (i, j)} - {49} <= listed  # 49 equals 1
    if list_rows > 1:
        assert not listed & {0, 7, 14, 21, 28}


def test_blocks_of_counters_are_handed_on_packed():
    rng = random.Random(9)
    texts = [" ".join(rng.choices("abcdefghijklmnop", k=200)) for _ in range(300)]
    blocks, raw = [], 0
    for part in (texts[:200], texts[150:]):
        batch = pa.record_batch([pa.array(range(len(part))), pa.array(part)], ["id", "text"])
        out = pa.Table.from_batches(ngram_join._profiles(4)([batch]))
        made = out.filter(pc.is_valid(out["block"])).select(["block", "counts"])
        raw += made.num_rows << ngram_join._BLOCK_BITS
        blocks += made.to_batches()
    assert sum(len(counts.as_py()) for batch in blocks for counts in batch["counts"]) < raw / 16
    (summed,) = ngram_join._sum_blocks(blocks)
    total = np.zeros(1 << ngram_join.SKETCH_BITS, np.int64)
    for _, grams in ngram_join.batch_sets(pa.array(texts[:200] + texts[150:]), 4):
        np.add.at(total, (grams >> np.uint64(64 - ngram_join.SKETCH_BITS)).astype(np.int64), 1)
    want = np.minimum(255, 8 * np.log2(np.maximum(total, 1))).astype(np.uint8)
    want = want.reshape(-1, 1 << ngram_join._BLOCK_BITS)
    held = total.reshape(want.shape).any(axis=1)
    assert sorted(summed["block"].to_pylist()) == np.flatnonzero(held).tolist()
    for block, classes in zip(summed["block"].to_pylist(), summed["counts"].to_pylist()):
        assert classes == want[block].tobytes()


def test_sketch_order_never_changes_the_result(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices("abcdef", k=30))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = sorted(map(tuple, ngram_join.near_duplicates(docs, n=2, similar=(60, 100)).collect()))
    # With one row per list every gram that repeats is dealt out to several lists.
    monkeypatch.setattr(ngram_join, "LIST_ROWS", 1)
    got = sorted(map(tuple, ngram_join.near_duplicates(docs, n=2, similar=(60, 100)).collect()))
    assert got == want
    sets = [_shingles(t, 2) for _, t in rows]
    links = [
        (i, j) for i in range(60) for j in range(i)
        if 100 * len(sets[i] & sets[j]) >= 60 * len(sets[i] | sets[j])
    ]
    assert [r[2] for r in want] == [_smallest(range(60), links)[i] for i in range(60)]


def test_vectors_match_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(60, 24)).astype(np.float32)
    near = base[:30] + rng.normal(size=(30, 24)).astype(np.float32) * 0.28
    group = base[40] + rng.normal(size=(80, 24)).astype(np.float32) * 0.2
    plain = [x.tolist() for x in np.concatenate([base, near, group, base[:9] * 7, base[:5]])]
    odd = [
        None, [], [0.0] * 24, [float("nan")] * 24, [float("inf")] + [1.0] * 23, [None] + [1.0] * 23,
        [1.0, 0.0], [2.0, 0.0], [0.0, -0.0, 1.0], [-0.0, 0.0, 1.0], [1e-38, 0.0, 0.0], [3e38, 0.0, 0.0],
    ]
    vectors = [*plain, *odd]
    rows = [(i, v, 1, "x") for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int, kept string")
    got = sorted(map(tuple, embedding_dedup.near_duplicates(df, tile=16).collect()))

    def usable(v):
        return bool(v) and None not in v and np.isfinite(v).all() and any(v)

    unit = {}
    for i, v in enumerate(vectors):
        if usable(v):
            x = np.array(v, np.float32).astype(np.float64)
            x = x / np.abs(x).max()
            unit[i] = x / np.sqrt(x @ x)
    links = [
        (i, j) for i in unit for j in unit
        if j < i and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.95
    ]
    component = _smallest(range(len(vectors)), links)
    count = [0] * len(vectors)
    for i, j in links:
        count[i] += 1
        count[j] += 1
    want = [(i, count[i], component[i], component[i] == i) for i in range(len(vectors))]
    assert got == want
    assert max(count) > 40


def test_vectors_of_an_empty_table_and_null_ids(spark):
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert embedding_dedup.near_duplicates(empty).count() == 0
    df = spark.createDataFrame(
        [(None, [1.0, 0.0]), (3, [1.0, 0.0]), (3, [1.0, 0.0])], "vec_id bigint, embedding array<float>"
    )
    got = sorted(map(tuple, embedding_dedup.near_duplicates(df).collect()), key=repr)
    assert got == sorted([(None, 0, None, None), (3, 1, 3, True), (3, 1, 3, True)], key=repr)


def test_bounds_hold_for_every_pair():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 33)) * np.exp(rng.normal(size=(200, 33)) * 2)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    cosine = x @ x.T
    for threshold in (-0.2, 0.3, 0.8):
        found = {(i, j) for a, b in embedding_dedup._links(x, x, threshold) for i, j in zip(a, b)}
        assert found == set(zip(*np.nonzero(cosine >= threshold)))


@pytest.mark.parametrize("kind", ["float", "double"])
def test_pairs_of_tiles_are_neither_shuffled_nor_written(spark, monkeypatch, kind):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(300, 12))
    x = np.concatenate([base, base[:90] + rng.normal(size=(90, 12)) * 0.2, base[7] + rng.normal(size=(110, 12)) * 0.1])
    x = x.astype(kind if kind == "double" else np.float32).astype(float)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], f"vec_id bigint, embedding array<{kind}>")
    plans, materialise = {}, embedding_dedup.materialise

    def seen(rows, label, *args, **more):
        plans[label] = rows._jdf.queryExecution().executedPlan().toString()
        return materialise(rows, label, *args, **more)

    monkeypatch.setattr(embedding_dedup, "materialise", seen)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.files.maxPartitionBytes": "40k", "spark.sql.files.openCostInBytes": "0"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        got = sorted(map(tuple, embedding_dedup.near_duplicates(df, tile=16).collect()))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert "Exchange" not in plans["vector-links"]
    unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    linked = unit @ unit.T >= 0.95
    component = _smallest(range(len(x)), [(i, j) for i, j in zip(*np.nonzero(linked)) if j < i])
    assert got == [(i, int(linked[i].sum()) - 1, component[i], component[i] == i) for i in range(len(x))]


def test_counts_and_edges_of_a_task_are_folded():
    held = embedding_dedup._Held()
    for at in range(3):
        held.add(np.array([5, 6, 7 + at]), np.array([1, 0, 2]))
        held.edges.append(np.array([[5, 6], [6, 7 + at], [5, 7 + at]]))
    assert held.size() == 15
    held.fold()
    assert held.size() == 8
    out = held.flush().to_pydict()
    assert list(zip(out["node"], out["n"]))[:4] == [(5, 3), (7, 2), (8, 2), (9, 2)]
    assert out["other"][:4] == [None] * 4 and out["n"][4:] == [None] * 4
    assert held.size() == 0
