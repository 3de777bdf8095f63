"""Whitening and hard negatives against brute force."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegate.llm import eigen, gnat, hard_negatives, whitening
from tidegate.llm.queries import QUERIES

ROWS = "vec_id bigint, embedding array<float>, label int, id string, n double, codes int"


def _matrices():
    rng = np.random.default_rng(5)
    basis, _ = np.linalg.qr(rng.standard_normal((20, 20)))
    yield "full", np.cov(rng.standard_normal((300, 30)).T)
    yield "clusters", (basis * np.repeat([7.0, 7.0 - 1e-9, 2.0, 1.0], 5)) @ basis.T
    yield "low rank", np.cov(rng.standard_normal((4, 12)).T)
    yield "identity", np.eye(9)
    yield "falling", np.diag(np.arange(11.0))
    yield "split", np.kron(np.eye(3), [[2.0, 1.0], [1.0, 2.0]])
    yield "one", np.array([[3.0]])
    yield "two", np.array([[3.0, -1.0], [-1.0, 0.5]])
    yield "large", 1e150 * np.cov(rng.standard_normal((50, 6)).T)


@pytest.mark.parametrize("name, matrix", list(_matrices()), ids=[n for n, _ in _matrices()])
def test_eigenpairs(name, matrix):
    k = min(8, len(matrix))
    values, components = eigen.leading_eigenpairs(matrix, 8)
    norm = np.abs(np.linalg.eigvalsh(matrix)).max()
    assert np.abs(values - np.linalg.eigvalsh(matrix)[::-1][:k]).max() <= 1e-13 * norm
    assert np.abs(components.T @ components - np.eye(k)).max() < 1e-12
    assert np.abs(matrix @ components - components * values).max() <= 1e-12 * norm


def test_no_variance():
    values, components = eigen.leading_eigenpairs(np.zeros((3, 3)), 2)
    assert values.tolist() == [0, 0] and components.shape == (3, 2)
    assert eigen.leading_eigenpairs(np.zeros((0, 0)), 2)[0].size == 0


def _brute_whitening(rows, k=8):
    kept = [
        (i, v) for i, v in rows
        if v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]
    codes = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in kept]
    n, sums = len(codes), [sum(c) for c in zip(*codes)]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(v, sums)] for v in codes])
    covariance = centred.T @ centred / n
    values, components = np.linalg.eigh(covariance)
    values, components = values[::-1][:k], components[:, ::-1][:, :k]
    white = centred @ components / np.sqrt(values)
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in codes]
    return [i for i, _ in kept], n, deviation, white, values / np.trace(covariance)


def _compare_whitening(got, rows):
    ids, n, deviation, white, explained = _brute_whitening(rows)
    assert len(got) == white.size and len({r["identity_error"] for r in got}) == 1
    assert got[0]["identity_error"] < 1e-9
    cells = {(r["vec_id"], r["component"]): r for r in got}
    assert set(cells) == {(i, c + 1) for i in ids for c in range(white.shape[1])}
    for c in range(white.shape[1]):
        mine = np.array([cells[i, c + 1]["whitened"] for i in ids])
        sign = np.sign(mine @ white[:, c])
        assert np.abs(sign * mine - white[:, c]).max() < 1e-8
        assert abs(cells[ids[0], c + 1]["explained"] / explained[c] - 1) < 1e-9
    for i, d in zip(ids, deviation):
        assert int(cells[i, 1]["deviation"]) == d and cells[i, 1]["n"] == n


def test_whitening_query_matches_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    df = QUERIES["op12_whitening"](spark, sf_dir)
    assert dict(df.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint",
        "whitened": "double", "explained": "double", "identity_error": "double",
    }
    _compare_whitening(df.collect(), rows)


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(2)
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [1.0, None, 2.0], [nan, 1.0, 1.0], [inf, 1.0, 1.0], [1.0] * 9, [1.0] * 2, [3e38, 0.0, 0.0]]
    good = [[float(np.float32(c)) for c in v] for v in rng.standard_normal((40, 3)) * [100, 1, 1e-2]]
    rows = [(i, v) for i, v in enumerate(odd + good)]
    df = spark.createDataFrame([(i, v, 1, "x", 0.5, 3) for i, v in rows], ROWS)
    _compare_whitening(whitening.whiten(df).collect(), rows[len(odd):])
    # Repeated and null ids stay, one row for each row and component.
    again = df.filter("vec_id >= 8").selectExpr("IF(vec_id % 2 = 0, NULL, 1L) AS vec_id", "embedding")
    assert whitening.whiten(again).count() == 40 * 3
    assert whitening.whiten(df.limit(0)).count() == 0


def test_whitening_without_variance(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = whitening.whiten(df).collect()
    assert len(got) == 4
    assert {(int(r["deviation"]), r["whitened"], r["explained"], r["identity_error"]) for r in got} == {(0, None, None, None)}
    line = spark.createDataFrame([(i, [float(i), 0.5]) for i in range(5)], "vec_id bigint, embedding array<double>")
    got = whitening.whiten(line).collect()
    assert {(r["component"], r["whitened"] is None) for r in got} == {(1, False), (2, True)}
    assert max(r["identity_error"] for r in got) < 1e-12


def test_deviation_beyond_a_long_is_exact(spark):
    rows = [(i, [float(2**40 * (i - 3)), 1.0]) for i in range(7)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    codes = [[int(1024 * c) + 100_000 for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*codes)]
    want = {i: sum((7 * c - s) ** 2 for c, s in zip(v, sums)) for i, v in enumerate(codes)}
    assert {r["vec_id"]: int(r["deviation"]) for r in whitening.whiten(df).collect()} == want


def _brute_negatives(rows, anchors, scale=256, positives=5, negatives=10, window=(30, 90)):
    """Lists of ``(id, vector, label)`` rows; every score is computed."""
    kept = [
        (i, [math.floor(scale * float(c)) for c in v], label) for i, v, label in rows
        if i is not None and label is not None and v and all(c is not None and math.isfinite(c) for c in v)
    ]
    out = []
    codes = np.array([v for _, v, _ in kept], object).reshape(len(kept), -1)
    scores = codes @ codes.T if kept else []
    for a, (i, _, label) in enumerate(kept):
        if not anchors(i):
            continue
        mine = sorted((-scores[a][b], j) for b, (j, _, other) in enumerate(kept) if other == label and j != i)
        others = sorted((-scores[a][b], j) for b, (j, _, other) in enumerate(kept) if other != label)
        for p, j in mine[:positives]:
            inside = [(-s, k) for s, k in others if window[0] * -p <= 100 * -s <= window[1] * -p]
            out += [(i, j, rank + 1, k, -p, s) for rank, (s, k) in enumerate(inside[:negatives])]
    return sorted(out)


NEGATIVES = "anchor_id positive_id rank negative_id positive_score negative_score".split()


def test_hard_negatives_query_matches_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    shifted = lambda i, label: (label + 1) % 10 if i % 7 == 0 else label
    rows = [(r["vec_id"], r["embedding"], shifted(r["vec_id"], r["label"])) for r in rows]
    df = QUERIES["op11_hard_negatives"](spark, sf_dir)
    kinds = dict.fromkeys(NEGATIVES, "bigint") | {"rank": "int"}
    assert dict(df.dtypes) == kinds
    got = sorted(tuple(r) for r in df.select(*NEGATIVES).collect())
    assert got == _brute_negatives(rows, lambda i: i % 100 == 0) and got


@pytest.mark.parametrize("tile, leaf, sample", [(16, 8, 64), (4, 30, 1000)])
def test_hard_negatives_of_groups_and_ties(spark, monkeypatch, tile, leaf, sample):
    rng = np.random.default_rng(tile)
    centres = rng.standard_normal((12, 6)) * 3
    x = centres[rng.integers(0, 12, 300)] + 0.05 * rng.standard_normal((300, 6))
    x[100:200] = np.round(x[100:200])  # ties
    x[200:260] = x[200]  # a hot vector
    rows = [(int(i * 3), [float(c) for c in v], int(rng.integers(0, 3))) for i, v in enumerate(x)]
    rows += rows[:20] + [(rows[5][0], rows[6][1], 1)]
    monkeypatch.setattr(hard_negatives, "TILE_ROWS", tile)
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 7)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(3)
    got = hard_negatives.mine(df, F.col("vec_id") % 4 == 0, leaf_rows=leaf, sample_rows=sample)
    assert sorted(tuple(r) for r in got.collect()) == _brute_negatives(rows, lambda i: i % 4 == 0)


def test_hard_negatives_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (2, [0.9, 0.1], 1), (4, [0.5, 0.5], 2), (6, [0.4, 0.0], 3), (None, [0.5, 0.5], 2),
        (8, [0.5, 0.5], None), (10, None, 2), (12, [], 2), (14, [0.5, None], 2), (16, [0.5, nan], 2),
        (18, [inf, 0.5], 2), (20, [0.0, 0.0], 1), (22, [-1.0, 0.0], 2), (24, [-1.0, -1.0], 2), (26, [0.5, 0.5], 2),
    ]
    odd = [*rows, (28, [0.5] * 3, 2), (30, [1e30, 0.0], 2)]  # another length; beyond exact scores
    df = spark.createDataFrame([(i, v, label, "x", 0.5, 1) for i, v, label in odd], ROWS.replace("float", "double"))
    want = _brute_negatives(rows, lambda i: i % 2 == 0)
    assert sorted(tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") % 2 == 0).collect()) == want and want
    for none in (hard_negatives.mine(df.limit(0), F.lit(True)), hard_negatives.mine(df, F.lit(None))):
        assert none.columns == NEGATIVES and none.count() == 0


def test_tree_leaves_out_no_reachable_leaf():
    rng = np.random.default_rng(3)
    x = np.round(rng.standard_normal((3000, 5)) * [90, 40, 20, 5, 1] + rng.integers(0, 3, (3000, 1)) * 150)
    tree = gnat.fit(x[::10], 10, 60)
    tree.measure(x)
    leaf = tree.route(x)
    assert tree.leaves > 20 and len(np.unique(leaf)) > 20
    q = x[::100]
    scores = q @ x.T
    low = np.quantile(scores, [0.9, 0.999], axis=1).T
    high = low + [[5000, np.inf]]
    found = tree.reach(q, low, high)
    searched = 0
    for i in range(len(q)):
        inside = ((scores[i][:, None] >= low[i]) & (scores[i][:, None] <= high[i])).any(axis=1)
        mine = {at for at, who in found.items() if i in who}
        assert set(leaf[inside]) <= mine
        searched += len(mine)
    assert searched < 0.8 * len(q) * tree.leaves  # and most others are left out
    assert tree.reach(q, np.full((len(q), 1), 1.0), np.full((len(q), 1), 0.0)) == {}


def test_anchors_and_tiles_are_not_shuffled_for_their_pairs(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, [float(c) for c in v], int(rng.integers(0, 2))) for i, v in enumerate(rng.standard_normal((90, 4)))]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    plans, materialise = [], hard_negatives.materialise

    def seen(found, label, *args, **more):
        if label == "negatives-found":
            plans.append(found._jdf.queryExecution().executedPlan().toString())
        return materialise(found, label, *args, **more)

    monkeypatch.setattr(hard_negatives, "materialise", seen)
    monkeypatch.setattr(hard_negatives, "TILE_ROWS", 8)
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 4)
    got = hard_negatives.mine(df, F.col("vec_id") % 9 == 0, leaf_rows=16)
    assert sorted(tuple(r) for r in got.collect()) == _brute_negatives(rows, lambda i: i % 9 == 0)
    assert len(plans) == 2 and not any("Exchange" in plan for plan in plans)


@pytest.mark.parametrize("held", [0, 1 << 16])
def test_best_rows_of_windows_over_many_tiles(monkeypatch, held):
    monkeypatch.setattr(hard_negatives, "HELD", held)
    rng, n, k = np.random.default_rng(6), 9, 3
    kind, codes = np.dtype("<i2"), rng.integers(-9, 10, (n, 5))
    ids, labels = np.arange(n), rng.integers(0, 2, n)
    owner = np.sort(rng.integers(0, n - 1, 14))  # the last anchor has no window
    low = rng.integers(-40, 60, 14)
    windows = np.column_stack([owner, np.arange(14), owner + 50, np.full(14, 70), low, low + rng.integers(0, 90, 14)])
    bits = rng.random((2, n)) < 0.8
    row = {
        "block": 7, "ids": ids.astype("<i8").tobytes(), "labels": labels.astype("<i8").tobytes(),
        "codes": codes.astype(kind).tobytes(), "windows": windows.astype("<i8").tobytes(), "leaves": [4, 2],
        "reach": np.packbits(bits, axis=1).tobytes(),
    }
    best = hard_negatives._Best(row, kind, np.float32, k, same=False)
    want = {w: [] for w in range(14)}
    for t in range(40):
        leaf = [4, 2][t % 2]
        tile = hard_negatives._Rows(rng.integers(0, 99, 20), rng.integers(0, 2, 20), rng.integers(-9, 10, (20, 5)).astype(float))
        best.meet(leaf, tile)
        for w, (i, _, _, _, least, most) in enumerate(windows):
            if bits[t % 2, i]:
                scores = (tile.codes @ codes[i]).astype(int)
                want[w] += [(-s, j) for s, j, at in zip(scores, tile.ids, tile.labels) if at != labels[i] and least <= s <= most]
    got = best.found().to_pylist()
    expected = [(7, owner[w], w, owner[w], owner[w] + 50, 70, j, -s) for w in want for s, j in sorted(want[w])[:k]]
    assert sorted(tuple(r.values()) for r in got) == sorted(expected) and len(got) > 20
