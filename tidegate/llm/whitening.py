"""Whitening of vectors: distributed centred covariance, leading components, projection."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm import eigen, vectors
from tidegate.session import materialise, ship_package

SCALE, OFFSET, COMPONENTS = 1024, 100_000, 8
#: Codes lie within this bound: their sums over 2**31 rows fit a long.
BOUND = 1 << 52
_HALF = 1 << 26


@dataclass
class Model:
    """What the fit list determines; sizes depend on the width of a vector alone."""

    n: int
    sums: list[int]
    values: np.ndarray  # leading eigenvalues of the covariance, falling
    components: np.ndarray  # their unit vectors, as columns
    trace: float


def usable(rows: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """Rows whose vector is finite, of the length most of these have, and small enough to code."""
    fine = rows.filter(vectors.all_finite(F.col(vector_col)))
    fine = fine.filter(vectors.codes_fit(F.col(vector_col), SCALE, BOUND - OFFSET - 1))
    return fine.filter(F.size(vector_col) == vectors.common_length(fine, vector_col))


def fit(coded: DataFrame, k: int = COMPONENTS) -> Model | None:
    """Leading components of the long vectors ``codes``; None without rows."""
    n, sums = _sums(coded)
    if n == 0:
        return None
    covariance = _products(coded, _centre(n, sums), len(sums)) / n
    values, components = eigen.leading_eigenpairs(covariance, k)
    return Model(n, sums, values, components, float(np.trace(covariance)))


def whiten(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = COMPONENTS
) -> DataFrame:
    """``(id_col, component, n, deviation, whitened, explained, identity_error)`` for each row.

    Each component ``c`` of a vector becomes ``floor(1024 c) + 100000``. One row comes back for
    each input row that takes part and each of the ``k`` leading components (as many as a vector
    has, if fewer), numbered from 1. ``deviation`` is decimal: the exact sum of
    ``(n x - S)**2`` over the dimensions.

    Defined cases: rows with a null or empty vector, or with null or non-finite components, take no
    part; nor do those of another length than most vectors have (the longer among equals), or with
    a component beyond 2**42. Equal rows count each; ids may be null or repeat. A component without variance
    (an eigenvalue that rounding can't tell from 0) has null ``whitened`` and doesn't enter
    ``identity_error``, which is null if there is no other; ``explained`` is null if nothing
    varies. An empty table gives no rows. Other columns are ignored.

    How it runs. Sums, then products of centred vectors, are added up by each task and merged by
    Spark: a task hands on one matrix, of a vector's width squared. That matrix alone meets the
    driver, which finds the components; they are broadcast and every vector is projected where it
    lies. The covariance of the projected rows is measured by two more such passes over them.
    """
    spark = rows.sparkSession
    ship_package(spark)
    chosen = rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    coded = materialise(
        usable(chosen, "vector").select("id", vectors.codes(F.col("vector"), SCALE, OFFSET).alias("codes")),
        "whitening-codes",
    )
    model = fit(coded, k)
    id_type = rows.schema[id_col].dataType.simpleString()
    shape = f"id {id_type}, deviation decimal(38,0), white array<double>"
    if model is None:
        projected, error = spark.createDataFrame([], shape), None
    else:
        shared = spark.sparkContext.broadcast(model)
        projected = materialise(coded.mapInArrow(_projector(shared), shape), "whitening-rows")
        error = _identity_error(projected, model)
    explained = [] if model is None or model.trace == 0 else (model.values / model.trace).tolist()
    each = projected.select("id", "deviation", F.posexplode("white").alias("at", "whitened"))
    share = F.element_at(F.array(*map(F.lit, explained)), F.col("at") + 1) if explained else F.lit(None)
    return each.select(
        F.col("id").alias(id_col),
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n if model else 0).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        share.cast("double").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _sums(coded: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and exact sums of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, None, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
            # Halves of a code: sums of either stay within a long in any task.
            parts = (x >> 26).sum(axis=0), (x & (_HALF - 1)).sum(axis=0)
            n += batch.num_rows
            high, low = parts if high is None else (high + parts[0], low + parts[1])
        if n:
            at = pa.array(np.arange(len(high), dtype=np.int32))
            yield pa.record_batch(
                [at, pa.array([n] * len(high)), pa.array(high), pa.array(low)], ["at", "n", "high", "low"]
            )

    parts = coded.select("codes").mapInArrow(run, "at int, n bigint, high bigint, low bigint")
    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    merged = parts.groupBy("at").agg(F.sum("n").alias("n"), total("high"), total("low")).collect()
    merged.sort(key=lambda r: r["at"])
    if not merged:
        return 0, []
    return merged[0]["n"], [int(r["high"]) * _HALF + int(r["low"]) for r in merged]


def _centre(n: int, sums: list[int]) -> Callable[[pa.Array], np.ndarray]:
    """Function from an array of codes to ``x - S/n``, rounded once."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])

    def centred(column: pa.Array) -> np.ndarray:
        return (_matrix(column, len(sums)) - whole) - rest

    return centred


def _products(rows: DataFrame, centred: Callable[[pa.Array], np.ndarray], width: int) -> np.ndarray:
    """Sum over all rows of the outer products of their centred vectors (the last column)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        some = False
        for batch in batches:
            if batch.num_rows:
                x = centred(batch.column(0))
                total += x.T @ x
                some = True
        if some:
            i, j = np.triu_indices(width)
            yield pa.record_batch(
                [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], ["i", "j", "v"]
            )

    column = rows.columns[-1]
    parts = rows.select(column).mapInArrow(run, "i int, j int, v double")
    merged = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    out = np.zeros((width, width))
    out[merged["i"], merged["j"]] = merged["v"]
    return out + np.triu(out, 1).T


def _projector(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        n, sums, width = model.n, model.sums, len(model.sums)
        centred = _centre(n, sums)
        varies = _varies(model)
        weights = model.components[:, varies] / np.sqrt(model.values[varies])
        exact = np.array(sums, object)
        for batch in batches:
            x = _matrix(batch.column(1), width)
            white = np.full((len(x), len(varies)), np.nan)
            white[:, varies] = centred(batch.column(1)) @ weights
            cells = pa.array(white.ravel(), mask=np.tile(~varies, len(x)))
            starts = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(varies))
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array(_deviations(x, n, exact), pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(starts, cells),
                ],
                ["id", "deviation", "white"],
            )

    return run


def _varies(model: Model) -> np.ndarray:
    """Which components have variance beyond the rounding of the covariance."""
    return model.values > len(model.sums) * np.finfo(float).eps * model.trace


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int]:
    """Exact ``sum((n x - S)**2)`` of each row; in longs where it must fit, else in Python's integers."""
    if len(x) == 0:
        return []
    least, most = x.min(axis=0).astype(object), x.max(axis=0).astype(object)
    reach = [max(abs(n * int(a) - s), abs(n * int(b) - s)) for a, b, s in zip(least, most, sums)]
    large = max([n * int(v) for v in most] + [-n * int(v) for v in least] + [abs(s) for s in sums])
    if sum(r * r for r in reach) < 1 << 63 and large < 1 << 62:
        gap = n * x - sums.astype(np.int64)
        return [int(v) for v in (gap * gap).sum(axis=1)]
    gap = n * x.astype(object) - sums
    return [int(v) for v in (gap * gap).sum(axis=1)]


def _identity_error(projected: DataFrame, model: Model) -> float | None:
    """Largest absolute entry of the whitened rows' covariance less the identity."""
    kept = int(_varies(model).sum())
    if kept == 0:
        return None
    # Components that vary come first.
    white = projected.select(F.slice("white", 1, kept).alias("white"))
    means = white.agg(*(F.avg(F.col("white")[i]).alias(f"m{i}") for i in range(kept))).first()
    mean = np.array(list(means))

    def centred(column: pa.Array) -> np.ndarray:
        return _matrix(column, kept) - mean

    covariance = _products(white, centred, kept) / model.n
    return float(np.abs(covariance - np.eye(kept)).max())
