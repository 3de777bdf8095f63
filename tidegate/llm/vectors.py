"""What the operators on vectors share: which rows take part, and integer codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def all_finite(vector: Column) -> Column:
    """Whether a vector has components and none is null, NaN or infinite; null gives false."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def common_length(rows: DataFrame, vector_col: str) -> int:
    """The length that most vectors have, the longer one among equals; 0 without vectors."""
    sizes = rows.groupBy(F.size(vector_col).alias("size")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.agg(F.max(F.struct("n", "size")).alias("most")).first()["most"]
    return most["size"] if most else 0


def codes(vector: Column, factor: int, offset: int = 0) -> Column:
    """``floor(factor * x) + offset`` of each component, as long; components must fit."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(factor))) + F.lit(offset))


def codes_fit(vector: Column, factor: int, bound: int) -> Column:
    """Whether every scaled component lies within ``bound``, so that integer sums stay exact."""
    return F.forall(vector, lambda x: F.abs(x.cast("double") * F.lit(float(factor))) <= F.lit(float(bound)))
