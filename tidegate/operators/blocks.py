"""Ordered per-stream calculations that never put a whole stream into one task.

A window partitioned by stream alone sends a hot stream to one task. Here a stream is
first cut into blocks of consecutive order numbers (``order div block_rows``): rows are
shuffled by (stream, block), so a task never needs more than ``block_rows`` rows of a
stream at a time. Only one summary row per block meets its whole stream.

The order column must be an integer that is unique within its stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 1 << 18
BLOCK = "_block"


def with_block(df: DataFrame, order: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    return df.withColumn(BLOCK, F.expr(f"`{order}` div {int(block_rows)}L"))


def running_total(
    df: DataFrame,
    key: str,
    order: str,
    amounts: dict[str, str],
    block_rows: int = BLOCK_ROWS,
    inclusive: bool = True,
    attach: DataFrame | None = None,
    extents: bool = False,
) -> DataFrame:
    """Add running sums per stream: ``amounts`` maps each new column to the summed one.

    ``extents`` keeps the block number, and for each sum its value before and after the block, as
    ``<name>_from`` and ``<name>_to``. Rows of a block then stand in one partition.

    ``attach`` (one row per stream) adds its columns on the way: it is joined to the block
    summaries, so the rows themselves are not shuffled for it. Streams it lacks are left out.
    """
    rows = with_block(df, order, block_rows)
    within = (
        Window.partitionBy(key, BLOCK)
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    )
    before = Window.partitionBy(key).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(key, BLOCK).agg(*[F.sum(v).alias(f"_sum_{k}") for k, v in amounts.items()])
    ends = [
        column
        for k in amounts if extents
        for base in (F.coalesce(F.sum(f"_sum_{k}").over(before), F.lit(0)),)
        for column in (base.alias(f"{k}_from"), (base + F.col(f"_sum_{k}")).alias(f"{k}_to"))
    ]
    bases = sums.select(
        key, BLOCK, *[F.sum(f"_sum_{k}").over(before).alias(f"_base_{k}") for k in amounts], *ends
    )
    if attach is not None:
        bases = bases.join(attach, key)
    zero = F.lit(0)
    totals = {
        k: F.coalesce(F.sum(v).over(within), zero) + F.coalesce(F.col(f"_base_{k}"), zero)
        for k, v in amounts.items()
    }
    out = rows.join(bases, [key, BLOCK]).withColumns(totals)
    return out.drop(*([] if extents else [BLOCK]), *[f"_base_{k}" for k in amounts])


def with_stream_extent(
    df: DataFrame, key: str, order: str, extent: dict[str, Column], block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Add whole-stream ``min``/``max`` columns; ``extent`` maps names to block aggregates.

    Names starting with ``first`` are minimised over the blocks, all others maximised. The
    result comes back through a join on (stream, block), so a hot stream stays spread out.
    """
    rows = with_block(df, order, block_rows)
    whole = Window.partitionBy(key)
    per_block = rows.groupBy(key, BLOCK).agg(*[agg.alias(name) for name, agg in extent.items()])
    per_stream = per_block.select(
        key,
        BLOCK,
        *[
            (F.min(name) if name.startswith("first") else F.max(name)).over(whole).alias(name)
            for name in extent
        ],
    )
    return rows.join(per_stream, [key, BLOCK]).drop(BLOCK)


#: Numbers that one array holds at most.
PIECE = 1 << 16


def explode_range(
    df: DataFrame, first: Column, last: Column, name: str, piece: int = PIECE, apart: tuple[str, ...] = ()
) -> DataFrame:
    """``df`` once for each integer from ``first`` to ``last``, in the new column ``name``; none if last < first.

    Generated code holds all that one row of a stage grows to, and an array has an end. So a
    range is cut into pieces of ``piece`` numbers, and an exchange deals them over tasks. Where many
    ranges are equal, the columns ``apart`` keep them from meeting in one task.
    """
    step = F.lit(int(piece)).cast("bigint")
    starts = F.when(last >= first, F.sequence(first.cast("bigint"), last.cast("bigint"), step))
    cut = df.select("*", last.cast("bigint").alias("_last"), F.explode(starts).alias("_first"))
    # Only the first number tells the pieces of a row apart, and it also tells most rows apart.
    dealt = cut.repartition(F.xxhash64("_first", "_last", *apart))
    numbers = F.sequence("_first", F.least(F.col("_first") + step - 1, F.col("_last")))
    return dealt.select("*", F.explode(numbers).alias(name)).drop("_first", "_last")
