"""Capture slices: the rows of a stream inside each recording window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.functions.values import MICROS, literal_micros, micros

# Readers that cut exactly and treat zero as "no limit"; the others round up to whole seconds.
EXACT_READERS = ("capture", "plugin")


def limit_us(duration_us: Column, reader: Column) -> Column:
    """Length of the cut in microseconds; NULL means no limit."""
    exact = F.bround(duration_us / 1000.0).cast("bigint") * 1000
    whole = F.ceil(duration_us / float(MICROS)).cast("bigint") * MICROS
    is_exact = reader.isin(*EXACT_READERS)
    return F.when(~is_exact, whole).when(duration_us > 0, exact)


def window_bins(windows: DataFrame, bin_us: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per limited window and time bin it touches: the join side of a slice.

    ``windows`` has stream_id, window_id, start_ts, duration_us and reader. ``keep`` names more
    columns to carry along.
    """
    limit = limit_us(F.col("duration_us"), F.col("reader"))
    sized = windows.where(limit > 0).select(
        F.col("stream_id"),
        "window_id",
        *keep,
        micros(F.col("start_ts")).alias("start_us"),
        (micros(F.col("start_ts")) + limit).alias("end_us"),
    )
    first = F.floor(F.col("start_us") / bin_us)
    last = F.floor((F.col("end_us") - 1) / bin_us)
    return sized.select("*", F.explode(F.sequence(first, last)).alias("bin"))


def capture_slice(
    captures: DataFrame, windows: DataFrame, bin_width: str = "1h", ts: str = "ts"
) -> DataFrame:
    """Rows of ``captures`` in ``[start, start + duration)`` of each window of their stream.

    An interval join. The equi keys are stream and time bin, so a hot stream is spread over
    its bins; the exact bounds are the residual condition. Windows without a limit take every
    later row of their stream and are joined on the stream alone: nothing ends them, so rows that
    arrive later (``captures`` may be a stream) are theirs too.
    """
    bin_us = literal_micros(bin_width)
    at = micros(F.col(ts))
    rows = captures.withColumn("_at", at).withColumn("bin", F.floor(F.col("_at") / bin_us))
    spans = window_bins(windows, bin_us)
    inside = (F.col("_at") >= F.col("start_us")) & (F.col("_at") < F.col("end_us"))
    limited = rows.join(spans, ["stream_id", "bin"]).where(inside).drop(
        "_at", "bin", "start_us", "end_us"
    )
    limit = limit_us(F.col("duration_us"), F.col("reader"))
    endless = windows.where(limit.isNull()).select(
        "stream_id", "window_id", micros(F.col("start_ts")).alias("start_us")
    )
    later = captures.withColumn("_at", at).join(endless, "stream_id").where("_at >= start_us")
    return limited.unionByName(later.drop("_at", "start_us"))


def slice_totals(slices: DataFrame, n_bytes: str = "n_bytes") -> DataFrame:
    """Rows and bytes per window."""
    return slices.groupBy("window_id", "stream_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(n_bytes).alias("n_bytes")
    )


def window_totals(
    captures: DataFrame, windows: DataFrame, bin_width: str = "1h", ts: str = "ts", n_bytes: str = "n_bytes"
) -> DataFrame:
    """What :func:`slice_totals` gives for :func:`capture_slice`, without a row for each pair.

    A window holds the rows before its end less those before its start. Both ends are looked up in
    running totals: within their time bin by a running sum over its rows and ends, before it by the
    sums of the earlier bins, one row per bin and stream. The cost is rows plus windows, however
    many overlap; a window without a limit ends after all rows. Windows without rows are left out.
    """
    bin_us = literal_micros(bin_width)
    zero, forever = F.lit(0).cast("bigint"), (1 << 63) - 1
    limit = limit_us(F.col("duration_us"), F.col("reader"))
    start = micros(F.col("start_ts"))
    end = F.when(limit.isNull(), F.lit(forever)).otherwise(start + limit)
    ends = F.array(
        F.struct(start.alias("us"), F.lit(-1).alias("sign")),
        F.struct(end.alias("us"), F.lit(1).alias("sign")),
    )
    points = windows.where(limit.isNull() | (limit > 0)).select(
        "stream_id", "window_id", F.inline(ends), zero.alias("n"), zero.alias("b")
    )
    rows = captures.select(
        "stream_id",
        F.lit(None).cast(windows.schema["window_id"].dataType).alias("window_id"),
        micros(F.col(ts)).alias("us"),
        F.lit(0).alias("sign"),
        F.lit(1).cast("bigint").alias("n"),
        F.coalesce(F.col(n_bytes).cast("bigint"), zero).alias("b"),
    )
    events = rows.unionByName(points).withColumn("bin", F.floor(F.col("us") / bin_us))
    before = Window.partitionBy("stream_id").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    sums = events.groupBy("stream_id", "bin").agg(F.sum("n").alias("bin_n"), F.sum("b").alias("bin_b"))
    bases = sums.select(
        "stream_id",
        "bin",
        F.coalesce(F.sum("bin_n").over(before), zero).alias("base_n"),
        F.coalesce(F.sum("bin_b").over(before), zero).alias("base_b"),
    )
    # A row at the very time of an end is not before it: ends come first.
    inside = (
        Window.partitionBy("stream_id", "bin")
        .orderBy("us", F.col("sign") == 0)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    running = events.withColumns({"run_n": F.sum("n").over(inside), "run_b": F.sum("b").over(inside)})
    found = running.where("sign <> 0").join(bases, ["stream_id", "bin"])
    return (
        found.groupBy("window_id", "stream_id")
        .agg(
            F.sum(F.col("sign") * (F.col("run_n") + F.col("base_n"))).alias("n_rows"),
            F.sum(F.col("sign") * (F.col("run_b") + F.col("base_b"))).alias("n_bytes"),
        )
        .where("n_rows > 0")
    )
