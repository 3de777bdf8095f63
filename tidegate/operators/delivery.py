"""Chunking, message envelopes, integrity checks, timeouts and progress of streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.functions.constants import (
    KIND_EOF,
    KIND_INIT,
    KIND_RAW,
    MESSAGE_BYTES,
    NO_DATA_TIMEOUT,
)
from tidegate.functions.values import from_micros, literal_micros, micros
from tidegate.operators.blocks import BLOCK, BLOCK_ROWS, running_total, with_block
from tidegate.operators.digest import stream_digests

INIT_FIELDS = ("jobId", "taskId", "tdoId", "offsetMS", "mediaStartTimeUTC", "mimeType", "ffmpegFormat")
#: Fixed values of the public 32-bit FNV-1a hash.
FNV_OFFSET, FNV_PRIME = 2166136261, 16777619
EMPTY_MD5 = "d41d8cd98f00b204e9800998ecf8427e"


def _size(payload: Column) -> Column:
    return F.coalesce(F.octet_length(payload).cast("bigint"), F.lit(0))


def _slices(payload: Column, size: int) -> Column:
    """Array of consecutive slices of ``size`` bytes, the last one shorter; empty for no bytes."""
    length = _size(payload)
    starts = F.sequence(F.lit(0).cast("bigint"), F.floor((length - 1) / size))
    cut = F.transform(
        starts, lambda i: F.substring(payload, (i * size + 1).cast("int"), F.lit(size))
    )
    return F.when(length > 0, cut).otherwise(F.array().cast("array<binary>"))


def chunk_payloads(
    df: DataFrame,
    key: str,
    payload: str,
    message_bytes: int = MESSAGE_BYTES,
    keep_empty: bool = False,
) -> DataFrame:
    """Cut each payload into messages: (key, chunk_no, n_bytes, value). No shuffle.

    A payload without bytes has no messages; ``keep_empty`` gives it one empty chunk, so that an
    object store keeps the object. The slices are made inside the exploded array, so the generator carries the key and
    one slice per row and never repeats the whole payload. The outer form of the generator
    keeps the optimizer from building every array a second time to test its size.
    """
    data = F.col(payload).cast("binary")
    cut = df.select(key, F.posexplode_outer(_slices(data, message_bytes)).alias("chunk_no", "value"))
    if keep_empty:
        cut = cut.fillna(0, "chunk_no").withColumn(
            "value", F.coalesce("value", F.lit("").cast("binary"))
        )
    else:
        cut = cut.where("chunk_no IS NOT NULL")
    return cut.select(
        key,
        F.col("chunk_no").cast("bigint").alias("chunk_no"),
        F.octet_length("value").cast("bigint").alias("n_bytes"),
        "value",
    )


def init_message(fields: dict[str, Column]) -> Column:
    return F.to_json(F.struct(*[fields[name].alias(name) for name in INIT_FIELDS if name in fields]))


def eof_message(n_bytes: Column, md5: Column) -> Column:
    return F.to_json(F.struct(n_bytes.alias("contentLength"), md5.alias("md5Checksum")))


def eof_claim() -> Column:
    """What an eof message says about its stream, as a struct; NULL for other kinds."""
    parsed = F.from_json(F.col("value").cast("string"), "contentLength BIGINT, md5Checksum STRING")
    return F.when(F.col("kind") == KIND_EOF, parsed)


def envelope_totals(messages: DataFrame, key: str = "stream_id") -> DataFrame:
    """Messages, raw bytes and the claims of the eof message per stream."""
    lean = messages.select(key, "n_bytes", eof_claim().alias("_eof"))
    return lean.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_messages"),
        F.sum("n_bytes").alias("raw_bytes"),
        F.max("_eof.contentLength").alias("content_length"),
        F.max("_eof.md5Checksum").alias("md5_checksum"),
    )


def _message(seq: Column, kind: str, n_bytes: Column, value: Column) -> Column:
    return F.struct(
        seq.cast("bigint").alias("seq"),
        F.lit(kind).alias("kind"),
        n_bytes.cast("bigint").alias("n_bytes"),
        value.cast("binary").alias("value"),
    )


def envelope(
    df: DataFrame,
    key: str,
    payload: str,
    init: dict[str, Column],
    key_prefix: Column,
    message_bytes: int = MESSAGE_BYTES,
) -> DataFrame:
    """Init, raw and eof messages of payloads held one per row.

    One generator over ``[init, raw…, eof]`` per row: a single scan, no union, no shuffle.
    Digest and length come from the payload in place.
    """
    data = F.col(payload).cast("binary")
    length = _size(data)
    slices = _slices(data, message_bytes)
    digest = F.md5(F.coalesce(data, F.lit(b"")))
    last = F.ceil(length / message_bytes) + 1
    messages = F.concat(
        F.array(_message(F.lit(0), KIND_INIT, F.lit(0), init_message(init))),
        F.transform(
            slices, lambda v, i: _message(i + 1, KIND_RAW, F.octet_length(v), v)
        ),
        F.array(_message(last, KIND_EOF, F.lit(0), eof_message(length, digest))),
    )
    return df.select(F.col(key), key_prefix.alias("_prefix"), F.inline_outer(messages)).select(
        key, "seq", "kind", F.concat("_prefix", "kind").alias("key"), "n_bytes", "value"
    )


def payload_digests(df: DataFrame, key: str, payload: str) -> DataFrame:
    """Length and MD5 of payloads held one per row: a projection."""
    data = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    return df.select(
        key, F.octet_length(data).cast("bigint").alias("n_bytes"), F.md5(data).alias("md5")
    )


def rechunk_rows(
    captures: DataFrame,
    key: str = "stream_id",
    order: str = "seq",
    payload: str = "payload",
    message_bytes: int = MESSAGE_BYTES,
    block_rows: int = BLOCK_ROWS,
    attach: DataFrame | None = None,
) -> DataFrame:
    """Messages of streams captured as many rows; row borders leave no trace.

    Each row learns its byte offset, is cut at message borders, and the pieces of one message
    (at most ``message_bytes`` bytes) are put together in offset order. Messages that lie inside
    a block of rows are put together where the block's rows were numbered, so payload is exchanged
    once; only the two messages at a block's ends are exchanged again. ``attach`` adds columns of a
    table with one row per stream.
    """
    extra = [c for c in attach.columns if c != key] if attach is not None else []
    attach = attach.withColumnRenamed(key, "k") if attach is not None else None
    size = int(message_bytes)
    rows = captures.select(
        F.col(key).alias("k"), F.col(order).alias("o"), F.col(payload).cast("binary").alias("data")
    ).withColumn("n", _size(F.col("data")))
    placed = running_total(
        rows.where("n > 0"), "k", "o", {"at": "n"}, block_rows, inclusive=False, attach=attach, extents=True
    )

    def assembled(chosen: str, *within: str) -> DataFrame:
        pieces = placed.select(
            "k",
            BLOCK,
            *extra,
            F.expr(f"""
                inline_outer(transform(
                    filter(sequence(at div {size}L, (at + n - 1) div {size}L), c -> {chosen}),
                    c -> named_struct(
                        'chunk_no', c,
                        'piece_at', greatest(c * {size}L, at),
                        'piece', substring(data,
                            cast(greatest(c * {size}L - at, 0L) as int) + 1,
                            cast(least((c + 1) * {size}L, at + n) - greatest(c * {size}L, at) as int)))))
            """),
        ).where("chunk_no IS NOT NULL")
        return (
            pieces.groupBy("k", *within, "chunk_no", *extra)
            .agg(F.expr("listagg(piece) within group (order by piece_at)").alias("value"))
            .select("k", "chunk_no", "value", *extra)
        )

    inside = f"c * {size}L >= at_from AND (c + 1) * {size}L <= at_to"
    whole, across = assembled(inside, BLOCK), assembled(f"NOT ({inside})")
    return whole.unionByName(across).select(
        F.col("k").alias(key),
        "chunk_no",
        F.octet_length("value").cast("bigint").alias("n_bytes"),
        "value",
        *extra,
    )


def envelope_from_rows(
    captures: DataFrame,
    streams: DataFrame,
    init: dict[str, Column],
    key_prefix: Column,
    key: str = "stream_id",
    order: str = "seq",
    payload: str = "payload",
    message_bytes: int = MESSAGE_BYTES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Messages of streams captured as many rows; ``streams`` has one row per stream.

    Raw rows stay where re-chunking left them, with their prefix attached through the block
    summaries; only init and eof rows meet the digests.
    """
    prefixes = streams.select(key, key_prefix.alias("_prefix"))
    raw = rechunk_rows(captures, key, order, payload, message_bytes, block_rows, prefixes)
    digests = stream_digests(captures, key, order, payload)
    heads = streams.select(
        key, key_prefix.alias("_prefix"), init_message(init).alias("_init")
    ).join(digests, key, "left")
    length = F.coalesce(F.col("n_bytes"), F.lit(0).cast("bigint"))
    ends = F.array(
        _message(F.lit(0), KIND_INIT, F.lit(0), F.col("_init")),
        _message(
            F.ceil(length / message_bytes) + 1,
            KIND_EOF,
            F.lit(0),
            eof_message(length, F.coalesce(F.col("md5"), F.lit(EMPTY_MD5))),
        ),
    )
    framed = heads.select(key, "_prefix", F.inline(ends)).select(
        key, "seq", "kind", F.concat("_prefix", "kind").alias("key"), "n_bytes", "value"
    )
    body = raw.select(
        key,
        (F.col("chunk_no") + 1).alias("seq"),
        F.lit(KIND_RAW).alias("kind"),
        F.concat("_prefix", F.lit(KIND_RAW)).alias("key"),
        "n_bytes",
        "value",
    )
    return framed.unionByName(body)


def empty_envelopes(
    failed: DataFrame, written: DataFrame, key: str, init: dict[str, Column], key_prefix: Column
) -> DataFrame:
    """One init and one eof of an empty stream for failed streams that wrote nothing."""
    silent = failed.join(written.select(key).distinct(), key, "left_anti")
    messages = F.array(
        _message(F.lit(0), KIND_INIT, F.lit(0), init_message(init)),
        _message(F.lit(1), KIND_EOF, F.lit(0), eof_message(F.lit(0).cast("bigint"), F.lit(EMPTY_MD5))),
    )
    return (
        silent.dropDuplicates([key])
        .select(key, key_prefix.alias("_prefix"), F.inline(messages))
        .select(key, "seq", "kind", F.concat("_prefix", "kind").alias("key"), "n_bytes", "value")
    )


def fnv1a(text: Column) -> Column:
    """32-bit FNV-1a hash of a text's UTF-8 bytes, as an unsigned number; NULL for NULL."""
    digits = F.hex(text.cast("binary"))
    places = F.when(F.octet_length(text) > 0, F.sequence(F.lit(0), F.octet_length(text) - 1))
    places = F.when(text.isNotNull(), F.coalesce(places, F.array().cast("array<int>")))

    def byte(i: Column) -> Column:
        return F.conv(F.substr(digits, i * 2 + 1, F.lit(2)), 16, 10).cast("bigint")

    return F.aggregate(
        F.transform(places, byte),
        F.lit(FNV_OFFSET),
        lambda h, b: (h.bitwiseXOR(b) * F.lit(FNV_PRIME)).bitwiseAND(F.lit(0xFFFFFFFF)),
    )


def place_messages(
    messages: DataFrame, topic: Column, partition: Column, partitions: int
) -> DataFrame:
    """(topic, partition, key, value): a fixed partition, or the producer's choice by the key.

    A producer takes the key's 32-bit FNV-1a hash as a signed number, its remainder by the number of
    partitions, and drops the sign. It deals messages without a key out at random; here they go
    to partition 0.
    """
    hashed = fnv1a(F.coalesce(F.col("key").cast("string"), F.lit("")))
    signed = hashed - F.when(hashed >= 1 << 31, F.lit(1 << 32)).otherwise(F.lit(0))
    by_key = F.when(F.col("key").isNull(), 0).otherwise(F.abs(signed % partitions))
    fixed = F.when(partition >= 0, partition)
    return messages.withColumns(
        {"topic": topic, "partition": F.coalesce(fixed, by_key).cast("int")}
    )


def sequence_ranges(
    messages: DataFrame, key: str = "stream_id", order: str = "seq", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Which messages are lost or sent again: ``(key, from_seq, to_seq, state, n_messages)``.

    A range of state ``missing`` holds numbers from 0 to the last one seen that no message has;
    numbers of a ``repeated`` one have several, and ``n_messages`` counts the extra copies (else
    the numbers). Ranges are as long as can be. What is lost after the last number seen can't be
    told from numbers. A stream is cut into blocks of numbers; only their first and last numbers,
    and the runs that touch a block's border, meet their whole stream.
    """
    size = int(block_rows)
    seen = (
        messages.select(F.col(key).alias("k"), F.col(order).cast("bigint").alias("o"))
        .where("o >= 0")
        .groupBy("k", "o")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    seen = with_block(seen, "o", size)
    in_block = Window.partitionBy("k", BLOCK).orderBy("o")
    over_blocks = Window.partitionBy("k").orderBy(BLOCK)

    def gaps(df: DataFrame) -> DataFrame:
        return df.where("o - before > 1").selectExpr(
            "k", "before + 1 AS from_seq", "o - 1 AS to_seq", "'missing' AS state", "o - before - 1 AS n"
        )

    ends = seen.groupBy("k", BLOCK).agg(F.min("o").alias("o"), F.max("o").alias("last"))
    last_before = F.coalesce(F.lag("last").over(over_blocks), F.lit(-1).cast("bigint"))

    # Repeated numbers in a row differ from their rank by the same amount.
    runs = (
        seen.where("n > 1")
        .withColumn("run", F.col("o") - F.row_number().over(in_block))
        .groupBy("k", BLOCK, "run")
        .agg(F.min("o").alias("from_seq"), F.max("o").alias("to_seq"), F.sum(F.col("n") - 1).alias("n"))
    )
    touches = (F.col("from_seq") == F.col(BLOCK) * size) | (F.col("to_seq") == (F.col(BLOCK) + 1) * size - 1)
    over_runs = Window.partitionBy("k").orderBy("from_seq")
    fresh = F.coalesce(F.lag("to_seq").over(over_runs) + 1 != F.col("from_seq"), F.lit(True))
    stitched = (
        runs.where(touches)
        .withColumn("fresh", fresh.cast("int"))
        .withColumn("run", F.sum("fresh").over(over_runs))
        .groupBy("k", "run")
        .agg(F.min("from_seq").alias("from_seq"), F.max("to_seq").alias("to_seq"), F.sum("n").alias("n"))
    )
    names = ["k", "from_seq", "to_seq", F.lit("repeated").alias("state"), "n"]
    every = (
        gaps(seen.withColumn("before", F.lag("o").over(in_block)))
        .unionByName(gaps(ends.withColumn("before", last_before)))
        .unionByName(runs.where(~touches).select(*names))
        .unionByName(stitched.select(*names))
    )
    return every.select(F.col("k").alias(key), "from_seq", "to_seq", "state", F.col("n").alias("n_messages"))


def integrity_audit(messages: DataFrame, key: str = "stream_id") -> DataFrame:
    """Check each stream of a message table against its own eof message.

    Gaps are told from distinct sequence numbers, messages that were sent twice by
    ``duplicate_seq``; bytes and digest are those of the messages as they stand. All checks but the digest are one partially aggregated group-by; the digest is
    recomputed from the raw messages in order.
    """
    is_raw = F.col("kind") == KIND_RAW
    # Values leave the rows before the group-by, so that it moves and sorts small rows only.
    lean = messages.select(
        key,
        "seq",
        "kind",
        F.octet_length("value").cast("bigint").alias("_size"),
        eof_claim().alias("_eof"),
    )
    facts = lean.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_messages"),
        F.max("seq").alias("_last"),
        F.count_distinct("seq").alias("_distinct"),
        F.coalesce(F.max(F.col("kind") == KIND_INIT), F.lit(False)).alias("has_init"),
        F.coalesce(F.max(F.col("kind") == KIND_EOF), F.lit(False)).alias("has_eof"),
        F.coalesce(F.sum(F.when(is_raw, F.col("_size"))), F.lit(0)).alias("raw_bytes"),
        F.max("_eof.contentLength").alias("_length"),
        F.max("_eof.md5Checksum").alias("_md5"),
    )
    digests = stream_digests(messages.where(is_raw), key, "seq", "value").select(
        key, F.col("md5").alias("_actual")
    )
    actual = F.coalesce(F.col("_actual"), F.lit(EMPTY_MD5))
    return facts.join(digests, key, "left").select(
        key,
        "n_messages",
        "raw_bytes",
        "has_init",
        "has_eof",
        (F.col("_last") + 1 != F.col("_distinct")).alias("missing_seq"),
        (F.col("_distinct") != F.col("n_messages")).alias("duplicate_seq"),
        F.coalesce(F.col("_length") != F.col("raw_bytes"), F.lit(False)).alias("length_mismatch"),
        F.coalesce(F.col("_md5") != actual, F.lit(False)).alias("digest_mismatch"),
    )


def no_data_timeouts(
    captures: DataFrame,
    timeout: str = NO_DATA_TIMEOUT,
    key: str = "stream_id",
    order: str = "seq",
    ts: str = "ts",
    n_bytes: str = "n_bytes",
    starts: DataFrame | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Where each stream ends when no data arrives for ``timeout``; rows without bytes are no data.

    ``starts(key, start_time)`` adds the wait for the first row. Rows meet only their own
    block; each block reports what it holds before its first gap, and the blocks of a stream
    (one row each) decide which of them still count.
    """
    limit = literal_micros(timeout)
    rows = captures.select(
        F.col(key).alias("k"),
        F.col(order).cast("bigint").alias("o"),
        micros(F.col(ts)).alias("us"),
        F.col(n_bytes).cast("bigint").alias("n"),
        F.lit(1).cast("bigint").alias("is_row"),
    ).where("n > 0")
    rows = with_block(rows, "o", block_rows)
    if starts is not None:
        # The start is a block of its own before all others.
        marks = starts.select(
            F.col(key).alias("k"),
            F.lit(None).cast("bigint").alias("o"),
            micros(F.col("start_time")).alias("us"),
            F.lit(0).cast("bigint").alias("n"),
            F.lit(0).cast("bigint").alias("is_row"),
            F.lit(-(1 << 62)).cast("bigint").alias(BLOCK),
        )
        rows = rows.unionByName(marks)

    in_block = Window.partitionBy("k", BLOCK).orderBy("o")
    gap = F.coalesce(F.col("us") - F.lag("us").over(in_block) >= limit, F.lit(False))
    flagged = rows.withColumn("gap", gap).withColumn(
        "cut", F.max("gap").over(in_block.rowsBetween(Window.unboundedPreceding, 0))
    )
    alive = ~F.col("cut")
    blocks = flagged.groupBy("k", BLOCK).agg(
        F.min("us").alias("first_us"),
        F.max("us").alias("last_us"),
        F.max("cut").alias("has_cut"),
        F.sum("is_row").alias("rows"),
        F.sum(F.when(alive, F.col("is_row")).otherwise(0)).alias("alive_rows"),
        F.sum(F.when(alive, F.col("n")).otherwise(0)).alias("alive_bytes"),
        F.max(F.when(alive, F.col("us"))).alias("alive_us"),
        F.max(F.when(alive, F.col("o"))).alias("alive_o"),
    )
    over_blocks = Window.partitionBy("k").orderBy(BLOCK)
    wait = F.coalesce(
        F.col("first_us") - F.lag("last_us").over(over_blocks) >= limit, F.lit(False)
    )
    cut_here = F.max("wait").over(over_blocks.rowsBetween(Window.unboundedPreceding, 0))
    cut_before = F.coalesce(
        F.max("has_cut").over(over_blocks.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False)
    )
    counted = blocks.withColumn("wait", wait).withColumn("live", ~(cut_here | cut_before))
    live = F.col("live")
    summary = counted.groupBy("k").agg(
        F.sum("rows").alias("all_rows"),
        F.sum(F.when(live, F.col("alive_rows")).otherwise(0)).alias("rows_kept"),
        F.sum(F.when(live, F.col("alive_bytes")).otherwise(0)).alias("bytes_kept"),
        F.max(F.when(live, F.col("alive_us"))).alias("last_us"),
        F.max(F.when(live, F.col("alive_o"))).alias("last_seq"),
    )
    timed_out = (F.col("rows_kept") < F.col("all_rows")) | (F.col("all_rows") == 0)
    end_us = F.when(timed_out, F.col("last_us") + limit).otherwise(F.col("last_us"))
    return summary.select(
        F.col("k").alias(key),
        timed_out.alias("timed_out"),
        from_micros(end_us).alias("end_time"),
        "rows_kept",
        "bytes_kept",
        (F.col("all_rows") - F.col("rows_kept")).alias("rows_dropped"),
        "last_seq",
    )


def cut_at_timeout(
    captures: DataFrame,
    ends: DataFrame,
    key: str = "stream_id",
    order: str = "seq",
    n_bytes: str = "n_bytes",
) -> DataFrame:
    """Rows that are delivered before the no-data timer ends their stream.

    ``ends`` is the result of :func:`no_data_timeouts`. An envelope of these rows carries an eof
    message that agrees with what was delivered.
    """
    last = ends.select(key, F.col("last_seq").alias("_last"))
    kept = captures.where(F.col(n_bytes) > 0).join(last, key).where(F.col(order) <= F.col("_last"))
    return kept.drop("_last")


def byte_progress(
    captures: DataFrame,
    key: str = "stream_id",
    order: str = "seq",
    n_bytes: str = "n_bytes",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Cumulative bytes of each stream after each row."""
    return running_total(captures, key, order, {"bytes_so_far": n_bytes}, block_rows)
