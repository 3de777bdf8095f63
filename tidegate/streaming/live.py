"""Live delivery: messages, ends and idle heartbeats of streams that arrive as many rows.

A stream's state is small: what is left below one message, where it stands, and the rows whose
order is not certain yet. Event-time timers act when the watermark passes them, so a stream ends
and later rows are dropped while the job runs. State needs Spark's RocksDB store;
:func:`tidegate.streaming.jobs.run_to_table` sets it with ``stateful=True``.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidegate.functions.constants import (
    HEARTBEAT_INTERVAL,
    KIND_EOF,
    KIND_INIT,
    KIND_RAW,
    MESSAGE_BYTES,
    NO_DATA_TIMEOUT,
)
from tidegate.functions.values import from_micros, literal_micros, micros
from tidegate.operators.delivery import EMPTY_MD5, eof_message, init_message
from tidegate.operators.digest import stream_digests
from tidegate.session import ship_package
from tidegate.streaming.jobs import with_event_time

_FAR = 1 << 62
#: Waiting rows that one entry of the state holds at most.
_ENTRY_ROWS = 4096
# Spark also loads a processor in a worker beside the driver that does not see shipped packages, so
# the processors travel as code, not as names in this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _packed(rows: list[tuple]) -> list[tuple]:
    """Entries of columns: a call of the state store costs far more than the rows it carries."""
    pieces = (rows[i : i + _ENTRY_ROWS] for i in range(0, len(rows), _ENTRY_ROWS))
    return [tuple(map(list, zip(*piece))) for piece in pieces]


def _unpacked(entries: Iterator[tuple]) -> list[tuple]:
    return [row for entry in entries for row in zip(*entry)]


def _wake_by(handle: StatefulProcessorHandle, wake: int) -> None:
    """One timer, no later than ``wake``. It has milliseconds and must not fire before that microsecond."""
    at = -(-wake // 1000)
    armed = list(handle.listTimers())
    if not armed or at < min(armed):
        for timer in armed:
            handle.deleteTimer(timer)
        handle.registerTimer(at)


class Delivery(StatefulProcessor):
    """Re-chunks the rows of one stream, in order, and ends it.

    Rows wait until the watermark has passed them: then no earlier one can come. A stream ends
    when its next row is ``timeout_us`` or more after the last, when the watermark has passed that time
    without one, or after a row marked as its end. Nothing is delivered afterwards.
    """

    def __init__(self, message_bytes: int, timeout_us: int | None, forget_us: int | None):
        self.message_bytes = message_bytes
        self.timeout_us = timeout_us
        self.forget_us = forget_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.place = handle.getValueState("place", "seq BIGINT, n_bytes BIGINT, last_us BIGINT, ended BOOLEAN")
        self.rest = handle.getValueState("rest", "data BINARY")
        self.waiting = handle.getListState("waiting", "o ARRAY<BIGINT>, us ARRAY<BIGINT>, data ARRAY<BINARY>, is_end ARRAY<BOOLEAN>")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if key[0] is None:
            return
        place = self.place.get()
        if place and place[3]:
            # Rows come before timers: the stream may be due to be forgotten.
            passed = timerValues.getCurrentWatermarkInMs() * 1000
            if self.forget_us is None or place[2] + self.forget_us > passed:
                return
            self._forget()
            place = None
        fresh = [(o, us, data, is_end) for _, o, _, us, data, is_end in rows if data or is_end]
        if not fresh:
            return
        self.waiting.appendList(_packed(fresh))
        first = min(r[1] for r in fresh)
        if first <= timerValues.getCurrentWatermarkInMs() * 1000:
            yield from self._advance(key, place, timerValues)
        else:
            # None is due. What waits already has its timer, so it is not read again.
            _wake_by(self.handle, first)

    def handleExpiredTimer(self, key: Any, timerValues, expiredTimerInfo) -> Iterator[Row]:
        place = self.place.get()
        if place and place[3]:
            self._forget()
            return
        yield from self._advance(key, place, timerValues)

    def _forget(self) -> None:
        self.place.clear()
        self._disarm()

    def _disarm(self) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)

    def _advance(self, key: Any, place: tuple | None, timers) -> Iterator[Row]:
        """Deliver what the watermark has passed and set the timer for what comes next."""
        passed = timers.getCurrentWatermarkInMs() * 1000
        rows = sorted(_unpacked(self.waiting.get()), key=lambda r: r[0])
        due = [r for r in rows if r[1] <= passed]
        seq, size, last, _ = place or (0, 0, None, False)
        ended = False
        if due:
            held = self.rest.get() if place else None
            buffer = bytearray(held[0] if held else b"")
            for _, us, data, is_end in due:
                if self.timeout_us is not None and last is not None and us - last >= self.timeout_us:
                    ended = True
                    break
                if seq == 0:
                    yield self._row(key, 0, KIND_INIT, us)
                    seq = 1
                last = us
                buffer += data or b""
                size += len(data or b"")
                whole = len(buffer) // self.message_bytes * self.message_bytes
                for at in range(0, whole, self.message_bytes):
                    yield self._row(key, seq, KIND_RAW, us, bytes(buffer[at : at + self.message_bytes]))
                    seq += 1
                del buffer[:whole]
                if is_end:
                    ended = True
                    break
            self.rest.update((bytes(buffer),))
        if not ended and last is not None and self.timeout_us is not None:
            ended = last + self.timeout_us <= passed
        self._disarm()
        if not ended:
            left = [r for r in rows if r[1] > passed]
            if due:
                self.waiting.put(_packed(left)) if left else self.waiting.clear()
                self.place.update((seq, size, last, False))
            wake = min((r[1] for r in left), default=_FAR)
            if last is not None and self.timeout_us is not None:
                wake = min(wake, last + self.timeout_us)
            if wake < _FAR:
                # A timer has milliseconds; it must not fire before the row's microsecond.
                self.handle.registerTimer(-(-wake // 1000))
            return
        held = self.rest.get()
        if held and held[0]:
            yield self._row(key, seq, KIND_RAW, last, held[0])
            seq += 1
        yield self._row(key, seq, KIND_EOF, last, None, size)
        self.rest.clear()
        self.waiting.clear()
        self.place.update((seq + 1, size, last, True))
        if self.forget_us is not None:
            self.handle.registerTimer(-(-(last + self.forget_us) // 1000))

    @staticmethod
    def _row(key: Any, seq: int, kind: str, us: int, value: bytes | None = None, total: int | None = None) -> Row:
        return Row(k=key[0], seq=seq, kind=kind, at_us=us, content_length=total, value=value)


def live_envelope(
    captures: DataFrame,
    delay: str,
    timeout: str | None = NO_DATA_TIMEOUT,
    key: str = "stream_id",
    order: str = "seq",
    ts: str = "ts",
    payload: str = "payload",
    end: str | None = None,
    message_bytes: int = MESSAGE_BYTES,
    forget: str | None = None,
) -> DataFrame:
    """Messages of live streams: ``(key, seq, kind, n_bytes, value, content_length, at)``.

    Message borders depend on the bytes alone, whatever the micro-batches. Rows are put in order by
    ``order``, which must rise with event time; ``delay`` is how late one may come, and it is how long messages
    lag behind. Rows without bytes are no data. A stream starts with its first row of data and
    ends by the no-data ``timeout`` (in event time; None never) or with a row whose boolean column
    ``end`` is true; rows after that are dropped. A stream's number of bytes stands in its eof row;
    values of init and eof rows are null here (:func:`framed`). ``at`` is the time of the last row in the message.

    State per stream: less than one message, the rows of the last ``delay``, and four numbers. Those of an
    ended stream stay, so that later rows are dropped, until event time is ``forget`` past
    its last row (None: for good).
    """
    ship_package(captures.sparkSession)
    timed = with_event_time(captures, ts, delay)
    rows = timed.select(
        F.col(key).alias("k"),
        F.col(order).cast("bigint").alias("o"),
        F.col(ts),
        micros(F.col(ts)).alias("us"),
        F.col(payload).cast("binary").alias("data"),
        (F.coalesce(F.col(end), F.lit(False)) if end else F.lit(False)).alias("is_end"),
    )
    kind = captures.schema[key].dataType.simpleString()
    limit = None if timeout is None else literal_micros(timeout)
    out = rows.groupBy("k").transformWithState(
        statefulProcessor=Delivery(message_bytes, limit, None if forget is None else literal_micros(forget)),
        outputStructType=f"k {kind}, seq BIGINT, kind STRING, at_us BIGINT, content_length BIGINT, value BINARY",
        outputMode="Append",
        timeMode="EventTime",
    )
    return out.select(
        F.col("k").alias(key),
        "seq",
        "kind",
        F.coalesce(F.octet_length("value").cast("bigint"), F.lit(0).cast("bigint")).alias("n_bytes"),
        "value",
        "content_length",
        from_micros(F.col("at_us")).alias("at"),
    )


def framed(
    messages: DataFrame,
    streams: DataFrame,
    init: dict[str, Column],
    key_prefix: Column,
    key: str = "stream_id",
) -> DataFrame:
    """Live messages with the JSON of init and eof and the message key, as in the batch envelope.

    ``streams`` has one row per stream; a streaming ``messages`` meets it as a stream-static join, and a
    stream it lacks gets null keys. The eof has no MD5 yet: a running MD5 can't be kept as
    state, so :func:`with_checksums` adds it from the landed rows.
    """
    heads = streams.select(key, key_prefix.alias("_prefix"), init_message(init).alias("_init"))
    eof = eof_message(F.col("content_length"), F.lit(None).cast("string"))
    value = (
        F.when(F.col("kind") == KIND_INIT, F.col("_init").cast("binary"))
        .when(F.col("kind") == KIND_EOF, eof.cast("binary"))
        .otherwise(F.col("value"))
    )
    joined = messages.join(heads, key, "left")
    return joined.select(
        key, "seq", "kind", F.concat("_prefix", "kind").alias("key"), "n_bytes", value.alias("value"), "content_length"
    )


def with_checksums(landed: DataFrame, key: str = "stream_id") -> DataFrame:
    """Landed live messages, each eof with the MD5 of its stream's landed bytes.

    Streams that have not ended keep the messages they have. Only raw values are digested, and
    only eof rows meet the digests.
    """
    digests = stream_digests(landed.where(F.col("kind") == KIND_RAW), key, "seq", "value")
    eofs = landed.where(F.col("kind") == KIND_EOF).join(digests.select(key, "md5"), key, "left")
    md5 = F.coalesce("md5", F.lit(EMPTY_MD5))
    names = [key, "seq", "kind", "key", "n_bytes", "value"]
    ends = eofs.withColumn("value", eof_message(F.col("content_length"), md5).cast("binary"))
    return landed.where(F.col("kind") != KIND_EOF).select(*names).unionByName(ends.select(*names))


class Heartbeats(StatefulProcessor):
    """Ticks of one stream: one at its first row, then one per interval, with data or without.

    The tick at ``first + n * step`` is sent when the watermark has passed it and counts the rows before it.
    One timer is armed at a time, for the next tick. Ticks stop when the stream has
    had no data for ``timeout_us``; rows after that are dropped.
    """

    def __init__(self, step_us: int, timeout_us: int):
        self.step_us = step_us
        self.timeout_us = timeout_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.place = handle.getValueState(
            "place", "first_us BIGINT, last_us BIGINT, tick BIGINT, n_bytes BIGINT, ended BOOLEAN"
        )
        self.waiting = handle.getListState("waiting", "us ARRAY<BIGINT>, n_bytes ARRAY<BIGINT>")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if key[0] is None:
            return
        place = self.place.get()
        if place and place[4]:
            return
        fresh = [(us, n) for _, _, us, n in rows]
        if not fresh:
            return
        self.waiting.appendList(_packed(fresh))
        first = min(fresh)[0]
        if first <= timerValues.getCurrentWatermarkInMs() * 1000:
            yield from self._advance(key, place, timerValues)
        else:
            _wake_by(self.handle, first)

    def handleExpiredTimer(self, key: Any, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._advance(key, self.place.get(), timerValues)

    def _advance(self, key: Any, place: tuple | None, timers) -> Iterator[Row]:
        passed = timers.getCurrentWatermarkInMs() * 1000
        rows = sorted(_unpacked(self.waiting.get()))
        due = [r for r in rows if r[0] <= passed]
        left = rows[len(due) :]
        first, last, tick, size, ended = place or (None, None, 0, 0, False)
        for us, n in due:
            if first is None:
                first = last = us
            if us - last >= self.timeout_us:
                break
            # Ticks up to this row's time don't see it.
            while first + tick * self.step_us <= us:
                yield self._row(key, tick, size)
                tick += 1
            last = us
            size += n
        if first is not None:
            until = min(passed, last + self.timeout_us)
            ended = last + self.timeout_us <= passed
            while first + tick * self.step_us <= until:
                yield self._row(key, tick, size)
                tick += 1
            self.place.update((first, last, tick, size, ended))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if ended:
            self.waiting.clear()
            return
        if due:
            self.waiting.put(_packed(left)) if left else self.waiting.clear()
        wake = left[0][0] if left else _FAR
        if first is not None:
            wake = min(wake, first + tick * self.step_us, last + self.timeout_us)
        self.handle.registerTimer(-(-wake // 1000))

    def _row(self, key: Any, tick: int, size: int) -> Row:
        return Row(k=key[0], ordinal=tick + 1, uptime_ms=tick * self.step_us // 1000, n_bytes=size)


def live_heartbeats(
    captures: DataFrame,
    delay: str,
    interval: str = HEARTBEAT_INTERVAL,
    timeout: str = NO_DATA_TIMEOUT,
    key: str = "stream_id",
    ts: str = "ts",
    n_bytes: str = "n_bytes",
) -> DataFrame:
    """``(key, ordinal, status, uptime_ms, n_bytes)``: heartbeats of live streams, idle ones included.

    The first is sent for the start of a stream, the next every ``interval`` of event time with the bytes
    of the rows before, until no row has come for ``timeout``. State holds the rows of the last
    ``delay`` and five numbers per stream; those of an ended stream stay, so that later rows are dropped.
    """
    ship_package(captures.sparkSession)
    timed = with_event_time(captures, ts, delay)
    rows = timed.select(
        F.col(key).alias("k"),
        F.col(ts),
        micros(F.col(ts)).alias("us"),
        F.coalesce(F.col(n_bytes).cast("bigint"), F.lit(0).cast("bigint")).alias("n"),
    )
    kind = captures.schema[key].dataType.simpleString()
    out = rows.groupBy("k").transformWithState(
        statefulProcessor=Heartbeats(literal_micros(interval), literal_micros(timeout)),
        outputStructType=f"k {kind}, ordinal BIGINT, uptime_ms BIGINT, n_bytes BIGINT",
        outputMode="Append",
        timeMode="EventTime",
    )
    return out.select(F.col("k").alias(key), "ordinal", F.lit("running").alias("status"), "uptime_ms", "n_bytes")
