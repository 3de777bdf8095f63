"""Calls of the state store that live processors make: rows that are not due are only appended."""

from __future__ import annotations

from tidegate.streaming import live


class _State:
    def __init__(self):
        self.entries, self.gets = [], 0

    def get(self):
        self.gets += 1
        return iter(list(self.entries))

    def appendList(self, entries):
        self.entries += entries

    def put(self, entries):
        self.entries = list(entries)

    def clear(self):
        self.entries = []


class _Value:
    value = None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class _Handle:
    def __init__(self):
        self.timers, self.lists = [], {}

    def getValueState(self, name, schema):
        return _Value()

    def getListState(self, name, schema):
        return self.lists.setdefault(name, _State())

    def listTimers(self):
        return iter(list(self.timers))

    def registerTimer(self, at):
        self.timers.append(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


class _Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def _started(processor):
    handle = _Handle()
    processor.init(handle)
    return handle, handle.lists["waiting"]


def test_rows_that_are_not_due_are_not_read_back():
    delivery = live.Delivery(4, 10_000_000, None)
    handle, waiting = _started(delivery)
    times = [5_000_001, 3_000_000, 7_000_000]
    for i, us in enumerate(times):
        rows = [("s", i * 2 + k, None, us, b"abc", False) for k in (1, 0)]
        assert list(delivery.handleInputRows(("s",), iter(rows), _Clock(0))) == []
    assert (waiting.gets, len(waiting.entries), handle.timers) == (0, 3, [3000])
    sent = list(delivery.handleExpiredTimer(("s",), _Clock(6000), None))
    assert [r["value"] for r in sent if r["kind"] == "raw_stream"] == [b"abca", b"bcab", b"cabc"]
    assert (waiting.gets, len(waiting.entries), handle.timers) == (1, 1, [7000])
    sent = list(delivery.handleExpiredTimer(("s",), _Clock(17_000), None))
    assert [(r["kind"], r["value"], r["content_length"]) for r in sent] == [
        ("raw_stream", b"abca", None), ("raw_stream", b"bc", None), ("stream_eof", None, 18),
    ]
    assert (waiting.entries, handle.timers) == ([], [])


def test_heartbeats_wait_for_their_timer():
    beats = live.Heartbeats(1_000_000, 5_000_000)
    handle, waiting = _started(beats)
    for us in (2_500_001, 1_000_000):
        assert list(beats.handleInputRows(("s",), iter([("s", None, us, 2)]), _Clock(0))) == []
    assert (waiting.gets, len(waiting.entries), handle.timers) == (0, 2, [1000])
    sent = list(beats.handleExpiredTimer(("s",), _Clock(4000), None))
    assert [(r["ordinal"], r["n_bytes"]) for r in sent] == [(1, 0), (2, 2), (3, 4), (4, 4)]
    assert handle.timers == [5000]
    # A row that is due already is dealt with at once, in the order of time.
    list(beats.handleInputRows(("s",), iter([("s", None, 3_900_000, 1)]), _Clock(4000)))
    assert beats.place.value == (1_000_000, 3_900_000, 4, 5, False)


def test_entries_hold_a_bounded_number_of_rows(monkeypatch):
    monkeypatch.setattr(live, "_ENTRY_ROWS", 3)
    rows = [(i, i * 2, bytes([i]) if i else None, i == 6) for i in range(7)]
    entries = live._packed(rows)
    assert [len(entry[0]) for entry in entries] == [3, 3, 1]
    assert live._unpacked(iter(entries)) == rows
    assert live._packed([]) == []
