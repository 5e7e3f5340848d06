"""The ordered replay takes a handful of state calls per session and micro-batch, however many events there are."""

import pandas as pd
import pytest
from pyspark.sql import Row

from chatprep.streaming import ordered


class Counted:
    """Value, list and map state in memory that counts the calls, as each is a round trip to the JVM."""

    def __init__(self, handle):
        self.handle, self.held = handle, None

    def __getattribute__(self, name):
        if name not in ("handle", "held"):
            object.__getattribute__(self, "handle").calls += 1
        return object.__getattribute__(self, name)

    def exists(self):
        return self.held is not None

    def clear(self):
        self.held = None

    def update(self, value):
        self.held = value


class CountedList(Counted):
    def get(self):
        return iter(self.held or [])

    def appendValue(self, value):
        self.held = (self.held or []) + [value]

    def appendList(self, values):
        self.held = (self.held or []) + values


class CountedValue(Counted):
    def get(self):
        return self.held


class CountedMap(Counted):
    def updateValue(self, key, value):
        self.held = (self.held or {}) | {key: value}

    def iterator(self):
        return iter(list((self.held or {}).items()))

    def removeKey(self, key):
        del self.held[key]


class Handle:
    def __init__(self):
        self.calls, self.timers = 0, set()

    def getValueState(self, *_):
        return CountedValue(self)

    def getListState(self, *_):
        return CountedList(self)

    def getMapState(self, *_):
        return CountedMap(self)

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.discard(at)


class Watermark:
    def __init__(self, at):
        self.getCurrentWatermarkInMs = lambda: at


def events(histories, rows):
    names = ["sid", "seq", "ms", "cmd", "ok", "text", "answer"]
    return iter([pd.DataFrame(rows, columns=names)]) if histories else iter([Row(*names)(*r) for r in rows])


def fire(processor, handle, now):
    (at,) = handle.timers
    assert at <= now
    out = list(processor.handleExpiredTimer((1,), Watermark(now), None))
    handle.timers.discard(at)
    return out


@pytest.mark.parametrize("histories", [False, True])
def test_calls_do_not_grow_with_events(histories):
    calls = []
    for n in (20, 900):
        handle = Handle()
        processor = ordered._processor(histories, 10**9, "sys")
        processor.init(handle)
        came = [(1, i, 1000 + i, "message", True, f"m{i}", f"a{i}") for i in range(n)]
        list(processor.handleInputRows((1,), events(histories, came[::-1]), Watermark(0)))
        fire(processor, handle, 1000 + n // 2)
        fire(processor, handle, 1000 + n)
        calls.append(handle.calls)
    assert calls[0] == calls[1], calls


def test_repeated_seq_waits_as_it_came_last_and_the_rest_goes_on_waiting():
    handle = Handle()
    processor = ordered._processor(True, 10**9, "sys")
    processor.init(handle)
    list(processor.handleInputRows((1,), events(True, [(1, 2, 20, "message", True, "two", "x"), (1, 1, 10, "message", True, "one", None)]), Watermark(0)))
    list(processor.handleInputRows((1,), events(True, [(1, 2, 40, "message", True, "again", "y"), (1, 5, 50, "save", False, "save", None)]), Watermark(0)))
    assert fire(processor, handle, 30) == []  # 1 is applied; 2 now waits until 40
    assert handle.timers == {41}
    list(processor.handleInputRows((1,), events(True, [(1, 6, 60, "clear", False, "clear", None), (1, 7, 70, "message", True, "new", "z"),
                                                       (1, 8, 71, "exit", False, "exit", None)]), Watermark(30)))
    (saved,) = fire(processor, handle, 55)
    assert [(m["role"], m["content"]) for m in saved.conversation[0]] == [
        ("system", "sys"), ("user", "one"), ("assistant", None), ("user", "again"), ("assistant", "y")]
    (ended,) = fire(processor, handle, 80)
    assert list(ended.kind) == ["exit"] and [m["content"] for m in ended.conversation[0]] == ["sys", "new", "z"]


def test_chunks_are_bounded_and_keep_every_row():
    rows = [(i, "x" * (300_000 if i % 7 == 0 else 1), None) for i in range(5000)]
    chunks = list(ordered._chunks(rows))
    assert [r for c in chunks for r in zip(*c)] == rows
    assert all(len(c[0]) <= ordered.CHUNK_ROWS and sum(map(len, c[1])) < ordered.CHUNK_CHARS + 300_000 for c in chunks)
