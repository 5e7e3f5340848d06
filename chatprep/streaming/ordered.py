"""Session replay of a stream whose events arrive out of order.

Events carry an event time. They wait in list state, a whole chunk of columns to an entry, until the watermark (the
latest event time seen, less ``delay``) has passed them: from then on Spark lets nothing earlier through, so what is passed
can be applied in ``seq`` order, once each (a repeated ``seq`` replaces itself while it waits). Any order of
arrival within ``delay`` gives the result of the batch replay. ``seq`` and event time of a session must
agree; an event whose ``seq`` was passed all the same is counted (``n_late``) or listed (kind ``late``), and rows older
than the watermark are dropped by Spark and counted in the query's progress.

State leaves: ``expire_after`` past a session's last event (in event time) its last record is written and
everything kept for it is removed. Until then a session holds its waiting events, a few numbers and, for
histories, the current conversation. Events that come later still begin the session anew, so ``expire_after``
should exceed the longest pause. An event-time timer per session drives both; the store is RocksDB.

Every call of the state store is a round trip between Python and the JVM, so a session takes a handful of them per
micro-batch, however many events it has: arrivals are appended as chunks, a timer reads what waits, applies what
is due and writes back the rest and the conversation's new messages, again as chunks.

A stream ends only when it is stopped, so the last ``delay`` of events waits until later events (of any
session, or a heartbeat row with a null ``sid``) move the watermark past them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ..functions.text import classify_command, clean_response, py_strip
from .sessions import RECORD_SCHEMA, SUMMARY_SCHEMA, _use_rocksdb

META = ("n_events long, n_late long, last_seq long, last_ms long, first_exit_seq long, last_clear_seq long, "
        "total_messages long, timer long")
META_NAMES = [x.split()[0] for x in META.split(", ")]
CHUNK_ROWS, CHUNK_CHARS = 1000, 1 << 20  # an entry of list state ends at either


def _chunks(rows: Iterable[tuple]) -> Iterator[tuple]:
    """The rows as columns, one tuple of lists per entry of list state."""
    part, chars = [], 0
    for row in rows:
        part.append(row)
        chars += sum(len(x) for x in row if isinstance(x, str))
        if len(part) >= CHUNK_ROWS or chars >= CHUNK_CHARS:
            yield tuple(map(list, zip(*part)))
            part, chars = [], 0
    if part:
        yield tuple(map(list, zip(*part)))


def _append(state, rows: Iterable[tuple]) -> None:
    for chunk in _chunks(rows):
        state.appendValue(chunk)


def _rows(state) -> Iterator[tuple]:
    for chunk in state.get():
        yield from zip(*chunk)


def _processor(histories: bool, expire_ms: int, system_prompt: str):
    from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

    names = ["seq", "ms", "cmd", "ok"] + (["text", "answer"] if histories else [])
    waits = "seq array<long>, ms array<long>, cmd array<string>, ok array<boolean>"

    class OrderedReplay(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.meta = handle.getValueState("meta", META)
            self.waiting = handle.getListState("waiting", waits + (", text array<string>, answer array<string>" if histories else ""))
            self.messages = handle.getListState("messages", "role array<string>, content array<string>")

        def _load(self) -> dict:
            return dict(zip(META_NAMES, self.meta.get() or (0, 0, None, None, None, None, 0, None)))

        def _store(self, m: dict, wake: int | None) -> None:
            if m["timer"] != wake:
                if m["timer"] is not None:
                    self.handle.deleteTimer(m["timer"])
                if wake is not None:
                    self.handle.registerTimer(wake)
                m["timer"] = wake
            self.meta.update(tuple(m.values()))

        def _record(self, sid, seq, kind):
            if self.stored is None:
                self.stored = list(_rows(self.messages))
            said = [{"role": "system", "content": system_prompt}]
            said += [{"role": r, "content": c} for r, c in self.stored + self.fresh]
            return {"sid": sid, "seq": seq, "kind": kind, "total_messages": len(said) - 1, "conversation": said}

        def _forget(self) -> None:
            self.stored, self.fresh, self.forgotten = [], [], True

        def _apply(self, sid, m: dict, seq: int, ms: int, cmd: str, ok: bool, text=None, answer=None) -> dict | None:
            if m["last_seq"] is not None and seq <= m["last_seq"]:
                m["n_late"] += 1
                return {"sid": sid, "seq": seq, "kind": "late", "total_messages": None, "conversation": None}
            m["last_seq"], m["n_events"], m["last_ms"] = seq, m["n_events"] + 1, max(ms, m["last_ms"] or ms)
            if m["first_exit_seq"] is not None:
                return None
            if cmd == "exit":
                m["first_exit_seq"] = seq
                record = self._record(sid, seq, "exit") if histories else None
                self._forget()
                return record
            if cmd == "clear":
                m["last_clear_seq"], m["total_messages"] = seq, 0
                self._forget()
            elif cmd == "message" and ok:
                m["total_messages"] += 2
                if histories:
                    self.fresh += [("user", text), ("assistant", answer)]
            elif cmd == "save" and histories:
                return self._record(sid, seq, "save")
            return None

        def _output(self, sid, m: dict, records: list):
            if histories:  # frame by frame: Spark would keep the Rows of all timers of a task until the last one
                return pd.DataFrame(records, columns=["sid", "seq", "kind", "total_messages", "conversation"])
            return Row(sid=sid, total_messages=m["total_messages"], ended_by_exit=m["first_exit_seq"] is not None,
                       first_exit_seq=m["first_exit_seq"], last_clear_seq=m["last_clear_seq"], n_events=m["n_events"], n_late=m["n_late"])

        def _arrived(self, rows) -> Iterator[tuple]:
            if not histories:
                for row in rows:
                    yield tuple(row[n] for n in names)
                return
            for frame in rows:
                for seq, ms, cmd, ok, *said in zip(*(frame[n].tolist() for n in names)):
                    yield int(seq), int(ms), cmd, bool(ok), *(None if x is None or x != x else x for x in said)

        def handleInputRows(self, key, rows, timerValues):
            if key[0] is None or key[0] != key[0]:  # heartbeats move the watermark and leave nothing
                return iter(())  # (a filter would be pushed below the watermark, which would then not see them)
            first = None
            for chunk in _chunks(self._arrived(rows)):  # each chunk is put away before the next one is read
                self.waiting.appendValue(chunk)
                first = min(chunk[1]) if first is None else min(first, *chunk[1])
            if first is not None:
                m = self._load()
                if m["timer"] is None or m["timer"] > first + 1:
                    self._store(m, first + 1)
            return iter(())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            sid, now = key[0], timerValues.getCurrentWatermarkInMs()
            m = self._load()
            self.stored, self.fresh, self.forgotten = None, [], False
            waiting = {seq: (seq, *event) for seq, *event in _rows(self.waiting)}  # of a repeated seq, what came last
            ready = sorted((e for e in waiting.values() if e[1] <= now), key=lambda e: e[0])
            rest = [e for e in waiting.values() if e[1] > now]
            records = [r for r in [self._apply(sid, m, *e) for e in ready] if r is not None]
            m["timer"] = None  # the one that fired
            gone = not rest and m["last_ms"] is not None and m["last_ms"] + expire_ms <= now
            if gone:
                if histories and m["first_exit_seq"] is None and m["n_events"]:
                    records.append(self._record(sid, m["last_seq"], "idle"))
                self.meta.clear(), self.waiting.clear(), self.messages.clear()
            else:
                if ready:
                    self.waiting.clear()
                    _append(self.waiting, rest)
                if histories:
                    if self.forgotten:
                        self.messages.clear()
                    _append(self.messages, self.fresh)
                end = (m["last_ms"] if m["last_ms"] is not None else now) + expire_ms
                self._store(m, min(e[1] for e in rest) + 1 if rest else max(end, now + 1))
            if records if histories else ready:
                yield self._output(sid, m, records)

        def close(self) -> None:
            pass

    return OrderedReplay()


def _ordered(log_stream: DataFrame, histories: bool, delay: timedelta, expire_after: timedelta, system_prompt: str, schema: str) -> DataFrame:
    _use_rocksdb(log_stream)
    ts = F.col("ts").cast("timestamp")
    said = log_stream.withColumn("ts", ts).withWatermark("ts", f"{int(delay.total_seconds() * 1000)} milliseconds")
    events = said.select(
        F.col("sid").cast("long").alias("sid"), F.col("seq").cast("long").alias("seq"), "ts",
        F.ceil(F.unix_micros("ts") / 1000).cast("long").alias("ms"), classify_command("text").alias("cmd"), F.col("response").isNotNull().alias("ok"),
        *([F.col("text"), F.when(F.col("response").isNotNull(), clean_response(py_strip("response"))).alias("answer")] if histories else []))
    sessions = events.groupBy("sid")
    return (sessions.transformWithStateInPandas if histories else sessions.transformWithState)(
        statefulProcessor=_processor(histories, int(expire_after.total_seconds() * 1000), system_prompt),
        outputStructType=schema, outputMode="Append", timeMode="EventTime")


def replay_sessions_ordered(log_stream: DataFrame, delay: timedelta, expire_after: timedelta) -> DataFrame:
    """Session summaries ``(sid, total_messages, ended_by_exit, first_exit_seq, last_clear_seq, n_events, n_late)`` of a
    session log stream ``(sid, seq, ts, text, response, ...)``, a new row whenever events of a session were applied.
    ``sessions.latest_summaries`` keeps the last one of each."""
    return _ordered(log_stream, False, delay, expire_after, "", SUMMARY_SCHEMA)


def replay_histories_ordered(log_stream: DataFrame, delay: timedelta, expire_after: timedelta, system_prompt: str | None = None) -> DataFrame:
    """History records ``(sid, seq, kind, total_messages, conversation)``: one per ``save``, one at ``exit``, and one of
    kind ``idle`` when a session that did not exit expires."""
    from ..operators.messages import FALLBACK_SYSTEM_PROMPT

    return _ordered(log_stream, True, delay, expire_after, FALLBACK_SYSTEM_PROMPT if system_prompt is None else system_prompt, RECORD_SCHEMA)
