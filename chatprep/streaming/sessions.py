"""Session replay as a Structured Streaming query.

The chat loop is a live process: events of a session arrive over time. Here each session's
state is a handful of numbers (events seen, last seq applied, first exit, last clear, messages in
the current conversation, late events), kept by ``applyInPandasWithState`` in the state store. Inside a
micro-batch a session's events are applied in ``seq`` order. An event with a ``seq`` not above the last
applied one arrived late or twice: it cannot be applied in order any more, so it is counted in ``n_late``,
and a session with ``n_late = 0`` equals the batch replay. State is kept for every session seen (a session
that goes on after a pause goes on from its state). Output mode ``update``: every micro-batch emits the
new summary of the sessions it touched, with the columns of the batch ``replay_sessions`` and ``n_late``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.text import classify_command
from ..session import checkpoint_dir

SUMMARY_SCHEMA = ("sid long, total_messages long, ended_by_exit boolean, first_exit_seq long, "
                  "last_clear_seq long, n_events long, n_late long")
STATE_SCHEMA = ("n_events long, last_seq long, first_exit_seq long, last_clear_seq long, "
                "total_messages long, exited boolean, n_late long")
STATE_STORE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _step(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    sid = key[0]
    if state.exists:
        n_events, last_seq, first_exit, last_clear, total, exited, n_late = state.get
    else:
        n_events, last_seq, first_exit, last_clear, total, exited, n_late = 0, None, None, None, 0, False, 0
    frames = [b for b in batches if len(b)]
    if frames:
        pdf = pd.concat(frames).sort_values("seq", kind="mergesort")
        for seq, cmd, ok in zip(pdf["seq"].tolist(), pdf["cmd"].tolist(), pdf["ok"].tolist()):
            if last_seq is not None and seq <= last_seq:
                n_late += 1
                continue
            last_seq = seq
            n_events += 1
            if exited:
                continue
            if cmd == "exit":
                exited, first_exit = True, seq
            elif cmd == "clear":
                last_clear, total = seq, 0
            elif cmd == "message" and ok:
                total += 2
    state.update((n_events, last_seq, first_exit, last_clear, total, exited, n_late))
    yield pd.DataFrame([{
        "sid": sid, "total_messages": total, "ended_by_exit": exited, "first_exit_seq": first_exit,
        "last_clear_seq": last_clear, "n_events": n_events, "n_late": n_late,
    }]).astype({"first_exit_seq": "Int64", "last_clear_seq": "Int64"})


def _use_rocksdb(stream: DataFrame) -> None:
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE_PROVIDER)


def replay_sessions_stream(log_stream: DataFrame) -> DataFrame:
    """Streaming session summaries from a streaming session log ``(sid, seq, text, response, ...)``.
    The state store provider (RocksDB: state on disk, not on the heap) is set on the session here."""
    _use_rocksdb(log_stream)
    x = log_stream.select(
        F.col("sid").cast("long").alias("sid"), F.col("seq").cast("long").alias("seq"),
        classify_command("text").alias("cmd"), F.col("response").isNotNull().alias("ok"))
    return x.groupBy("sid").applyInPandasWithState(_step, SUMMARY_SCHEMA, STATE_SCHEMA, "update", GroupStateTimeout.NoTimeout)


def run_replay_stream(log_stream: DataFrame, out_path: str, checkpoint: str | None = None, available_now: bool = True):
    """Start the stream; every micro-batch writes its summaries to ``out_path/batch=<n>`` (Parquet,
    overwritten if the batch is repeated after a failure). Returns the started query.

    The checkpoint goes under the cluster's checkpoint folder unless one is given. With ``available_now``
    the query stops by itself once the input is processed."""
    spark = log_stream.sparkSession
    out = out_path.rstrip("/")
    cp = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/replay-{out.rsplit('/', 1)[-1]}"

    def write(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={n}")

    w = replay_sessions_stream(log_stream).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", cp)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


def latest_summaries(updates: DataFrame) -> DataFrame:
    """Collapse the update stream to the last summary per session (events applied and late ones only grow)."""
    fields = [c for c in updates.columns if c not in ("sid", "batch")]
    last = F.max_by(F.struct(*fields), F.col("n_events") + F.col("n_late"))
    return updates.groupBy("sid").agg(last.alias("s")).select("sid", "s.*")


# --- history records as a live process (transformWithStateInPandas) -------------------------

RECORD_SCHEMA = ("sid long, seq long, kind string, total_messages int, "
                 "conversation array<struct<role:string,content:string>>")


def _history_processor(system_prompt: str, idle_ms: int | None):
    from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

    class HistoryProcessor(StatefulProcessor):
        """Per session: value state (last seq, ended, pending timer) and list state holding the current
        conversation (cleared by ``clear``). ``save`` emits the conversation as it is, ``exit`` or the
        idle timeout emits it a last time and frees it; what arrives after that, or with a ``seq`` that
        was passed already, is emitted as ``late``."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.meta = handle.getValueState("meta", "last_seq long, ended boolean, timer long")
            self.msgs = handle.getListState("msgs", "role string, content string")

        def _record(self, sid, seq, kind):
            conv = [{"role": "system", "content": system_prompt}]
            conv += [{"role": role, "content": content} for role, content in self.msgs.get()]  # in append order
            return {"sid": sid, "seq": seq, "kind": kind, "total_messages": len(conv) - 1, "conversation": conv}

        def _frame(self, out):
            return pd.DataFrame(out, columns=["sid", "seq", "kind", "total_messages", "conversation"])

        def handleInputRows(self, key, rows, timerValues):
            sid = key[0]
            last_seq, ended, timer = self.meta.get() if self.meta.exists() else (None, False, None)
            frames = [b for b in rows if len(b)]
            out = []
            if frames:
                pdf = pd.concat(frames).sort_values("seq", kind="mergesort")
                for seq, cmd, user, answer in zip(pdf["seq"].tolist(), pdf["cmd"].tolist(),
                                                  pdf["text"].tolist(), pdf["answer"].tolist()):
                    if ended or (last_seq is not None and seq <= last_seq):
                        out.append({"sid": sid, "seq": seq, "kind": "late", "total_messages": None, "conversation": None})
                        continue
                    last_seq = seq
                    if cmd == "clear":
                        self.msgs.clear()
                    elif cmd == "message" and answer is not None:
                        self.msgs.appendList([("user", user), ("assistant", answer)])
                    elif cmd in ("save", "exit"):
                        out.append(self._record(sid, seq, cmd))
                        if cmd == "exit":
                            ended = True
                            self.msgs.clear()
            if timer is not None:
                self.handle.deleteTimer(timer)
                timer = None
            if idle_ms and not ended:
                timer = timerValues.getCurrentProcessingTimeInMs() + idle_ms
                self.handle.registerTimer(timer)
            self.meta.update((last_seq, ended, timer))
            if out:
                yield self._frame(out)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            last_seq, ended, _ = self.meta.get()
            if not ended:
                record = self._record(key[0], last_seq, "idle")
                self.msgs.clear()
                self.meta.update((last_seq, True, None))
                yield self._frame([record])

        def close(self) -> None:
            pass

    return HistoryProcessor()


def replay_histories_stream(log_stream: DataFrame, system_prompt: str | None = None,
                            idle_timeout_ms: int | None = None) -> DataFrame:
    """History records from a streaming session log: one row per ``save`` (the conversation as it is then) and
    one for the end of the session, each starting with the system prompt. A session ends with ``exit`` or,
    with ``idle_timeout_ms``, after that long without events (kind ``idle``); its conversation then leaves
    the state, three values per session stay. Events that come too late are rows of kind ``late``, so
    nothing is dropped unseen.

    Responses are cleaned (strip, EOS cut, bold markup) JVM-side before grouping; the Python processor only
    appends messages to list state, so state per live session is its current conversation."""
    from ..functions.text import clean_response, py_strip
    from ..operators.messages import FALLBACK_SYSTEM_PROMPT

    _use_rocksdb(log_stream)
    x = log_stream.select(
        F.col("sid").cast("long").alias("sid"), F.col("seq").cast("long").alias("seq"),
        classify_command("text").alias("cmd"), F.col("text"),
        F.when(F.col("response").isNotNull(), clean_response(py_strip("response"))).alias("answer"))
    proc = _history_processor(system_prompt if system_prompt is not None else FALLBACK_SYSTEM_PROMPT, idle_timeout_ms)
    return x.groupBy("sid").transformWithStateInPandas(
        statefulProcessor=proc, outputStructType=RECORD_SCHEMA, outputMode="Append",
        timeMode="ProcessingTime" if idle_timeout_ms else "None")
