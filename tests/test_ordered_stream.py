"""Replay of out-of-order streams: equal to the batch replay, state that leaves."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from chatprep.operators import sessions
from chatprep.streaming.ordered import replay_histories_ordered, replay_sessions_ordered
from chatprep.streaming.sessions import latest_summaries

LOG = "sid long, seq long, ts timestamp, text string, response string"
T0 = dt.datetime(2024, 1, 1)
DELAY, EXPIRE = dt.timedelta(minutes=30), dt.timedelta(hours=3)


def log_rows(seed=3, n=400):
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        sid = 1 if rng.random() < 0.4 else rng.randint(2, 9)
        text = rng.choices([f"m{seq}", "save", "clear", "exit", ""], [60, 12, 4, 1 if sid % 2 else 0, 4])[0]
        rows.append((sid, seq, T0 + dt.timedelta(seconds=20 * seq + rng.random()), text, rng.choice([None, f"**a** {seq}"])))
    return rows


def heartbeat(spark, folder, at):
    spark.createDataFrame([(None, None, at, None, None)], LOG).coalesce(1).write.mode("append").parquet(folder)


def drain(frame, out, checkpoint):
    q = frame.writeStream.format("parquet").option("path", out).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    assert q.awaitTermination(600)
    return q


def stream(spark, folder):
    return spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(folder)


@pytest.mark.parametrize("n_files", [1, 4])
def test_shuffled_stream_equals_batch(spark, tmp_dir, n_files):
    rows = log_rows()
    log = spark.createDataFrame(rows, LOG)
    rng = random.Random(8)
    order = sorted(rows, key=lambda r: r[2] + DELAY * rng.random() * 0.95)
    src = os.path.join(tmp_dir, "src")
    size = -(-len(order) // n_files)
    for i in range(n_files):
        part = order[i * size:(i + 1) * size]
        rng.shuffle(part)
        spark.createDataFrame(part + part[:3], LOG).coalesce(1).write.mode("append").parquet(src)  # some come twice
    heartbeat(spark, src, T0 + dt.timedelta(days=1))
    drain(replay_sessions_ordered(stream(spark, src), DELAY, dt.timedelta(days=30)), f"{tmp_dir}/sums", os.path.join(tmp_dir, "cp1"))
    got = latest_summaries(spark.read.parquet(f"{tmp_dir}/sums"))
    want = sessions.replay_sessions(log).select("sid", "total_messages", "ended_by_exit", "first_exit_seq", "last_clear_seq", "n_events", F.lit(0).alias("n_late"))
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))

    drain(replay_histories_ordered(stream(spark, src), DELAY, dt.timedelta(days=30), "sys"), f"{tmp_dir}/hist", os.path.join(tmp_dir, "cp2"))
    got = spark.read.parquet(f"{tmp_dir}/hist")
    saved = {(r.sid, r.save_seq): r.total_messages for r in sessions.session_snapshots(log).collect()}
    assert {(r.sid, r.seq): r.total_messages for r in got.filter("kind = 'save'").collect()} == saved and saved
    final = {r.sid: [tuple(m) for m in r.messages] for r in sessions.replay_conversations(log, "sys").collect()}
    ended = {r.sid for r in sessions.replay_sessions(log).filter("ended_by_exit").collect()}
    exits = {r.sid: [tuple(m) for m in r.conversation] for r in got.filter("kind = 'exit'").collect()}
    assert set(exits) == ended and all(exits[s] == final[s] for s in exits) and ended
    assert got.filter("kind = 'late'").count() == 0


def test_state_leaves_after_expiry(spark, tmp_dir):
    src, cp = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "cp")
    rows = [(s, s * 10 + i, T0 + dt.timedelta(minutes=i), ["hi", "clear", "there", "save"][i], "ok") for s in range(1, 41) for i in range(4)]
    spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(src)
    heartbeat(spark, src, T0 + dt.timedelta(hours=1))
    frame = replay_histories_ordered(stream(spark, src), DELAY, EXPIRE, "sys")
    q = drain(frame, f"{tmp_dir}/gone", cp)
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert kept[-1] > 0
    heartbeat(spark, src, T0 + dt.timedelta(hours=9))
    heartbeat(spark, src, T0 + dt.timedelta(hours=9, minutes=1))
    q = drain(replay_histories_ordered(stream(spark, src), DELAY, EXPIRE, "sys"), f"{tmp_dir}/gone", cp)
    after = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert after[-1] == 0, (kept, after)
    idle = spark.read.parquet(f"{tmp_dir}/gone").filter("kind = 'idle'").collect()
    assert sorted(r.sid for r in idle) == list(range(1, 41)) and all([tuple(m) for m in r.conversation][1:] == [("user", "there"), ("assistant", "ok")] for r in idle)
    assert spark.read.parquet(f"{tmp_dir}/gone").filter("kind = 'save'").count() == 40


def test_events_behind_an_applied_one_are_late(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    minute = dt.timedelta(minutes=1)
    spark.createDataFrame([(1, 5, T0, "a", "x")], LOG).coalesce(1).write.mode("append").parquet(src)
    heartbeat(spark, src, T0 + 60 * minute)
    spark.createDataFrame([(1, 4, T0 + 40 * minute, "b", "y"), (1, 6, T0 + 41 * minute, "c", "z")], LOG).coalesce(1).write.mode("append").parquet(src)
    heartbeat(spark, src, T0 + 100 * minute)
    drain(replay_sessions_ordered(stream(spark, src), DELAY, dt.timedelta(days=1)), f"{tmp_dir}/late", os.path.join(tmp_dir, "cp"))
    (row,) = latest_summaries(spark.read.parquet(f"{tmp_dir}/late")).collect()
    assert (row.n_events, row.n_late, row.total_messages) == (2, 1, 4)
