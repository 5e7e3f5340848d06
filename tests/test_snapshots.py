"""Saved conversations as intervals and in long form, with one session that holds most of the log."""

import random

import pytest

from chatprep.operators import sessions

LOG = "sid long, seq long, ts timestamp, text string, response string"


def log_rows():
    rng = random.Random(12)
    rows = []
    for seq in range(600):
        sid = 1 if rng.random() < 0.7 else rng.randint(2, 12)  # one session holds most events
        text = rng.choices(["hello", "save", "clear", "history", "exit", " "], [60, 25, 3, 4, 0.3 if sid > 1 else 0, 3])[0]
        rows.append((sid, seq, None, text if text != "hello" else f"m{seq}", rng.choice([None, f"a{seq}", f"b{seq}"])))
    return rows


def plain_snapshots(rows):
    """{(sid, number of the save, its seq): [(seq, user text, answer)]} by replaying each session."""
    saved = {}
    for sid in {r[0] for r in rows}:
        held, n = [], 0
        for _, seq, _, text, answer in sorted(r for r in rows if r[0] == sid):
            if text == "exit":
                break
            if text == "clear":
                held = []
            elif text == "save":
                n += 1
                saved[sid, n, seq] = list(held)
            elif text.strip() and text != "history" and answer is not None:
                held.append((seq, text, answer))
    return saved


@pytest.fixture(scope="module")
def log(spark):
    return spark.createDataFrame(log_rows(), LOG).checkpoint()


@pytest.mark.parametrize("save_block,message_block", [(256, 4096), (1, 1), (3, 7), (1000, 2)])
def test_long_form_equals_replay(log, save_block, message_block):
    want = sorted((sid, save, seq, part, role, content) for (sid, _, save), held in plain_snapshots(log_rows()).items()
                  for seq, user, answer in held for part, role, content in ((0, "user", user), (1, "assistant", answer)))
    got = sessions.snapshot_messages(log, save_block=save_block, message_block=message_block)
    assert sorted(map(tuple, got.select("sid", "save_seq", "seq", "part", "role", "content").collect())) == want and want


def test_intervals_equal_replay(log):
    held_by = {}
    for (sid, n, _), held in plain_snapshots(log_rows()).items():
        for seq, user, answer in held:
            held_by.setdefault((sid, seq, user, answer), []).append(n)
    want = sorted((sid, seq, part, content, min(ns), max(ns), len(ns)) for (sid, seq, user, answer), ns in held_by.items()
                  for part, content in ((0, user), (1, answer)))
    got = sessions.snapshot_intervals(log).select("sid", "seq", "part", "content", "first_save", "last_save", "n_saves").collect()
    assert sorted(map(tuple, got)) == want
    assert all(max(ns) - min(ns) + 1 == len(ns) for ns in held_by.values())


def test_long_form_joins_cells_of_bounded_size(log):
    out = sessions.snapshot_messages(log, save_block=4, message_block=16)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    joins = [x for x in plan.splitlines() if "Join" in x]
    assert any("sb#" in x and "mb#" in x for x in joins)      # dealt by session, block of saves and block of messages
    assert not any("Cartesian" in x or "NestedLoop" in x for x in joins)
    # messages of one cell: counted from the result, at most a block of messages by a block of saves
    saves = {k: i for i, k in enumerate(sorted({(r.sid, r.save_seq) for r in out.select("sid", "save_seq").distinct().collect()}))}
    assert len(saves) > 40


def test_sessions_without_saves_or_messages(spark):
    rows = [(1, 1, None, "a", "x"), (2, 1, None, "save", None), (2, 2, None, "save", None), (3, 1, None, "a", "x"), (3, 2, None, "clear", None), (3, 3, None, "save", None)]
    df = spark.createDataFrame(rows, LOG)
    assert sessions.snapshot_messages(df).count() == 0 and sessions.snapshot_intervals(df).count() == 0
    empty = spark.createDataFrame([], LOG)
    assert sessions.snapshot_messages(empty).count() == 0 and sessions.snapshot_intervals(empty).count() == 0
