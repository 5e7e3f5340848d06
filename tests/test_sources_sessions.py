"""Readers and writers on files in a temporary folder; session replay rules on hand-made logs;
stream = batch for the session replay."""

import json
import os

import pytest
from pyspark.sql import functions as F

from chatprep import sources
from chatprep.operators import messages, registry, sessions, validate
from chatprep.plans import fixtures
from chatprep.streaming.sessions import latest_summaries, run_replay_stream
from conftest import SF01


def test_prompt_catalog_and_resolution(spark, tmp_dir):
    d = os.path.join(tmp_dir, "prompts")
    os.makedirs(d)
    for name, text in {"default": "  Be kind.\n", "tutor": "　Teach.\n\n", "empty": "   \n"}.items():
        with open(os.path.join(d, f"{name}.txt"), "w", encoding="utf-8") as f:
            f.write(text)
    with open(os.path.join(d, "README.md"), "w") as f:
        f.write("not a prompt")
    cat = sources.read_prompt_catalog(spark, d)
    assert {r.name: r.prompt for r in cat.collect()} == {"default": "Be kind.", "tutor": "Teach.", "empty": ""}
    req = spark.createDataFrame([(1, "tutor"), (2, "missing"), (3, None), (4, "empty")], "id int, prompt_name string")
    got = {r.id: r.system_prompt for r in messages.resolve_system_prompt(req, cat).collect()}
    assert got == {1: "Teach.", 2: "Be kind.", 3: "Be kind.", 4: ""}
    no_default = cat.filter(F.col("name") != "default")
    got2 = {r.id: r.system_prompt for r in messages.resolve_system_prompt(req, no_default).collect()}
    assert got2[2] == messages.FALLBACK_SYSTEM_PROMPT


def test_manifests_listing_and_lineage(spark, tmp_dir):
    root = os.path.join(tmp_dir, "models")
    ad = os.path.join(root, "adapter1")
    merged = os.path.join(root, "merged1")
    os.makedirs(ad)
    os.makedirs(merged)
    ti = {"model_name": "google/gemma-3-1b-it", "dataset_file": "data/x.jsonl", "epochs": 3, "batch_size": 2,
          "learning_rate": 0.0001, "max_length": 512, "gradient_accumulation_steps": 8, "lora_r": 16,
          "lora_alpha": 32, "lora_dropout": 0.05, "save_steps": 100, "total_examples": 400}
    with open(os.path.join(ad, "training_info.json"), "w") as f:
        json.dump(ti, f, indent=2)
    cfg = {"alpha": 32, "r": 16, "bias": "none", "rank_pattern": {}, "target_modules": ["q_proj", "v_proj"],
           "peft_type": "LORA", "task_type": "CAUSAL_LM", "layers_pattern": None}
    with open(os.path.join(ad, "adapter_config.json"), "w") as f:
        json.dump(cfg, f, indent=2)
    with open(os.path.join(ad, "adapter_model.safetensors"), "wb") as f:
        f.write(b"\0" * 100)
    mi = {"base_model": "google/gemma-3-1b-it", "lora_adapter": ad, "merged_at": "2025-01-01T00:00:00",
          "dtype": "auto", "device_map": "auto", "safe_serialization": False}
    with open(os.path.join(merged, "merge_info.json"), "w") as f:
        json.dump(mi, f, indent=2)
    with open(os.path.join(merged, "config.json"), "w") as f:
        json.dump({"_name_or_path": "google/gemma-3-1b-it"}, f)

    listing = sources.list_artifacts(spark, root)
    assert "content" not in listing.columns
    flags = {os.path.basename(r.dir): r for r in registry.valid_adapters(listing).collect()}
    assert flags["adapter1"].is_adapter and flags["adapter1"].model_source == "hub"
    assert not flags["merged1"].is_adapter and flags["merged1"].model_source == "local"
    miss = {os.path.basename(r.dir) for r in registry.missing_artifacts(listing).collect()}
    assert miss == {"adapter1", "merged1"}

    trainings = sources.read_run_manifests(spark, root, "training_info")
    merges = sources.read_run_manifests(spark, root, "merge_info")
    assert trainings.count() == 1 and merges.count() == 1
    lin = registry.run_lineage(merges, trainings).collect()[0]  # a plain path, as the merge wrote it
    assert lin.training_info is not None and lin.training_info.total_examples == 400
    for spelled in ("file:" + ad, "file://" + ad, ad + "/", os.path.join(root, ".", "adapter1"), root + "//adapter1"):
        assert registry.run_lineage(merges.withColumn("lora_adapter", F.lit(spelled)), trainings).first().training_info is not None, spelled
    relative = merges.withColumn("lora_adapter", F.lit("./models/adapter1"))
    assert registry.run_lineage(relative, trainings, base=tmp_dir).first().training_info is not None
    assert registry.run_lineage(relative, trainings).first().training_info is None
    request = spark.createDataFrame([(merged, root + "/none", ad + "/")], "out_dir string, base_model string, adapter_dir string")
    found = registry.resolve_artifact_source(listing, request, file="adapter_model.safetensors").first()
    assert (found.source, found.source_dir) == ("adapter", ad + "/")
    cfgs = sources.read_run_manifests(spark, root, "adapter_config")
    scan = registry.adapter_config_scan(cfgs).collect()
    assert sorted(r.module for r in scan) == ["q_proj", "v_proj"] and scan[0].scale == 2.0


def test_sinks_roundtrip(spark, tmp_dir):
    convs = messages.fold_messages(spark.read.parquet(f"{SF01}/conversations.parquet"))
    rec = sessions.conversation_record(convs, ts=None, saved_at=F.lit("history/x.json"))
    out = os.path.join(tmp_dir, "hist")
    sources.write_history(rec.select("record.*"), out)
    back = spark.read.text(out).collect()
    assert len(back) == 100
    first = json.loads(back[0].value)
    assert first["model_info"]["session_duration"] is None and "conversation" in first
    assert any(ord(ch) > 127 for r in back for ch in r.value)  # non-ASCII not escaped

    ex = spark.range(5).withColumnRenamed("id", "example_id")
    man = os.path.join(tmp_dir, "run7")
    sources.write_run_manifest(ex, {"model_name": "m", "epochs": 3, "learning_rate": 1e-4, "note": "é"}, man)
    m = sources.read_run_manifests(spark, tmp_dir).collect()
    assert len(m) == 1 and m[0].total_examples == 5 and m[0].epochs == 3 and m[0].save_steps is None
    with open(os.path.join(man, "training_info.json"), encoding="utf-8") as f:
        raw = json.load(f)
    assert list(raw) == [*sources.sinks.MANIFEST_FIELDS, "note"] and raw["note"] == "é"
    # write -> read -> lineage
    os.makedirs(os.path.join(tmp_dir, "merged"))
    with open(os.path.join(tmp_dir, "merged", "merge_info.json"), "w") as f:
        json.dump({"base_model": "b", "lora_adapter": man}, f)
    merges = sources.read_run_manifests(spark, tmp_dir, "merge_info")
    assert registry.run_lineage(merges, sources.read_run_manifests(spark, tmp_dir)).first().training_info.total_examples == 5

    ts = os.path.join(tmp_dir, "train")
    sources.write_training_set(ex.withColumn("epoch", F.col("example_id") % 2), ts, partition_by=["epoch"])
    assert spark.read.parquet(ts).count() == 5


def test_read_chat_jsonl_schema(spark, tmp_dir):
    p = os.path.join(tmp_dir, "c.jsonl")
    with open(p, "w") as f:
        f.write('{"messages":[{"role":"user","content":"a"}],"extra":1}\n')
    df = sources.read_chat_jsonl(spark, p)
    assert df.columns == ["messages"] and df.collect()[0].messages[0].content == "a"


def _log(spark, rows):
    return spark.createDataFrame(rows, "sid long, seq long, ts timestamp_ntz, text string, response string")


def test_replay_rules(spark):
    import datetime as dt

    t = dt.datetime(2024, 1, 1)
    rows = [
        (1, 1, t, "hello", "**hi**<end_of_turn>junk"),
        (1, 2, t, "broken", None),            # failed generation: user turn removed
        (1, 3, t, "clear", None),
        (1, 4, t, "again", "ok"),
        (1, 5, t, " exit", "still a message"),  # not a command: commands are not stripped
        (1, 6, t, "history", None),
        (1, 7, t, "   ", None),
        (1, 8, t, "QUIT", None),
        (1, 9, t, "after", "ignored"),
        (2, 1, t, "exit", None),              # exits at once: empty conversation
        (2, 2, t, "late", "x"),
    ]
    log = _log(spark, rows)
    msgs = sessions.replay_messages(log).orderBy("sid", "seq", "part").collect()
    assert [(r.sid, r.seq, r.role, r.content) for r in msgs] == [
        (1, 4, "user", "again"), (1, 4, "assistant", "ok"),
        (1, 5, "user", " exit"), (1, 5, "assistant", "still a message")]
    summ = {r.sid: r for r in sessions.replay_sessions(log).collect()}
    assert summ[1].total_messages == 4 and summ[1].first_exit_seq == 8 and summ[1].last_clear_seq == 3
    assert summ[2].total_messages == 0 and summ[2].ended_by_exit
    convs = {r.sid: r.messages for r in sessions.replay_conversations(log, "SYS").collect()}
    assert len(convs[2]) == 1 and convs[2][0].content == "SYS" and len(convs[1]) == 5
    saved = {r.sid for r in validate.should_save(sessions.replay_conversations(log, "SYS")).collect()}
    assert saved == {1}


def test_snapshots(spark):
    import datetime as dt

    t = dt.datetime(2024, 1, 1)
    rows = [(1, 1, t, "a", "x"), (1, 2, t, "save", None), (1, 3, t, "b", "y"), (1, 4, t, "save", None),
            (1, 5, t, "clear", None), (1, 6, t, "save", None), (1, 7, t, "exit", None), (1, 8, t, "save", None)]
    snaps = sessions.session_snapshots(_log(spark, rows)).orderBy("save_seq").collect()
    assert [(r.save_seq, r.segment, r.total_messages) for r in snaps] == [(2, 0, 2), (4, 0, 4), (6, 1, 0)]
    said = sessions.snapshot_messages(_log(spark, rows)).orderBy("save_seq", "seq", "part").collect()
    assert [(r.save_seq, r.role, r.content) for r in said] == [
        (2, "user", "a"), (2, "assistant", "x"), (4, "user", "a"), (4, "assistant", "x"), (4, "user", "b"), (4, "assistant", "y")]


def test_append_responses_rules(spark):
    convs = spark.createDataFrame([
        (1, [("user", "q")]), (2, [("user", "q")]), (3, [("system", "s")]), (4, [("user", "q"), ("assistant", "a")]), (5, []), (6, [("user", "q")])],
        "conv_id long, messages array<struct<role:string,content:string>>")
    resp = spark.createDataFrame([(1, 0, "yes"), (3, 0, "x"), (4, 1, "x"), (5, 0, "x"), (6, 4, "other turn")], "conv_id long, turn int, response string")
    got = {r.conv_id: [tuple(m) for m in r.messages] for r in sessions.append_responses(convs, resp, turn="turn").collect()}
    assert got == {1: [("user", "q"), ("assistant", "yes")], 2: [], 3: [("system", "s")], 4: [("user", "q"), ("assistant", "a")], 5: [], 6: []}
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "conv_id long, response string")
    with pytest.raises(Exception, match="more than one response for 1"):
        sessions.append_responses(convs, twice).collect()


def test_final_records_and_requested_paths(spark, tmp_dir):
    import datetime as dt
    from urllib.parse import quote

    from chatprep.plans.runs import export_histories

    t = dt.datetime(2024, 1, 2, 3, 4, 5)
    rows = [(1, 1, t, "hi", "yo", None), (2, 1, t, "exit", None, None), (3, 1, t, "exit", None, "mine.json"),
            (4, 1, t, "hi", "yo", "/abs/x.json"), (4, 2, t, "exit", None, None), (5, 1, t, "hi", None, "")]
    log = spark.createDataFrame(rows, "sid long, seq long, ts timestamp_ntz, text string, response string, requested string")
    got = {r.sid: (len(r.messages), r.path) for r in sessions.final_records(log, requested="requested").collect()}
    # 2 and 5 say nothing and ask for nothing; 3 asked for its (empty) conversation; 1 never exits and is saved too
    assert got == {1: (3, "history/chat_20240102_030405.json"), 3: (1, "history/mine.json"), 4: (3, "/abs/x.json")}
    out = os.path.join(tmp_dir, "final")
    export_histories(log, out, requested="requested")
    assert sorted(d for d in os.listdir(out) if d.startswith("saved_at=")) == sorted(
        "saved_at=" + quote(quote(p, safe=""), safe="") for _, p in got.values())


@pytest.mark.parametrize("n_files", [1, 3, 10])
def test_stream_equals_batch(spark, tmp_dir, n_files):
    log = fixtures.session_log(spark, SF01).select("sid", "seq", "ts", "text", "response")
    src = os.path.join(tmp_dir, f"src{n_files}")
    # files arrive in seq order (one append per range), as a live log would
    bounds = log.agg(F.min("seq"), F.max("seq")).collect()[0]
    lo, hi = bounds[0], bounds[1] + 1
    step = (hi - lo + n_files - 1) // n_files
    for i in range(n_files):
        chunk = log.filter((F.col("seq") >= lo + i * step) & (F.col("seq") < lo + (i + 1) * step))
        chunk.coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = os.path.join(tmp_dir, f"out{n_files}")
    q = run_replay_stream(stream, out, checkpoint=os.path.join(tmp_dir, f"cp{n_files}"))
    assert q.awaitTermination(600)
    last = latest_summaries(spark.read.parquet(out))
    assert last.filter("n_late > 0").count() == 0
    got = {tuple(r) for r in last.drop("n_late").collect()}
    want = {tuple(r) for r in sessions.replay_sessions(log).select(
        "sid", "total_messages", "ended_by_exit", "first_exit_seq", "last_clear_seq", "n_events").collect()}
    assert got == want


def _files(spark, parts, src, schema):
    """One file per part, in order, with modification times that keep it."""
    import time

    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)


def test_late_events_are_counted(spark, tmp_dir):
    import datetime as dt

    t = dt.datetime(2024, 1, 1)
    schema = "sid long, seq long, ts timestamp_ntz, text string, response string"
    parts = [[(1, 1, t, "a", "x"), (1, 5, t, "b", "y"), (2, 1, t, "a", "x")], [(1, 3, t, "late", "z"), (1, 5, t, "b", "y"), (1, 6, t, "c", "w")]]
    src, out = os.path.join(tmp_dir, "src_late"), os.path.join(tmp_dir, "out_late")
    _files(spark, parts, src, schema)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    assert run_replay_stream(stream, out, checkpoint=os.path.join(tmp_dir, "cp_late")).awaitTermination(600)
    got = {r.sid: (r.n_events, r.n_late, r.total_messages) for r in latest_summaries(spark.read.parquet(out)).collect()}
    assert got == {1: (3, 2, 6), 2: (1, 0, 2)}


def test_history_stream_ends_idle_sessions_and_lists_late_events(spark, tmp_dir):
    import datetime as dt
    import time

    from chatprep.streaming.sessions import replay_histories_stream

    t = dt.datetime(2024, 1, 1)
    schema = "sid long, seq long, ts timestamp_ntz, text string, response string"
    src, out = os.path.join(tmp_dir, "src_idle"), os.path.join(tmp_dir, "out_idle")
    _files(spark, [[(1, 1, t, "a", "x"), (2, 1, t, "b", "y"), (2, 2, t, "exit", None)]], src, schema)
    stream = spark.readStream.schema(schema).parquet(src)
    q = (replay_histories_stream(stream, "sys", idle_timeout_ms=2000).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", os.path.join(tmp_dir, "cp_idle")).outputMode("append").trigger(processingTime="1 second").start())

    def rows():
        try:
            return {(r.sid, r.seq, r.kind): r.conversation for r in spark.read.parquet(out).collect()}
        except Exception:  # nothing written yet
            return {}

    def wait(key):
        deadline = time.time() + 120
        while key not in rows() and time.time() < deadline:
            time.sleep(1)

    try:
        wait((1, 1, "idle"))
        _files(spark, [[(1, 2, t, "too late", "z"), (2, 3, t, "after exit", "z")]], src, schema)
        wait((1, 2, "late"))
    finally:
        q.stop()
    got = rows()
    assert set(got) == {(1, 1, "idle"), (2, 2, "exit"), (1, 2, "late"), (2, 3, "late")}
    assert [tuple(m) for m in got[(1, 1, "idle")]] == [("system", "sys"), ("user", "a"), ("assistant", "x")]


def test_require_examples_and_idempotent_drop(spark):
    empty = spark.createDataFrame([], "example_id long, input_ids array<int>")
    with pytest.raises(ValueError, match="No valid examples"):
        validate.require_examples(validate.drop_invalid_examples(empty))
    df = spark.createDataFrame([(1, [1, 2]), (2, []), (3, None)], "example_id long, input_ids array<int>")
    once = validate.drop_invalid_examples(df)
    assert sorted(r.example_id for r in once.collect()) == [1]
    assert sorted(r.example_id for r in validate.drop_invalid_examples(once).collect()) == [1]
    validate.require_examples(once)


def test_prepare_training_run_end_to_end(spark, tmp_dir):
    from chatprep.plans.runs import prepare_training_run

    lines = fixtures.chat_lines(spark, "/root/testdata/sf0.001").orderBy("line_no").select("line")
    src = os.path.join(tmp_dir, "data.jsonl")
    with open(src, "w", encoding="utf-8") as f:
        for r in lines.collect():
            f.write(r.line + "\n")
    # the derived file has 40 % bad lines: the gate stops the run
    with pytest.raises(ValueError, match="lines are bad"):
        prepare_training_run(spark, src, os.path.join(tmp_dir, "run0"))
    good = os.path.join(tmp_dir, "good.jsonl")
    with open(src, encoding="utf-8") as fi, open(good, "w", encoding="utf-8") as fo:
        for ln in fi:
            if python_ok(ln):
                fo.write(ln)
    out = os.path.join(tmp_dir, "run1")
    res = prepare_training_run(spark, good, out, model_name="m", max_length=32, max_vocab=200, epochs=2)
    n_ok = sum(1 for _ in open(good, encoding="utf-8"))
    assert res["total_examples"] == n_ok and res["files"] == 1 and res["lines"] == n_ok and res["errors"] == 0
    ex = spark.read.parquet(os.path.join(out, "examples"))
    assert {len(r.input_ids) for r in ex.collect()} == {32}
    plan = spark.read.parquet(os.path.join(out, "plan"))
    assert plan.count() == 2 * (n_ok // 2 * 2) and {"file", "line_no"} <= set(plan.columns)
    manifest = sources.read_run_manifests(spark, out).collect()
    assert len(manifest) == 1 and (manifest[0].model_name, manifest[0].total_examples, manifest[0].epochs) == ("m", n_ok, 2)


def python_ok(line):
    from chatprep.functions.json import python_status

    return python_status(line.strip()) == "ok"


def test_export_histories(spark, tmp_dir):
    from chatprep.plans.runs import export_histories

    log = fixtures.session_log(spark, SF01)
    out = os.path.join(tmp_dir, "hist")
    export_histories(log, out)
    recs = [json.loads(r.value) for r in spark.read.text(out).collect()]
    n_saved = validate.should_save(sessions.replay_conversations(log)).count()
    assert len(recs) == n_saved
    r0 = recs[0]
    assert r0["conversation"][0]["role"] == "system"
    assert r0["total_messages"] == len(r0["conversation"]) - 1
    assert r0["model_info"]["saved_at"].startswith("history/chat_") and r0["model_info"]["session_duration"] >= 0


def _brute_replay(rows):
    """Plain Python chat loop over (sid, seq, text, response) rows: final summary per session and
    the message count of every save."""
    from chatprep.functions.text import EXIT_WORDS

    by_sid = {}
    for sid, seq, text, resp in sorted(rows, key=lambda r: (r[0], r[1])):
        by_sid.setdefault(sid, []).append((seq, text, resp))
    summary, saves = {}, {}
    for sid, evs in by_sid.items():
        msgs, exit_seq, last_clear = 0, None, None
        for seq, text, resp in evs:
            if exit_seq is not None:
                continue
            low = text.lower()
            if low in EXIT_WORDS:
                exit_seq = seq
            elif low == "clear":
                msgs, last_clear = 0, seq
            elif low == "save":
                saves[(sid, seq)] = msgs
            elif low == "history" or not text.strip():
                pass
            elif resp is not None:
                msgs += 2
        summary[sid] = (msgs, exit_seq is not None, exit_seq, last_clear, len(evs))
    return summary, saves


def test_hot_session_matches_brute_force(spark):
    # a third of all events belong to session 0; range partitions cut it into pieces
    hot = F.col("seq") % 3 == 0
    log = (fixtures.session_log(spark, SF01)
           .withColumn("sid", F.when(hot, F.lit(0)).otherwise(F.col("sid") + 1))
           # the hot session stays open all along: its exit commands become plain messages
           .withColumn("text", F.when(hot & F.lower("text").isin("exit", "quit", "終了"), F.lit("stay"))
                       .otherwise(F.col("text"))))
    rows = [(r.sid, r.seq, r.text, r.response) for r in log.select("sid", "seq", "text", "response").collect()]
    summary, saves = _brute_replay(rows)
    got = {r.sid: (r.total_messages, r.ended_by_exit, r.first_exit_seq, r.last_clear_seq, r.n_events)
           for r in sessions.replay_sessions(log).collect()}
    assert got == summary
    snaps = {(r.sid, r.save_seq): r.total_messages for r in sessions.session_snapshots(log).collect()}
    assert snaps == saves
    assert sum(1 for k in saves if k[0] == 0) > 10


def test_history_stream_equals_batch(spark, tmp_dir):
    from chatprep.streaming.sessions import replay_histories_stream

    log = fixtures.session_log(spark, SF01).select("sid", "seq", "ts", "text", "response")
    src = os.path.join(tmp_dir, "src_hist")
    bounds = log.agg(F.min("seq"), F.max("seq")).collect()[0]
    step = (bounds[1] + 1 - bounds[0] + 2) // 3
    for i in range(3):  # three files in seq order
        log.filter((F.col("seq") >= bounds[0] + i * step) & (F.col("seq") < bounds[0] + (i + 1) * step)) \
            .coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = (replay_histories_stream(stream).writeStream.format("memory").queryName("hist_stream")
         .outputMode("append").option("checkpointLocation", os.path.join(tmp_dir, "cp_hist"))
         .trigger(availableNow=True).start())
    assert q.awaitTermination(600)
    got = spark.table("hist_stream")
    # final records of exited sessions == batch replay of those sessions
    exits = {r.sid: [tuple(m) for m in r.conversation] for r in got.filter(F.col("kind") == "exit").collect()}
    ended = {r.sid for r in sessions.replay_sessions(log).filter("ended_by_exit").collect()}
    batch = {r.sid: [tuple(m) for m in r.messages] for r in sessions.replay_conversations(log).collect()}
    assert set(exits) == ended
    assert all(exits[s] == batch[s] for s in exits)
    # snapshots at saves == batch snapshot counts
    snaps = {(r.sid, r.seq): r.total_messages for r in got.filter(F.col("kind") == "save").collect()}
    want = {(r.sid, r.save_seq): r.total_messages for r in sessions.session_snapshots(log).collect()}
    assert snaps == want
