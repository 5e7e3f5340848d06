"""Registered queries (one per operator) and, for each, the same computation in plain SQL.

Every query reads the driver tables in ``sf_dir`` (directly or through a derivation in
``plans.fixtures``) and returns flat columns: lists are joined into strings, computed columns
carry the same alias on both sides. The SQL runs in DuckDB over the same tables.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.json import is_valid_json
from ..functions.text import (
    bold_to_ansi,
    classify_command,
    clean_response,
    cut_at_eos,
    ensure_eos,
    history_path,
    py_strip,
)
from ..operators import batches, messages, registry, sessions, tokens, validate
from ..session import checkpoint_dir, table
from . import fixtures
from .training import rendered_texts, training_examples, training_examples_from_lines

# Parameters of the registered checks (fixed; not tuned to the data).
CHECK_MAX_LENGTH = 512
CHECK_TOP_TOKENS = 1000  # of the top-k vocabulary query
PROMPT_CATALOG = [
    ("default", "You are a helpful assistant. Answer carefully."),
    ("assistant", "You are a capable assistant."),
    ("coding_assistant", "You are an experienced programming assistant."),
    ("creative_writer", "You are a creative writer."),
    ("tutor", ""),
]
PROMPT_REQUESTS = ["default", "assistant", "coding_assistant", "creative_writer", "tutor", "missing", None]


def _json(c):
    return F.to_json(c)


def _ids(c):
    return F.array_join(F.transform(F.col(c), lambda x: x.cast("string")), " ")


# ------------------------------------------------------------------------------------------
# shared Spark pieces
# ------------------------------------------------------------------------------------------

def _lines(spark, d):
    return fixtures.chat_lines(spark, d).select("file", "line_no", "line")


def _unnumbered_lines(spark, d):
    return fixtures.chat_lines(spark, d, numbered=False).select("file", "line")


def _convs(spark, d):
    return messages.fold_messages(table(spark, d, "conversations"))


def _texts(spark, d):
    return rendered_texts(_convs(spark, d), "conv_id")


def _vocab(spark, d):
    return tokens.build_vocabulary(_texts(spark, d), "text")


def _log(spark, d):
    return fixtures.session_log(spark, d)


def _catalog(spark):
    return spark.createDataFrame(PROMPT_CATALOG, "name string, prompt string")


# ------------------------------------------------------------------------------------------
# queries
# ------------------------------------------------------------------------------------------

def _written_lines(spark, lines):
    """Write lines in order as text files under the checkpoint folder (a few files); returns the path."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/lines-{uuid.uuid4().hex}"
    lines.repartitionByRange(4, "line_no").sortWithinPartitions("line_no").select("line").write.text(path)
    return path


def q_read_jsonl_lines(spark, d):
    """Written and read again: the lines of the files in order, numbered through."""
    from ..sources.jsonl import read_jsonl_lines

    read = read_jsonl_lines(spark, _written_lines(spark, _lines(spark, d)))
    sizes = read.groupBy("file").agg(F.count(F.lit(1)).alias("n"))  # one row per file
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return read.join(F.broadcast(sizes), "file").select((F.col("line_no") + F.col("before")).alias("line_no"), "line")


def q_read_chat_jsonl(spark, d):
    """Written and read again: the messages of every line that passes the gate."""
    from ..sources.jsonl import read_chat_jsonl

    ok = validate.classify_lines(_lines(spark, d)).filter("status = 'ok'")
    read = read_chat_jsonl(spark, _written_lines(spark, ok.select("line_no", py_strip("line").alias("line"))))
    return read.select(F.size("messages").alias("n_messages"), _json("messages").alias("messages"))


def q_is_valid_json(spark, d):
    return _lines(spark, d).select("file", "line_no", is_valid_json("line").alias("valid"))


def q_classify_lines(spark, d):
    return validate.classify_lines(_lines(spark, d)).select("file", "line_no", "status")


def q_validation_report(spark, d):
    return validate.validation_report(_unnumbered_lines(spark, d))


def q_first_invalid_line(spark, d):
    return validate.first_invalid_line(_lines(spark, d))


def q_error_report(spark, d):
    return validate.error_report(_lines(spark, d))


def q_encoding_report(spark, d):
    return validate.encoding_report(fixtures.undecodable_lines(spark, d))


def q_dataset_statistics(spark, d):
    return validate.dataset_statistics(table(spark, d, "conversations")).select(
        "role", "n_messages", "n_conversations", F.col("total_chars").cast("long").alias("total_chars"), "avg_chars",
        F.col("min_chars").cast("long").alias("min_chars"), F.col("max_chars").cast("long").alias("max_chars"))


def q_turn_count_histogram(spark, d):
    return validate.turn_count_histogram(table(spark, d, "conversations"))


def q_chat_format_report(spark, d):
    r = validate.chat_format_report(messages.fold_messages(fixtures.dirty_turns(spark, d)))
    return r.select("conv_id", F.array_join("violations", ",").alias("violations"), "n_violations", "is_valid")


def q_repair_suggestions(spark, d):
    bad_lines = validate.classify_lines(_lines(spark, d)).filter(F.col("status") != "ok").select(
        F.lit("line").alias("source"), F.col("line_no").alias("item"), F.col("status").alias("code"))
    bad_convs = validate.chat_format_report(messages.fold_messages(fixtures.dirty_turns(spark, d))).select(
        F.lit("conversation").alias("source"), F.col("conv_id").alias("item"), F.explode("violations").alias("code"))
    return validate.repair_suggestions(bad_lines.unionByName(bad_convs), "code").select("source", "item", "code", "suggestion")


def q_dataset_readiness(spark, d):
    return validate.dataset_readiness(table(spark, d, "documents"), ["lang"], table(spark, d, "labels"))


def q_recommend_config(spark, d):
    counts = table(spark, d, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select("lang", "n", F.explode(F.array(*[F.lit(k) for k in (1, 10, 100)])).alias("k"))
    return validate.recommend_config(counts.select("lang", (F.col("n") * F.col("k")).cast("long").alias("n_examples")))


def _texts_with_gaps(spark, d):
    """The rendered texts, empty where the id is a multiple of 7, else missing where it is one of 11."""
    i, t = F.col("example_id"), F.col("text")
    return _texts(spark, d).select(i, F.when(i % 7 == 0, F.lit("")).when(i % 11 == 0, F.lit(None).cast("string")).otherwise(t).alias("text"))


def q_drop_invalid_examples(spark, d):
    ids = tokens.encode_tokens(_texts_with_gaps(spark, d), _vocab(spark, d), max_length=CHECK_MAX_LENGTH)
    return validate.drop_invalid_examples(ids, "token_ids").select("example_id", F.size("token_ids").alias("n_tokens"))


def q_training_examples_from_lines(spark, d):
    ex = training_examples_from_lines(_lines(spark, d), max_length=CHECK_MAX_LENGTH)
    return ex.select("file", "line_no", "n_tokens", _ids("input_ids").alias("input_ids"),
                     _ids("attention_mask").alias("attention_mask"), _ids("labels").alias("labels"))


def q_parse_chat_lines(spark, d):
    from ..sources.jsonl import parse_chat_lines

    r = parse_chat_lines(_lines(spark, d))
    return r.select("file", "line_no", F.size("messages").alias("n_messages"), _json("messages").alias("messages"))


def q_should_save(spark, d):
    convs = sessions.replay_conversations(_log(spark, d))
    return validate.should_save(convs).select("sid", F.size("messages").alias("n_messages"))


def q_fold_messages(spark, d):
    return _convs(spark, d).select("conv_id", F.size("messages").alias("n_messages"), _json("messages").alias("messages"))


def q_explode_messages(spark, d):
    return messages.explode_messages(_convs(spark, d))


def q_inject_system_prompt(spark, d):
    c = messages.inject_system_prompt(_convs(spark, d), messages.FALLBACK_SYSTEM_PROMPT)
    return c.select("conv_id", _json("messages").alias("messages"))


def _prompt_requests(spark, d):
    conv_ids = table(spark, d, "conversations").select("conv_id").distinct()
    names = F.array(*[F.lit(n).cast("string") for n in PROMPT_REQUESTS])
    return conv_ids.withColumn("prompt_name", F.element_at(names, (F.col("conv_id") % len(PROMPT_REQUESTS) + 1).cast("int")))


def q_resolve_system_prompt(spark, d):
    r = messages.resolve_system_prompt(_prompt_requests(spark, d), _catalog(spark))
    return r.select("conv_id", "prompt_name", "system_prompt")


def q_render_chat(spark, d):
    c = _convs(spark, d)
    return c.select(
        "conv_id",
        messages.render_chat("messages").alias("text"),
        messages.render_chat("messages", add_generation_prompt=True).alias("prompt"),
        messages.render_chat("messages", messages.CHATML_TEMPLATE).alias("chatml"),
    )


def q_ensure_eos(spark, d):
    r = _convs(spark, d).select("conv_id", messages.render_chat("messages").alias("r"))
    # every fifth text already ends with the token
    r = r.withColumn("r", F.when(F.col("conv_id") % 5 == 0, F.concat("r", F.lit(tokens.EOS_TOKEN))).otherwise(F.col("r")))
    return r.select("conv_id", ensure_eos("r", tokens.EOS_TOKEN).alias("text"))


def q_build_vocabulary(spark, d):
    return _vocab(spark, d)


def q_build_vocabulary_top(spark, d):
    return tokens.build_vocabulary(_texts(spark, d), "text", max_size=CHECK_TOP_TOKENS)


def q_encode_tokens(spark, d):
    ids = tokens.encode_tokens(_texts(spark, d), _vocab(spark, d), max_length=None)
    return ids.select("example_id", F.size("token_ids").alias("n_tokens"), _ids("token_ids").alias("token_ids"))


def q_training_examples(spark, d):
    # as users call it: the vocabulary is built inside, from every token of the conversations
    ex = training_examples(table(spark, d, "conversations"), max_length=CHECK_MAX_LENGTH)
    return ex.select("example_id", "n_tokens", _ids("input_ids").alias("input_ids"),
                     _ids("attention_mask").alias("attention_mask"), _ids("labels").alias("labels"))


def q_plan_batches(spark, d):
    ex = table(spark, d, "conversations").select(F.col("conv_id").alias("example_id")).distinct()
    return batches.plan_batches(ex)


def q_resume_batches(spark, d):
    """Steps 2 to 4 of the second epoch, without the rest of the plan."""
    ex = table(spark, d, "conversations").select(F.col("conv_id").alias("example_id")).distinct()
    return batches.resume_batches(batches.number_examples(ex), epoch=1, first_step=2, steps=3)


def q_resolve_special_ids(spark, d):
    resp = fixtures.raw_responses(spark, d).select(F.col("response").alias("text"))
    vocab = tokens.build_vocabulary(resp, "text")
    r = tokens.resolve_special_ids(vocab)
    return r.select(_ids("eos_ids").alias("eos_ids"), "pad_id")


def q_cut_at_eos(spark, d):
    return fixtures.raw_responses(spark, d).select("doc_id", cut_at_eos("response").alias("text"))


def q_bold_to_ansi(spark, d):
    return fixtures.raw_responses(spark, d).select("doc_id", bold_to_ansi("response").alias("text"))


def q_clean_response(spark, d):
    return fixtures.raw_responses(spark, d).select("doc_id", clean_response("response").alias("text"))


def q_py_strip(spark, d):
    r = fixtures.spaced_texts(spark, d)
    return r.select("doc_id", py_strip("response").alias("text"), F.length(py_strip("response")).cast("long").alias("n_chars"))


def q_append_responses(spark, d):
    convs = _convs(spark, d)
    # one response per conversation, by rule: generation failed (NULL) for every fourth, and every
    # fifth belongs to an earlier turn than the last
    last = table(spark, d, "conversations").groupBy("conv_id").agg((F.count(F.lit(1)) - 1).alias("_last"))
    resp = fixtures.raw_responses(spark, d).join(last, F.col("doc_id") == F.col("conv_id")).select(
        "conv_id", F.when(F.col("doc_id") % 4 != 0, clean_response("response")).alias("response"),
        (F.col("_last") - F.when(F.col("doc_id") % 5 == 0, 1).otherwise(0)).alias("turn"))
    out = sessions.append_responses(convs, resp, turn="turn")
    return out.select("conv_id", F.size("messages").alias("n_messages"), _json("messages").alias("messages"))


def q_conversation_record(spark, d):
    log = _log(spark, d)
    convs = sessions.replay_conversations(log)
    summ = sessions.replay_sessions(log).select("sid", "end_ts")
    rec = sessions.conversation_record(
        convs.join(summ, "sid"), ts="end_ts", saved_at=history_path(F.lit(None).cast("string"), F.col("end_ts")))
    return rec.select("sid", "timestamp", "total_messages", F.col("model_info.saved_at").alias("saved_at"),
                      _json("conversation").alias("conversation"))


def q_history_view(spark, d):
    return sessions.history_view(_convs(spark, d)).select("conv_id", "idx", "line")


def q_classify_command(spark, d):
    return _log(spark, d).select("sid", "seq", classify_command("text").alias("cmd"))


def q_replay_sessions(spark, d):
    return sessions.replay_sessions(_log(spark, d)).select(
        "sid", "total_messages", "ended_by_exit", "first_exit_seq", "last_clear_seq", "n_events")


def q_replay_sessions_stream(spark, d):
    """The events as a stream, run to its end; the last summary of every session."""
    from ..streaming.sessions import latest_summaries, run_replay_stream

    events = f"{d.rstrip('/')}/events.parquet"
    # as a pattern, the path may be one file as well as a directory of files
    stream = spark.readStream.schema(spark.read.parquet(events).schema).parquet(events[:-1] + "[t]")
    run = f"{checkpoint_dir(spark).rstrip('/')}/tables/stream-{uuid.uuid4().hex}"
    q = run_replay_stream(fixtures.as_session_log(stream), f"{run}/out", checkpoint=f"{run}/state")
    q.awaitTermination()
    return latest_summaries(spark.read.parquet(f"{run}/out")).select(
        "sid", "total_messages", "ended_by_exit", "first_exit_seq", "last_clear_seq", "n_events")


def _shuffled_log(spark, d):
    """The session log as a stream in four files, every event up to six hours late (by rule), and a heartbeat."""
    run = f"{checkpoint_dir(spark).rstrip('/')}/streams/{uuid.uuid4().hex}"
    log = fixtures.session_log(spark, d).withColumn("ts", F.col("ts").cast("timestamp")).select("sid", "seq", "ts", "text", "response")
    came = F.unix_seconds("ts") + (F.col("seq") * 7919) % (6 * 3600)
    span = log.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    first, last = span["a"].timestamp(), span["b"].timestamp()
    slot = F.least(F.floor((came - F.lit(int(first))) * 4 / F.lit(int(last - first) + 1)), F.lit(3))
    slotted = log.withColumn("slot", slot)
    for i in range(4):
        slotted.filter(F.col("slot") == i).drop("slot").repartition(2, "seq").write.mode("append").parquet(f"{run}/log")
    beat = log.limit(0).unionByName(spark.createDataFrame([(None, None, span["b"] + datetime.timedelta(days=1), None, None)], log.schema))
    beat.coalesce(1).write.mode("append").parquet(f"{run}/log")
    return spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 2).parquet(f"{run}/log"), run


def _drained(frame, run):
    q = frame.writeStream.format("parquet").option("path", f"{run}/out").option("checkpointLocation", f"{run}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return frame.sparkSession.read.schema(frame.schema).parquet(f"{run}/out")


def q_replay_sessions_ordered(spark, d):
    """Events that come up to six hours late, replayed in order by a stream with a watermark of six hours."""
    from ..streaming.ordered import replay_sessions_ordered
    from ..streaming.sessions import latest_summaries

    stream, run = _shuffled_log(spark, d)
    out = _drained(replay_sessions_ordered(stream, datetime.timedelta(hours=6), datetime.timedelta(days=365)), run)
    return latest_summaries(out)


def q_replay_histories_ordered(spark, d):
    """The history records that the same stream writes: one per save and per exit."""
    from ..streaming.ordered import replay_histories_ordered

    stream, run = _shuffled_log(spark, d)
    out = _drained(replay_histories_ordered(stream, datetime.timedelta(hours=6), datetime.timedelta(days=365)), run)
    said = F.array_join(F.transform("conversation", lambda m: F.concat(m["role"], F.lit(": "), m["content"])), "|")
    return out.select("sid", "seq", "kind", "total_messages", F.md5(said).alias("conversation_md5"))


def q_replay_messages(spark, d):
    return sessions.replay_messages(_log(spark, d))


def q_session_snapshots(spark, d):
    return sessions.session_snapshots(_log(spark, d)).select("sid", "save_seq", "segment", "total_messages")


def q_snapshot_messages(spark, d):
    return sessions.snapshot_messages(_log(spark, d))


def q_snapshot_intervals(spark, d):
    return sessions.snapshot_intervals(_log(spark, d))


def q_final_records(spark, d):
    r = sessions.final_records(_log(spark, d), requested="requested")
    return r.select("sid", F.size("messages").alias("n_messages"), "path")


def q_session_duration(spark, d):
    return sessions.session_duration(_log(spark, d))


def q_history_path(spark, d):
    log = _log(spark, d)
    snaps = sessions.session_snapshots(log).join(log.select("sid", F.col("seq").alias("save_seq"), "requested"),
                                                 ["sid", "save_seq"])
    return snaps.select("sid", "save_seq", history_path("requested", "ts").alias("path"))


def q_history_view_sessions(spark, d):
    return sessions.history_view(sessions.replay_conversations(_log(spark, d)), key="sid").select("sid", "idx", "line")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "read_jsonl_lines": q_read_jsonl_lines,
    "read_chat_jsonl": q_read_chat_jsonl,
    "is_valid_json": q_is_valid_json,
    "classify_lines": q_classify_lines,
    "validation_report": q_validation_report,
    "first_invalid_line": q_first_invalid_line,
    "error_report": q_error_report,
    "encoding_report": q_encoding_report,
    "dataset_statistics": q_dataset_statistics,
    "turn_count_histogram": q_turn_count_histogram,
    "chat_format_report": q_chat_format_report,
    "repair_suggestions": q_repair_suggestions,
    "dataset_readiness": q_dataset_readiness,
    "recommend_config": q_recommend_config,
    "drop_invalid_examples": q_drop_invalid_examples,
    "parse_chat_lines": q_parse_chat_lines,
    "training_examples_from_lines": q_training_examples_from_lines,
    "should_save": q_should_save,
    "fold_messages": q_fold_messages,
    "explode_messages": q_explode_messages,
    "inject_system_prompt": q_inject_system_prompt,
    "resolve_system_prompt": q_resolve_system_prompt,
    "render_chat": q_render_chat,
    "ensure_eos": q_ensure_eos,
    "build_vocabulary": q_build_vocabulary,
    "build_vocabulary_top": q_build_vocabulary_top,
    "encode_tokens": q_encode_tokens,
    "training_examples": q_training_examples,
    "plan_batches": q_plan_batches,
    "resume_batches": q_resume_batches,
    "resolve_special_ids": q_resolve_special_ids,
    "cut_at_eos": q_cut_at_eos,
    "bold_to_ansi": q_bold_to_ansi,
    "clean_response": q_clean_response,
    "py_strip": q_py_strip,
    "append_responses": q_append_responses,
    "conversation_record": q_conversation_record,
    "history_view": q_history_view,
    "history_view_sessions": q_history_view_sessions,
    "classify_command": q_classify_command,
    "replay_sessions": q_replay_sessions,
    "replay_sessions_stream": q_replay_sessions_stream,
    "replay_sessions_ordered": q_replay_sessions_ordered,
    "replay_histories_ordered": q_replay_histories_ordered,
    "replay_messages": q_replay_messages,
    "session_snapshots": q_session_snapshots,
    "snapshot_messages": q_snapshot_messages,
    "snapshot_intervals": q_snapshot_intervals,
    "final_records": q_final_records,
    "session_duration": q_session_duration,
    "history_path": q_history_path,
}


# ------------------------------------------------------------------------------------------
# oracle SQL (DuckDB)
# ------------------------------------------------------------------------------------------

# Fixed values, written out here so that a wrong constant in the library turns a row red.
WS = (r"[\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
      r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
TOKEN_SQL = r"<[^<>\x{9}-\x{D} ]+>|[^<\x{9}-\x{D} ]+|<"
EOS = "<eos>"
SPECIALS_SQL = ["<pad>", "<unk>", "<bos>", "<eos>"]
EOS_SQL = ["<end_of_turn>", "<|im_end|>", "</s>", "<|endoftext|>"]
PLAIN_SQL = {"system": ("", ""), "user": ("\n\nUser: ", ""), "assistant": ("\n\nAssistant: ", "")}
PLAIN_GENERATION_SQL = "\n\nAssistant:"
CHATML_SQL = {r: (f"<|im_start|>{r}\n", "<|im_end|>\n") for r in ("system", "user", "assistant")}
FALLBACK = "あなたは親切で知識豊富なAIアシスタントです。ユーザーの質問に丁寧に答えてください。"
BANDS_SQL = [("small", 0, 1000, 8, 16, 0.1, 1e-4), ("medium", 1000, 10001, 16, 32, 0.05, 5e-5), ("large", 10001, None, 32, 64, 0.05, 2e-5)]
MESSAGES_SQL = {
    "invalid_json": "cannot be parsed as one JSON value", "not_object": "holds a JSON value that is no object",
    "missing_messages": "has no messages key", "messages_not_list": "has a messages value that is no list"}
STRIP = f"'^{WS}+|{WS}+\\z'"
NL2 = "chr(10) || chr(10)"
ESC = "chr(27)"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, {STRIP}, '', 'g')"


FOLD = """conv AS (
  SELECT conv_id, list({'role': role, 'content': text} ORDER BY turn) AS m
  FROM conversations GROUP BY conv_id)"""

CHAT_LINES = FOLD + """,
clean_lines AS (SELECT conv_id, CAST(to_json({'messages': m}) AS VARCHAR) AS l FROM conv),
lines AS (
  SELECT 'conversations.jsonl' AS file,
         row_number() OVER (ORDER BY conv_id) AS line_no,
         CASE conv_id % 10
           WHEN 3 THEN substring(l, 1, length(l) - 1)
           WHEN 5 THEN '{"msgs":' || substring(l, 13)
           WHEN 7 THEN '{"messages":"x"}'
           WHEN 9 THEN l || ' x'
           ELSE CASE conv_id % 20
             WHEN 6 THEN '123'
             WHEN 16 THEN chr(12288) || l
             WHEN 11 THEN '{"messages":[],"a":1,"a":2}'
             WHEN 1 THEN l || chr(133)
             ELSE l END END AS line,
         conv_id
  FROM clean_lines)"""

STATUS = f"""status_lines AS (
  SELECT file, line_no, line, {_strip('line')} AS s FROM lines),
classified AS (
  SELECT file, line_no, line,
    CASE WHEN NOT json_valid(s) THEN 'invalid_json'
         WHEN json_type(s) = 'OBJECT' THEN
           CASE WHEN json_type(s, '$.messages') IS NULL THEN 'missing_messages'
                WHEN json_type(s, '$.messages') = 'ARRAY' THEN 'ok'
                ELSE 'messages_not_list' END
         WHEN json_type(s) = 'ARRAY' THEN
           CASE WHEN list_contains(json_extract_string(s, '$[*]'), 'messages') THEN 'not_object' ELSE 'missing_messages' END
         WHEN json_type(s) = 'VARCHAR' THEN
           CASE WHEN contains(json_extract_string(s, '$'), 'messages') THEN 'not_object' ELSE 'missing_messages' END
         ELSE 'not_object' END AS status
  FROM status_lines)"""


def _render_sql(m: str, roles: dict, gen: str | None = None) -> str:
    def lit(s: str) -> str:
        parts = s.split("\n")
        out = " || chr(10) || ".join("'" + p.replace("'", "''") + "'" for p in parts)
        return f"({out})"

    pre = " ".join(f"WHEN '{r}' THEN {lit(p)}" for r, (p, _) in roles.items())
    suf = " ".join(f"WHEN '{r}' THEN {lit(s)}" for r, (_, s) in roles.items())
    known = ", ".join(f"'{r}'" for r in roles)
    body = (f"array_to_string(list_transform({m}, lambda x: (CASE x.role {pre} END) || x.content || "
            f"(CASE x.role {suf} END)), '')")
    if gen is not None:
        body = f"({body} || {lit(gen)})"
    bad = f"len(list_filter({m}, lambda x: x.role IS NULL OR x.role NOT IN ({known}) OR x.content IS NULL)) > 0"
    return f"(CASE WHEN {m} IS NULL OR {bad} THEN NULL ELSE {body} END)"


RENDER = _render_sql("m", PLAIN_SQL)

TEXTS = FOLD + f""",
rendered AS (SELECT conv_id AS example_id, {RENDER} AS r FROM conv),
texts AS (SELECT example_id,
    CASE WHEN r IS NULL THEN NULL WHEN ends_with(r, '{EOS}') THEN r ELSE r || '{EOS}' END AS text
  FROM rendered)"""

SPECIALS = " UNION ALL ".join(f"SELECT '{t}' AS token, {i}::INTEGER AS token_id" for i, t in enumerate(SPECIALS_SQL))
SPECIAL_LIST = ", ".join(f"'{t}'" for t in SPECIALS_SQL)


def _vocab_sql(texts: str, size: int | None = None) -> str:
    """All tokens of the texts, or the ``size`` most frequent."""
    top = f"LIMIT {size}" if size else ""
    return f"""tok_counts AS (
  SELECT token, count(*) AS n FROM (
    SELECT unnest(regexp_extract_all(text, '{TOKEN_SQL}')) AS token FROM {texts} WHERE text IS NOT NULL)
  WHERE token NOT IN ({SPECIAL_LIST}) GROUP BY token),
top_tokens AS (SELECT token, n FROM tok_counts ORDER BY n DESC, token {top}),
vocab AS (
  {SPECIALS}
  UNION ALL
  SELECT token, (row_number() OVER (ORDER BY n DESC, token) + 3)::INTEGER AS token_id
  FROM top_tokens)"""


def _encode_sql(texts: str, max_len: int | None) -> str:
    cut = f"WHERE pos <= {max_len}" if max_len else ""
    return f"""exploded AS (
  SELECT example_id, token, pos FROM (
    SELECT example_id, unnest(t) AS token, generate_subscripts(t, 1) AS pos
    FROM (SELECT example_id, regexp_extract_all(text, '{TOKEN_SQL}') AS t FROM {texts} WHERE text IS NOT NULL)) {cut}),
encoded AS (
  SELECT e.example_id, list(coalesce(v.token_id, 1) ORDER BY e.pos) AS ids
  FROM exploded e LEFT JOIN vocab v ON e.token = v.token GROUP BY e.example_id)"""


LOG = """log AS (
  SELECT user_id AS sid, event_id AS seq, ts,
    CASE WHEN event_id % 997 = 0 THEN 'exit'
         WHEN event_id % 41 = 0 THEN '終了'
         WHEN event_id % 50 = 0 THEN 'save'
         WHEN event_type = 'signup' THEN 'clear'
         WHEN event_id % 29 = 0 THEN 'History'
         WHEN event_id % 31 = 0 THEN ' '
         WHEN event_id % 37 = 0 THEN 'QUIT '
         ELSE props END AS text,
    CASE WHEN event_type = 'error' THEN NULL
         ELSE '**' || event_type || '** ' || props || '<end_of_turn> trailer' END AS response,
    CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN ''
         WHEN 2 THEN '/abs/' || CAST(user_id AS VARCHAR) || '.json'
         ELSE 'user_' || CAST(user_id AS VARCHAR) || '.json' END AS requested
  FROM events),
cmds AS (
  SELECT *, CASE WHEN lower(text) IN ('exit', 'quit', '終了') THEN 'exit'
                 WHEN lower(text) = 'clear' THEN 'clear'
                 WHEN lower(text) = 'history' THEN 'history'
                 WHEN lower(text) = 'save' THEN 'save'
                 WHEN regexp_matches(text, '^""" + WS + """*\\z') THEN 'blank'
                 ELSE 'message' END AS cmd
  FROM log),
bounds AS (
  SELECT sid, min(seq) FILTER (WHERE cmd = 'exit') AS first_exit_seq, count(*) AS n_events
  FROM cmds GROUP BY sid),
active AS (
  SELECT c.*, b.first_exit_seq FROM cmds c JOIN bounds b USING (sid)
  WHERE b.first_exit_seq IS NULL OR c.seq < b.first_exit_seq),
clears AS (SELECT sid, max(seq) FILTER (WHERE cmd = 'clear') AS last_clear_seq FROM active GROUP BY sid),
final_msgs AS (
  SELECT a.* FROM active a LEFT JOIN clears c USING (sid)
  WHERE a.cmd = 'message' AND a.response IS NOT NULL AND (c.last_clear_seq IS NULL OR a.seq > c.last_clear_seq))"""


def _mix_sql(x: str, key: str) -> str:
    """A number below 2**31 from a number and a key."""
    z = f"((y * 48271 + c + {key}) % 2147483647)"
    return f"list_reduce([1013904223::BIGINT, 374761393, 668265263], lambda y, c: xor({z}, {z} >> 15), {x})"


def _plan_sql(epochs: int) -> str:
    """placed(epoch, example_id, position, n): examples numbered in id order, each number moved by six rounds
    over a rectangle of width * height cells, and again while it is out of range."""
    left, right = "(x // height)", "(x % height)"
    rounds = f"""list_reduce(keys, lambda x, k: CASE WHEN k % 2 = 0
    THEN (({left} + {_mix_sql(right, "(k // 2)")}) % width) * height + {right}
    ELSE {left} * height + ({right} + {_mix_sql(left, "(k // 2)")}) % height END, """
    return f"""WITH ex AS (SELECT DISTINCT conv_id AS example_id FROM conversations),
sized AS (SELECT example_id, row_number() OVER (ORDER BY example_id) - 1 AS number, count(*) OVER () AS n FROM ex),
roots AS (SELECT n, (SELECT min(h) FROM range(1, 100000) r(h) WHERE h * h >= m.n) AS root FROM (SELECT DISTINCT n FROM sized) m),
tall AS (SELECT s.*, (SELECT arg_min(h, ((n + h - 1) // h * h - n) * 10000 + h) FROM range(1, 100000) q(h)
  WHERE h >= root AND h < root + least(root // 8 + 1, 4096)) AS height FROM sized s JOIN roots USING (n)),
wide AS (SELECT *, (n + height - 1) // height AS width FROM tall),
bases AS (SELECT CAST(e AS INTEGER) AS epoch, {_mix_sql(_mix_sql("42::BIGINT", "0") + " + e", "0")} AS base FROM range({epochs}) r(e)),
keyed AS (SELECT epoch, list_transform(range(6), lambda i: {_mix_sql("(base + i)", "0")} * 2 + i % 2) AS keys FROM bases),
first AS (SELECT *, {rounds}number) AS moved FROM wide, keyed),
placed AS (SELECT epoch, example_id, n, CASE WHEN moved < n THEN moved ELSE
  list_reduce(range(width * height - n), lambda v, w: CASE WHEN v < n THEN v ELSE {rounds}v) END, moved) END AS position FROM first)
"""


def _eos_cut_sql(x: str) -> str:
    parts = []
    for e in EOS_SQL:
        parts.append(f"WHEN contains({x}, '{e}') THEN {_strip(f'split_part({x}, {chr(39)}{e}{chr(39)}, 1)')}")
    return f"(CASE {' '.join(parts)} ELSE {x} END)"


def _bold_sql(x: str) -> str:
    return f"regexp_replace({x}, '\\*\\*([^\\n]*?)\\*\\*', {ESC} || '[1m\\1' || {ESC} || '[0m', 'g')"


RESPONSES = """responses AS (
  SELECT doc_id,
    CASE doc_id % 7
      WHEN 1 THEN text || '<end_of_turn> tail'
      WHEN 2 THEN '  ' || text || ' </s> more <|im_end|> x'
      WHEN 3 THEN '**' || lang || '** ' || text
      WHEN 4 THEN text || '<|endoftext|>'
      WHEN 5 THEN '**bold' || chr(10) || 'not** ' || text
      WHEN 6 THEN text || ' **a** and **b**'
      ELSE text END AS response
  FROM documents)"""

SPACED = """responses AS (
  SELECT doc_id,
    CASE doc_id % 6
      WHEN 1 THEN chr(12288) || text || chr(8232)
      WHEN 2 THEN chr(9) || chr(133) || text || chr(28)
      WHEN 3 THEN chr(160) || chr(8287) || text
      WHEN 4 THEN chr(65279) || text || chr(10)
      WHEN 5 THEN ' ' || chr(8195) || chr(5760) || ' '
      ELSE text END AS response
  FROM documents)"""


def _iso(ts: str) -> str:
    return (f"CASE WHEN strftime({ts}, '%f') = '000000' THEN strftime({ts}, '%Y-%m-%dT%H:%M:%S') "
            f"ELSE strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f') END")


def _ids_sql(x: str) -> str:
    return f"array_to_string(list_transform({x}, lambda i: CAST(i AS VARCHAR)), ' ')"


def _pad_sql(ids: str, L: int, pad: int) -> str:
    n = f"len({ids})"
    return (f"array_to_string(list_transform(list_concat({ids}[1:{L}], "
            f"list_transform(range(greatest(0, {L} - {n})), lambda z: {pad})), lambda i: CAST(i AS VARCHAR)), ' ')")


def _mask_sql(ids: str, L: int) -> str:
    n = f"len({ids})"
    return (f"array_to_string(list_concat(list_transform(range(least({n}, {L})), lambda z: '1'), "
            f"list_transform(range(greatest(0, {L} - {n})), lambda z: '0')), ' ')")


def _catalog_sql() -> str:
    rows = " UNION ALL ".join(f"SELECT '{n}' AS name, '{p}' AS prompt" for n, p in PROMPT_CATALOG)
    return f"catalog AS ({rows})"


def _requests_sql() -> str:
    names = ", ".join("NULL" if n is None else f"'{n}'" for n in PROMPT_REQUESTS)
    return (f"requests AS (SELECT conv_id, ([{names}]::VARCHAR[])[conv_id % {len(PROMPT_REQUESTS)} + 1] AS prompt_name "
            f"FROM (SELECT DISTINCT conv_id FROM conversations))")


DIRTY_FOLD = """dturns AS (
  SELECT conv_id, turn,
    CASE WHEN conv_id % 9 = 1 AND turn = 1 THEN 'tool' WHEN conv_id % 9 = 2 AND turn = 2 THEN 'system'
         WHEN conv_id % 9 = 4 AND turn % 2 = 1 THEN 'user' ELSE role END AS role,
    CASE WHEN conv_id % 9 = 3 AND turn = 0 THEN NULL ELSE text END AS text
  FROM conversations),
dconv AS (SELECT conv_id, list({'role': role, 'content': text} ORDER BY turn) AS m FROM dturns GROUP BY conv_id)"""


def _chat_format_sql() -> str:
    return DIRTY_FOLD + """,
g AS (SELECT conv_id, m, CASE WHEN len(m) > 0 AND m[1].role = 'system' THEN 1 ELSE 0 END AS lead FROM dconv),
v AS (SELECT conv_id, list_filter([
    CASE WHEN len(m) = 0 THEN 'empty' END,
    CASE WHEN len(list_filter(m, lambda x: x.role IS NULL OR x.role NOT IN ('system', 'user', 'assistant'))) > 0 THEN 'bad_role' END,
    CASE WHEN len(list_filter(m, lambda x, i: x.role = 'system' AND i > 1)) > 0 THEN 'system_not_first' END,
    CASE WHEN len(list_filter(m, lambda x: x.content IS NULL)) > 0 THEN 'null_content' END,
    CASE WHEN len(list_filter(m, lambda x, i: i - 1 >= lead AND NOT coalesce(x.role = (CASE WHEN (i - 1 - lead) % 2 = 0 THEN 'user' ELSE 'assistant' END), false))) > 0 THEN 'not_alternating' END,
    CASE WHEN len(m) > 0 AND NOT coalesce(m[-1].role = 'assistant', false) THEN 'no_final_assistant' END
  ], lambda c: c IS NOT NULL) AS violations FROM g)"""


def _rules_sql() -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS code, '{s.replace(chr(39), chr(39) * 2)}' AS suggestion" for c, s in validate.REPAIR_RULES)
    return f"rules AS ({rows})"


def _bands_sql() -> str:
    rows = []
    for i, (name, lo, hi, r, a, dr, lr) in enumerate(BANDS_SQL):
        rows.append(f"SELECT '{name}' AS band, {lo} AS lo, {('NULL' if hi is None else hi)} AS hi, {r}::INTEGER AS lora_r, "
                    f"{a}::INTEGER AS lora_alpha, {dr}::DOUBLE AS lora_dropout, {lr}::DOUBLE AS learning_rate")
    return "bands AS (" + " UNION ALL ".join(rows) + ")"


ERRMSG = " ".join(f"WHEN '{k}' THEN '{v.replace(chr(39), chr(39) * 2)}'" for k, v in MESSAGES_SQL.items())


def _snapshots_sql() -> str:
    return LOG + """,
act2 AS (
  SELECT *, sum(CASE WHEN cmd = 'clear' THEN 1 ELSE 0 END) OVER (PARTITION BY sid ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS segment
  FROM active),
act3 AS (
  SELECT *, sum(CASE WHEN cmd = 'message' AND response IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY sid, segment ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS msgs
  FROM act2),
snaps AS (SELECT sid, seq AS save_seq, CAST(segment AS BIGINT) AS segment, CAST(msgs * 2 AS BIGINT) AS total_messages, ts, requested
  FROM act3 WHERE cmd = 'save')"""


def _replay_conv_sql() -> str:
    return LOG + f""",
msg_rows AS (
  SELECT sid, seq, 0 AS part, 'user' AS role, text AS content FROM final_msgs
  UNION ALL
  SELECT sid, seq, 1 AS part, 'assistant' AS role, {_bold_sql(_eos_cut_sql(_strip('response')))} AS content FROM final_msgs),
folded AS (SELECT sid, list({{'role': role, 'content': content}} ORDER BY seq, part) AS m FROM msg_rows GROUP BY sid),
rconv AS (
  SELECT s.sid, list_concat([{{'role': 'system', 'content': '{FALLBACK}'}}], coalesce(f.m, [])) AS m
  FROM (SELECT DISTINCT sid FROM log) s LEFT JOIN folded f USING (sid)),
summary AS (
  SELECT c.sid, max(c.ts) FILTER (WHERE b.first_exit_seq IS NULL OR c.seq <= b.first_exit_seq) AS end_ts, min(c.ts) AS start_ts
  FROM cmds c JOIN bounds b USING (sid) GROUP BY c.sid)"""


def _history_view_sql(src: str, key: str) -> str:
    return f"""hv AS (
  SELECT {key}, generate_subscripts(t, 1) AS idx, unnest(t) AS x FROM (SELECT {key}, m[2:] AS t FROM {src})),
hv2 AS (SELECT {key}, idx,
    CASE WHEN x.role = 'user' THEN 'User' ELSE 'Assistant' END AS lab,
    CASE WHEN length(x.content) > 100 THEN substring(x.content, 1, 100) || '...' ELSE x.content END AS c FROM hv)
SELECT {key}, CAST(idx AS INTEGER) AS idx, CAST(idx AS VARCHAR) || '. ' || lab || ': ' || c AS line FROM hv2"""


ORACLE_SQL: dict[str, str] = {
    "read_jsonl_lines": "WITH " + CHAT_LINES + """
SELECT line_no, line FROM lines""",
    "read_chat_jsonl": "WITH " + CHAT_LINES + ", " + STATUS + """,
okc AS (SELECT CAST(json_extract(s, '$.messages') AS STRUCT(role VARCHAR, content VARCHAR)[]) AS m FROM classified JOIN status_lines USING (file, line_no) WHERE status = 'ok')
SELECT CAST(len(m) AS INTEGER) AS n_messages, CAST(to_json(m) AS VARCHAR) AS messages FROM okc""",
    "is_valid_json": "WITH " + CHAT_LINES + """
SELECT file, line_no, json_valid(line) AS valid FROM lines""",
    "classify_lines": "WITH " + CHAT_LINES + ", " + STATUS + """
SELECT file, line_no, status FROM classified""",
    "validation_report": "WITH " + CHAT_LINES + ", " + STATUS + """,
agg AS (SELECT file, count(*) AS line_count,
    count(*) FILTER (WHERE status <> 'ok') AS error_count,
    count(*) FILTER (WHERE status = 'invalid_json') AS invalid_json,
    count(*) FILTER (WHERE status = 'not_object') AS not_object,
    count(*) FILTER (WHERE status = 'missing_messages') AS missing_messages,
    count(*) FILTER (WHERE status = 'messages_not_list') AS messages_not_list,
    CAST(0 AS BIGINT) AS invalid_utf8
  FROM classified GROUP BY file)
SELECT *, round(error_count / line_count, 6) AS error_rate,
  NOT (error_count > line_count * CAST(0.1 AS DOUBLE)) AND invalid_utf8 = 0 AS passed FROM agg""",
    "first_invalid_line": "WITH " + CHAT_LINES + f"""
SELECT file, coalesce(min(line_no) FILTER (WHERE NOT json_valid(line)), count(*)) AS lines_checked,
  min(line_no) FILTER (WHERE NOT json_valid(line)) AS first_bad_line,
  arg_min({_strip('line')}, line_no) FILTER (WHERE NOT json_valid(line)) AS first_bad_content
FROM lines GROUP BY file""",
    "error_report": "WITH " + CHAT_LINES + ", " + STATUS + f"""
SELECT file, line_no, status, 'Line ' || CAST(line_no AS VARCHAR) || ' ' || (CASE status {ERRMSG} END) AS message, line
FROM classified WHERE status <> 'ok'""",
    "encoding_report": "WITH " + CHAT_LINES + """
SELECT file, count(*) AS line_count, count(*) FILTER (WHERE conv_id % 6 = 1) AS invalid_utf8_lines,
  count(*) FILTER (WHERE conv_id % 6 = 1) = 0 AS passed FROM lines GROUP BY file""",
    "dataset_statistics": """
SELECT role, count(*) AS n_messages, count(DISTINCT conv_id) AS n_conversations,
  CAST(sum(length(text)) AS BIGINT) AS total_chars, round(avg(length(text)), 6) AS avg_chars,
  CAST(min(length(text)) AS BIGINT) AS min_chars, CAST(max(length(text)) AS BIGINT) AS max_chars
FROM conversations GROUP BY role""",
    "turn_count_histogram": """
SELECT n_turns, count(*) AS n_conversations FROM (SELECT conv_id, count(*) AS n_turns FROM conversations GROUP BY conv_id)
GROUP BY n_turns""",
    "chat_format_report": "WITH " + _chat_format_sql() + """
SELECT conv_id, array_to_string(violations, ',') AS violations, CAST(len(violations) AS INTEGER) AS n_violations,
  len(violations) = 0 AS is_valid FROM v""",
    "repair_suggestions": "WITH " + CHAT_LINES + ", " + STATUS + ", " + _chat_format_sql()
    + ", " + _rules_sql() + """,
errs AS (
  SELECT 'line' AS source, line_no AS item, status AS code FROM classified WHERE status <> 'ok'
  UNION ALL
  SELECT 'conversation' AS source, conv_id AS item, unnest(violations) AS code FROM v)
SELECT e.source, e.item, e.code, r.suggestion FROM errs e LEFT JOIN rules r ON e.code = r.code""",
    "dataset_readiness": """
SELECT d.lang, count(*) AS n_examples, count(l.quality) AS n_labeled, round(avg(l.quality), 6) AS avg_quality,
  CASE WHEN count(*) >= 400 THEN 'ready' WHEN count(*) >= 200 THEN 'ready_if_high_quality' ELSE 'too_small' END AS readiness
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.lang""",
    "recommend_config": "WITH " + _bands_sql() + """,
counts AS (SELECT lang, CAST(n * k AS BIGINT) AS n_examples FROM (SELECT lang, count(*) AS n FROM documents GROUP BY lang), (VALUES (1), (10), (100)) f(k))
SELECT c.lang, c.n_examples, b.band, b.lora_r, b.lora_alpha, b.lora_dropout, b.learning_rate
FROM counts c LEFT JOIN bands b ON c.n_examples >= b.lo AND (b.hi IS NULL OR c.n_examples < b.hi)""",
    "parse_chat_lines": "WITH " + CHAT_LINES + ", " + STATUS + """,
okc AS (SELECT file, line_no, CAST(json_extract(s, '$.messages') AS STRUCT(role VARCHAR, content VARCHAR)[]) AS m FROM classified JOIN status_lines USING (file, line_no) WHERE status = 'ok')
SELECT file, line_no, CAST(len(m) AS INTEGER) AS n_messages, CAST(to_json(m) AS VARCHAR) AS messages FROM okc""",
    "training_examples_from_lines": "WITH " + CHAT_LINES + ", " + STATUS + f""",
okc AS (SELECT file, line_no, CAST(json_extract(s, '$.messages') AS STRUCT(role VARCHAR, content VARCHAR)[]) AS m FROM classified JOIN status_lines USING (file, line_no) WHERE status = 'ok'),
rendered2 AS (SELECT line_no AS example_id, {RENDER} AS r FROM okc),
texts2 AS (SELECT example_id, CASE WHEN r IS NULL THEN NULL WHEN ends_with(r, '{EOS}') THEN r ELSE r || '{EOS}' END AS text FROM rendered2),
{_vocab_sql('texts2')},
{_encode_sql('texts2', CHECK_MAX_LENGTH)}
SELECT 'conversations.jsonl' AS file, example_id AS line_no, CAST(len(ids) AS INTEGER) AS n_tokens,
  {_pad_sql('ids', CHECK_MAX_LENGTH, 0)} AS input_ids,
  {_mask_sql('ids', CHECK_MAX_LENGTH)} AS attention_mask,
  {_pad_sql('ids', CHECK_MAX_LENGTH, 0)} AS labels
FROM encoded WHERE len(ids) > 0""",
    "drop_invalid_examples": "WITH " + TEXTS + ", " + _vocab_sql("texts") + f""",
gaps AS (SELECT example_id, CASE WHEN example_id % 7 = 0 THEN '' WHEN example_id % 11 = 0 THEN NULL ELSE text END AS text FROM texts),
{_encode_sql('gaps', CHECK_MAX_LENGTH)}
SELECT example_id, CAST(len(ids) AS INTEGER) AS n_tokens FROM encoded WHERE len(ids) > 0""",
    "should_save": "WITH " + _replay_conv_sql() + """
SELECT sid, CAST(len(m) AS INTEGER) AS n_messages FROM rconv WHERE len(m) > 1""",
    "fold_messages": "WITH " + FOLD + """
SELECT conv_id, CAST(len(m) AS INTEGER) AS n_messages, CAST(to_json(m) AS VARCHAR) AS messages FROM conv""",
    "explode_messages": """
SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS pos, role, text AS content
FROM conversations""",
    "inject_system_prompt": "WITH " + FOLD + f"""
SELECT conv_id, CAST(to_json(CASE WHEN len(m) > 0 AND m[1].role = 'system' THEN m
  ELSE list_concat([{{'role': 'system', 'content': '{FALLBACK}'}}], m) END) AS VARCHAR) AS messages FROM conv""",
    "resolve_system_prompt": "WITH " + _catalog_sql() + ", " + _requests_sql() + """
SELECT r.conv_id, r.prompt_name,
  coalesce(c.prompt, (SELECT prompt FROM catalog WHERE name = 'default'), '""" + FALLBACK + """') AS system_prompt
FROM requests r LEFT JOIN catalog c ON r.prompt_name = c.name""",
    "render_chat": "WITH " + FOLD + f"""
SELECT conv_id, {RENDER} AS text, {_render_sql('m', PLAIN_SQL, PLAIN_GENERATION_SQL)} AS prompt,
  {_render_sql('m', CHATML_SQL)} AS chatml FROM conv""",
    "ensure_eos": "WITH " + FOLD + f""",
r0 AS (SELECT conv_id, {RENDER} AS r FROM conv),
r AS (SELECT conv_id, CASE WHEN conv_id % 5 = 0 THEN r || '{EOS}' ELSE r END AS r FROM r0)
SELECT conv_id, CASE WHEN ends_with(r, '{EOS}') THEN r ELSE r || '{EOS}' END AS text FROM r""",
    "build_vocabulary": "WITH " + TEXTS + ", " + _vocab_sql("texts") + """
SELECT token, token_id FROM vocab""",
    "build_vocabulary_top": "WITH " + TEXTS + ", " + _vocab_sql("texts", CHECK_TOP_TOKENS) + """
SELECT token, token_id FROM vocab""",
    "encode_tokens": "WITH " + TEXTS + ", " + _vocab_sql("texts") + ", " + _encode_sql("texts", None) + f"""
SELECT example_id, CAST(len(ids) AS INTEGER) AS n_tokens, {_ids_sql('ids')} AS token_ids FROM encoded""",
    "training_examples": "WITH " + TEXTS + ", " + _vocab_sql("texts") + ", "
    + _encode_sql("texts", CHECK_MAX_LENGTH) + f"""
SELECT example_id, CAST(len(ids) AS INTEGER) AS n_tokens,
  {_pad_sql('ids', CHECK_MAX_LENGTH, 0)} AS input_ids,
  {_mask_sql('ids', CHECK_MAX_LENGTH)} AS attention_mask,
  {_pad_sql('ids', CHECK_MAX_LENGTH, 0)} AS labels
FROM encoded WHERE len(ids) > 0""",
    "plan_batches": _plan_sql(3) + """SELECT epoch, example_id, position, position // 2 AS batch, position // 16 AS step
FROM placed WHERE position // 2 < n // 2""",
    "resume_batches": _plan_sql(2) + """SELECT epoch, example_id, position, position // 2 AS batch, position // 16 AS step
FROM placed WHERE position // 2 < n // 2 AND epoch = 1 AND position // 16 BETWEEN 2 AND 4""",
    "resolve_special_ids": "WITH " + RESPONSES + ", rtexts AS (SELECT response AS text FROM responses), "
    + _vocab_sql("rtexts") + """,
cands AS (SELECT * FROM (VALUES (0, '<eos>'), (1, '<end_of_turn>'), (2, '<|im_end|>'), (3, '</s>'), (4, '<|endoftext|>')) t(pos, token)),
hits AS (SELECT v.token_id, min(c.pos) AS pos FROM cands c JOIN vocab v USING (token) WHERE v.token_id <> 1 GROUP BY v.token_id),
eos AS (SELECT list(token_id ORDER BY pos) AS ids FROM hits)
SELECT array_to_string(list_transform(ids, lambda i: CAST(i AS VARCHAR)), ' ') AS eos_ids,
  CAST(coalesce((SELECT min(token_id) FROM vocab WHERE token = '<pad>'), ids[1]) AS INTEGER) AS pad_id FROM eos""",
    "cut_at_eos": "WITH " + RESPONSES + f"""
SELECT doc_id, {_eos_cut_sql('response')} AS text FROM responses""",
    "bold_to_ansi": "WITH " + RESPONSES + f"""
SELECT doc_id, {_bold_sql('response')} AS text FROM responses""",
    "clean_response": "WITH " + RESPONSES + f"""
SELECT doc_id, {_bold_sql(_eos_cut_sql('response'))} AS text FROM responses""",
    "py_strip": "WITH " + SPACED + f"""
SELECT doc_id, {_strip('response')} AS text, CAST(length({_strip('response')}) AS BIGINT) AS n_chars FROM responses""",
    "append_responses": "WITH " + FOLD + ", " + RESPONSES + f""",
resp AS (SELECT c.conv_id, CASE WHEN doc_id % 4 <> 0 THEN {_bold_sql(_eos_cut_sql('response'))} END AS response,
    len(c.m) - 1 - CASE WHEN doc_id % 5 = 0 THEN 1 ELSE 0 END AS turn FROM responses JOIN conv c ON doc_id = c.conv_id),
out AS (SELECT p.conv_id, CASE
    WHEN p.m[len(p.m)].role <> 'user' THEN p.m
    WHEN r.response IS NOT NULL THEN list_concat(p.m, [{{'role': 'assistant', 'content': r.response}}])
    ELSE p.m[1:len(p.m) - 1] END AS m
  FROM conv p LEFT JOIN resp r ON p.conv_id = r.conv_id AND r.turn = len(p.m) - 1)
SELECT conv_id, CAST(len(m) AS INTEGER) AS n_messages, CAST(to_json(m) AS VARCHAR) AS messages FROM out""",
    "conversation_record": "WITH " + _replay_conv_sql() + f"""
SELECT r.sid, {_iso('s.end_ts')} AS timestamp,
  CAST(len(list_filter(r.m, lambda x: NOT coalesce(x.role = 'system', false))) AS INTEGER) AS total_messages,
  'history/chat_' || strftime(s.end_ts, '%Y%m%d_%H%M%S') || '.json' AS saved_at, CAST(to_json(r.m) AS VARCHAR) AS conversation
FROM rconv r JOIN summary s USING (sid)""",
    "history_view": "WITH " + FOLD + ", " + _history_view_sql("conv", "conv_id"),
    "history_view_sessions": "WITH " + _replay_conv_sql() + ", " + _history_view_sql("rconv", "sid"),
    "classify_command": "WITH " + LOG + """
SELECT sid, seq, cmd FROM cmds""",
    "replay_sessions": "WITH " + LOG + """
SELECT b.sid, CAST(2 * (SELECT count(*) FROM final_msgs f WHERE f.sid = b.sid) AS BIGINT) AS total_messages,
  b.first_exit_seq IS NOT NULL AS ended_by_exit, b.first_exit_seq, c.last_clear_seq, b.n_events
FROM bounds b LEFT JOIN clears c USING (sid)""",
    "replay_sessions_stream": "WITH " + LOG + """
SELECT b.sid, CAST(2 * (SELECT count(*) FROM final_msgs f WHERE f.sid = b.sid) AS BIGINT) AS total_messages,
  b.first_exit_seq IS NOT NULL AS ended_by_exit, b.first_exit_seq, c.last_clear_seq, b.n_events
FROM bounds b LEFT JOIN clears c USING (sid)""",
    "replay_sessions_ordered": "WITH " + LOG + """
SELECT b.sid, CAST(2 * (SELECT count(*) FROM final_msgs f WHERE f.sid = b.sid) AS BIGINT) AS total_messages,
  b.first_exit_seq IS NOT NULL AS ended_by_exit, b.first_exit_seq, c.last_clear_seq, b.n_events, CAST(0 AS BIGINT) AS n_late
FROM bounds b LEFT JOIN clears c USING (sid)""",
    "replay_histories_ordered": "WITH " + _snapshots_sql() + f""",
points AS (
  SELECT sid, save_seq AS seq, 'save' AS kind, segment FROM snaps
  UNION ALL
  SELECT sid, first_exit_seq, 'exit', (SELECT count(*) FROM active a WHERE a.sid = b.sid AND a.cmd = 'clear') FROM bounds b WHERE first_exit_seq IS NOT NULL),
told AS (
  SELECT p.sid, p.seq, p.kind, CAST(2 * count(a.seq) AS INTEGER) AS total_messages,
    string_agg('|user: ' || a.text || '|assistant: ' || {_bold_sql(_eos_cut_sql(_strip('a.response')))}, '' ORDER BY a.seq) AS said
  FROM points p LEFT JOIN act2 a ON a.sid = p.sid AND a.segment = p.segment AND a.seq < p.seq AND a.cmd = 'message' AND a.response IS NOT NULL
  GROUP BY p.sid, p.seq, p.kind)
SELECT sid, seq, kind, total_messages, md5('system: {FALLBACK}' || coalesce(said, '')) AS conversation_md5 FROM told""",
    "replay_messages": "WITH " + LOG + f"""
SELECT sid, seq, 0 AS part, 'user' AS role, text AS content FROM final_msgs
UNION ALL
SELECT sid, seq, 1 AS part, 'assistant' AS role, {_bold_sql(_eos_cut_sql(_strip('response')))} AS content FROM final_msgs""",
    "session_snapshots": "WITH " + _snapshots_sql() + """
SELECT sid, save_seq, segment, total_messages FROM snaps""",
    "snapshot_messages": "WITH " + _snapshots_sql() + f""",
held AS (SELECT s.sid, s.save_seq, a.seq, a.text, a.response FROM snaps s JOIN act2 a ON a.sid = s.sid AND a.segment = s.segment
  AND a.seq < s.save_seq WHERE a.cmd = 'message' AND a.response IS NOT NULL)
SELECT sid, save_seq, seq, 0 AS part, 'user' AS role, text AS content FROM held
UNION ALL
SELECT sid, save_seq, seq, 1 AS part, 'assistant' AS role, {_bold_sql(_eos_cut_sql(_strip('response')))} AS content FROM held""",
    "snapshot_intervals": "WITH " + _snapshots_sql() + f""",
numbered AS (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY save_seq) AS no FROM snaps),
held AS (SELECT a.sid, a.segment, a.seq, a.text, a.response, min(s.no) AS first_save, max(s.no) AS last_save, count(*) AS n_saves
  FROM act2 a JOIN numbered s ON a.sid = s.sid AND a.segment = s.segment AND a.seq < s.save_seq
  WHERE a.cmd = 'message' AND a.response IS NOT NULL GROUP BY ALL)
SELECT sid, CAST(segment AS BIGINT) AS segment, seq, 0 AS part, 'user' AS role, text AS content, first_save, last_save, n_saves FROM held
UNION ALL
SELECT sid, CAST(segment AS BIGINT) AS segment, seq, 1 AS part, 'assistant' AS role, {_bold_sql(_eos_cut_sql(_strip('response')))} AS content,
  first_save, last_save, n_saves FROM held""",
    "final_records": "WITH " + _replay_conv_sql() + """,
asked AS (SELECT sid, arg_min_null(requested, seq) AS requested FROM log GROUP BY sid)
SELECT r.sid, CAST(len(r.m) AS INTEGER) AS n_messages,
  CASE WHEN a.requested IS NULL OR a.requested = '' THEN 'history/chat_' || strftime(s.end_ts, '%Y%m%d_%H%M%S') || '.json'
       WHEN starts_with(a.requested, '/') THEN a.requested ELSE 'history/' || a.requested END AS path
FROM rconv r JOIN summary s USING (sid) JOIN asked a USING (sid) WHERE len(r.m) > 1 OR coalesce(a.requested, '') <> ''""",
    "session_duration": "WITH " + LOG + """,
ends AS (SELECT c.sid, min(c.ts) AS t0, max(c.ts) FILTER (WHERE b.first_exit_seq IS NULL OR c.seq <= b.first_exit_seq) AS t1
  FROM cmds c JOIN bounds b USING (sid) GROUP BY c.sid)
SELECT sid, date_diff('microsecond', t0, t1) / 1e6 AS session_duration FROM ends""",
    "history_path": "WITH " + _snapshots_sql() + """
SELECT sid, save_seq,
  CASE WHEN requested IS NULL OR requested = '' THEN 'history/chat_' || strftime(ts, '%Y%m%d_%H%M%S') || '.json'
       WHEN starts_with(requested, '/') THEN requested
       ELSE 'history/' || requested END AS path
FROM snaps""",
}


# ------------------------------------------------------------------------------------------
# run registry
# ------------------------------------------------------------------------------------------

def q_valid_adapters(spark, d):
    return registry.valid_adapters(fixtures.artifact_listing(spark, d))


def q_missing_artifacts(spark, d):
    return registry.missing_artifacts(fixtures.artifact_listing(spark, d))


def q_resolve_artifact_source(spark, d):
    r = registry.resolve_artifact_source(fixtures.artifact_listing(spark, d), fixtures.merge_requests(spark, d),
                                         fixtures.model_configs(spark, d))
    return r.select("out_dir", "base_model", "adapter_dir", "source_dir", "source")


def q_run_lineage(spark, d):
    r = registry.run_lineage(fixtures.merge_manifests(spark, d), fixtures.training_manifests(spark, d))
    return r.select("dir", "base_model", "lora_adapter", F.col("training_info").isNotNull().alias("has_training"),
                    F.col("training_info.model_name").alias("training_model_name"),
                    F.col("training_info.epochs").alias("training_epochs"),
                    F.col("training_info.total_examples").alias("training_total_examples"))


def q_adapter_config_scan(spark, d):
    return registry.adapter_config_scan(fixtures.adapter_configs(spark, d))


def _model_links(spark, d):
    return registry.model_links(fixtures.merge_manifests(spark, d), fixtures.model_configs(spark, d))


def q_model_lineage(spark, d):
    return registry.model_lineage(_model_links(spark, d))


def q_resolve_artifact_chain(spark, d):
    return registry.resolve_artifact_chain(fixtures.artifact_listing(spark, d), _model_links(spark, d))


QUERIES.update({
    "model_lineage": q_model_lineage,
    "resolve_artifact_chain": q_resolve_artifact_chain,
    "valid_adapters": q_valid_adapters,
    "missing_artifacts": q_missing_artifacts,
    "resolve_artifact_source": q_resolve_artifact_source,
    "run_lineage": q_run_lineage,
    "adapter_config_scan": q_adapter_config_scan,
})

_FILES = ", ".join(f"'{f}'" for f in fixtures.ARTIFACT_FILES)
LISTING = f"""listing AS (
  SELECT 'runs/r' || CAST(p_partkey // 7 AS VARCHAR) AS dir, ([{_FILES}])[p_partkey % 9 + 1] AS file,
    CAST(p_size AS BIGINT) * 1000 + p_partkey AS length, p_partkey, p_size, p_retailprice, p_brand
  FROM part)"""
_RUN = "'runs/r' || CAST(p_partkey // 7 {} AS VARCHAR)"
# every chain walked one link at a time, from each directory, until it stops or meets itself
_WALK = "WITH RECURSIVE " + LISTING + f""",
made AS (SELECT dir AS node, 0 AS prio, {_RUN.format('+ 2')} AS nxt FROM listing WHERE file = 'config.json' AND p_size % 2 = 0
  UNION ALL SELECT dir, 1, {_RUN.format('- 1')} FROM listing WHERE file = 'merge_info.json'),
known AS (SELECT DISTINCT dir AS node FROM listing WHERE file IN ('config.json', 'merge_info.json')),
links AS (SELECT node, (SELECT arg_min(nxt, (prio, nxt)) FROM made m WHERE m.node = k.node) AS nxt FROM known k),
"""

ORACLE_SQL.update({
    "model_lineage": _WALK + """walk AS (SELECT node AS dir, node AS here, CAST(0 AS BIGINT) AS depth, [node] AS seen FROM links
  UNION ALL SELECT w.dir, l.nxt, w.depth + 1, list_append(w.seen, l.nxt) FROM walk w JOIN links l ON l.node = w.here
  WHERE l.nxt IS NOT NULL AND NOT list_contains(w.seen, l.nxt))
SELECT w.dir, CASE WHEN l.nxt IS NULL THEN w.here END AS root, CASE WHEN l.nxt IS NULL THEN w.depth END AS depth, l.nxt IS NOT NULL AS cyclic
FROM (SELECT *, row_number() OVER (PARTITION BY dir ORDER BY depth DESC) AS nth FROM walk) w LEFT JOIN links l ON l.node = w.here WHERE nth = 1""",
    "resolve_artifact_chain": _WALK + """holders AS (SELECT DISTINCT dir AS node FROM listing WHERE file = 'tokenizer.model'),
walk AS (SELECT node AS dir, node AS here, CAST(0 AS BIGINT) AS hops, [node] AS seen FROM links
  UNION ALL SELECT w.dir, l.nxt, w.hops + 1, list_append(w.seen, l.nxt) FROM walk w JOIN links l ON l.node = w.here
  WHERE l.nxt IS NOT NULL AND NOT list_contains(w.seen, l.nxt)),
hit AS (SELECT dir, min(hops) AS hops, arg_min(here, hops) AS source_dir FROM walk WHERE here IN (SELECT node FROM holders) GROUP BY dir)
SELECT links.node AS dir, source_dir, hops FROM links LEFT JOIN hit ON hit.dir = links.node""",
    "valid_adapters": "WITH " + LISTING + """
SELECT dir, bool_or(file = 'adapter_config.json') AS is_adapter,
  CASE WHEN bool_or(file = 'config.json') THEN 'local' ELSE 'hub' END AS model_source,
  count(*) AS n_files, CAST(sum(length) AS BIGINT) AS total_bytes
FROM listing GROUP BY dir""",
    "missing_artifacts": "WITH " + LISTING + """
SELECT d.dir, 'tokenizer.model' AS file FROM (SELECT DISTINCT dir FROM listing) d
WHERE NOT EXISTS (SELECT 1 FROM listing l WHERE l.dir = d.dir AND l.file = 'tokenizer.model')""",
    "resolve_artifact_source": "WITH " + LISTING + f""",
reqs AS (SELECT dir AS out_dir, {_RUN.format('+ 1')} AS base_model, {_RUN.format('- 1')} AS adapter_dir
  FROM listing WHERE file = 'merge_info.json'),
cfgs AS (SELECT dir, CASE WHEN p_size % 2 = 0 THEN '{{"_name_or_path": "' || {_RUN.format('+ 2')} || '", "model_type": "gemma3"}}'
    ELSE '{{"model_type": "gemma3"}}' END AS content FROM listing WHERE file = 'config.json'),
r2 AS (SELECT r.*, coalesce(json_extract_string(c.content, '$._name_or_path'), r.base_model) AS origin
  FROM reqs r LEFT JOIN cfgs c ON c.dir = r.base_model),
cands AS (SELECT out_dir, 0 AS prio, out_dir AS d FROM r2 UNION ALL SELECT out_dir, 1, origin FROM r2
  UNION ALL SELECT out_dir, 2, adapter_dir FROM r2),
best AS (SELECT out_dir, min(prio) AS prio, arg_min(d, prio) AS source_dir FROM cands
  WHERE d IN (SELECT dir FROM listing WHERE file = 'tokenizer.model') GROUP BY out_dir)
SELECT r.out_dir, r.base_model, r.adapter_dir, b.source_dir,
  CASE b.prio WHEN 0 THEN 'own' WHEN 1 THEN 'base_model' WHEN 2 THEN 'adapter' END AS source
FROM reqs r LEFT JOIN best b USING (out_dir)""",
    "run_lineage": "WITH " + LISTING + f""",
merges AS (SELECT dir, 'base/' || lower(replace(p_brand, '#', '')) AS base_model, {_RUN.format('- 1')} AS lora_adapter
  FROM listing WHERE file = 'merge_info.json'),
trains AS (SELECT dir, 'base/' || lower(replace(p_brand, '#', '')) AS model_name,
    CAST(p_size % 5 + 1 AS INTEGER) AS epochs, p_partkey AS total_examples
  FROM listing WHERE file = 'training_info.json')
SELECT m.dir, m.base_model, m.lora_adapter, t.dir IS NOT NULL AS has_training, t.model_name AS training_model_name,
  t.epochs AS training_epochs, t.total_examples AS training_total_examples
FROM merges m LEFT JOIN trains t ON t.dir = m.lora_adapter""",
    "adapter_config_scan": "WITH " + LISTING + f""",
cfg AS (SELECT dir, CAST(8 * (p_size % 4 + 1) AS INTEGER) AS r, p_size FROM listing WHERE file = 'adapter_config.json'),
x AS (SELECT dir, r, CAST(2 * r AS INTEGER) AS alpha, list_transform(range(1, p_size % 7 + 1), lambda i: 'module_' || CAST(i AS VARCHAR)) AS mods FROM cfg)
SELECT dir, r, alpha, alpha / r AS scale,
  unnest(CASE WHEN len(mods) = 0 THEN [NULL]::VARCHAR[] ELSE mods END) AS module FROM x""",
})


# ------------------------------------------------------------------------------------------
# per-example Python hook
# ------------------------------------------------------------------------------------------

PY_TOKEN_PATTERN = r"<[^<>\t\n\x0b\x0c\r ]+>|[^<\t\n\x0b\x0c\r ]+|<"  # the token pattern in Python syntax
ASSISTANT_MARK = "\n\nAssistant: "


def python_token_stats(example: dict) -> dict:
    """Example user function: token count and first token by Python's ``re``; an example
    without an assistant turn is refused (raises) and therefore dropped."""
    import re

    text = example["text"]
    if ASSISTANT_MARK not in text:
        raise ValueError("example has no assistant message")
    toks = re.findall(PY_TOKEN_PATTERN, text)
    return {"n_tokens": len(toks), "first_token": toks[0] if toks else None}


def q_map_examples(spark, d):
    from ..operators.udf import map_examples

    return map_examples(_texts(spark, d), python_token_stats, "n_tokens int, first_token string",
                        keep=["example_id"]).drop("error")


QUERIES["map_examples"] = q_map_examples
ORACLE_SQL["map_examples"] = "WITH " + TEXTS + f"""
SELECT example_id, CAST(len(regexp_extract_all(text, '{TOKEN_SQL}')) AS INTEGER) AS n_tokens,
  regexp_extract_all(text, '{TOKEN_SQL}')[1] AS first_token
FROM texts WHERE contains(text, chr(10) || chr(10) || 'Assistant: ')"""


def q_chat_format_report_turns(spark, d):
    r = validate.chat_format_report_turns(fixtures.dirty_turns(spark, d))
    return r.select("conv_id", F.array_join("violations", ",").alias("violations"), "n_violations", "is_valid")


QUERIES["chat_format_report_turns"] = q_chat_format_report_turns
ORACLE_SQL["chat_format_report_turns"] = ORACLE_SQL["chat_format_report"]


def q_history_records(spark, d):
    from .runs import history_records

    r = history_records(_log(spark, d))
    return r.select("sid", F.col("record.timestamp").alias("timestamp"),
                    F.col("record.total_messages").alias("total_messages"),
                    F.col("record.model_info.saved_at").alias("saved_at"),
                    F.col("record.model_info.session_duration").alias("session_duration"),
                    _json("record.conversation").alias("conversation"))


QUERIES["history_records"] = q_history_records
ORACLE_SQL["history_records"] = "WITH " + _replay_conv_sql() + f"""
SELECT r.sid, {_iso('s.end_ts')} AS timestamp,
  CAST(len(list_filter(r.m, lambda x: NOT coalesce(x.role = 'system', false))) AS INTEGER) AS total_messages,
  'history/chat_' || strftime(s.end_ts, '%Y%m%d_%H%M%S') || '.json' AS saved_at,
  date_diff('microsecond', s.start_ts, s.end_ts) / 1e6 AS session_duration,
  CAST(to_json(r.m) AS VARCHAR) AS conversation
FROM rconv r JOIN summary s USING (sid) WHERE len(r.m) > 1"""


# C9 on its own, with a length that cuts most conversations; C10 on whole texts
CUT_CHECK_LENGTH = 128


def q_truncate_and_pad(spark, d):
    ids = tokens.encode_tokens(_texts(spark, d), _vocab(spark, d))
    x = tokens.truncate_and_pad(ids, "token_ids", CUT_CHECK_LENGTH)
    return x.select("example_id", _ids("input_ids").alias("input_ids"), _ids("attention_mask").alias("attention_mask"))


def q_causal_labels(spark, d):
    x = tokens.causal_labels(tokens.encode_tokens(_texts(spark, d), _vocab(spark, d)), "token_ids")
    return x.select("example_id", _ids("labels").alias("labels"))


QUERIES["truncate_and_pad"] = q_truncate_and_pad
QUERIES["causal_labels"] = q_causal_labels
_ENCODED = "WITH " + TEXTS + ", " + _vocab_sql("texts") + ", " + _encode_sql("texts", None)
ORACLE_SQL["truncate_and_pad"] = _ENCODED + f"""
SELECT example_id, {_pad_sql('ids', CUT_CHECK_LENGTH, 0)} AS input_ids,
  {_mask_sql('ids', CUT_CHECK_LENGTH)} AS attention_mask FROM encoded"""
ORACLE_SQL["causal_labels"] = _ENCODED + f"""
SELECT example_id, {_ids_sql('ids')} AS labels FROM encoded"""
