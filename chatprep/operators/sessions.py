"""Chat sessions as event logs: replay to the final conversation, snapshots at each save,
responses appended to conversations, history records and the history listing.

A session log has one row per line typed into the chat loop: ``(sid, seq, ts, text, response)``;
``seq`` orders a session's events, ``response`` is the model's raw answer (NULL = generation
failed). The loop's rules: exit/quit/終了 end the session, clear resets it to the system prompt,
history/save/blank lines change nothing, a message adds the user turn and, if generation worked,
the cleaned assistant turn (a failed generation removes the user turn again).

Scale: everything comes from one numbering of the log (``session_steps``): running counts of exits,
clears and answered messages per session, by range partitions of (session, seq), so a session that holds a
large share of all events is spread over many tasks. Reports per session are partial aggregates over
it; outputs that need the texts join them back by (session, seq), a key without hot values. No join or
window is dealt by session alone, except the fold of one conversation into one record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import classify_command, clean_response, history_path, preview, py_strip
from .messages import FALLBACK_SYSTEM_PROMPT, message
from .ranking import checked_broadcast, running_sums
from .validate import should_save

LOG_COLUMNS = ["sid", "seq", "ts", "text", "response"]


def _with_cmd(log: DataFrame) -> DataFrame:
    return log.withColumn("cmd", classify_command("text"))


def session_steps(log: DataFrame) -> DataFrame:
    """The log without its texts, numbered: ``(sid, seq, ts, cmd, answered, exits_before, clears, answers, saves)``.

    ``exits_before`` counts the exits before the event (0: the session is live), ``clears``, ``answers`` and
    ``saves`` the clears, the answered messages and the saves up to and including it. The result is
    pinned: reports read it more than once."""
    x = _with_cmd(log)
    answered = (F.col("cmd") == "message") & F.col("response").isNotNull()
    narrow = x.select("sid", "seq", "ts", "cmd", F.coalesce(answered, F.lit(False)).alias("answered"))
    is_exit = (F.col("cmd") == "exit").cast("long")
    steps = running_sums(narrow, ["sid"], "seq", {
        "_exits": is_exit, "clears": (F.col("cmd") == "clear").cast("long"), "answers": F.col("answered").cast("long"),
        "saves": (F.col("cmd") == "save").cast("long")})
    steps = steps.withColumn("exits_before", F.col("_exits") - F.coalesce(is_exit, F.lit(0))).drop("_exits")
    return steps.checkpoint(eager=True)


def _live() -> Column:
    return F.col("exits_before") == 0


def session_bounds(log: DataFrame, steps: DataFrame | None = None) -> DataFrame:
    """Per session: ``first_exit_seq`` (NULL if never exited), ``last_clear_seq`` (last clear before that
    exit), ``n_clears`` and ``n_answers`` before it, ``n_answers_cleared`` (those up to the last clear),
    ``first_seq``, ``n_events``, ``start_ts``, ``end_ts`` (last event up to and including the exit)."""
    steps = session_steps(log) if steps is None else steps
    live_clear = _live() & (F.col("cmd") == "clear")
    return steps.groupBy("sid").agg(
        F.min(F.when(F.col("cmd") == "exit", F.col("seq"))).alias("first_exit_seq"),
        F.max(F.when(live_clear, F.col("seq"))).alias("last_clear_seq"),
        F.coalesce(F.max(F.when(_live(), F.col("clears"))), F.lit(0)).alias("n_clears"),
        F.coalesce(F.max(F.when(_live(), F.col("answers"))), F.lit(0)).alias("n_answers"),
        F.coalesce(F.max(F.when(live_clear, F.col("answers"))), F.lit(0)).alias("n_answers_cleared"),
        F.min("seq").alias("first_seq"),
        F.count(F.lit(1)).alias("n_events"),
        F.min("ts").alias("start_ts"),
        F.max(F.when(_live(), F.col("ts"))).alias("end_ts"),
    )


def _message_pairs(kept: DataFrame, extra_eos: str | None, *more: str) -> DataFrame:
    """The two messages of every answered event: ``(more..., sid, seq, part, role, content)``."""
    pair = F.array(
        F.struct(F.lit(0).alias("part"), F.lit("user").alias("role"), F.col("text").alias("content")),
        F.struct(F.lit(1).alias("part"), F.lit("assistant").alias("role"),
                 clean_response(py_strip("response"), extra_eos).alias("content")),  # decoded text is stripped first
    )
    return kept.select(*more, "sid", "seq", F.inline(pair))


def _final_steps(steps: DataFrame) -> DataFrame:
    """(sid, seq) of the answered messages of every session's final conversation: live, and with no live
    clear after them. Clears that follow are counted from the far end, again by range partitions."""
    live = steps.filter(_live()).select("sid", "seq", "answered", (-F.col("seq")).alias("_back"), (F.col("cmd") == "clear").cast("long").alias("_clear"))
    after = running_sums(live, ["sid"], "_back", {"_after": F.col("_clear")})
    return after.filter(F.col("answered") & (F.col("_after") == 0)).select("sid", "seq")


def replay_messages(log: DataFrame, extra_eos: str | None = None, steps: DataFrame | None = None) -> DataFrame:
    """The final conversation of every session in long form (system prompt not included):
    ``(sid, seq, part, role, content)``, ``part`` 0 = user turn, 1 = assistant turn."""
    final = _final_steps(session_steps(log) if steps is None else steps)
    return _message_pairs(log.join(final, ["sid", "seq"], "left_semi"), extra_eos)


def replay_sessions(log: DataFrame, steps: DataFrame | None = None) -> DataFrame:
    """One row per session: ``total_messages`` (non-system messages of the final conversation),
    ``ended_by_exit``, ``first_exit_seq``, ``last_clear_seq``, ``n_events``, ``start_ts``,
    ``end_ts`` (last event up to and including the exit)."""
    b = session_bounds(log, steps)
    return b.select(
        "sid", ((F.col("n_answers") - F.col("n_answers_cleared")) * 2).alias("total_messages"),
        F.col("first_exit_seq").isNotNull().alias("ended_by_exit"),
        "first_exit_seq", "last_clear_seq", "n_events", "start_ts", "end_ts")


def _seconds() -> Column:
    return F.expr("timestampdiff(MICROSECOND, start_ts, end_ts)") / F.lit(1e6)


def session_duration(log: DataFrame) -> DataFrame:
    """``(sid, session_duration)``: seconds from the first event to the last one up to the exit. Two
    partial aggregates and one join of per-session rows; the log is not numbered for it."""
    x = _with_cmd(log).select("sid", "seq", "ts", "cmd")
    exits = x.filter(F.col("cmd") == "exit").groupBy("sid").agg(F.min("seq").alias("first_exit_seq"))
    spans = x.join(checked_broadcast(exits), "sid", "left").groupBy("sid").agg(
        F.min("ts").alias("start_ts"),
        F.max(F.when(F.col("first_exit_seq").isNull() | (F.col("seq") <= F.col("first_exit_seq")), F.col("ts"))).alias("end_ts"))
    return spans.select("sid", _seconds().alias("session_duration"))


def _fold(msgs: DataFrame, keys: list[str], system_prompt: str | Column) -> DataFrame:
    """``(keys, messages)``: one row per group, the system prompt first."""
    p = F.lit(system_prompt) if isinstance(system_prompt, str) else system_prompt
    ordered = F.array_sort(F.collect_list(F.when(F.col("role").isNotNull(), F.struct("seq", "part", "role", "content"))))
    folded = msgs.groupBy(*keys).agg(ordered.alias("_m"))
    return folded.select(*keys, F.concat(F.array(message("system", p)), F.transform("_m", lambda m: message(m["role"], m["content"]))).alias("messages"))


def replay_conversations(log: DataFrame, system_prompt: str | Column = FALLBACK_SYSTEM_PROMPT,
                         extra_eos: str | None = None, steps: DataFrame | None = None) -> DataFrame:
    """``(sid, messages)``: the system prompt followed by the final conversation (a session that
    exited at once still gets a row with only the system prompt). This folds one session into one
    row, which is what a history record is; use ``replay_messages`` to stay in long form."""
    steps = session_steps(log) if steps is None else steps
    sids = steps.select("sid").distinct().select("sid", F.lit(None).cast(log.schema["seq"].dataType).alias("seq"),
                                                 F.lit(None).cast("int").alias("part"), F.lit(None).cast("string").alias("role"),
                                                 F.lit(None).cast("string").alias("content"))
    return _fold(replay_messages(log, extra_eos, steps).unionByName(sids), ["sid"], system_prompt)


def session_snapshots(log: DataFrame, steps: DataFrame | None = None) -> DataFrame:
    """One row per ``save`` before the exit: ``(sid, save_seq, segment, total_messages, ts)``,
    where ``segment`` counts the clears before the save and ``total_messages`` the non-system
    messages the saved conversation holds (``snapshot_messages`` gives the messages themselves)."""
    steps = (session_steps(log) if steps is None else steps).filter(_live())
    # messages of the current segment = count now - count at the clear that opened the segment
    opened = steps.filter(F.col("cmd") == "clear").select("sid", F.col("clears").alias("segment"), F.col("answers").alias("_at_clear"))
    saves = steps.filter(F.col("cmd") == "save").withColumnRenamed("clears", "segment").join(opened, ["sid", "segment"], "left")
    msgs = F.col("answers") - F.coalesce(F.col("_at_clear"), F.lit(0))
    return saves.select("sid", F.col("seq").alias("save_seq"), "segment", (msgs * 2).alias("total_messages"), "ts")


def _segments(live: DataFrame) -> DataFrame:
    """Per (session, segment) that has a save: ``last_no`` (the number of its last save, counted through the
    session) and ``low`` (answered messages when it began)."""
    first_save = F.min(F.when(F.col("cmd") == "save", F.col("saves")))
    found = live.groupBy("sid", F.col("clears").alias("segment")).agg(
        first_save.alias("_first"), F.max("saves").alias("last_no"), F.min("answers").alias("low"))
    return found.filter(F.col("_first").isNotNull()).drop("_first")


def _held_intervals(live: DataFrame, segments: DataFrame) -> DataFrame:
    """``(sid, seq, segment, answers, first_no, last_no)`` of the messages that some save holds: the saves of a message
    are those of its segment after it, one run of numbers."""
    said = live.filter("answered").select("sid", "seq", F.col("clears").alias("segment"), "answers", (F.col("saves") + 1).alias("first_no"))
    return said.join(segments.drop("low"), ["sid", "segment"]).filter("first_no <= last_no")


def snapshot_intervals(log: DataFrame, extra_eos: str | None = None, steps: DataFrame | None = None) -> DataFrame:
    """The messages of all saved conversations, each once, with the saves that hold it:
    ``(sid, segment, seq, part, role, content, first_save, last_save, n_saves)``, where ``first_save`` and
    ``last_save`` are the numbers (from 1, per session) of the first and the last save that hold the message, and
    every save between them does too. As many rows as messages, however many saves there are."""
    live = (session_steps(log) if steps is None else steps).filter(_live())
    held = _held_intervals(live, checked_broadcast(_segments(live))).select(
        "sid", "seq", "segment", F.col("first_no").alias("first_save"), F.col("last_no").alias("last_save"),
        (F.col("last_no") - F.col("first_no") + 1).alias("n_saves"))
    pairs = _message_pairs(log.join(held, ["sid", "seq"]), extra_eos, "segment", "first_save", "last_save", "n_saves")
    return pairs.select("sid", "segment", "seq", "part", "role", "content", "first_save", "last_save", "n_saves")


def snapshot_messages(log: DataFrame, extra_eos: str | None = None, steps: DataFrame | None = None,
                      save_block: int = 256, message_block: int = 4096) -> DataFrame:
    """The saved conversation of every ``save`` in long form, system prompt not included:
    ``(sid, save_seq, seq, part, role, content)``. A save holds all messages of its segment before it, so
    the output has as many rows as the saved files have messages.

    It is a range join of the messages' save numbers (``snapshot_intervals``) with the numbered saves, cut
    into a grid: ``save_block`` consecutive saves of a session by ``message_block`` consecutive messages. A message
    goes to the blocks of saves that hold it, a block of saves to the blocks of messages before it, and a
    cell joins them by equality. So one session's saves and messages, however many, spread over as many tasks
    as their output needs, and no cell holds more than its two blocks."""
    live = (session_steps(log) if steps is None else steps).filter(_live())
    segments = checked_broadcast(_segments(live))

    def block(x: Column, size: int) -> Column:
        return F.call_function("div", x, F.lit(size))

    def run(low: Column, high: Column, size: int) -> Column:
        return F.explode(F.sequence(block(low, size), block(high, size)))

    held = _held_intervals(live, segments).join(log.select("sid", "seq", "text", "response"), ["sid", "seq"])
    messages = held.select("sid", "seq", "text", "response", "first_no", "last_no", block(F.col("answers"), message_block).alias("mb"),
                           run(F.col("first_no"), F.col("last_no"), save_block).alias("sb"))
    saves = live.filter(F.col("cmd") == "save").select("sid", F.col("clears").alias("segment"), F.col("seq").alias("save_seq"), "saves", "answers")
    blocks = saves.join(segments.drop("last_no"), ["sid", "segment"]).groupBy("sid", block(F.col("saves"), save_block).alias("sb")).agg(
        F.collect_list(F.struct("saves", "save_seq")).alias("list"), F.min("low").alias("low"), F.max("answers").alias("high"))
    blocks = blocks.select("sid", "sb", "list", run(F.col("low"), F.greatest("low", "high"), message_block).alias("mb"))
    inside = F.filter("list", lambda x: x["saves"].between(F.col("first_no"), F.col("last_no")))
    out = messages.join(blocks, ["sid", "sb", "mb"]).select("sid", "seq", "text", "response", F.explode(inside).alias("s"))
    return _message_pairs(out.select("sid", "seq", "text", "response", F.col("s.save_seq").alias("save_seq")), extra_eos, "save_seq")


def final_records(log: DataFrame, system_prompt: str | Column = FALLBACK_SYSTEM_PROMPT, base: str = "history",
                  requested: str | None = None, steps: DataFrame | None = None) -> DataFrame:
    """What every session writes when it ends, by an exit or not: ``(sid, messages, start_ts, end_ts, path)``.

    Only sessions worth saving have a row: more than the system prompt, or a path asked for. The path
    asked for is the value of the log's ``requested`` column at the session's first event."""
    steps = session_steps(log) if steps is None else steps
    convs = replay_conversations(log, system_prompt, steps=steps)
    bounds = session_bounds(log, steps).select("sid", "start_ts", "end_ts")
    convs = convs.join(bounds, "sid")
    if requested is None:
        convs = convs.withColumn("requested", F.lit(None).cast("string"))
    else:
        asked = log.groupBy("sid").agg(F.min_by(requested, "seq").alias("requested"))
        convs = convs.join(asked, "sid")
    kept = should_save(convs, requested="requested")
    return kept.select("sid", "messages", "start_ts", "end_ts", history_path("requested", "end_ts", base).alias("path"))


def append_responses(convs: DataFrame, responses: DataFrame, key: str = "conv_id", messages: str = "messages",
                     response: str = "response", turn: str | None = None) -> DataFrame:
    """Answer the conversations that wait for one: those that end in a user message.

    A response appends the assistant message; none (NULL or no row) removes the waiting user message, as a
    failed generation does. Conversations that do not end in a user message stay as they are. With ``turn``
    a response belongs to the message at that place (from 0) and is used only if that message is the
    waiting one. Two responses for one place are an error."""
    m, n = F.col(messages), F.size(messages)
    place = [key] + ([turn] if turn else [])
    r = responses.groupBy(*place).agg(F.count(F.lit(1)).alias("_rows"), F.first(response).alias("_resp"))
    on = F.col("c." + key) == F.col("r." + key)
    if turn:
        on = on & (F.size(F.col("c." + messages)) - 1 == F.col("r." + turn))
    joined = convs.alias("c").join(r.alias("r"), on, "left").select("c.*", "_rows", "_resp")
    waits = (n > 0) & F.coalesce(F.element_at(m, -1).getField("role") == "user", F.lit(False))
    twice = F.raise_error(F.concat(F.lit("more than one response for "), F.col(key).cast("string")))
    answered = F.when(F.col("_resp").isNotNull(), F.concat(m, F.array(message("assistant", F.col("_resp"))))).otherwise(
        F.slice(m, 1, F.greatest(n - 1, F.lit(0))))
    return joined.withColumn(messages, F.when(~waits, m).when(F.col("_rows") > 1, twice.cast(convs.schema[messages].dataType)).otherwise(answered)).drop("_rows", "_resp")


def iso_timestamp(ts) -> Column:
    """Python ``datetime.isoformat()``: microseconds only when not zero."""
    t = F.col(ts) if isinstance(ts, str) else ts
    return F.when(F.date_format(t, "SSSSSS") == "000000", F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(
        F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def conversation_record(convs: DataFrame, messages: str = "messages", ts: str | None = None,
                        saved_at: str | Column | None = None, duration: str | None = None) -> DataFrame:
    """Adds the history record columns: ``timestamp`` (ISO text), ``conversation``,
    ``total_messages`` (messages whose role is not system) and ``model_info`` {saved_at,
    session_duration (NULL unless given)}; plus ``record`` = the whole record as a struct."""
    m = F.col(messages)
    ts_col = iso_timestamp(ts) if ts else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    sa = (F.col(saved_at) if isinstance(saved_at, str) else saved_at) if saved_at is not None else F.lit(None).cast("string")
    dur = F.col(duration).cast("double") if duration else F.lit(None).cast("double")
    out = (
        convs.withColumn("timestamp", ts_col)
        .withColumn("conversation", m)
        .withColumn("total_messages", F.size(F.filter(m, lambda x: ~F.coalesce(x["role"] == "system", F.lit(False)))))
        .withColumn("model_info", F.struct(sa.alias("saved_at"), dur.alias("session_duration")))
    )
    return out.withColumn("record", F.struct("timestamp", "conversation", "total_messages", "model_info"))


def history_view(convs: DataFrame, key: str = "conv_id", messages: str = "messages") -> DataFrame:
    """The chat loop's ``history`` listing: element 0 is skipped whatever its role, numbering
    starts at 1, "User" for user messages and "Assistant" for all others, content cut to 100
    code points plus "...". ``(key, idx, role_label, content, line)``."""
    m = F.col(messages)
    tail = F.slice(m, 2, F.greatest(F.size(m) - 1, F.lit(0)))
    x = convs.select(key, F.posexplode(tail).alias("_p", "_m"))
    label = F.when(F.col("_m.role") == "user", F.lit("User")).otherwise(F.lit("Assistant"))
    content = preview(F.col("_m.content"))
    return x.select(
        key, (F.col("_p") + 1).alias("idx"), label.alias("role_label"), content.alias("content"),
        F.concat((F.col("_p") + 1).cast("string"), F.lit(". "), label, F.lit(": "), content).alias("line"),
    )


def snapshot_paths(snapshots: DataFrame, requested: str = "requested", ts: str = "ts", base: str = "history") -> DataFrame:
    """Where each snapshot is written (absolute kept, relative under ``base``, else timestamped)."""
    return snapshots.withColumn("path", history_path(requested, ts, base))
