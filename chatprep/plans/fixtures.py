"""Data sets derived from the driver tables, so that every check runs on (and grows with) them.

Each derivation is a fixed rule on the source rows; no row is dropped. The same rules are
written in SQL in ``plans.checks`` for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.messages import fold_messages
from ..operators.ranking import global_row_number
from ..session import table

JSONL_FILE = "conversations.jsonl"


def chat_lines(spark: SparkSession, sf_dir: str, numbered: bool = True) -> DataFrame:
    """``(file, line_no, line)``: every conversation as one chat JSONL line, ordered by conv_id,
    corrupted by ``conv_id % 10``: 3 -> last character cut, 5 -> key renamed to "msgs",
    7 -> ``{"messages":"x"}``, 9 -> " x" appended; then by ``conv_id % 20``: 6 -> the number 123,
    16 -> U+3000 in front (stripped by the gate), 11 -> a repeated key and no message, 1 -> U+0085 behind;
    others unchanged.

    ``numbered=False`` skips the (global-order) line numbering for reports that do not use it."""
    convs = fold_messages(table(spark, sf_dir, "conversations"))
    line = F.to_json(F.struct(F.col("messages")))
    k = F.col("conv_id") % 10
    dirty = (
        F.when(k == 3, F.expr("substring(_l, 1, length(_l) - 1)"))
        .when(k == 5, F.concat(F.lit('{"msgs":'), F.expr("substring(_l, 13)")))
        .when(k == 7, F.lit('{"messages":"x"}'))
        .when(k == 9, F.concat(F.col("_l"), F.lit(" x")))
        .when(F.col("conv_id") % 20 == 6, F.lit("123"))
        .when(F.col("conv_id") % 20 == 16, F.concat(F.lit("\u3000"), F.col("_l")))
        .when(F.col("conv_id") % 20 == 11, F.lit('{"messages":[],"a":1,"a":2}'))
        .when(F.col("conv_id") % 20 == 1, F.concat(F.col("_l"), F.lit("\u0085")))
        .otherwise(F.col("_l"))
    )
    lines = convs.select("conv_id", line.alias("_l")).select("conv_id", dirty.alias("line"))
    if not numbered:
        return lines.select(F.lit(JSONL_FILE).alias("file"), "line", "conv_id")
    numbered = global_row_number(lines, ["conv_id"], out="_rn")
    return numbered.select(F.lit(JSONL_FILE).alias("file"), (F.col("_rn") + 1).alias("line_no"), "line", "conv_id")


def undecodable_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``chat_lines`` unnumbered; where ``conv_id % 6 = 1`` a byte that is not UTF-8 is appended."""
    x = chat_lines(spark, sf_dir, numbered=False)
    bad = F.concat(F.col("line").cast("binary"), F.lit(bytearray(b"\xff")))
    return x.select("file", F.when(F.col("conv_id") % 6 == 1, bad).otherwise(F.col("line").cast("binary")).cast("string").alias("line"))


def dirty_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` with format faults by ``conv_id % 9``: 1 -> turn 1 has role "tool", 2 -> turn 2 has
    role "system", 3 -> turn 0 has no text, 4 -> odd turns have role "user"; others unchanged."""
    c, t = F.col("conv_id") % 9, F.col("turn")
    role = (F.when((c == 1) & (t == 1), F.lit("tool")).when((c == 2) & (t == 2), F.lit("system"))
            .when((c == 4) & (t % 2 == 1), F.lit("user")).otherwise(F.col("role")))
    text = F.when(~((c == 3) & (t == 0)), F.col("text"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", role.alias("role"), text.alias("text"))


def spaced_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, response)``: document texts between white space of many kinds, by ``doc_id % 6``: 1 -> U+3000 ...
    U+2028; 2 -> tab, U+0085 ... U+001C; 3 -> U+00A0 U+205F in front; 4 -> U+FEFF (not white space) ... line
    feed; 5 -> only white space; 0 -> as is."""
    d = table(spark, sf_dir, "documents")
    k, t = F.col("doc_id") % 6, F.col("text")
    resp = (F.when(k == 1, F.concat(F.lit("\u3000"), t, F.lit("\u2028"))).when(k == 2, F.concat(F.lit("\t\u0085"), t, F.lit("\u001c")))
            .when(k == 3, F.concat(F.lit("\u00a0\u205f"), t)).when(k == 4, F.concat(F.lit("\ufeff"), t, F.lit("\n")))
            .when(k == 5, F.lit(" \u2003\u1680 ")).otherwise(t))
    return d.select("doc_id", resp.alias("response"))


def session_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as chat-loop input: ``sid = user_id``, ``seq = event_id``. Text by rule, first
    match wins: event_id % 997 = 0 -> "exit"; % 41 = 0 -> "終了"; % 50 = 0 -> "save";
    signup -> "clear"; % 29 = 0 -> "History"; % 31 = 0 -> " " (blank); % 37 = 0 -> "QUIT " (a
    message: commands are not stripped); otherwise the event's props. Response: NULL for error
    events (generation failed), else "**<event_type>** <props><end_of_turn> trailer".
    ``requested`` (save path asked for) by event_id % 4: NULL, '', '/abs/<sid>.json', 'user_<sid>.json'."""
    return as_session_log(table(spark, sf_dir, "events"))


def as_session_log(ev: DataFrame) -> DataFrame:
    """``session_log`` of an events table, or of a stream of events."""
    eid = F.col("event_id")
    text = (
        F.when(eid % 997 == 0, F.lit("exit"))
        .when(eid % 41 == 0, F.lit("終了"))
        .when(eid % 50 == 0, F.lit("save"))
        .when(F.col("event_type") == "signup", F.lit("clear"))
        .when(eid % 29 == 0, F.lit("History"))
        .when(eid % 31 == 0, F.lit(" "))
        .when(eid % 37 == 0, F.lit("QUIT "))
        .otherwise(F.col("props"))
    )
    response = F.when(F.col("event_type") == "error", F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("**"), F.col("event_type"), F.lit("** "), F.col("props"), F.lit("<end_of_turn> trailer")))
    sid = F.col("user_id").cast("string")
    requested = (
        F.when(eid % 4 == 0, F.lit(None).cast("string"))
        .when(eid % 4 == 1, F.lit(""))
        .when(eid % 4 == 2, F.concat(F.lit("/abs/"), sid, F.lit(".json")))
        .otherwise(F.concat(F.lit("user_"), sid, F.lit(".json")))
    )
    return ev.select(
        F.col("user_id").alias("sid"), eid.alias("seq"), "ts", text.alias("text"), response.alias("response"),
        requested.alias("requested"))


def raw_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, response)``: document texts dressed up as raw model output, by doc_id % 7:
    0 as is; 1 + "<end_of_turn> tail"; 2 "  " + text + " </s> more <|im_end|> x"; 3 "**<lang>** " +
    text; 4 + "<|endoftext|>"; 5 "**bold\\nnot** " + text; 6 + " **a** and **b**"."""
    d = table(spark, sf_dir, "documents")
    k = F.col("doc_id") % 7
    t = F.col("text")
    resp = (
        F.when(k == 1, F.concat(t, F.lit("<end_of_turn> tail")))
        .when(k == 2, F.concat(F.lit("  "), t, F.lit(" </s> more <|im_end|> x")))
        .when(k == 3, F.concat(F.lit("**"), F.col("lang"), F.lit("** "), t))
        .when(k == 4, F.concat(t, F.lit("<|endoftext|>")))
        .when(k == 5, F.concat(F.lit("**bold\nnot** "), t))
        .when(k == 6, F.concat(t, F.lit(" **a** and **b**")))
        .otherwise(t)
    )
    return d.select("doc_id", resp.alias("response"))


# --- run registry, derived from `part` ---------------------------------------------------------
# Every part row is one file: directory runs/r<p_partkey div 7>, file name ARTIFACT_FILES[p_partkey % 9].
ARTIFACT_FILES = [
    "adapter_config.json", "adapter_model.safetensors", "tokenizer.json", "tokenizer_config.json",
    "training_info.json", "config.json", "tokenizer.model", "merge_info.json", "special_tokens_map.json",
]


def _run_dir(k):
    return F.concat(F.lit("runs/r"), k.cast("string"))


def artifact_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(dir, file, path, length, p_partkey, p_size, p_retailprice, p_brand)``."""
    p = table(spark, sf_dir, "part")
    files = F.array(*[F.lit(f) for f in ARTIFACT_FILES])
    d = _run_dir(F.floor(F.col("p_partkey") / 7).cast("long"))
    f = F.element_at(files, (F.col("p_partkey") % len(ARTIFACT_FILES) + 1).cast("int"))
    return p.select(
        d.alias("dir"), f.alias("file"), F.concat(d, F.lit("/"), f).alias("path"),
        (F.col("p_size").cast("long") * 1000 + F.col("p_partkey")).alias("length"),
        "p_partkey", "p_size", "p_retailprice", "p_brand")


def training_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The content of every training_info.json of the listing, from its part row."""
    x = artifact_listing(spark, sf_dir).filter(F.col("file") == "training_info.json")
    return x.select(
        "dir", "path",
        F.concat(F.lit("base/"), F.lower(F.regexp_replace("p_brand", "#", ""))).alias("model_name"),
        F.lit("data/fine_tune_data.jsonl").alias("dataset_file"),
        (F.col("p_size") % 5 + 1).cast("int").alias("epochs"),
        F.lit(2).alias("batch_size"),
        (F.col("p_retailprice") / 1e7).alias("learning_rate"),
        F.lit(512).alias("max_length"),
        F.lit(8).alias("gradient_accumulation_steps"),
        F.lit(16).alias("lora_r"),
        F.lit(32).alias("lora_alpha"),
        F.lit(0.05).alias("lora_dropout"),
        F.lit(100).alias("save_steps"),
        F.col("p_partkey").alias("total_examples"),
    )


def adapter_configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """adapter_config.json contents: r = 8 * (1 + p_size % 4); alpha = 2r, given under
    ``lora_alpha`` instead when p_size % 3 = 0; the first (p_size % 7) target modules
    module_1, module_2, ... (none -> empty list)."""
    x = artifact_listing(spark, sf_dir).filter(F.col("file") == "adapter_config.json")
    r = (F.lit(8) * (F.col("p_size") % 4 + 1)).cast("int")
    alt = F.col("p_size") % 3 == 0
    count = (F.col("p_size") % 7).cast("int")
    names = F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda i: F.concat(F.lit("module_"), i.cast("string")))
    mods = F.when(count > 0, names).otherwise(F.array().cast("array<string>"))
    return x.select(
        "dir", r.alias("r"),
        F.when(~alt, r * 2).cast("int").alias("alpha"), F.when(alt, r * 2).cast("int").alias("lora_alpha"),
        mods.alias("target_modules"))


def merge_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """merge_info.json contents: the adapter is the run directory before this one."""
    x = artifact_listing(spark, sf_dir).filter(F.col("file") == "merge_info.json")
    k = F.floor(F.col("p_partkey") / 7).cast("long")
    return x.select(
        "dir", F.concat(F.lit("base/"), F.lower(F.regexp_replace("p_brand", "#", ""))).alias("base_model"),
        _run_dir(k - 1).alias("lora_adapter"), F.lit("auto").alias("dtype"), F.lit("auto").alias("device_map"),
        (F.col("p_size") % 2 == 0).alias("safe_serialization"))


def merge_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One merge per merge_info.json: output = its directory, base model = the next run
    directory, adapter = the previous one."""
    x = artifact_listing(spark, sf_dir).filter(F.col("file") == "merge_info.json")
    k = F.floor(F.col("p_partkey") / 7).cast("long")
    return x.select(F.col("dir").alias("out_dir"), _run_dir(k + 1).alias("base_model"), _run_dir(k - 1).alias("adapter_dir"))


def model_configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """config.json texts: ``_name_or_path`` points two run directories on when p_size is even."""
    x = artifact_listing(spark, sf_dir).filter(F.col("file") == "config.json")
    k = F.floor(F.col("p_partkey") / 7).cast("long")
    content = F.when(
        F.col("p_size") % 2 == 0,
        F.concat(F.lit('{"_name_or_path": "'), _run_dir(k + 2), F.lit('", "model_type": "gemma3"}')),
    ).otherwise(F.lit('{"model_type": "gemma3"}'))
    return x.select("dir", content.alias("content"))
