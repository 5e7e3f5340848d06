"""Validation of chat JSONL and of conversations, and the data-set level reports built on it.

All reports are hash aggregates with map-side partial aggregation, so a file or key holding a
large share of the lines is combined inside each task before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.json import (
    STATUS_INVALID_JSON,
    STATUS_MISSING,
    STATUS_NOT_LIST,
    STATUS_NOT_OBJECT,
    STATUS_OK,
    is_valid_json,
    with_status,
)
from ..functions.text import py_strip
from .ranking import position_in_group

# --- fixed values ----------------------------------------------------------------------------
# The trainer refuses a data set when more than this share of its lines is bad.
MAX_ERROR_RATE = 0.1
# Data-set size advice: at least 400 examples; about 200 can do when quality is high.
READY_MIN_EXAMPLES = 400
HIGH_QUALITY_MIN_EXAMPLES = 200
# LoRA settings by data-set size: [lo, hi) examples -> r, alpha, dropout, learning rate.
SIZE_BANDS = [
    ("small", 0, 1000, 8, 16, 0.1, 1e-4),
    ("medium", 1000, 10001, 16, 32, 0.05, 5e-5),
    ("large", 10001, None, 32, 64, 0.05, 2e-5),
]
CHAT_ROLES = ["system", "user", "assistant"]
# ---------------------------------------------------------------------------------------------

ERROR_MESSAGES = {
    STATUS_INVALID_JSON: "cannot be parsed as one JSON value",
    STATUS_NOT_OBJECT: "holds a JSON value that is no object",
    STATUS_MISSING: "has no messages key",
    STATUS_NOT_LIST: "has a messages value that is no list",
}

REPAIR_RULES = [
    (STATUS_INVALID_JSON, "Fix the JSON syntax: one complete object per line, double-quoted keys and strings, no trailing text or commas."),
    (STATUS_NOT_OBJECT, "Wrap the example in an object: {\"messages\": [...]}."),
    (STATUS_MISSING, "Add a \"messages\" key (lower case) holding the list of turns."),
    (STATUS_NOT_LIST, "Make \"messages\" a list of {\"role\", \"content\"} objects."),
    ("invalid_utf8", "Re-encode the file as UTF-8."),
    ("empty", "Add at least one user and one assistant message."),
    ("bad_role", "Use only the roles system, user and assistant."),
    ("system_not_first", "Move the system message to the start, or drop it."),
    ("null_content", "Give every message a string content."),
    ("not_alternating", "Alternate user and assistant messages, starting with user."),
    ("no_final_assistant", "End the conversation with an assistant message."),
]


def classify_lines(lines: DataFrame, line_col: str = "line", strip: bool = True) -> DataFrame:
    """Add ``status`` (ok / invalid_json / not_object / missing_messages / messages_not_list)."""
    return with_status(lines, line_col, "status", strip=strip)


def _with_empty_files(report: DataFrame, by: list[str], files: DataFrame | None, passed: str = "passed") -> DataFrame:
    """Add a row of zero counts (which passes) for every group of ``files`` without a line."""
    if files is None:
        return report
    rest = files.select(*by).distinct().join(report.select(*by), by, "left_anti")
    zeros = [F.lit(0).cast("long").alias(c) for c in report.columns if c not in by and report.schema[c].dataType.typeName() == "long"]
    return report.unionByName(rest.select(*by, *zeros, F.lit(True).alias(passed)), allowMissingColumns=True)


def validation_report(lines: DataFrame, max_error_rate: float = MAX_ERROR_RATE,
                      by: list[str] | None = None, line_col: str = "line", files: DataFrame | None = None) -> DataFrame:
    """Per file: line and error counts, counts per class, undecodable lines and ``passed``.

    ``files`` (a listing with the ``by`` columns, see ``sources.list_input_files``) adds a row for every
    file without lines; such a file has an unknown error rate and passes.

    ``passed`` is false when ``error_count > line_count * max_error_rate`` (double arithmetic,
    as in Python: exactly 10 % bad still passes) or when any line is not valid UTF-8."""
    classified = classify_lines(lines, line_col).withColumn("valid_utf8", F.is_valid_utf8(F.col(line_col)))
    return status_report(classified, max_error_rate, by, files)


def status_report(classified: DataFrame, max_error_rate: float = MAX_ERROR_RATE, by: list[str] | None = None,
                  files: DataFrame | None = None) -> DataFrame:
    """``validation_report`` of lines that have been classified: ``status`` and ``valid_utf8`` beside the ``by`` columns."""
    by = by if by is not None else ["file"]
    st = F.col("status")
    agg = classified.groupBy(*by).agg(
        F.count(F.lit(1)).alias("line_count"),
        F.count_if(st != STATUS_OK).alias("error_count"),
        F.count_if(st == STATUS_INVALID_JSON).alias("invalid_json"),
        F.count_if(st == STATUS_NOT_OBJECT).alias("not_object"),
        F.count_if(st == STATUS_MISSING).alias("missing_messages"),
        F.count_if(st == STATUS_NOT_LIST).alias("messages_not_list"),
        F.count_if(~F.col("valid_utf8")).alias("invalid_utf8"),
    )
    report = agg.withColumn("error_rate", F.round(F.col("error_count") / F.col("line_count"), 6)).withColumn(
        "passed",
        ~(F.col("error_count") > F.col("line_count") * F.lit(float(max_error_rate))) & (F.col("invalid_utf8") == 0),
    )
    return _with_empty_files(report, by, files)


NAMED_FAILURES = 20  # failed files that the error names; it counts all of them


def require_valid(report: DataFrame) -> DataFrame:
    """Raise ``ValueError`` when any file of the report failed (the report is one row per file).

    The error counts all failed files and names the first ``NAMED_FAILURES`` of them by path."""
    bad = report.filter(~F.col("passed")).select("file", "error_count", "line_count", "invalid_utf8")
    named = bad.orderBy("file").limit(NAMED_FAILURES + 1).collect()
    if not named:
        return report
    parts = [f"{r['file']}: {r['invalid_utf8']} lines are not valid UTF-8" if r["invalid_utf8"]
             else f"{r['file']}: {r['error_count']} of {r['line_count']} lines are bad" for r in named[:NAMED_FAILURES]]
    total = bad.count() if len(named) > NAMED_FAILURES else len(named)
    raise ValueError(f"{total} file(s) refused: " + "; ".join(parts) + ("; ..." if total > len(parts) else ""))


def first_invalid_line(lines: DataFrame, by: list[str] | None = None, files: DataFrame | None = None) -> DataFrame:
    """The standalone checker (``files`` as in ``validation_report``): per file, the first line that is not valid JSON (unstripped, as the
    checker reads it), its stripped content, and how many lines were checked (up to and including
    that line, or all)."""
    by = by if by is not None else ["file"]
    checked = lines.withColumn("_bad", ~is_valid_json("line", strip=False))
    bad_no = F.when(F.col("_bad"), F.col("line_no"))
    report = checked.groupBy(*by).agg(
        F.coalesce(F.min(bad_no), F.count(F.lit(1))).alias("lines_checked"),
        F.min(bad_no).alias("first_bad_line"),
        F.min_by(F.when(F.col("_bad"), py_strip("line")), bad_no).alias("first_bad_content"),
    )
    if files is None:
        return report
    rest = files.select(*by).distinct().join(report.select(*by), by, "left_anti")
    return report.unionByName(rest.withColumn("lines_checked", F.lit(0).cast("long")), allowMissingColumns=True)


def error_report(lines: DataFrame) -> DataFrame:
    """One row per bad line: ``(file, line_no, status, message, line)``; the caller sorts."""
    msg = F.lit(None).cast("string")
    for status, text in ERROR_MESSAGES.items():
        msg = F.when(F.col("status") == status, F.lit(text)).otherwise(msg)
    return (
        classify_lines(lines)
        .filter(F.col("status") != STATUS_OK)
        .select("file", "line_no", "status",
                F.concat(F.lit("Line "), F.col("line_no").cast("string"), F.lit(" "), msg).alias("message"),
                "line")
    )


def encoding_report(lines: DataFrame, by: list[str] | None = None, files: DataFrame | None = None) -> DataFrame:
    """Per file: lines that are not valid UTF-8 (a strict UTF-8 reader would reject the file)."""
    by = by if by is not None else ["file"]
    report = lines.groupBy(*by).agg(
        F.count(F.lit(1)).alias("line_count"),
        F.count_if(~F.is_valid_utf8("line")).alias("invalid_utf8_lines"),
    ).withColumn("passed", F.col("invalid_utf8_lines") == 0)
    return _with_empty_files(report, by, files)


def dataset_statistics(turns: DataFrame, key: str = "conv_id", role: str = "role", text: str = "text") -> DataFrame:
    """Per role: messages, conversations, characters (code points) total/avg/min/max."""
    n = F.length(text)
    return turns.groupBy(role).agg(
        F.count(F.lit(1)).alias("n_messages"),
        F.countDistinct(key).alias("n_conversations"),
        F.sum(n).alias("total_chars"),
        F.round(F.avg(n), 6).alias("avg_chars"),
        F.min(n).alias("min_chars"),
        F.max(n).alias("max_chars"),
    )


def turn_count_histogram(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """How many conversations have 1, 2, 3, ... messages."""
    per_conv = turns.groupBy(key).agg(F.count(F.lit(1)).alias("n_turns"))
    return per_conv.groupBy("n_turns").agg(F.count(F.lit(1)).alias("n_conversations"))


def chat_format_report(convs: DataFrame, messages: str = "messages") -> DataFrame:
    """Adds ``violations`` (array of codes, in a fixed order), ``n_violations`` and ``is_valid``.

    Codes: empty, bad_role, system_not_first, null_content, not_alternating (after an optional
    leading system message the roles must go user, assistant, user, ...), no_final_assistant."""
    m = F.col(messages)
    n = F.size(m)
    lead = F.when((n > 0) & (m.getItem(0).getField("role") == "system"), F.lit(1)).otherwise(F.lit(0))

    def any_of(pred):
        return F.coalesce(F.exists(m, pred), F.lit(False))

    bad_role = any_of(lambda x: x["role"].isNull() | ~x["role"].isin(*CHAT_ROLES))
    sys_late = F.exists(F.transform(m, lambda x, i: (x["role"] == "system") & (i > 0)), lambda b: F.coalesce(b, F.lit(False)))
    null_content = any_of(lambda x: x["content"].isNull())
    not_alt = F.exists(
        F.transform(m, lambda x, i: (i >= lead) & ~F.coalesce(
            x["role"] == F.when((i - lead) % 2 == 0, F.lit("user")).otherwise(F.lit("assistant")), F.lit(False))),
        lambda b: b,
    )
    no_final = (n > 0) & ~F.coalesce(F.element_at(m, -1).getField("role") == "assistant", F.lit(False))
    codes = F.array(
        F.when(n == 0, F.lit("empty")),
        F.when(bad_role, F.lit("bad_role")),
        F.when(sys_late, F.lit("system_not_first")),
        F.when(null_content, F.lit("null_content")),
        F.when(not_alt, F.lit("not_alternating")),
        F.when(no_final, F.lit("no_final_assistant")),
    )
    v = F.filter(codes, lambda c: c.isNotNull())
    return convs.withColumn("violations", v).withColumn("n_violations", F.size("violations")).withColumn(
        "is_valid", F.col("n_violations") == 0)


def chat_format_report_turns(turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role",
                             text: str = "text") -> DataFrame:
    """``chat_format_report`` on the turn table itself, without folding conversations:
    ``(key, violations, n_violations, is_valid)``, same codes and order.

    Positions come from ``position_in_group`` (exact, block-wise); every rule is then a per-row
    flag combined by a partial (map-side) aggregate, so a conversation holding a large share of
    all turns is never gathered in one place. A null key is one conversation, a null order comes first. Alternation is checked for both possible starts
    (with and without a leading system message) and the right one is picked per conversation."""
    r, p = F.col(role), F.col("_pos")
    # only whether the text is NULL matters: keep the shuffled rows narrow
    narrow = turns.select(key, order, role, F.col(text).isNull().alias("_nul"))
    x = position_in_group(narrow, [key], order, "_pos")

    def expected(start):
        return F.when((p - start) % 2 == 0, F.lit("user")).otherwise(F.lit("assistant"))

    def off(start):
        return (p >= start) & ~F.coalesce(r == expected(start), F.lit(False))

    agg = x.groupBy(key).agg(
        F.max(r.isNull() | ~r.isin(*CHAT_ROLES)).alias("bad_role"),
        F.max((r == "system") & (p > 0)).alias("sys_late"),
        F.max(F.col("_nul")).alias("null_content"),
        F.max((p == 0) & F.coalesce(r == "system", F.lit(False))).alias("_lead"),
        F.max(off(0)).alias("_off0"),
        F.max(off(1)).alias("_off1"),
        F.max_by(F.struct(r.alias("r")), F.col("_pos")).alias("_l"),
    )
    not_alt = F.when(F.col("_lead"), F.col("_off1")).otherwise(F.col("_off0"))
    no_final = ~F.coalesce(F.col("_l.r") == "assistant", F.lit(False))
    codes = F.array(
        F.when(F.coalesce(F.col("bad_role"), F.lit(False)), F.lit("bad_role")),
        F.when(F.coalesce(F.col("sys_late"), F.lit(False)), F.lit("system_not_first")),
        F.when(F.col("null_content"), F.lit("null_content")),
        F.when(not_alt, F.lit("not_alternating")),
        F.when(no_final, F.lit("no_final_assistant")),
    )
    return agg.select(key, F.filter(codes, lambda c: c.isNotNull()).alias("violations")).withColumn(
        "n_violations", F.size("violations")).withColumn("is_valid", F.col("n_violations") == 0)


def repair_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(REPAIR_RULES, "code string, suggestion string")


def repair_suggestions(errors: DataFrame, code_col: str = "code") -> DataFrame:
    """Attach a repair hint to every error code (broadcast join with the fixed rule table)."""
    rules = F.broadcast(repair_rules(errors.sparkSession).withColumnRenamed("code", code_col))
    return errors.join(rules, code_col, "left")


def dataset_readiness(df: DataFrame, key: list[str], labels: DataFrame | None = None,
                      id_col: str = "doc_id") -> DataFrame:
    """Per group: example count, labelled count, mean quality, and readiness
    (ready >= 400, ready_if_high_quality >= 200, else too_small)."""
    x = df.select(*key, id_col)
    if labels is not None:
        x = x.join(labels.select(id_col, "quality"), id_col, "left")
    else:
        x = x.withColumn("quality", F.lit(None).cast("int"))
    n = F.col("n_examples")
    return x.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_examples"),
        F.count("quality").alias("n_labeled"),
        F.round(F.avg("quality"), 6).alias("avg_quality"),
    ).withColumn(
        "readiness",
        F.when(n >= READY_MIN_EXAMPLES, F.lit("ready"))
        .when(n >= HIGH_QUALITY_MIN_EXAMPLES, F.lit("ready_if_high_quality"))
        .otherwise(F.lit("too_small")),
    )


def size_bands(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(i, *b) for i, b in enumerate(SIZE_BANDS)],
        "band_id int, band string, lo long, hi long, lora_r int, lora_alpha int, lora_dropout double, learning_rate double",
    )


def recommend_config(counts: DataFrame, n_col: str = "n_examples") -> DataFrame:
    """LoRA settings for each row's example count. The band is found with the band limits as a
    CASE, then the 3-row band table is attached by a broadcast equi-join (no nested-loop join)."""
    n = F.col(n_col)
    band_id = None
    for i, (_, lo, hi, *_rest) in enumerate(SIZE_BANDS):
        cond = (n >= lo) if hi is None else ((n >= lo) & (n < hi))
        band_id = F.when(cond, F.lit(i)) if band_id is None else band_id.when(cond, F.lit(i))
    bands = F.broadcast(size_bands(counts.sparkSession).drop("lo", "hi"))
    return counts.withColumn("band_id", band_id).join(bands, "band_id", "left").drop("band_id")


def drop_invalid_examples(df: DataFrame, ids: str = "input_ids") -> DataFrame:
    """Keep examples that were formatted and have at least one token."""
    return df.filter(F.col(ids).isNotNull() & (F.size(ids) > 0))


def require_examples(df: DataFrame) -> DataFrame:
    """Stop the run when no example is left."""
    if df.isEmpty():
        raise ValueError("No valid examples after tokenization")
    return df


def should_save(convs: DataFrame, messages: str = "messages", requested: str | None = None) -> DataFrame:
    """Conversations worth writing: more than one message, or a save path was asked for
    (an empty path counts as not asked)."""
    keep = F.size(messages) > 1
    if requested:
        keep = keep | F.coalesce(F.col(requested) != "", F.lit(False))
    return convs.filter(keep)
