"""JSONL readers.

``read_jsonl_lines`` numbers the lines of every file 1, 2, 3, ... the way a Python ``for`` loop
over the open file does, but without a global window or ``zipWithIndex``: each file split is
read by one task in order, so a line's number is (its position inside the split) + (lines in the
earlier splits of the same file). The split table has one row per split and is joined back.
Spark's text source splits on ``\\n``, ``\\r\\n`` and ``\\r`` like Python's text mode; unlike
Python it drops a UTF-8 byte order mark at the start of a file.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.json import STATUS_OK
from ..functions.text import py_strip
from ..operators.ranking import checked_broadcast

MESSAGE_TYPE = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
MESSAGES_TYPE = T.ArrayType(MESSAGE_TYPE)
CHAT_SCHEMA = T.StructType([T.StructField("messages", MESSAGES_TYPE)])
LINES_SCHEMA = "file string, line_no long, line string"


def read_jsonl_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(file, line_no, line)`` for every line of every file under ``path`` (1-based numbers)."""
    raw = (
        spark.read.text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("_split"),
            F.col("value").alias("line"),
        )
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    splits = raw.groupBy("file", "_split").agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    # One row per file split (input size / split size): measured, then broadcast if small.
    splits = checked_broadcast(splits)
    return raw.join(splits, ["file", "_split"]).select(
        "file", (F.col("_mid") - F.col("_first") + F.col("_off") + 1).alias("line_no"), "line")


def read_unnumbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(file, line)`` in one pass, for reports that do not use line numbers."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))


def list_input_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(file)`` of every input file, empty ones included (a scan skips those): the listing that Spark's
    reader makes anyway, one path per file, spelled as in the ``file`` column of the readers here."""
    files = sorted(re.sub(r"^([A-Za-z][A-Za-z0-9+.-]*):///", r"\1:/", f) for f in spark.read.text(path).inputFiles())
    return spark.createDataFrame([(f,) for f in files], "file string")


def _python_messages(text: str) -> list[dict] | None:
    """The messages of a chat line as ``json.loads`` reads it, in the shape the native parse gives."""
    def plain(v):
        return v if v is None or isinstance(v, str) else json.dumps(v, ensure_ascii=False, separators=(",", ":"))

    found = json.loads(text)["messages"]
    return [{"role": plain(m.get("role")), "content": plain(m.get("content"))} if isinstance(m, dict) else None for m in found]


def parse_chat_lines(lines: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Chat examples from validated lines: only ``ok`` lines, parsed with the chat schema
    (other fields of the object are dropped, as the trainer does).

    Every ``ok`` line gives one row with messages: the line is stripped as the gate strips it, and the
    few lines that are valid JSON but beyond the limits of the native parser are parsed by ``json.loads``
    in Arrow batches (only those go to Python)."""
    keep = keep if keep is not None else [c for c in ("file", "line_no") if c in lines.columns]
    from ..operators.validate import classify_lines

    ok = classify_lines(lines).filter(F.col("status") == STATUS_OK)
    text = py_strip("line")
    parsed = ok.select(*keep, text.alias("_text"), F.from_json(text, CHAT_SCHEMA).getField("messages").alias("messages"))
    schema = T.StructType([*(parsed.schema[k] for k in keep), T.StructField("messages", MESSAGES_TYPE)])
    kind = pa.list_(pa.struct([("role", pa.string()), ("content", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = pa.array([_python_messages(t) for t in b.column(len(keep)).to_pylist()], kind)
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], got], names=[*keep, "messages"])

    beyond = parsed.filter(F.col("messages").isNull()).drop("messages").mapInArrow(run, schema)
    return parsed.filter(F.col("messages").isNotNull()).drop("_text").unionByName(beyond)


def read_chat_jsonl(spark: SparkSession, path: str | list[str], mode: str = "FAILFAST") -> DataFrame:
    """Load chat JSONL with an explicit schema (no inference pass); one ``messages`` column."""
    return spark.read.schema(CHAT_SCHEMA).option("mode", mode).json(path)
