"""The validation gate as a staged write: raw files are read once, and nothing is visible unless the gate passes."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.json import STATUS_OK
from ..operators.ranking import checked_broadcast
from ..operators.validate import MAX_ERROR_RATE, classify_lines, require_valid, status_report
from .jsonl import list_input_files

STAGED_SCHEMA = "file string, split long, place long, status string, valid_utf8 boolean, line string"


def write_gated(spark: SparkSession, paths: str | list[str], out: str, max_error_rate: float = MAX_ERROR_RATE) -> DataFrame:
    """Validate chat JSONL while it is copied to ``out`` (Parquet, read by ``read_gated_lines``); returns the report of
    ``validation_report``, one row per file.

    One scan of the raw files writes every line's class and place, and the text of the good ones, to a folder beside
    ``out``; the counts come along with that write (an ``Observation``). If no line is bad, they decide. Otherwise the
    report is an aggregate over the written classes. ``out`` appears by one rename when every file passes; when one does not,
    or anything else fails, the staged folder is deleted and ``ValueError`` raised as by ``require_valid``.
    ``FileExistsError`` if ``out`` is there already, so no run is ever half replaced."""
    out = out.rstrip("/")
    staged = f"{out}.staged-{uuid.uuid4().hex}"
    sc = spark.sparkContext
    to, at = sc._jvm.org.apache.hadoop.fs.Path(out), sc._jvm.org.apache.hadoop.fs.Path(staged)
    fs = to.getFileSystem(sc._jsc.hadoopConfiguration())
    if fs.exists(to):
        raise FileExistsError(out)
    seen = Observation()
    raw = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("place"), F.col("value").alias("line"))
    good = F.col("status") == STATUS_OK
    lines = classify_lines(raw).withColumn("valid_utf8", F.is_valid_utf8("line"))
    lines = lines.observe(seen, F.count(F.lit(1)).alias("lines"), F.count_if(~good | ~F.col("valid_utf8")).alias("bad"))
    try:
        lines.select("file", "split", "place", "status", "valid_utf8", F.when(good, F.col("line")).alias("line")).write.parquet(staged)
        written = spark.read.schema(STAGED_SCHEMA).parquet(staged)
        report = status_report(written, max_error_rate, files=list_input_files(spark, paths)).checkpoint(eager=True)
        if seen.get["bad"]:
            require_valid(report)
        if not fs.rename(at, to):
            raise OSError(f"cannot rename {staged} to {out}")
    except BaseException:
        fs.delete(at, True)
        raise
    return report


def read_gated_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, line_no, line)`` of the good lines of ``write_gated``, with the numbers they have in their files.

    A line's number is its place within its split (kept by the write) plus the lines of earlier splits; the table of
    splits has one row each and reads two columns of numbers."""
    stored = spark.read.schema(STAGED_SCHEMA).parquet(path)
    splits = stored.groupBy("file", "split").agg(F.min("place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = checked_broadcast(splits.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    return stored.filter(F.col("status") == STATUS_OK).join(splits, ["file", "split"]).select(
        "file", (F.col("place") - F.col("_first") + F.col("_off") + 1).alias("line_no"), "line")
