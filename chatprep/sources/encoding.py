"""Where a file stops being UTF-8: what a strict reader would raise, without decoding a file in one piece."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ranking import checked_broadcast
from .jsonl import list_input_files

PLACE_SCHEMA = "file string, bad_offset long, bad_bytes int, reason string, line_no long"


def first_undecodable(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(file, bad_offset, bad_bytes, reason, line_no)`` of every file: the byte offset, length and reason of the first
    sequence that is no UTF-8, as in Python's ``UnicodeDecodeError`` for the whole file (``start``, ``end - start``,
    ``reason``), and the number of the ``\\n``-ended line it begins in. All NULL where a file can be decoded; empty
    files too. For uncompressed files.

    No sequence of UTF-8 goes on over a line feed, so lines are decoded apart, by the built-in check, in the splits that
    Spark reads. One scan gives each split its bytes, lines and first bad line; byte offsets of splits are sums over
    that table (one row per split). A second scan of the splits that hold a file's first bad line, none if all files are
    clean, adds up the lines before it. Python sees one line per bad file. A byte order mark, which the reader leaves
    out, shows as the difference between a file's size and its lines."""
    raw = (
        spark.read.text(path, lineSep="\n")
        .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_split"),
                F.col("_metadata.file_size").alias("_size"), F.col("value").alias("line"))
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    length = F.octet_length("line").cast("long") + 1
    splits = checked_broadcast(raw.groupBy("file", "_split").agg(
        F.max("_size").alias("_size"), F.sum(length).alias("_bytes"), F.count(F.lit(1)).alias("_lines"),
        F.min(F.when(~F.is_valid_utf8("line"), F.col("_mid"))).alias("_bad")))
    whole = Window.partitionBy("file")
    before = whole.orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    placed = splits.select(
        "*", F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_off"), F.coalesce(F.sum("_lines").over(before), F.lit(0)).alias("_line"),
        # without a mark, the lines with a line feed each are as long as the file, or longer by the one it does not end in
        F.when(F.sum("_bytes").over(whole) < F.col("_size") - 1, 3).otherwise(0).alias("_mark"),
        F.min(F.when(F.col("_bad").isNotNull(), F.col("_split"))).over(whole).alias("_first"))
    first = checked_broadcast(placed.filter("_split = _first").select("file", "_split", "_size", "_bad", "_off", "_line", "_mark"))
    near = raw.drop("_size").join(first, ["file", "_split"]).filter("_mid <= _bad")
    earlier = F.col("_mid") < F.col("_bad")
    found = near.groupBy("file", "_size", (F.col("_off") + F.col("_mark")).alias("_off"), "_line").agg(
        F.coalesce(F.sum(F.when(earlier, length)), F.lit(0)).alias("_in"), F.count_if(earlier).alias("_n"),
        F.max(F.when(~earlier, F.col("line").cast("binary"))).alias("line"))
    found = found.select("file", F.col("_size").alias("size"), (F.col("_off") + F.col("_in")).alias("start"), (F.col("_line") + F.col("_n") + 1).alias("line_no"), "line")
    return list_input_files(spark, path).join(found.mapInPandas(_places, PLACE_SCHEMA), "file", "left")


def _places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The error of each line, which ends in a line feed unless it ends the file."""
    for batch in batches:
        rows = []
        for r in batch.itertuples():
            try:
                (r.line if r.start + len(r.line) >= r.size else r.line + b"\n").decode("utf-8")
            except UnicodeDecodeError as error:
                rows.append((r.file, r.start + error.start, error.end - error.start, error.reason, r.line_no))
        yield pd.DataFrame(rows, columns=["file", "bad_offset", "bad_bytes", "reason", "line_no"])
