"""The two data paths of a fine-tuning project as single calls.

``prepare_training_run``: chat JSONL -> validation gate -> fixed-length examples -> per-epoch
batch plan -> run manifest. ``export_histories``: session event log -> final conversations ->
history records (one JSON line per session worth saving).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.batches import (
    DEFAULT_ACCUMULATION,
    DEFAULT_BATCH_SIZE,
    DEFAULT_EPOCHS,
    DEFAULT_SEED,
    plan_batches,
)
from ..operators.messages import FALLBACK_SYSTEM_PROMPT
from ..operators.sessions import conversation_record, final_records
from ..operators.tokens import DEFAULT_MAX_LENGTH
from ..operators.validate import require_examples
from ..session import checkpoint_dir
from ..sources.gate import read_gated_lines, write_gated
from ..sources.sinks import write_history, write_run_manifest, write_training_set
from .training import training_examples_from_lines


def prepare_training_run(spark: SparkSession, paths: str | list[str], out_dir: str, model_name: str = "",
                         max_length: int = DEFAULT_MAX_LENGTH, max_vocab: int | None = None,
                         epochs: int = DEFAULT_EPOCHS, batch_size: int = DEFAULT_BATCH_SIZE,
                         accumulation: int = DEFAULT_ACCUMULATION, seed: int = DEFAULT_SEED,
                         extra_config: dict | None = None) -> dict:
    """Writes ``out_dir/lines`` (the good lines, see ``write_gated``), ``out_dir/examples`` (Parquet, keyed by file and line number), ``out_dir/plan`` (Parquet,
    partitioned by epoch) and ``out_dir/training_info.json``; returns file, line, error and example counts.

    Raises ``ValueError`` when a file fails the gate (nothing is left behind then) or no example is left, and
    ``FileExistsError`` if the lines of an earlier run are in ``out_dir``. The raw files are read once, by the
    staged write of the gate; the examples are written once and read back, so nothing is computed twice (and a lost
    executor does not send the job back to the raw files)."""
    out = out_dir.rstrip("/")
    checkpoint_dir(spark)
    report = write_gated(spark, paths, f"{out}/lines")
    lines = read_gated_lines(spark, f"{out}/lines")
    # one summary row for the caller (the report itself has one row per file)
    totals = report.agg(F.count(F.lit(1)).alias("files"), F.sum("line_count").alias("lines"),
                        F.sum("error_count").alias("errors")).first().asDict()
    write_training_set(training_examples_from_lines(lines, max_length=max_length, max_vocab=max_vocab),
                       f"{out}/examples")
    examples = require_examples(spark.read.parquet(f"{out}/examples"))
    plan = plan_batches(examples, id_col=["file", "line_no"], batch_size=batch_size, accumulation=accumulation, epochs=epochs, seed=seed)
    write_training_set(plan, f"{out}/plan", partition_by=["epoch"])
    config = {
        "model_name": model_name,
        "dataset_file": paths if isinstance(paths, str) else ",".join(paths),
        "epochs": epochs, "batch_size": batch_size, "max_length": max_length,
        "gradient_accumulation_steps": accumulation, **(extra_config or {}),
    }
    manifest = write_run_manifest(examples, config, out)
    return {**totals, "total_examples": manifest["total_examples"], "out_dir": out}


def history_records(log: DataFrame, system_prompt: str = FALLBACK_SYSTEM_PROMPT, base: str = "history",
                    requested: str | None = None) -> DataFrame:
    """One history record per session worth saving (more than the system prompt, or a path asked for in
    the log's column ``requested``), timestamped with the session's last event, ``saved_at`` the path asked
    for or the default timestamped one, and ``session_duration`` filled in."""
    final = final_records(log, system_prompt, base, requested)
    final = final.withColumn("duration", F.expr("timestampdiff(MICROSECOND, start_ts, end_ts)") / F.lit(1e6))
    rec = conversation_record(final, ts="end_ts", saved_at="path", duration="duration")
    return rec.select("sid", "record")


def export_histories(log: DataFrame, out_dir: str, system_prompt: str = FALLBACK_SYSTEM_PROMPT,
                     requested: str | None = None) -> None:
    """Write the history records as JSON lines (NULL fields kept, non-ASCII not escaped), the records of
    each path in a directory of their own: ``out_dir/saved_at=<path, URL-encoded>/``."""
    records = history_records(log, system_prompt, requested=requested)
    write_history(records.select("record.*", F.url_encode("record.model_info.saved_at").alias("saved_at")), out_dir, partition_by=["saved_at"])
