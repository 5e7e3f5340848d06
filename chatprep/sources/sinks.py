"""Writers: training set, history records, run manifest."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame


def write_training_set(df: DataFrame, path: str, partition_by: list[str] | None = None,
                       mode: str = "overwrite") -> None:
    """Tokenised examples (or a batch plan joined to them) as Parquet, optionally by epoch."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_history(records: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """One JSON line per conversation record; NULL fields are written as ``null`` and
    non-ASCII text is not escaped."""
    w = records.write.mode(mode).option("ignoreNullFields", False)
    (w.partitionBy(*partition_by) if partition_by else w).json(path)


# The fields of a training manifest, in order.
MANIFEST_FIELDS = ["model_name", "dataset_file", "epochs", "batch_size", "learning_rate", "max_length",
                   "gradient_accumulation_steps", "lora_r", "lora_alpha", "lora_dropout", "save_steps", "total_examples"]
MANIFEST_NAME = "training_info.json"


def run_manifest(examples: DataFrame, config: dict) -> dict:
    """The run configuration plus ``total_examples`` counted on the cluster: every field of a training
    manifest (``None`` where the configuration has none), then whatever else the configuration holds."""
    known = {**config, "total_examples": examples.count()}
    return {f: known.get(f) for f in MANIFEST_FIELDS} | {k: v for k, v in known.items() if k not in MANIFEST_FIELDS}


def write_run_manifest(examples: DataFrame, config: dict, directory: str) -> dict:
    """Write ``directory/training_info.json``, one indented JSON object that ``read_run_manifests`` finds,
    through the file system of the path (local, HDFS or an object store); returns the manifest."""
    manifest = run_manifest(examples, config)
    sc = examples.sparkSession.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{directory.rstrip('/')}/{MANIFEST_NAME}")
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path, True)
    try:
        out.write(json.dumps(manifest, indent=2, ensure_ascii=False).encode("utf-8"))
    finally:
        out.close()
    return manifest
