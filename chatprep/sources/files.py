"""Readers for the small files around a run: prompt files, run manifests, artifact listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import py_strip

TRAINING_INFO_SCHEMA = T.StructType([
    T.StructField("model_name", T.StringType()),
    T.StructField("dataset_file", T.StringType()),
    T.StructField("epochs", T.IntegerType()),
    T.StructField("batch_size", T.IntegerType()),
    T.StructField("learning_rate", T.DoubleType()),
    T.StructField("max_length", T.IntegerType()),
    T.StructField("gradient_accumulation_steps", T.IntegerType()),
    T.StructField("lora_r", T.IntegerType()),
    T.StructField("lora_alpha", T.IntegerType()),
    T.StructField("lora_dropout", T.DoubleType()),
    T.StructField("save_steps", T.IntegerType()),
    T.StructField("total_examples", T.LongType()),
])

MERGE_INFO_SCHEMA = T.StructType([
    T.StructField("base_model", T.StringType()),
    T.StructField("lora_adapter", T.StringType()),
    T.StructField("merged_at", T.StringType()),
    T.StructField("dtype", T.StringType()),
    T.StructField("device_map", T.StringType()),
    T.StructField("safe_serialization", T.BooleanType()),
    T.StructField("training_info", TRAINING_INFO_SCHEMA),
])

ADAPTER_CONFIG_SCHEMA = T.StructType([
    T.StructField("alpha", T.IntegerType()),
    T.StructField("lora_alpha", T.IntegerType()),
    T.StructField("base_model_name_or_path", T.StringType()),
    T.StructField("bias", T.StringType()),
    T.StructField("fan_in_fan_out", T.BooleanType()),
    T.StructField("inference_mode", T.BooleanType()),
    T.StructField("init_lora_weights", T.BooleanType()),
    T.StructField("lora_dropout", T.DoubleType()),
    T.StructField("peft_type", T.StringType()),
    T.StructField("r", T.IntegerType()),
    T.StructField("rank_pattern", T.MapType(T.StringType(), T.IntegerType())),
    T.StructField("target_modules", T.ArrayType(T.StringType())),
    T.StructField("task_type", T.StringType()),
])

MANIFEST_KINDS = {
    "training_info": TRAINING_INFO_SCHEMA,
    "merge_info": MERGE_INFO_SCHEMA,
    "adapter_config": ADAPTER_CONFIG_SCHEMA,
}


def _parent_dir(path_col):
    return F.regexp_extract(path_col, r"^(.*)/[^/]*$", 1)


def _in_few_tasks(read: DataFrame) -> DataFrame:
    """At most as many tasks as a shuffle of the session. Spark counts 4 MiB for every file it opens, so a task takes
    32 small files at most, and starting the task takes longer than reading them."""
    return read.coalesce(int(read.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def read_prompt_catalog(spark: SparkSession, directory: str) -> DataFrame:
    """``(name, prompt)`` for every ``*.txt`` file in ``directory``; the whole file, stripped.
    Read as bytes: the whole-text reader copies the Hadoop configuration for every file, one task at a time."""
    return _in_few_tasks(
        spark.read.format("binaryFile").load(directory, pathGlobFilter="*.txt")
        .select(
            F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.txt$", 1).alias("name"),
            py_strip(F.col("content").cast("string")).alias("prompt"),
        )
    )


def read_run_manifests(spark: SparkSession, root: str, kind: str = "training_info") -> DataFrame:
    """Every ``<kind>.json`` below ``root`` (one pretty-printed JSON object per file) with the
    directory it sits in."""
    schema = MANIFEST_KINDS[kind]
    return _in_few_tasks(
        spark.read.schema(schema)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"{kind}.json")
        .json(root)
        .withColumn("path", F.col("_metadata.file_path"))
        .withColumn("dir", _parent_dir(F.col("_metadata.file_path")))
    )


def list_artifacts(spark: SparkSession, root: str) -> DataFrame:
    """``(dir, file, path, length, modificationTime)`` of every file below ``root``.
    The file content column is never selected, so it is never read."""
    return _in_few_tasks(
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        .select("path", "length", "modificationTime")
        .withColumn("dir", _parent_dir(F.col("path")))
        .withColumn("file", F.regexp_extract(F.col("path"), r"([^/]*)$", 1))
        .select("dir", "file", "path", "length", "modificationTime")
    )
