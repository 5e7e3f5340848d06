"""Registered queries of the readers, sinks and the gate: files are written from the given tables under the
checkpoint folder and read back by the library; the SQL computes the same from the tables alone.

Files whose names matter (prompt files, manifests) are written by the tasks, each under its own name, so neither
their content nor their names pass through the driver.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import batches, tokens, validate
from ..session import checkpoint_dir, table
from ..sources import encoding, files, gate, sinks
from . import checks, fixtures

FILE_LENGTH = 64  # ids of the written training set
MODEL = "base/model"
FEW_BAD = [0, 1, 2, 4, 6, 8]  # of these, every twelfth line is bad
BAD_BYTES = [b"\xff", b"\xe3\x81", b"\xed\xa0\x80", b"\xc0\xaf", b"\xf0\x9f\x99"]


def _folder(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"


def _file_writer(root: str):
    """Of ``(dir, file, content)``, one file each as ``root/dir/file``; yields how many."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = pafs.FileSystem.from_uri(root)
        made = set()
        for batch in batches:
            for folder, file, content in zip(*(c.to_pylist() for c in batch.columns)):
                if folder not in made:
                    fs.create_dir(f"{top}/{folder}", recursive=True)
                    made.add(folder)
                staged = f"{top}/{folder}/.{file}.{uuid.uuid4().hex}"  # a repeated task replaces whole files
                with fs.open_output_stream(staged) as out:
                    out.write((content or b"") + b"\n")
                fs.move(staged, f"{top}/{folder}/{file}")
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    return write


def _written_named(rows: DataFrame, root: str) -> str:
    """Write ``(dir, file, content)``, one file each, as ``root/dir/file``; returns ``root``. A name that is null
    or comes twice is an error. The number of tasks is given: by the bytes alone all these small files fall to one."""
    dealt = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "dir", "file")
    single = dealt.groupBy("dir", "file").agg(F.max("content").cast("binary").alias("content"), F.count(F.lit(1)).alias("n"))
    fault = F.raise_error(F.concat(F.lit("not one file: "), F.coalesce(F.concat_ws("/", "dir", "file"), F.lit("null"))))
    sure = (F.col("n") == 1) & F.col("dir").isNotNull() & F.col("file").isNotNull()
    named = single.select(F.when(sure, F.col("dir")).otherwise(fault).alias("dir"), "file", "content")
    named.mapInArrow(_file_writer(root), "n long").write.format("noop").mode("overwrite").save()
    return root


def _below(root: str, c: str):
    """The path below ``root``."""
    return F.element_at(F.split(F.col(c), f"/{root.rsplit('/', 1)[-1]}/"), -1)


# --- A3: prompt files: the system prompts of the conversations, white space of several kinds around them ---------

def q_read_prompt_catalog(spark, d):
    said = table(spark, d, "conversations").filter("role = 'system'")
    rows = said.select(F.lit("prompts").alias("dir"), F.concat(F.lit("p"), F.col("conv_id"), F.lit(".txt")).alias("file"),
                       F.concat(F.lit("　 \n"), F.col("text"), F.lit("\n second line \n\n")).alias("content"))
    notes = rows.select("dir", F.concat("file", F.lit(".bak")).alias("file"), F.lit("not a prompt").alias("content"))
    root = _written_named(rows.unionByName(notes), _folder(spark, "prompts"))
    return files.read_prompt_catalog(spark, f"{root}/prompts")


# --- A4: manifests of all runs ------------------------------------------------------------------------------------

def q_read_run_manifests(spark, d):
    runs = fixtures.training_manifests(spark, d)
    body = F.to_json(F.struct(*[c for c in runs.columns if c not in ("dir", "path")]), {"pretty": "true"})
    rows = runs.select("dir", F.lit("training_info.json").alias("file"), body.alias("content"))
    other = runs.select("dir", F.lit("merge_info.json").alias("file"), F.lit('{"dtype": "auto"}').alias("content"))
    root = _written_named(rows.unionByName(other), _folder(spark, "manifests"))
    read = files.read_run_manifests(spark, root, "training_info")
    return read.select(_below(root, "dir").alias("dir"), _below(root, "path").alias("path"), "model_name", "dataset_file", "epochs",
                       "learning_rate", "lora_alpha", "total_examples")


# --- A5: a listing, of the files that Spark itself wrote, one directory per brand -----------------------------------

def q_list_artifacts(spark, d):
    root = _folder(spark, "artifacts")
    table(spark, d, "part").select("p_brand", "p_name").repartition("p_brand").write.partitionBy("p_brand").text(root)
    listed = files.list_artifacts(spark, root).filter("file LIKE 'part-%'")
    return listed.groupBy(_below(root, "dir").alias("dir")).agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("total_bytes"))


# --- A6: the training set, by epoch of its plan ----------------------------------------------------------------------

def q_write_training_set(spark, d):
    ids = tokens.encode_tokens(checks._texts(spark, d), checks._vocab(spark, d), max_length=FILE_LENGTH)
    padded = tokens.truncate_and_pad(ids, "token_ids", FILE_LENGTH).select("example_id", "input_ids", "attention_mask")
    plan = batches.plan_batches(padded, epochs=2).select("epoch", "example_id", "step")
    path = _folder(spark, "training-set")
    sinks.write_training_set(plan.join(padded, "example_id"), path, partition_by=["epoch"])
    read = spark.read.parquet(path)
    return read.select("epoch", "step", "example_id", checks._ids("input_ids").alias("input_ids"), checks._ids("attention_mask").alias("attention_mask"))


# --- A7: history records as JSON lines --------------------------------------------------------------------------------

HISTORY = ("timestamp string, conversation array<struct<role:string,content:string>>, total_messages int, "
           "model_info struct<saved_at:string,session_duration:double>")


def q_write_history(spark, d):
    from .runs import history_records

    path = _folder(spark, "history")
    sinks.write_history(history_records(checks._log(spark, d)).select("record.*"), path)
    read = spark.read.schema(HISTORY).json(path, mode="FAILFAST")
    return read.select("timestamp", "total_messages", "model_info.saved_at", "model_info.session_duration", F.to_json("conversation").alias("conversation"))


# --- A8: the manifest of a run ------------------------------------------------------------------------------------------

def q_write_run_manifest(spark, d):
    root = _folder(spark, "run")
    examples = table(spark, d, "conversations").select("conv_id").distinct()
    sinks.write_run_manifest(examples, {"model_name": MODEL, "dataset_file": "データ.jsonl", "epochs": 3, "batch_size": 2, "learning_rate": 2e-4,
                                        "max_length": 512, "gradient_accumulation_steps": 8, "note": "kept"}, root)
    return files.read_run_manifests(spark, root, "training_info").select(
        "model_name", "dataset_file", "epochs", "batch_size", "learning_rate", "max_length", "gradient_accumulation_steps", "lora_r", "total_examples")


# --- B4: what the gate says -----------------------------------------------------------------------------------------------

def q_require_valid(spark, d):
    """The gate over ten files: refused as a whole, passed without the bad ones."""
    lines = fixtures.chat_lines(spark, d, numbered=False).withColumn("file", F.concat(F.lit("f"), F.col("conv_id") % 10))
    report = validate.validation_report(lines.select("file", "line"))
    said = []
    for scope, part in (("all", report), ("good", report.filter("passed"))):
        try:
            said.append((scope, f"passed {validate.require_valid(part).count()}"))
        except ValueError as refused:
            said.append((scope, str(refused)))
    return spark.createDataFrame(said, "scope string, outcome string")


# --- B7: the byte at which a strict reader stops -------------------------------------------------------------------------

def q_first_undecodable(spark, d):
    """Thirteen files of messages in order; in most, a byte sequence that is no UTF-8 ends every seventeenth message."""
    c = table(spark, d, "conversations").select("conv_id", "turn", "text", (F.col("conv_id") % 13).alias("f"))
    kinds = F.array(*[F.lit(bytearray(b)) for b in BAD_BYTES])
    bad = F.when((F.col("f") % 4 != 0) & ((F.col("conv_id") * 31 + F.col("turn")) % 17 == F.col("f")),
                 F.get(kinds, (F.col("f") % len(BAD_BYTES)).cast("int"))).otherwise(F.lit(b""))
    lines = c.select("f", "conv_id", "turn", F.concat(F.coalesce("text", F.lit("")).cast("binary"), bad).cast("string").alias("line"))
    root = _folder(spark, "undecodable")
    # one file per f, its lines in order
    lines.repartition("f").sortWithinPartitions("f", "conv_id", "turn").select("f", "line").write.partitionBy("f").text(root)
    found = encoding.first_undecodable(spark, root)
    return found.select(F.regexp_extract("file", "/f=([0-9]+)/", 1).cast("long").alias("f"), "bad_offset", "bad_bytes", "reason", "line_no")


# --- B3, B4: the gate as a staged write ------------------------------------------------------------------------------------

def _gated(spark, d, rests: list[int]) -> tuple[str, str]:
    """Five files of the dirty lines with ``conv_id % 10`` in ``rests``, sent through the gate: where to, and what it said."""
    root = _folder(spark, "gate")
    lines = fixtures.chat_lines(spark, d, numbered=False).filter((F.col("conv_id") % 10).isin(rests))
    lines = lines.select(F.floor(F.col("conv_id") / 10 % 5).alias("f"), "conv_id", "line")
    lines.repartition("f").sortWithinPartitions("f", "conv_id").select("f", "line").write.partitionBy("f").text(f"{root}/raw")
    try:
        report = gate.write_gated(spark, f"{root}/raw", f"{root}/lines")
    except ValueError as refused:
        return f"{root}/lines", re.sub(r"\S*/(f=[0-9]+)/[^:]*", r"\1", str(refused))
    return f"{root}/lines", f"passed {report.count()} file(s)"


def q_write_gated(spark, d):
    """What readers see: the good lines with their numbers, and none at all if a file was refused."""
    path, said = _gated(spark, d, FEW_BAD)
    if not said.startswith("passed"):
        return spark.createDataFrame([], "file string, line_no long, line string")
    return gate.read_gated_lines(spark, path).withColumn("file", F.regexp_extract("file", "/(f=[0-9]+)/", 1))


def q_write_gated_refused(spark, d):
    path, said = _gated(spark, d, list(range(10)))
    sc = spark.sparkContext
    parent = sc._jvm.org.apache.hadoop.fs.Path(path).getParent()
    left = parent.getFileSystem(sc._jsc.hadoopConfiguration()).listStatus(parent)
    return spark.createDataFrame([(said, ",".join(sorted(s.getPath().getName() for s in left)))], "outcome string, left_behind string")


QUERIES = {"read_prompt_catalog": q_read_prompt_catalog, "read_run_manifests": q_read_run_manifests, "list_artifacts": q_list_artifacts,
           "write_training_set": q_write_training_set, "write_history": q_write_history, "write_run_manifest": q_write_run_manifest,
           "require_valid": q_require_valid, "first_undecodable": q_first_undecodable,
           "write_gated": q_write_gated, "write_gated_refused": q_write_gated_refused}

def _gate_sql(rests: list[int]) -> str:
    return "WITH " + checks.CHAT_LINES + ", " + checks.STATUS + f""",
mine AS (SELECT 'f=' || conv_id // 10 % 5 AS f, conv_id, line, status FROM classified
  JOIN (SELECT conv_id, line_no AS k FROM lines) ON k = line_no WHERE conv_id % 10 IN ({', '.join(map(str, rests))})),
numbered AS (SELECT *, row_number() OVER (PARTITION BY f ORDER BY conv_id) AS line_no FROM mine),
counted AS (SELECT f, count(*) AS n, count(*) FILTER (WHERE status <> 'ok') AS errors FROM mine GROUP BY f),
refused AS (SELECT * FROM counted WHERE errors > n * 0.1)
"""


_SAID = "chr(12288) || ' ' || chr(10) || text || chr(10) || ' second line' || chr(8195) || chr(10) || chr(10) || chr(10)"

ORACLE_SQL = {
    "read_prompt_catalog": f"""SELECT 'p' || conv_id AS name, {checks._strip(_SAID)} AS prompt FROM conversations WHERE role = 'system'""",
    "read_run_manifests": "WITH " + checks.LISTING + """
SELECT dir, dir || '/training_info.json' AS path, 'base/' || lower(replace(p_brand, '#', '')) AS model_name, 'data/fine_tune_data.jsonl' AS dataset_file,
  CAST(p_size % 5 + 1 AS INTEGER) AS epochs, p_retailprice / 1e7 AS learning_rate, CAST(32 AS INTEGER) AS lora_alpha, p_partkey AS total_examples
FROM listing WHERE file = 'training_info.json'""",
    "list_artifacts": """SELECT 'p_brand=' || replace(p_brand, '#', '%23') AS dir, CAST(1 AS BIGINT) AS n_files, CAST(sum(strlen(p_name) + 1) AS BIGINT) AS total_bytes
FROM part GROUP BY p_brand""",
    "write_training_set": checks._plan_sql(2).rstrip() + ", " + checks.TEXTS + ", " + checks._vocab_sql("texts") + ", " + checks._encode_sql("texts", FILE_LENGTH) + f"""
SELECT p.epoch, p.position // 16 AS step, example_id, {checks._pad_sql('ids', FILE_LENGTH, 0)} AS input_ids, {checks._mask_sql('ids', FILE_LENGTH)} AS attention_mask
FROM placed p JOIN encoded e USING (example_id) WHERE p.position // 2 < p.n // 2""",
    "write_history": checks.ORACLE_SQL["history_records"].replace("SELECT r.sid,", "SELECT"),
    "write_run_manifest": f"""SELECT '{MODEL}' AS model_name, 'データ.jsonl' AS dataset_file, CAST(3 AS INTEGER) AS epochs, CAST(2 AS INTEGER) AS batch_size,
  CAST(0.0002 AS DOUBLE) AS learning_rate, CAST(512 AS INTEGER) AS max_length, CAST(8 AS INTEGER) AS gradient_accumulation_steps,
  CAST(NULL AS INTEGER) AS lora_r, count(DISTINCT conv_id) AS total_examples FROM conversations""",
    "require_valid": """WITH c AS (SELECT DISTINCT conv_id FROM conversations),
f AS (SELECT 'f' || conv_id % 10 AS file, count(*) AS n, count(*) FILTER (WHERE conv_id % 10 IN (3, 5, 7, 9) OR conv_id % 20 = 6) AS errors
  FROM c GROUP BY ALL),
g AS (SELECT *, errors > n * 0.1 AS bad FROM f)
SELECT 'all' AS scope, count(*) || ' file(s) refused: ' || string_agg(file || ': ' || errors || ' of ' || n || ' lines are bad', '; ' ORDER BY file) AS outcome FROM g WHERE bad
UNION ALL SELECT 'good', 'passed ' || count(*) FROM g WHERE NOT bad""",
    "first_undecodable": """WITH c AS (SELECT conv_id % 13 AS f, conv_id, turn, coalesce(text, '') AS t,
    conv_id % 13 % 4 <> 0 AND (conv_id * 31 + turn) % 17 = conv_id % 13 AS bad FROM conversations),
p AS (SELECT f, t, bad, sum(strlen(t) + 1) OVER w - 1 AS place, sum(length(t) - length(replace(t, chr(10), '')) + 1) OVER w AS line_no,
    count(*) FILTER (WHERE bad) OVER w AS k FROM c WINDOW w AS (PARTITION BY f ORDER BY conv_id, turn ROWS UNBOUNDED PRECEDING)),
h AS (SELECT f, place, line_no FROM p WHERE bad AND k = 1)
SELECT f, CAST(place AS BIGINT) AS bad_offset, CAST(CASE WHEN place IS NULL THEN NULL ELSE ([1, 2, 1, 1, 3])[f % 5 + 1] END AS INTEGER) AS bad_bytes,
  CASE WHEN place IS NULL THEN NULL WHEN f % 5 IN (0, 3) THEN 'invalid start byte' ELSE 'invalid continuation byte' END AS reason,
  CAST(line_no AS BIGINT) AS line_no
FROM (SELECT DISTINCT f FROM c) LEFT JOIN h USING (f)""",
    "write_gated": _gate_sql(FEW_BAD) + """SELECT f AS file, line_no, line FROM numbered
WHERE status = 'ok' AND NOT EXISTS (SELECT 1 FROM refused)""",
    "write_gated_refused": _gate_sql(list(range(10))) + """SELECT CASE WHEN count(*) = 0 THEN 'passed ' || (SELECT count(*) FROM counted) || ' file(s)'
  ELSE count(*) || ' file(s) refused: ' || string_agg(f || ': ' || errors || ' of ' || n || ' lines are bad', '; ' ORDER BY f) END AS outcome,
  CASE WHEN count(*) = 0 THEN 'lines,raw' ELSE 'raw' END AS left_behind FROM refused""",
}
