"""Many small files are written and read by as many tasks as a shuffle has, neither by one nor by one per few files."""

import json
import os

import pytest

from chatprep import sources
from chatprep.plans.checks_files import _written_named

N = 120


@pytest.fixture()
def few_files_a_task(spark):
    spark.conf.set("spark.sql.files.openCostInBytes", str(64 << 20))  # two files fill a task of the reader
    yield
    spark.conf.unset("spark.sql.files.openCostInBytes")


def _files(folder: str, name, content) -> str:
    for i in range(N):
        os.makedirs(os.path.dirname(f"{folder}/{name(i)}"), exist_ok=True)
        with open(f"{folder}/{name(i)}", "w", encoding="utf-8") as f:
            f.write(content(i))
    return folder


def _tasks(df) -> int:
    return df.rdd.getNumPartitions()


def test_prompts_are_read_in_few_tasks(spark, tmp_dir, few_files_a_task):
    _files(tmp_dir, lambda i: f"p{i}.txt.bak", lambda i: "not a prompt")
    cat = sources.read_prompt_catalog(spark, _files(tmp_dir, lambda i: f"p{i}.txt", lambda i: f"　 \nsaid {i}\nü\n\n"))
    assert {(r.name, r.prompt) for r in cat.collect()} == {(f"p{i}", f"said {i}\nü") for i in range(N)}
    assert cat.count() == N
    assert _tasks(cat) <= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_manifests_and_listings_are_read_in_few_tasks(spark, tmp_dir, few_files_a_task):
    _files(tmp_dir, lambda i: f"r{i}/training_info.json", lambda i: json.dumps({"model_name": f"m{i}", "epochs": i}, indent=2))
    read, listed = sources.read_run_manifests(spark, tmp_dir), sources.list_artifacts(spark, tmp_dir)
    assert sorted((r.model_name, r.epochs, os.path.basename(r.dir)) for r in read.collect()) == sorted((f"m{i}", i, f"r{i}") for i in range(N))
    assert sorted(os.path.basename(r.dir) for r in listed.collect()) == sorted(f"r{i}" for i in range(N))
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert _tasks(read) <= most and _tasks(listed) <= most


def test_named_files_are_written_by_many_tasks(spark, tmp_dir):
    rows = spark.createDataFrame([("d", f"f{i}.txt", str(i)) for i in range(N)], "dir string, file string, content string")
    sc = spark.sparkContext
    sc.setJobGroup("named files", "")
    try:
        _written_named(rows, f"file:{tmp_dir}/out")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    said = sc.statusTracker()
    stages = [s for j in said.getJobIdsForGroup("named files") for s in said.getJobInfo(j).stageIds]
    last = said.getStageInfo(max(stages))
    assert last.numTasks == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(os.listdir(f"{tmp_dir}/out/d")) == sorted(f"f{i}.txt" for i in range(N))


def test_prompt_bytes_are_kept(spark, tmp_dir):
    said = {"blank": b" \n\xe3\x80\x80", "mark": b"\xef\xbb\xbfBe kind.\r\n", "broken": b" a\xff\x00b\n", "ü": b"x", "empty": b""}
    for name, content in said.items():
        with open(f"{tmp_dir}/{name}.txt", "wb") as f:
            f.write(content)
    got = sources.read_prompt_catalog(spark, tmp_dir).selectExpr("name", "hex(prompt) AS prompt")
    assert {r.name: bytes.fromhex(r.prompt) for r in got.collect()} == {
        "blank": b"", "mark": b"\xef\xbb\xbfBe kind.", "broken": b"a\xff\x00b", "ü": b"x"}  # Spark lists no empty file
