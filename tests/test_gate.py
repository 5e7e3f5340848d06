"""The gate as a staged write: lines and numbers as the reader gives them, nothing left of a refused run."""

import os

import pytest

from chatprep.operators import validate
from chatprep.sources import list_input_files, read_gated_lines, read_jsonl_lines, write_gated

GOOD = '{"messages": [{"role": "user", "content": "質問 %d"}]}\n'


def put(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "wb") as f:
        f.write(b"".join(x if isinstance(x, bytes) else x.encode() for x in lines))


@pytest.mark.parametrize("split", ["128m", "700"])
def test_lines_numbers_and_report(spark, tmp_dir, split):
    raw, out = f"{tmp_dir}/raw", f"{tmp_dir}/run/lines"
    put(raw, "a.jsonl", *[GOOD % i if i % 20 else "broken\n" for i in range(1, 101)])
    put(raw, "b.jsonl", *[GOOD % i for i in range(7)], GOOD.strip() % 8)
    put(raw, "empty.jsonl")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        report = write_gated(spark, raw, out)
        lines = read_jsonl_lines(spark, raw)
        wanted = validate.validation_report(lines, files=list_input_files(spark, raw))
        assert sorted(map(tuple, report.collect()), key=str) == sorted(map(tuple, wanted.select(report.columns).collect()), key=str)
        good = validate.classify_lines(lines).filter("status = 'ok'").select("file", "line_no", "line")
        assert sorted(map(tuple, read_gated_lines(spark, out).collect())) == sorted(map(tuple, good.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert os.listdir(f"{tmp_dir}/run") == ["lines"]
    with pytest.raises(FileExistsError):
        write_gated(spark, raw, out)
    assert read_gated_lines(spark, out).count() == 95 + 8


@pytest.mark.parametrize("bad,said", [([b"broken\n"] * 12, "12 of 112 lines are bad"), ([b"\xff\n"], "1 lines are not valid UTF-8")])
def test_nothing_is_left_of_a_refused_run(spark, tmp_dir, bad, said):
    raw = f"{tmp_dir}/raw"
    put(raw, "a.jsonl", *[GOOD % i for i in range(100)], *bad)
    put(raw, "fine.jsonl", GOOD % 1)
    os.makedirs(f"{tmp_dir}/run")
    with pytest.raises(ValueError, match=said):
        write_gated(spark, raw, f"{tmp_dir}/run/lines")
    assert os.listdir(f"{tmp_dir}/run") == []


def test_empty_input(spark, tmp_dir):
    put(f"{tmp_dir}/raw", "empty.jsonl")
    assert [r["passed"] for r in write_gated(spark, f"{tmp_dir}/raw", f"{tmp_dir}/lines").collect()] == [True]
    assert read_gated_lines(spark, f"{tmp_dir}/lines").count() == 0
