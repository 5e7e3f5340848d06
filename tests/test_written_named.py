"""Files of given names are written by the tasks: nothing else is left, a name stands for one row."""

import os

import pytest

from chatprep.plans.checks_files import _written_named

ROWS = "dir string, file string, content string"


def test_files_are_whole_and_alone(spark, tmp_dir):
    rows = [(f"runs/r{i % 50}", f"f{i}.json", None if i == 3 else f"{{\n é{i}}}") for i in range(200)] + [("prompts", "a b#%ü.txt", "　x\n")]
    root = _written_named(spark.createDataFrame(rows, ROWS).repartition(5), f"file:{tmp_dir}/out")
    found = {}
    for folder, _, files in os.walk(f"{tmp_dir}/out"):
        for name in files:
            with open(os.path.join(folder, name), encoding="utf-8", newline="") as f:
                found[os.path.relpath(folder, f"{tmp_dir}/out"), name] = f.read()
    assert root == f"file:{tmp_dir}/out"
    assert found == {(d, f): (c or "") + "\n" for d, f, c in rows}


@pytest.mark.parametrize("bad", [("d", "f.txt", "again"), ("d", None, "x"), (None, "f.txt", "x")])
def test_a_name_that_is_null_or_comes_twice_is_refused(spark, tmp_dir, bad):
    with pytest.raises(Exception, match="not one file"):
        _written_named(spark.createDataFrame([("d", "f.txt", "x"), ("e", "f.txt", "y"), bad], ROWS), f"{tmp_dir}/out")
