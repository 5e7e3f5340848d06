"""The first undecodable byte of a file, against Python's strict decoder."""

import os
import random

import pytest
from pyspark.sql import functions as F

from chatprep.sources.encoding import first_undecodable

BOM = b"\xef\xbb\xbf"
TAIL = [b"\xff", b"\xe3\x81", b"\xed\xa0\x80", b"\xc0\xaf", b"\xf0\x9f\x99", b"\xf4\x90\x80\x80", b"\x80", b"\xf5", b"\xe3\x81\n", b"\xf0\x9f\n\x99", b"\xe3\r\n"]


def expected(data):
    try:
        data.decode("utf-8")
    except UnicodeDecodeError as e:
        return e.start, e.end - e.start, e.reason, data.count(b"\n", 0, e.start) + 1
    return None, None, None, None


def cases():
    rng = random.Random(5)
    text = "質問 ok 🙂 é\nline\r\nnext\rsame\n\n".encode()
    out = {"clean": text * 40, "empty": b"", "mark": BOM + text, "mark_only": BOM, "mark_bad": BOM + text * 3 + b"\xff" + text, "mark_end": BOM + text[:-1] + b"a\xe3",
           "no_end": text * 3 + b"last", "one": b"\xff", "cut": "é".encode()[:1], "line_feed": b"\n", "two_bad": text * 50 + b"\xff\n" + text * 50 + b"\xe3\n"}
    for i, bad in enumerate(TAIL):
        out[f"end{i}"] = text * (i + 1) + bad
        out[f"in{i}"] = text * 20 * (i + 1) + bad + text * 30
    for i in range(20):
        data = bytearray(text * rng.randrange(1, 60))
        for _ in range(rng.randrange(3)):
            data[rng.randrange(len(data))] = rng.randrange(256)
        out[f"random{i}"] = bytes(data)
    return out


@pytest.mark.parametrize("split", ["128m", "300", "64"])
def test_places_equal_python(spark, tmp_dir, split):
    data = cases()
    for name, content in data.items():
        with open(os.path.join(tmp_dir, name), "wb") as f:
            f.write(content)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = first_undecodable(spark, tmp_dir).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    got = {r["file"].rsplit("/", 1)[-1]: (r["bad_offset"], r["bad_bytes"], r["reason"], r["line_no"]) for r in rows}
    assert len(rows) == len(data)
    assert {n: got[n] for n in data} == {n: expected(c) for n, c in data.items()}


def test_clean_folder(spark, tmp_dir):
    spark.range(50).select(F.concat(F.lit("あ"), F.col("id").cast("string"))).write.text(f"{tmp_dir}/x")
    assert {r["reason"] for r in first_undecodable(spark, f"{tmp_dir}/x").collect()} == {None}
