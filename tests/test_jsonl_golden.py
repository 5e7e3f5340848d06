"""Hand-written JSONL files: line numbers, line classes, the 10 % gate, the checker's first error.

Expected values come from our own small stdlib model of the trainer and the checker
(``expected_*`` below), never from the original scripts.
"""

import io
import json
import os

import pytest
from pyspark.sql import functions as F

from chatprep.functions.json import python_status
from chatprep.operators import validate
from chatprep.sources import list_input_files, read_jsonl_lines

GOLDEN = [
    "",
    "   ",
    "[1]",
    '"messages"',
    '["messages"]',
    '"no key here"',
    "123",
    "null",
    "true",
    "{'a':1}",
    '{"a":NaN}',
    '{"messages":[],"x":Infinity}',
    '{"a":1,"a":2}',
    '{"messages":1,"messages":[]}',
    '{"a":01}',
    '{"a":1,}',
    '{"a":"x\ty"}',
    '{"messages":null}',
    '{"Messages":[]}',
    "1,2",
    "1],[2",
    '{"messages":[{"role":"user","content":"hi"}]}',
    '  {"messages":[]}  ',
    '　{"messages":[]}',
    '{"messages":"x"}',
    '{"messages":{"role":"user"}}',
    '{"msgs":[]}',
    '{"messages":[]} x',
]


def expected_lines(raw: bytes):
    """Python's text-mode iteration (universal newlines) over a UTF-8 file."""
    text = raw.decode("utf-8")
    return [ln.rstrip("\r\n") for ln in io.StringIO(text, newline=None)]


def expected_status(line):
    return python_status(line.strip())


def write(tmp_dir, name, data: bytes):
    p = os.path.join(tmp_dir, name)
    with open(p, "wb") as f:
        f.write(data)
    return p


def test_line_classes_match_python(spark, tmp_dir):
    raw = ("\n".join(GOLDEN) + "\n").encode("utf-8")
    p = write(tmp_dir, "golden.jsonl", raw)
    got = validate.classify_lines(read_jsonl_lines(spark, p)).orderBy("line_no").collect()
    exp = expected_lines(raw)
    assert [r.line_no for r in got] == list(range(1, len(exp) + 1))
    assert [r.line for r in got] == exp
    for r, line in zip(got, exp):
        want = expected_status(line)
        assert r.status == want, (line, r.status, want)


def test_line_endings_crlf_and_cr(spark, tmp_dir):
    raw = b'{"messages":[]}\r\n{"a":1}\r{"messages":"x"}\n\n[1]'
    p = write(tmp_dir, "ends.jsonl", raw)
    got = read_jsonl_lines(spark, p).orderBy("line_no").collect()
    assert [r.line for r in got] == expected_lines(raw)
    assert [r.line_no for r in got] == [1, 2, 3, 4, 5]


def test_is_valid_json_checker_semantics(spark):
    from chatprep.functions.json import is_valid_json

    df = spark.createDataFrame([(s,) for s in GOLDEN], "line string")
    got = df.select("line", is_valid_json("line").alias("v")).collect()
    for r in got:
        try:
            json.loads(r.line)
            ok = True
        except ValueError:
            ok = False
        assert r.v == ok, r.line


def test_gate_exactly_ten_percent_passes(spark, tmp_dir):
    good = '{"messages":[{"role":"user","content":"a"}]}'
    p10 = write(tmp_dir, "ten.jsonl", ("\n".join([good] * 27 + ["bad"] * 3) + "\n").encode())
    p11 = write(tmp_dir, "eleven.jsonl", ("\n".join([good] * 26 + ["bad"] * 4) + "\n").encode())
    rep = {os.path.basename(r.file): r for r in validate.validation_report(read_jsonl_lines(spark, [p10, p11])).collect()}
    assert rep["ten.jsonl"].line_count == 30 and rep["ten.jsonl"].error_count == 3
    assert rep["ten.jsonl"].passed is True
    assert rep["eleven.jsonl"].passed is False
    with pytest.raises(ValueError, match="lines are bad"):
        validate.require_valid(validate.validation_report(read_jsonl_lines(spark, p11)))
    validate.require_valid(validate.validation_report(read_jsonl_lines(spark, p10)))


def test_empty_file_passes(spark, tmp_dir):
    p = write(tmp_dir, "empty.jsonl", b"")
    p2 = write(tmp_dir, "one.jsonl", b'{"messages":[]}\nx\n')
    files = list_input_files(spark, [p, p2])
    lines = read_jsonl_lines(spark, [p, p2])
    rep = {os.path.basename(r.file): r for r in validate.validation_report(lines, files=files).collect()}
    assert (rep["empty.jsonl"].line_count, rep["empty.jsonl"].error_count, rep["empty.jsonl"].passed) == (0, 0, True)
    assert rep["one.jsonl"].line_count == 2 and rep["one.jsonl"].passed is False
    first = {os.path.basename(r.file): r for r in validate.first_invalid_line(lines, files=files).collect()}
    assert first["empty.jsonl"].lines_checked == 0 and first["empty.jsonl"].first_bad_line is None
    assert {r.line_count for r in validate.encoding_report(lines, files=files).collect()} == {0, 2}
    validate.require_valid(validate.validation_report(read_jsonl_lines(spark, p), files=files.filter(F.col("file").endswith("empty.jsonl"))))


def test_all_failed_files_are_counted(spark, tmp_dir):
    ps = [write(tmp_dir, f"bad{i:02d}.jsonl", b"x\n") for i in range(25)]
    with pytest.raises(ValueError, match=r"25 file\(s\) refused: .*bad00.jsonl: 1 of 1 lines are bad.*; \.\.\.$"):
        validate.require_valid(validate.validation_report(read_jsonl_lines(spark, ps)))


def test_no_ok_line_is_lost(spark, tmp_dir):
    """In a session without any of the library's settings: lines in = examples + refused lines, for lines
    led by every kind of white space, with repeated keys, and beyond the limits of the JVM parsers."""
    from chatprep.plans.training import training_examples_from_lines
    from chatprep.sources.jsonl import parse_chat_lines

    plain = spark.newSession()
    plain.conf.unset("spark.sql.variant.allowDuplicateKeys")
    m = '"messages":[{"role":"user","content":"%s"}]'
    good = [w + "{" + m % "a" + "}" + w for w in ("", " ", "\u000b", "\u000c", "\u001f", "\u0085", "\u00a0", "\u3000")]
    good += ["{" + m % "dup" + ',"a":1,"a":2}', "{" + m % "num" + ',"n":' + "1" * 1100 + "}", "{" + m % "deep" + ',"n":' + "[" * 1200 + "]" * 1200 + "}",
             "{" + m % ("z" * 25_000_000) + "}", '{"messages":[{"role":"user","content":7}]}', '{"messages":[1,{"role":"user","content":"x"}]}', '{"messages":[]}']
    bad = ["{" + m % "cut" + "", "[" * 1200, "1" * 1100 + "x", '{"messages":"x"}', "123", '"messages"', "[1]", ""]
    path = write(tmp_dir, "mixed.jsonl", ("\n".join(good + bad) + "\n").encode())
    lines = read_jsonl_lines(plain, path)
    status = {r.line_no: r.status for r in validate.classify_lines(lines).collect()}
    assert [status[i + 1] for i in range(len(good + bad))] == [python_status(x.strip()) for x in good + bad]
    parsed = parse_chat_lines(lines).collect()
    assert sorted(r.line_no for r in parsed) == list(range(1, len(good) + 1))
    by_no = {r.line_no: r.messages for r in parsed}
    assert len(by_no[12][0].content) == 25_000_000 and by_no[13][0].content == "7" and by_no[14][1].content == "x"
    examples = training_examples_from_lines(lines, max_length=8).collect()
    refused = validate.error_report(lines).count()
    # a message that is no object cannot be rendered; everything else becomes an example
    assert len(examples) + 1 + refused == len(good + bad) and len({(r.file, r.line_no) for r in examples}) == len(examples)


def test_invalid_utf8_fails_gate(spark, tmp_dir):
    raw = b'{"messages":[]}\n{"messages":[{"role":"user","content":"\xff\xfe"}]}\n'
    p = write(tmp_dir, "bad_utf8.jsonl", raw)
    lines = read_jsonl_lines(spark, p)
    enc = validate.encoding_report(lines).collect()[0]
    assert enc.invalid_utf8_lines == 1 and enc.passed is False
    rep = validate.validation_report(lines).collect()[0]
    assert rep.passed is False
    with pytest.raises(ValueError, match="UTF-8"):
        validate.require_valid(validate.validation_report(lines))


def test_bom_is_dropped_by_reader(spark, tmp_dir):
    # Documented difference: Spark's text reader drops a leading UTF-8 BOM.
    p = write(tmp_dir, "bom.jsonl", b'\xef\xbb\xbf{"messages":[]}\n')
    r = validate.classify_lines(read_jsonl_lines(spark, p)).collect()[0]
    assert r.line == '{"messages":[]}' and r.status == "ok"


def test_missing_path_raises(spark, tmp_dir):
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException):
        read_jsonl_lines(spark, os.path.join(tmp_dir, "nope.jsonl")).count()


def test_first_invalid_line_and_count(spark, tmp_dir):
    lines = ['{"a":1}', '{"messages":[]}', '　{"b":2}', "{oops", "[]"]
    p = write(tmp_dir, "chk.jsonl", ("\n".join(lines) + "\n").encode())
    r = validate.first_invalid_line(read_jsonl_lines(spark, p)).collect()[0]
    # the checker does not strip: the U+3000 line is its first error
    assert r.first_bad_line == 3 and r.lines_checked == 3 and r.first_bad_content == '{"b":2}'
    p2 = write(tmp_dir, "allgood.jsonl", b'{"a":1}\n[2]\n')
    r2 = validate.first_invalid_line(read_jsonl_lines(spark, p2)).collect()[0]
    assert r2.first_bad_line is None and r2.lines_checked == 2


def test_line_numbers_across_many_splits(spark, tmp_dir):
    n = 20000
    body = "".join(f'{{"messages":[{{"role":"user","content":"line {i} ' + "x" * (i % 50) + '"}]}\n' for i in range(n))
    p1 = write(tmp_dir, "big1.jsonl", body.encode())
    p2 = write(tmp_dir, "big2.jsonl", body[: len(body) // 2].rsplit("\n", 1)[0].encode() + b"\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = read_jsonl_lines(spark, [p1, p2])
        assert df.rdd.getNumPartitions() > 10
        got = df.select(F.element_at(F.split("file", "/"), -1).alias("f"), "line_no", "line").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    for name, path in (("big1.jsonl", p1), ("big2.jsonl", p2)):
        with open(path, "rb") as fh:
            exp = expected_lines(fh.read())
        mine = sorted((r.line_no, r.line) for r in got if r.f == name)
        assert mine == list(enumerate(exp, 1))


def test_error_report_messages(spark, tmp_dir):
    p = write(tmp_dir, "err.jsonl", b'{"msgs":[]}\n{"messages":null}\nnope\n{"messages":[]}\n')
    got = {r.line_no: r for r in validate.error_report(read_jsonl_lines(spark, p)).collect()}
    assert got[1].message == "Line 1 has no messages key"
    assert got[2].message == "Line 2 has a messages value that is no list"
    assert got[3].message == "Line 3 cannot be parsed as one JSON value"
    assert 4 not in got


ADVERSARIAL = [
    '{"a":-Infinity}', '{"a":+1}', '{"a":-NaN}', '{"a":1e400}', '{"a":-0}', '{"a":"\\ud800"}', '"\\u0000"',
    '{"a":1}}', '{"a":[1,2]]', '1]}', '1}]', '[1]]', '{"a":1}]', '1 ]', '1.', '.5', '1e', '0x10', 'tru', 'nul',
    '"a', '"\\x"', '[1,]', '{"a" 1}', '{a:1}', '/*c*/1', '1//c', '[NaN]', '[Infinity,-Infinity]', '"NaN"',
    '{"messages":[NaN]}', ' 1', '1 ', '[1\n,2]', '{"a":"\\/"}', '[' * 50 + ']' * 50, '"' + 'x' * 10000 + '"',
    '{"a":1}{"b":2}', '[1][2]', '"a""b"', '1 2', '{"w":1}', '}', ']', '{', '[', ',', ':', '{"a":1,"b":}', '{"":1}',
]


def test_adversarial_strings_match_python(spark):
    from chatprep.functions.json import is_valid_json, line_status

    df = spark.createDataFrame([(s,) for s in ADVERSARIAL + GOLDEN], "l string")
    for r in df.select("l", is_valid_json("l").alias("v"), line_status("l", strip=False).alias("s")).collect():
        try:
            json.loads(r.l)
            ok = True
        except ValueError:
            ok = False
        assert (r.v, r.s) == (ok, python_status(r.l)), r.l[:60]
