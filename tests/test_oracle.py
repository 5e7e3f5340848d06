"""Every registered query equals its SQL (run by DuckDB) on the sf0.01 tables."""

import re

import pytest

from conftest import SF01

import __spark_entry__ as entry_mod
from tools.compare import compare

NAMES = sorted(entry_mod.oracle_sql())
# Queries without SQL are those of the training-data subpackage; they have tests of their own.
OTHER = re.compile(r"op[0-9]+_|pipeline$")


def test_every_query_has_oracle_or_is_listed():
    missing = set(entry_mod.queries()) - set(entry_mod.oracle_sql())
    assert not [n for n in missing if not OTHER.match(n)]


@pytest.fixture(scope="module")
def results(spark):
    return compare(spark, SF01, NAMES, verbose=False)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(results, name):
    assert results[name].startswith("ok"), results[name]


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["example_id", "n_tokens", "input_ids", "attention_mask", "labels"]


def test_scale_check_sf01_small_splits(spark):
    """Order- and split-sensitive operators at sf0.1 with small file splits and an odd number of
    shuffle partitions still equal their SQL."""
    names = ["plan_batches", "encode_tokens", "first_invalid_line", "session_snapshots", "chat_format_report_turns",
             "replay_messages", "training_examples_from_lines", "snapshot_messages"]
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(256 * 1024))
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        res = compare(spark, "/root/testdata/sf0.1", names, verbose=False)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert all(v.startswith("ok") for v in res.values()), res
