"""The keyed permutation and the batch plan built on it."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatprep.operators import batches, permutation


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 97, 1000, 1025])
def test_permutation_is_a_bijection_and_can_be_undone(spark, n):
    df = spark.range(n).withColumn("keys", permutation.round_keys(9, F.lit(2)))
    moved = df.withColumn("at", permutation.permuted(F.col("id"), F.col("keys"), n))
    back = moved.withColumn("again", permutation.permuted(F.col("at"), F.col("keys"), n, back=True)).collect()
    assert sorted(r["at"] for r in back) == list(range(n))
    assert all(r["again"] == r["id"] for r in back)


def test_permutation_of_a_large_range(spark):
    n = 10**15 + 37
    df = spark.range(0, n, n // 500).withColumn("keys", permutation.round_keys(1, F.lit(0)))
    moved = df.withColumn("at", permutation.permuted(F.col("id"), F.col("keys"), n))
    rows = moved.withColumn("again", permutation.permuted(F.col("at"), F.col("keys"), n, back=True)).collect()
    assert all(0 <= r["at"] < n and r["again"] == r["id"] for r in rows) and len({r["at"] for r in rows}) == len(rows)


def test_orders_are_well_mixed(spark):
    n = 20_000
    df = spark.range(n).crossJoin(spark.range(3).withColumnRenamed("id", "epoch")).withColumn("keys", permutation.round_keys(42, F.col("epoch")))
    got = df.select("epoch", "id", permutation.permuted(F.col("id"), F.col("keys"), n).alias("at")).toPandas()
    orders = [g.sort_values("id")["at"].to_numpy() for _, g in got.groupby("epoch")]
    base = np.arange(n)
    for a, b in [(base, orders[0]), (base, orders[1]), (orders[0], orders[1]), (orders[1], orders[2])]:
        assert abs(np.corrcoef(a, b)[0, 1]) < 0.03                      # independent ranks
    for o in orders:
        cells = np.histogram2d(base, o, bins=10)[0]                     # 200 expected in each of 100 cells
        assert ((cells - 200) ** 2 / 200).sum() < 160                   # chi-square, 99 degrees of freedom or less
        assert abs((np.diff(o) > 0).mean() - 0.5) < 0.02                # neighbours go either way


def test_one_shuffle_for_any_number_of_epochs(spark):
    ex = spark.range(0, 500).withColumnRenamed("id", "example_id")
    plan = batches.plan_batches(ex, epochs=40)
    assert plan.count() == 40 * 500
    text = plan._jdf.queryExecution().executedPlan().toString()
    moved = [x for x in text.splitlines() if "Exchange" in x and "Broadcast" not in x]
    assert not [x for x in moved if "example_id" in x]                  # the ids were numbered before; nothing moves them again


@pytest.mark.parametrize("drop_last", [True, False])
def test_resume_equals_the_plan(spark, drop_last):
    ex = spark.createDataFrame([(f"f{i % 3}", i) for i in range(101)], "file string, line_no int")
    ids = ["file", "line_no"]
    whole = batches.plan_batches(ex, ids, batch_size=4, accumulation=3, epochs=3, seed=8, drop_last=drop_last).collect()
    numbered = batches.number_examples(ex, ids).checkpoint()
    for epoch, first, steps in [(0, 0, None), (2, 3, 2), (1, 8, None), (1, 8, 50), (1, 99, 1), (0, 0, 0)]:
        got = batches.resume_batches(numbered, epoch, first, steps, batch_size=4, accumulation=3, seed=8, drop_last=drop_last).collect()
        last = 10**9 if steps is None else first + steps - 1
        assert sorted(map(tuple, got)) == sorted(tuple(r) for r in whole if r.epoch == epoch and first <= r.step <= last)


def test_plan_depends_on_the_ids_only(spark):
    rows = [(i,) for i in range(64)]
    a = batches.plan_batches(spark.createDataFrame(rows, "example_id long"))
    b = batches.plan_batches(spark.createDataFrame(rows[::-1], "example_id long").repartition(5))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    other = batches.plan_batches(spark.createDataFrame(rows, "example_id long"), seed=43)
    assert sorted(map(tuple, a.collect())) != sorted(map(tuple, other.collect()))


def test_plan_of_empty_null_and_repeated_ids(spark):
    assert batches.plan_batches(spark.createDataFrame([], "example_id long")).count() == 0
    odd = spark.createDataFrame([(None,), (None,), (3,), (3,), (1,)], "example_id long")
    plan = batches.plan_batches(odd, epochs=2, drop_last=False).collect()
    for e in (0, 1):
        assert sorted(r.position for r in plan if r.epoch == e) == list(range(5))
        assert sorted(str(r.example_id) for r in plan if r.epoch == e) == ["1", "3", "3", "None", "None"]
