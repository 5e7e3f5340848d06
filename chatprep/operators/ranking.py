"""Order-dependent numbering without funnelling data through one task.

``Window.orderBy(...)`` without a partition key moves every row into a single task, and a window
partitioned by a hot key does the same for that key. The helpers here keep the work spread out:

* ``global_row_number``: range-partition on the order key, sort inside each partition, count rows
  per partition, and add the running count of all earlier partitions. The per-partition table has
  at most (partitions + groups) rows, so broadcasting it is bounded.
* ``running_sums``: running sums per key where one key may hold a large share of all rows. Rows are
  range-partitioned by (key, order), so a hot key is cut into as many pieces as its share of the
  partitions, whatever its order values look like; a key goes on from one partition to the next at
  most once per partition, so the table of carried sums has at most as many rows as partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

# A table is broadcast only if it was measured to hold at most this many rows and bytes.
BROADCAST_ROW_LIMIT = 2_000_000
BROADCAST_BYTE_LIMIT = 128 << 20


def measured_bytes(df: DataFrame) -> Column:
    """Aggregate: about how many bytes the rows of ``df`` take (strings and binaries by their length)."""
    size = F.lit(0).cast("long")
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        size = size + (F.coalesce(F.octet_length(c), F.lit(0)) + 16 if f.dataType.typeName() in ("string", "binary") else F.lit(8))
    return F.coalesce(F.sum(size), F.lit(0))


def checked_broadcast(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """Broadcast a data-dependent (usually aggregated) side only after measuring its rows and bytes.

    The frame is checkpointed and measured; within both limits -> broadcast hint (the big side of the
    join is then never shuffled, so a hot key on it costs nothing); beyond them -> a shuffle join.
    Being a checkpoint, the side is a plain scan there, so AQE can split a hot key of the other side."""
    checkpoint_dir(df.sparkSession)
    df = df.checkpoint(eager=True)
    r = df.agg(F.count(F.lit(1)).alias("n"), measured_bytes(df).alias("b")).first()
    small = r["n"] <= (BROADCAST_ROW_LIMIT if max_rows is None else max_rows) and r["b"] <= (
        BROADCAST_BYTE_LIMIT if max_bytes is None else max_bytes)
    return F.broadcast(df) if small else df


def shuffle_partitions(spark: SparkSession, n: int | None = None) -> int:
    if n:
        return n
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def global_row_number(df: DataFrame, order_cols: list[str], group_col: str | None = None,
                      out: str = "rn", num_partitions: int | None = None) -> DataFrame:
    """0-based row number of each row in ``order_cols`` order (within ``group_col`` if given).

    ``order_cols`` must be unique within a group, so that the numbering is deterministic.
    ``group_col`` is meant for few groups (epochs); the offset table has one row per
    (partition, group) pair present.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    keys = ([group_col] if group_col else []) + list(order_cols)
    n = shuffle_partitions(spark, num_partitions)
    ranged = (
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    # Pin partition contents and order: the frame is read twice (counts, then numbering), and
    # the range bounds come from sampling. A reliable checkpoint also survives executor loss.
    ranged = ranged.checkpoint(eager=True)
    gkeys = ["_pid"] + ([group_col] if group_col else [])
    counts = ranged.groupBy(*gkeys).agg(F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_min_mid"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    if group_col:
        w = Window.partitionBy(group_col).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # This window runs over the small per-partition table only.
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(w), F.lit(0))).select(*gkeys, "_off", "_min_mid")
    offsets = F.broadcast(offsets)  # rows <= partitions + groups
    return (
        ranged.join(offsets, gkeys)
        .withColumn(out, F.col("_off") + F.col("_mid") - F.col("_min_mid"))
        .drop("_pid", "_mid", "_off", "_min_mid")
    )


def running_sums(df: DataFrame, key: list[str], order_col: str, values: dict[str, Column | str],
                 inclusive: bool = True, num_partitions: int | None = None) -> DataFrame:
    """Running sums of several values per ``key`` in ``order_col`` order (null keys are one key, null
    orders come first), all in one pass: ``values`` maps output column -> value column.

    Exact for any key and order values. Windows see one (partition, key) of a range partitioning, so a
    key holding a third of all rows is spread over a third of the partitions; the sums that a key brings
    along from earlier partitions (at most one row per partition) are broadcast."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    names = list(values)
    x = df.withColumns({f"_v{i}": F.coalesce((F.col(v) if isinstance(v, str) else v).cast("long"), F.lit(0))
                        for i, v in enumerate(values.values())})
    ranged = x.repartitionByRange(shuffle_partitions(spark, num_partitions), *key, order_col)
    # Pin contents: the frame is read twice, and range bounds come from sampling.
    ranged = ranged.withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)
    totals = ranged.groupBy("_pid", *key).agg(*[F.sum(f"_v{i}").alias(f"_t{i}") for i in range(len(names))])
    earlier = Window.partitionBy(*key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(F.col("_pid").alias("_cp"), *[F.col(k).alias(f"_k{j}") for j, k in enumerate(key)],
                          *[F.sum(f"_t{i}").over(earlier).alias(f"_c{i}") for i in range(len(names))])
    carry = F.broadcast(carry.filter(F.col("_c0").isNotNull()))  # a partition begins inside at most one key
    inner = Window.partitionBy("_pid", *key).orderBy(order_col)
    inner = inner.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    summed = ranged.withColumns({f"_in{i}": F.coalesce(F.sum(f"_v{i}").over(inner), F.lit(0)) for i in range(len(names))})
    on = [F.col("_pid") == F.col("_cp")] + [F.col(k).eqNullSafe(F.col(f"_k{j}")) for j, k in enumerate(key)]
    out = summed.join(carry, on, "left")
    out = out.withColumns({n: (F.coalesce(F.col(f"_c{i}"), F.lit(0)) + F.col(f"_in{i}")).cast("long") for i, n in enumerate(names)})
    extra = ["_pid", "_cp"] + [f"_k{j}" for j in range(len(key))] + [f"_{p}{i}" for i in range(len(names)) for p in ("v", "in", "c")]
    return out.drop(*extra)


def running_sum(df: DataFrame, key: list[str], order_col: str, value: Column | str, out: str,
                inclusive: bool = True, num_partitions: int | None = None) -> DataFrame:
    """Running sum of one value per ``key`` (see ``running_sums``)."""
    return running_sums(df, key, order_col, {out: value}, inclusive=inclusive, num_partitions=num_partitions)


def position_in_group(df: DataFrame, key: list[str], order_col: str, out: str = "pos",
                      num_partitions: int | None = None) -> DataFrame:
    """0-based position of each row within its ``key`` group in ``order_col`` order (exact,
    skew-safe: see ``running_sums``)."""
    return running_sum(df, key, order_col, F.lit(1), out, num_partitions=num_partitions).withColumn(out, F.col(out) - 1)
