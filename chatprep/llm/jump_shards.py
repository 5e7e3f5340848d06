"""Sharding by jump consistent hashing, in DataFrame expressions only.

A key jumps through ascending shard numbers: from shard b it jumps to floor((b + 1) / u), u drawn in
(0, 1] from a stream that depends on the key and the step alone. Its shard among n is the last
number below n, so with one more shard a key either stays or moves into the new shard, about 1 in
n + 1 of them, and no ring table exists. One fold over the steps gives both answers.

Defined cases: null ids are one key of their own (all in one shard); repeated rows get the same shard
and neighbouring slots; null text has size 16 and the checksum of the empty text; an empty table
gives an empty result. Only the id and the text column are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import global_row_number
from .shared import materialize

ROW_BYTES = 16  # added to the text's bytes


def jump_path(key: Column, n_shards: int, seed: int = 0) -> Column:
    """struct(shard, grown): the key's shard among ``n_shards`` and among ``n_shards + 1``.

    The path rises at each step and has about ln(n) steps; beyond 64 shards 128 steps are taken,
    which a path exceeds with a probability below 1e-60 even for a million shards (and then still
    has a stable, valid shard)."""
    steps = min(n_shards + 1, 128)

    def step(acc: Column, i: Column) -> Column:
        draw = (F.shiftrightunsigned(F.xxhash64(key, F.lit(seed), i), 33) + F.lit(1)) / F.lit(float(1 << 31))
        to = F.least(F.floor((acc["at"] + 1) / draw), F.lit(n_shards + 1)).cast("long")
        return F.struct(to.alias("at"), F.when(to < n_shards, to).otherwise(acc["shard"]).alias("shard"),
                        F.when(to < n_shards + 1, to).otherwise(acc["grown"]).alias("grown"))

    zero = F.lit(0).cast("long")
    start = F.struct(zero.alias("at"), zero.alias("shard"), zero.alias("grown"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step)


def shard_documents(docs: DataFrame, n_shards: int = 40, key: str = "doc_id", text: str = "text",
                    seed: int = 0) -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard) for every row of ``docs``.

    ``slot`` numbers the rows of a shard in key order from 0 without gaps, by range partitions and
    their counts, so neither a shard nor a hot key is ever gathered in one task."""
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    narrow = docs.select(F.col(key).alias("_key"), (F.octet_length(body) + ROW_BYTES).cast("long").alias("size"),
                         F.crc32(body).alias("text_crc32"))
    path = jump_path(F.col("_key"), n_shards, seed)
    placed = materialize(narrow.withColumn("_path", path).select(
        "_key", "size", "text_crc32", F.col("_path.shard").cast("int").alias("shard"),
        F.col("_path.grown").cast("int").alias("grown_shard")), "shards")
    ranked = global_row_number(placed, ["_key", "size", "text_crc32"], group_col="shard", out="slot")
    return ranked.select(F.col("_key").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard",
                         F.col("slot").cast("long").alias("slot"), "grown_shard")
