"""Per-epoch example order and batch / accumulation-step assignment.

Examples are numbered once, in id order. The order of an epoch is a keyed permutation of those numbers
(``permutation``), so every epoch is arithmetic on the number: one range shuffle serves any number of
epochs, and the examples of some steps are found by undoing the permutation, without the rest of the epoch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .permutation import permuted, round_keys
from .ranking import global_row_number

DEFAULT_BATCH_SIZE = 2
DEFAULT_ACCUMULATION = 8
DEFAULT_EPOCHS = 3
DEFAULT_SEED = 42


def number_examples(examples: DataFrame, id_col: str | list[str] = "example_id") -> DataFrame:
    """``(id columns, number)``: the examples numbered from 0 in id order. Repeated ids get numbers of their own."""
    ids = [id_col] if isinstance(id_col, str) else list(id_col)
    return global_row_number(examples.select(*ids), ids, out="number")


def _whole(x: Column, size: int) -> Column:
    return F.call_function("div", x, F.lit(size))


def _with_steps(placed: DataFrame, batch_size: int, accumulation: int) -> DataFrame:
    return placed.withColumn("batch", _whole(F.col("position"), batch_size)).withColumn("step", _whole(F.col("batch"), accumulation))


def plan_batches(examples: DataFrame, id_col: str | list[str] = "example_id", batch_size: int = DEFAULT_BATCH_SIZE,
                 accumulation: int = DEFAULT_ACCUMULATION, epochs: int = DEFAULT_EPOCHS,
                 seed: int = DEFAULT_SEED, drop_last: bool = True) -> DataFrame:
    """``(epoch, id columns, position, batch, step)``: every example once per epoch, in a shuffled order that depends
    only on the seed, the epoch and the set of ids; ``batch = position div batch_size``,
    ``step = batch div accumulation``; with ``drop_last`` the incomplete last batch is dropped.

    The rows come in no particular order; write them partitioned by epoch, or sort by position, as needed. Only
    the narrow id frame is numbered; join the plan back to the examples on the ids when features are needed."""
    ids = [id_col] if isinstance(id_col, str) else list(id_col)
    numbered = number_examples(examples, ids)
    n = numbered.count()  # of the pinned frame
    per_epoch = numbered.select(F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"), *ids, "number")
    keyed = per_epoch.withColumn("_keys", round_keys(seed, F.col("epoch")))
    out = _with_steps(keyed.withColumn("position", permuted(F.col("number"), F.col("_keys"), max(n, 1))), batch_size, accumulation)
    if drop_last:
        out = out.filter(F.col("batch") < n // batch_size)
    return out.select("epoch", *ids, "position", "batch", "step")


def resume_batches(numbered: DataFrame, epoch: int, first_step: int, steps: int | None = None, batch_size: int = DEFAULT_BATCH_SIZE,
                   accumulation: int = DEFAULT_ACCUMULATION, seed: int = DEFAULT_SEED, drop_last: bool = True) -> DataFrame:
    """The rows of ``plan_batches`` for ``steps`` steps of one epoch (to its end if None), from ``first_step`` on.

    ``numbered`` is ``number_examples`` of the same examples, written and read again where a run may be resumed in
    another session. Only the positions asked for are made and taken back to their numbers; the join moves as
    many rows as there are positions, plus the numbered ids."""
    spark = numbered.sparkSession
    n = numbered.count()
    size = batch_size * accumulation
    end = n // batch_size * batch_size if drop_last else n
    start = min(first_step * size, end)
    stop = end if steps is None else min(start + steps * size, end)
    places = spark.range(start, stop).select(F.col("id").alias("position"), F.lit(epoch).alias("epoch"))
    places = places.withColumn("_keys", round_keys(seed, F.col("epoch")))
    places = places.withColumn("number", permuted(F.col("position"), F.col("_keys"), max(n, 1), back=True))
    ids = [c for c in numbered.columns if c != "number"]
    return _with_steps(places.join(numbered, "number"), batch_size, accumulation).select("epoch", *ids, "position", "batch", "step")
