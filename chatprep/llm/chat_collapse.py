"""Chat formatting with cumulative-snapshot collapse.

Chat logs often hold a conversation once per turn, each time a little longer. Such snapshots are
found by rolling hashes: the hash of a prefix is the sum, over its turns, of hashes of (place in the
conversation, role, text), in four 31-bit lanes. Sums can be taken in blocks, so the prefix hashes of
one conversation of any length are computed by many tasks. A conversation goes if

* an equal conversation has a smaller id, or
* a longer conversation has a prefix of its length and hash (anti-join against the distinct
  prefixes; a first turn that a third of all conversations share is one row there).

What stays is rendered, one row per turn: the pieces of a conversation in order are its text.

Defined cases: null ids are one conversation; turns are ordered by number (null first) and, where
numbers tie, in a fixed order of their content; rows that repeat all four columns count once; a null
role is rendered as ``unknown``, a null text as empty (null and empty are different content for the
comparison); an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import global_row_number, running_sums
from .shared import materialize

LANES = ["s0", "s1", "s2", "s3"]
LANE_MASK = 0x7FFFFFFF  # 2**32 turns of one conversation fit a long sum


def _content(seed: int, *columns: Column) -> Column:
    """A hash that tells null from empty."""
    return F.xxhash64(F.lit(seed), *[x for c in columns for x in (c.isNull(), c)])


def prefixes(turns: DataFrame) -> DataFrame:
    """(_known, _id, r1, r2, pos, n, lanes): each distinct turn with its place, the conversation's
    length and the hash of the prefix that ends with it. ``turns`` has _known, _id, turn, r1, r2, content."""
    conv = ["_known", "_id"]
    narrow = materialize(turns.select(*conv, "turn", "r1", "r2", "content").distinct(), "turns")
    numbered = materialize(global_row_number(narrow, [*conv, "turn", "r1", "r2"], out="rn"), "numbered")
    bounds = materialize(numbered.groupBy(*conv).agg(F.min("rn").alias("start"), F.count("*").alias("n")), "bounds")
    placed = numbered.join(bounds, conv).withColumn("pos", F.col("rn") - F.col("start"))
    value = [F.xxhash64(F.lit(i), F.col("pos"), F.col("content")) for i in range(2)]
    lanes = [v for x in value for v in (x.bitwiseAND(F.lit(LANE_MASK)), F.shiftrightunsigned(x, 33))]
    placed = placed.withColumns({f"v{i}": v for i, v in enumerate(lanes)})
    summed = running_sums(placed, conv, "pos", {name: f"v{i}" for i, name in enumerate(LANES)})
    return summed.select(*conv, "r1", "r2", "pos", "n", *LANES)


def maximal(prefix: DataFrame) -> DataFrame:
    """(_known, _id) of the conversations that stay."""
    whole = prefix.filter(F.col("pos") == F.col("n") - 1).select("_known", "_id", "n", *LANES)
    first = whole.groupBy("n", *LANES).agg(F.min(F.struct("_known", "_id")).alias("c"))
    longer = prefix.filter(F.col("pos") < F.col("n") - 1).select((F.col("pos") + 1).alias("n"), *LANES).distinct()
    return first.join(longer, ["n", *LANES], "left_anti").select("c.*")


def render_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|im_start|>"), F.coalesce(role, F.lit("unknown")), F.lit("\n"), F.coalesce(text, F.lit("")), F.lit("<|im_end|>\n"))


def collapse_snapshots(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
                       text: str = "text") -> DataFrame:
    """(conversation, n_turns, pos, role, piece) of the maximal conversations; see the module text."""
    c, t, r, x = (F.col(n) for n in (conversation, turn, role, text))
    kind = turns.schema[conversation].dataType
    rows = turns.select(c.isNotNull().alias("_known"), F.coalesce(c, F.lit(0).cast(kind)).alias("_id"), t.alias("turn"), r.alias("role"),
                        x.alias("text"), _content(1, t, r, x).alias("r1"), _content(2, t, r, x).alias("r2"), _content(3, r, x).alias("content"))
    prefix = materialize(prefixes(rows), "prefixes")
    stay = materialize(maximal(prefix), "maximal")
    places = prefix.join(stay, ["_known", "_id"], "left_semi").select("_known", "_id", "r1", "r2", "pos", "n")
    once = rows.groupBy("_known", "_id", "r1", "r2").agg(F.first("role").alias("role"), F.first("text").alias("text"))
    out = places.join(once, ["_known", "_id", "r1", "r2"])
    return out.select(F.when(F.col("_known"), F.col("_id")).alias(conversation), F.col("n").alias("n_turns"), F.col("pos").cast("long").alias("pos"),
                      "role", render_turn(F.col("role"), F.col("text")).alias("piece"))


def fold_rendered(pieces: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """One row per conversation with its whole text, for conversations that fit a row."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "piece")))
    return pieces.groupBy(conversation, "n_turns").agg(F.array_join(F.transform(ordered, lambda p: p["piece"]), "").alias("text"))
