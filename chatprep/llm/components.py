"""Connected components of a link table by alternating large and small stars, all in shuffles."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialize


def components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """(v, root) for every end of a link in ``links`` (a, b): root is the smallest end reachable.

    Each round moves every vertex's links to its smallest neighbour, so paths shrink to stars in a
    logarithmic number of rounds, and a round that changes nothing is the last. Only (vertex, smallest) pairs are kept: a hub of any degree is a
    partial minimum, and its links are dealt by their other ends.

    The rounds go on until one changes nothing. If ``rounds`` is given and they run out before that, it is
    an error: the stars would still be several for one component."""
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), "edges")

    def state(df: DataFrame):
        return df.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()

    seen = state(edges)
    for done in count():
        if done == rounds:
            raise RuntimeError(f"components: {rounds} rounds were too few, the links still changed in the last")
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "low")
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.filter("u != v").distinct(), "large")
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = materialize(down.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        edges = materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = state(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select("v").distinct().select("v", F.col("v").alias("root"))
    return materialize(edges.select(F.col("u").alias("v"), F.col("v").alias("root")).unionByName(roots).groupBy("v").agg(F.min("root").alias("root")), "roots")
