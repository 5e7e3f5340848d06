"""Temperature mixing of sources to target weights, in DataFrame operations only.

* Token shares p of the sources become weights p**alpha / sum p**alpha. Lower alpha favours small
  sources, so both the entropy of the weights and the largest repetition rise as alpha falls; alpha
  in [0, 1] is bisected to the smallest value that keeps both within their limits. One aggregate over
  the table of sources evaluates all exponents that the next five halvings could visit.
* The budget is given, or such that the least repeated source is read exactly once; then no
  document is left out and small sources are repeated.
* A source's quota is whole passes plus a part of one more. Each pass permutes the source's blocks
  (hash of block and pass) and the documents in a block. The part takes blocks in that order while
  they fit, and from the first block that does not fit, documents in order while they fit.
  Block sums are aggregates; only the block that is cut is ever put in order.

Defined cases: null and empty source are one source ''; null text counts as empty; a document weighs
its words plus one; rows that agree in id and text take the same place and are in or out together
(so a quota is met but for the weight of such a group); an empty table gives an empty result. Columns
of ``docs`` with other names are kept by ``mixed_rows`` whatever they are called, unless they start with ``_mix_``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import materialize

WORD = "[^\\x20\\x09-\\x0D]+"
SMALL_ROWS = 200_000    # a table of sources or blocks up to this many rows may be broadcast, after it was counted
HALVINGS = 5            # halvings of the exponent's interval that one aggregate serves


@dataclass
class Mixture:
    """The chosen exponent, what it gives, and the plan table (one row per source)."""

    alpha: float
    entropy: float
    repetition: float
    plan: DataFrame
    blocks: DataFrame


def _small(df: DataFrame) -> DataFrame:
    """Hint a broadcast for a written table that was counted to be small; a plain join otherwise."""
    return F.broadcast(df) if df.count() <= SMALL_ROWS else df


def _prefixed(docs: DataFrame, key: str, text: str, source: str, seed: int) -> DataFrame:
    """``docs`` with the source name and the two hashes that place a document."""
    body = F.coalesce(F.col(text), F.lit(""))
    same = F.xxhash64(F.col(key), body)
    return docs.withColumns({
        "_mix_source": F.coalesce(F.col(source).cast("string"), F.lit("")),
        "_mix_home": F.xxhash64(F.lit(seed), same),
        "_mix_inner": F.xxhash64(F.lit(seed + 1), same)})


def _block(home: Column, n_blocks: Column) -> Column:
    return F.pmod(home, n_blocks)


def _place(block: Column, which_pass: Column, seed: int) -> Column:
    """Sort key of a block in a pass's permutation."""
    return F.xxhash64(F.lit(seed + 2), block, which_pass)


def _moments(totals: DataFrame, alphas: list[float]) -> list[tuple[float, float]]:
    """(entropy in nats, largest over smallest repetition) of the weights at each exponent."""
    p = F.col("log_share")
    exprs = []
    for i, a in enumerate(alphas):
        exprs += [F.sum(F.exp(p * a)).alias(f"z{i}"), F.sum(F.exp(p * a) * p * a).alias(f"l{i}")]
    row = totals.agg(F.min(p).alias("low"), F.max(p).alias("high"), *exprs).first()
    out = []
    for i, a in enumerate(alphas):
        z, l = row[f"z{i}"], row[f"l{i}"]
        out.append((math.log(z) - l / z, math.exp((row["high"] - row["low"]) * (1 - a))) if z else (0.0, 1.0))
    return out


def choose_exponent(totals: DataFrame, max_repetition: float | None, target_entropy: float | None,
                    rounds: int = 6) -> tuple[float, float, float]:
    """Bisect the exponent: the smallest in [0, 1] within both limits, with its entropy and repetition."""
    def within(m: tuple[float, float]) -> bool:
        return (max_repetition is None or m[1] <= max_repetition) and (target_entropy is None or m[0] <= target_entropy)

    lo, hi = 0.0, 1.0
    at_lo, best = _moments(totals, [0.0, 1.0])
    if within(at_lo):
        return 0.0, *at_lo
    for _ in range(rounds):
        n = 1 << HALVINGS
        grid = [lo + (hi - lo) * k / n for k in range(1, n)]
        met = _moments(totals, grid)
        a, b = 0, n  # a is outside the limits, b within
        while b - a > 1:
            mid = (a + b) // 2
            if within(met[mid - 1]):
                b, best = mid, met[mid - 1]
            else:
                a = mid
        lo, hi = lo + (hi - lo) * a / n, lo + (hi - lo) * b / n
    return hi, *best


def plan_mixture(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
                 max_repetition: float | None = 2.0, target_entropy: float | None = None,
                 budget_tokens: int | None = None, block_rows: int = 4096, most_blocks: int = 65536,
                 seed: int = 17) -> Mixture:
    """The plan table: source, tokens, rows, n_blocks, weight, quota, whole passes, and where the part ends."""
    weighed = _prefixed(docs, key, text, source, seed).select(
        "_mix_source", "_mix_home", "_mix_inner",
        (F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)) + 1).cast("long").alias("tokens"))
    weighed = materialize(weighed, "weighed")
    totals = weighed.groupBy("_mix_source").agg(F.sum("tokens").alias("total"), F.count("*").alias("rows"))
    totals = materialize(totals, "sources")
    whole = totals.agg(F.sum("total").alias("t")).first()["t"] or 1
    totals = totals.withColumn("log_share", F.log(F.col("total") / F.lit(float(whole))))
    alpha, entropy, repetition = choose_exponent(totals, max_repetition, target_entropy)
    # Budget: tokens(s) / weight(s) is largest for the source repeated least.
    norm = totals.agg(F.sum(F.exp(F.col("log_share") * alpha)).alias("z"),
                      F.max(F.exp(F.col("log_share") * (1 - alpha))).alias("m")).first()
    z = norm["z"] or 1.0
    budget = float(budget_tokens) if budget_tokens is not None else whole * (norm["m"] or 1.0) * z
    weight = F.exp(F.col("log_share") * alpha) / F.lit(z)
    wanted = F.round(weight * F.lit(budget)).cast("long")
    n_blocks = F.least(F.ceil(F.col("rows") / F.lit(block_rows)), F.lit(most_blocks)).cast("long")
    quotas = totals.select(
        F.col("_mix_source").alias("source"), "total", "rows", n_blocks.alias("n_blocks"), weight.alias("weight"),
        # the source read exactly once must not lose a document to rounding
        F.when(F.abs(wanted - F.col("total")) <= 1, F.col("total")).otherwise(wanted).alias("quota"))
    quotas = quotas.withColumn("passes", F.floor(F.col("quota") / F.col("total")).cast("long"))
    quotas = _small(materialize(quotas.withColumn("part", F.col("quota") - F.col("passes") * F.col("total")), "quotas"))
    # Sums of blocks, then the block in which each source's part ends.
    blocked = weighed.join(quotas, weighed["_mix_source"] == quotas["source"]).select(
        "source", _block(F.col("_mix_home"), F.col("n_blocks")).alias("block"), "_mix_inner", "tokens")
    sums = materialize(blocked.groupBy("source", "block").agg(F.sum("tokens").alias("block_tokens")), "blocks")
    order = Window.partitionBy("source").orderBy("place", "block").rowsBetween(Window.unboundedPreceding, -1)
    placed = sums.join(quotas.select("source", "passes", "part"), "source").withColumn("place", _place(F.col("block"), F.col("passes"), seed))
    placed = placed.withColumn("before", F.coalesce(F.sum("block_tokens").over(order), F.lit(0)))
    cut = placed.filter((F.col("before") <= F.col("part")) & (F.col("before") + F.col("block_tokens") > F.col("part")))
    cut = _small(materialize(cut.select("source", F.col("block").alias("cut_block"), F.col("place").alias("cut_place"),
                                        (F.col("part") - F.col("before")).alias("room")), "cuts"))
    # Inside the cut blocks (one per source, of about block_rows rows): groups of equal rows in order.
    inside = blocked.join(cut, (blocked["source"] == cut["source"]) & (blocked["block"] == cut["cut_block"])).select(
        blocked["source"], "_mix_inner", "tokens", "room")
    inside = inside.groupBy("source", "_mix_inner").agg(F.sum("tokens").alias("tokens"), F.max("room").alias("room"))
    running = F.sum("tokens").over(Window.partitionBy("source").orderBy("_mix_inner"))
    last = inside.withColumn("upto", running).filter("upto <= room").groupBy("source").agg(F.max("_mix_inner").alias("cut_inner"))
    plan = quotas.join(cut, "source", "left").join(last, "source", "left")
    return Mixture(alpha, entropy, repetition, materialize(plan, "mixture"), sums)


def _copies(docs: DataFrame, mixture: Mixture, key: str, text: str, source: str, seed: int) -> DataFrame:
    """``docs`` joined to the plan, one row per pass that takes the document (``_mix_pass``)."""
    plan = mixture.plan.select(*[F.col(c).alias(f"_mix_p_{c}") for c in mixture.plan.columns])
    known = _prefixed(docs, key, text, source, seed)
    known = known.join(_small(plan), F.col("_mix_source") == F.col("_mix_p_source"))
    block, passes = _block(F.col("_mix_home"), F.col("_mix_p_n_blocks")), F.col("_mix_p_passes")
    place, cut = _place(block, passes, seed), F.col("_mix_p_cut_place")
    earlier = (place < cut) | ((place == cut) & (block < F.col("_mix_p_cut_block")))
    within = (block == F.col("_mix_p_cut_block")) & (F.col("_mix_inner") <= F.col("_mix_p_cut_inner"))
    part = F.coalesce(earlier | within, F.lit(False)) & (F.col("_mix_p_part") > 0)
    taken = passes + part.cast("long")
    known = known.withColumn("_mix_block", block).withColumn("_mix_taken", taken).filter("_mix_taken > 0")
    return known.withColumn("_mix_pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_mix_taken") - 1)))


def mixed_rows(docs: DataFrame, mixture: Mixture, key: str = "doc_id", text: str = "text", source: str = "source",
               seed: int = 17) -> DataFrame:
    """The rows of the mixture with exactly the columns of ``docs``: a row as often as it is read."""
    return _copies(docs, mixture, key, text, source, seed).select(*docs.columns)


def mix_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 17,
                  **planning) -> DataFrame:
    """One row per reading of a document: key, source, pass, block, tokens of weight, the place of its
    block in the mixed stream ([0, 1): ``start`` of the block's share of the quota) and its order in the block.

    Reading by (start, inner_order) interleaves the sources in proportion to their weights."""
    mixture = plan_mixture(docs, key, text, source, seed=seed, **planning)
    plan = _small(mixture.plan.select("source", "passes", "total", "quota"))
    passes = F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes"))).alias("pass")
    blocks = mixture.blocks.join(plan, "source").select("source", "block", "block_tokens", "total", "quota", passes)
    blocks = blocks.withColumn("place", _place(F.col("block"), F.col("pass"), seed))
    order = Window.partitionBy("source", "pass").orderBy("place", "block").rowsBetween(Window.unboundedPreceding, -1)
    start = (F.col("pass") * F.col("total") + F.coalesce(F.sum("block_tokens").over(order), F.lit(0))) / F.greatest("quota", F.lit(1))
    starts = materialize(blocks.select(F.col("source").alias("s"), F.col("block").alias("b"), F.col("pass").alias("p"), start.alias("start")), "starts")
    taken = _copies(docs.select(F.col(key), F.col(text), F.col(source)), mixture, key, text, source, seed)
    narrow = taken.select(F.col(key).alias("_mix_key"), "_mix_source", "_mix_pass", "_mix_block", "_mix_inner",
                          F.col("_mix_p_weight").alias("weight"))
    joined = narrow.join(_small(starts), (F.col("_mix_source") == F.col("s")) & (F.col("_mix_block") == F.col("b")) & (F.col("_mix_pass") == F.col("p")))
    return joined.select(F.col("_mix_key").alias(key), F.col("_mix_source").alias("source"), F.col("_mix_pass").alias("pass"),
                         F.col("_mix_block").alias("block"), "start", F.col("_mix_inner").alias("inner_order"), "weight")
