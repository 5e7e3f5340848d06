"""Hard-negative mining by slot-decomposed selection.

An anchor's positives are its best rows of the same label. A negative serves a positive when its score
lies between ``low`` and ``high`` percent of the positive's score; the windows of one anchor overlap, and
each wants its own best rows. They are answered together:

* The upper limits of the anchor's windows, in descending order, cut the scores into disjoint slots;
  what lies above the first limit, or below every lower limit, belongs to no window.
* Rows are scored against a block of anchors in tasks; every task keeps the best ``k`` of each (anchor,
  slot) as its rows stream by (the combiner), and the tasks' lists are cut to the best ``k`` again.
* The best ``k`` under a limit are the best ``k`` of the slots from that limit down, merged: slots do not
  overlap, so the merge of a suffix is a concatenation cut at ``k``. The lower limit then cuts the list,
  which loses nothing: what it cuts away is below everything it keeps.

The grid: ``anchor_block`` anchors to a block, and rows dealt into as many parts as make ``tasks`` cells
together, more where a cell would hold over ``cell_pairs`` pairs. A cell holds its block of anchors and
streams its rows, so memory does not depend on the number of rows. Scores are integers: matrix products in
single or double precision where those are exact for the largest components, else 64-bit integers. Rows of
equal label and vector score equally with every anchor, so of each such run in an Arrow batch only the
first ``k + 1`` ids go on; one vector that a third of all rows share costs no more than others.

Defined cases: rows with a null label or vector, or a null or non-finite component, take no part; a null id
is never an anchor and comes last among ties; every row with an anchor's id is an anchor of its own, and a
row that repeats an anchor's id and label may be its positive; shorter vectors count as padded with zeros;
an anchor without positives, or a positive without negatives, gives no rows (a negative positive score has
an empty window); an empty table gives an empty result; other columns are not read. Components are taken
as ``floor(scale * x)`` cut to 64 bits; sums beyond 64 bits wrap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .shared import materialize, trimmed

ANCHOR_STEP, ROW_STEP = 512, 2048  # a tile of scores
LAST = np.iinfo(np.int64).max      # a null id among ties


def usable_rows(rows: DataFrame, key: str, vector: str, label: Column, scale: int) -> DataFrame:
    """(rid, id, label, v): the rows that take part, numbered, with integer components."""
    def finite(c: Column) -> Column:
        return F.coalesce(~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")), F.lit(False))

    out = rows.select(F.col(key).cast("long").alias("id"), label.alias("label"), F.col(vector).alias("x"))
    out = out.filter(F.col("label").isNotNull() & F.col("x").isNotNull() & F.forall("x", finite))
    whole = F.transform("x", lambda c: F.floor(c.cast("double") * scale).cast("long"))
    # The number is read back from the written table, so it is the same wherever it is used.
    return materialize(out.select(F.monotonically_increasing_id().alias("rid"), "id", "label", whole.alias("v")), "vectors")


def _vectors(column: pa.Array, width: int) -> np.ndarray:
    """(rows, width) of a list column, shorter lists padded with zeros."""
    n = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < n[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of ``a`` and ``b``."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64
    return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)


def _thin(label: np.ndarray, v: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` ids of every run of rows with equal label and vector. A hash brings equal rows
    together; whether neighbours are equal is then decided on the whole vectors."""
    key = W.mix(label.view(np.uint64), 1)
    if v.shape[1]:
        key = W.mix(key ^ (v.view(np.uint64) * W.mix(np.arange(v.shape[1], dtype=np.uint64), 2)).sum(axis=1, dtype=np.uint64), 3)
    order = np.lexsort((ids, key))
    same = (v[order][1:] == v[order][:-1]).all(axis=1) & (label[order][1:] == label[order][:-1])
    starts = np.flatnonzero(np.concatenate([[True], ~same]))
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return np.sort(order[place < k])


class _Best:
    """The best ``k`` (score, id) of every (anchor, slot) cell, as rows stream by."""

    def __init__(self, cells: int, k: int):
        self.k = k
        self.cell, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.floor = np.full(cells, np.iinfo(np.int64).min)  # the k-th best score of a full cell

    def add(self, cell: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(cell):
            return
        cell, score, ids = np.concatenate([self.cell, cell]), np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        order = np.lexsort((ids, -score, cell))
        cell, score, ids = cell[order], score[order], ids[order]
        starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        place = np.arange(len(cell)) - np.repeat(starts, np.diff(np.append(starts, len(cell))))
        self.floor[cell[place == self.k - 1]] = score[place == self.k - 1]
        stay = place < self.k
        self.cell, self.score, self.id = cell[stay], score[stay], ids[stay]


def _select(cells: DataFrame, width: int, k: int, positives: bool) -> DataFrame:
    """(rid, slot, id, score): the best ``k`` rows of each anchor and slot, per grid cell. ``cells`` holds the
    rows of a cell sorted so that its anchors come first: (anchor, rid, id, label, v, limits, least)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        state = None
        cell_now = None

        def close():
            if state is None:
                return None
            rid, _, _, limits, _, tiles = state
            slots = limits.shape[1]
            anchor = np.concatenate([t.cell // slots + i * ANCHOR_STEP for i, t in enumerate(tiles)])
            slot, ids, score = (np.concatenate(x) for x in zip(*((t.cell % slots, t.id, t.score) for t in tiles)))
            return pa.RecordBatch.from_arrays([pa.array(rid[anchor]), pa.array(slot.astype(np.int32)), pa.array(ids, mask=ids == LAST),
                                               pa.array(score)], names=["rid", "slot", "id", "score"])

        def open_anchors():
            t = pa.Table.from_batches(held).combine_chunks()
            rid, label = t.column("rid").to_numpy(), t.column("label").to_numpy()
            v = _vectors(t.column("v").chunk(0), width)
            if positives:
                limits, least = np.full((len(rid), 1), LAST), np.full(len(rid), -LAST - 1)
            else:
                lists = t.column("limits").chunk(0)
                n = np.diff(lists.offsets.to_numpy())
                limits = np.full((len(rid), max(int(n.max(initial=1)), 1)), -LAST - 1)
                limits[np.arange(limits.shape[1]) < n[:, None]] = lists.flatten().to_numpy()
                least = t.column("least").to_numpy()
            order = np.argsort(label, kind="stable")
            tiles = [_Best(min(ANCHOR_STEP, len(rid) - a) * limits.shape[1], k) for a in range(0, len(rid), ANCHOR_STEP)]
            return rid[order], label[order], v[order], limits[order], least[order], tiles

        def stream(batch: pa.RecordBatch) -> None:
            rid, label, v, limits, least, tiles = state
            ids = batch.column("id").fill_null(LAST).to_numpy()
            row_rid, row_label = batch.column("rid").to_numpy(), batch.column("label").to_numpy()
            row_v = _vectors(batch.column("v"), width)
            stay = _thin(row_label, row_v, ids, k + 1)
            ids, row_rid, row_label, row_v = ids[stay], row_rid[stay], row_label[stay], row_v[stay]
            slots = limits.shape[1]
            step = 64  # a short start: most rows are turned away by the floors that the first ones set
            lo = 0
            while lo < len(ids):
                hi = min(lo + step, len(ids))
                step = min(step * 2, ROW_STEP)
                for tile, best in enumerate(tiles):
                    a, b = tile * ANCHOR_STEP, min((tile + 1) * ANCHOR_STEP, len(rid))
                    score = _product(v[a:b], row_v[lo:hi])
                    same = label[a:b, None] == row_label[None, lo:hi]
                    if positives:
                        ok = same & (score >= best.floor[:, None]) & (rid[a:b, None] != row_rid[None, lo:hi])
                        at, col = np.nonzero(ok)
                        best.add(at, score[at, col], ids[lo:hi][col])
                        continue
                    ok = ~same & (score <= limits[a:b, :1]) & (score >= least[a:b, None])
                    at, col = np.nonzero(ok)
                    s = score[at, col]
                    cell = at * slots + (s[:, None] <= limits[a + at]).sum(axis=1) - 1
                    good = s >= best.floor[cell]
                    best.add(cell[good], s[good], ids[lo:hi][col[good]])
                lo = hi

        for batch in batches:
            cell = batch.column("cell").to_numpy()
            edges = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.zeros(0, int)
            for lo, hi in zip(edges, np.append(edges[1:], len(cell))):
                part = batch.slice(lo, hi - lo)
                if cell[lo] != cell_now:
                    if (done := close()) is not None:
                        yield done
                    cell_now, state, held = cell[lo], None, []
                n = int(np.searchsorted(part.column("kind").to_numpy(), 1))  # anchors first
                if n:
                    held.append(part.slice(0, n))
                if n < part.num_rows and (state is not None or held):
                    state = open_anchors() if state is None else state
                    stream(part.slice(n))
        if (done := close()) is not None:
            yield done

    return cells.mapInArrow(trimmed(run), "rid long, slot int, id long, score long")


def _grid(anchors: DataFrame, rows: DataFrame, blocks: int, parts: int) -> DataFrame:
    """Every (block of anchors, part of the rows) cell, one partition each, anchors first."""
    part = F.pmod(F.xxhash64(F.lit(3), "rid"), F.lit(parts))
    block = F.pmod(F.xxhash64(F.lit(4), "rid"), F.lit(blocks))
    a = anchors.withColumn("kind", F.lit(0)).withColumn("cell", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: block * parts + p.cast("long"))))
    r = rows.withColumn("limits", F.lit(None).cast("array<bigint>")).withColumn("least", F.lit(None).cast("long")).withColumn("kind", F.lit(1))
    r = r.withColumn("cell", F.explode(F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda b: b.cast("long") * parts + part)))
    both = a.unionByName(r)
    return both.repartitionById(blocks * parts, F.col("cell").cast("int")).sortWithinPartitions("cell", "kind")


def _cut(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each (anchor, slot) over all cells."""
    w = Window.partitionBy("rid", "slot").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k)


def _percent(score: Column, percent: int) -> Column:
    """``percent`` hundredths of a score, rounded down, in whole numbers that stay within 64 bits."""
    rest = F.pmod(score, F.lit(100))
    return F.lit(percent) * F.call_function("div", score - rest, F.lit(100)) + F.call_function("div", F.lit(percent) * rest, F.lit(100))


def mine_negatives(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str | Column = "label",
                   anchor: Column | None = None, positives: int = 5, k: int = 10, low: int = 30, high: int = 90, scale: int = 256,
                   anchor_block: int = 16_384, tasks: int | None = None, cell_pairs: int = 1 << 36) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); see the module text.
    ``anchor`` is a condition on ``id``; ``low`` and ``high`` are percents of the positive's score."""
    spark = rows.sparkSession
    anchor = F.col("id") % 100 == 0 if anchor is None else anchor
    named = F.col(label) if isinstance(label, str) else label
    all_rows = usable_rows(rows, key, vector, named.cast("long"), scale)
    picked = all_rows.filter(anchor)
    size = all_rows.agg(F.count("*").alias("n"), F.count_if(anchor).alias("a"), F.coalesce(F.max(F.size("v")), F.lit(0)).alias("d")).first()
    blocks = max(-(-size["a"] // anchor_block), 1)
    cells = max(tasks or 3 * spark.sparkContext.defaultParallelism, size["a"] * size["n"] // cell_pairs)
    parts = max(-(-cells // blocks), 1)
    empty = picked.withColumns({"limits": F.lit(None).cast("array<bigint>"), "least": F.lit(None).cast("long")})
    best = _cut(_select(_grid(empty, all_rows, blocks, parts), size["d"], positives, True), positives)
    ranked = F.sort_array(F.collect_list(F.struct("place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))))
    served = best.groupBy("rid").agg(ranked.alias("found"))
    upper = F.transform("found", lambda p: _percent(p["positive_score"], high))
    lower = F.transform("found", lambda p: -_percent(-p["positive_score"], low))
    served = materialize(served.select("rid", "found", F.reverse(F.array_sort(F.array_distinct(upper))).alias("limits"),
                                       F.array_min(lower).alias("least")), "positives")
    slots = _cut(_select(_grid(picked.join(served.drop("found"), "rid"), all_rows, blocks, parts), size["d"], k, False), k)
    lists = slots.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("slot", "place", "id", "score"))).alias("slots"))
    # Slots ascend as scores descend: the suffix from a positive's slot, cut at k, then at its lower limit.
    chosen = served.join(lists, "rid").join(picked.select("rid", F.col("id").alias("anchor_id")), "rid")
    chosen = chosen.select("anchor_id", "limits", "slots", F.explode("found").alias("p")).select("anchor_id", "limits", "slots", "p.*")
    slot = F.array_position("limits", _percent(F.col("positive_score"), high)).cast("int") - 1
    suffix = F.slice(F.filter("slots", lambda s: s["slot"] >= F.col("own")), 1, k)
    window = F.filter("suffix", lambda s: s["score"] >= -_percent(-F.col("positive_score"), low))
    chosen = chosen.withColumn("own", slot).withColumn("suffix", suffix)
    out = chosen.select("anchor_id", "positive_id", "positive_score", F.posexplode(window).alias("at", "n"))
    return out.select("anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("n.id").alias("negative_id"),
                      "positive_score", F.col("n.score").alias("negative_score"))


def planted_label(key: str = "vec_id", label: str = "label") -> Column:
    """The label with every seventh id's moved on by one."""
    value = F.col(label).cast("long")
    return F.when(F.col(key) % 7 == 0, (value + 1) % 10).otherwise(value)
