"""Quality rules: fixed rules over counts, then gradient-boosted trees with monotonic constraints.

* ``document_statistics`` counts over whole texts; the base rules (too few words, too many words in
  repeated windows) reject a document outright.
* The trees are fitted on the driver on at most ``max_rows`` labelled rows (the rows whose hashed ids
  come first; the bound is a parameter). Features are cut at quantiles into at most 32 bins, each
  split maximises the usual second-order gain, and a split on a constrained feature must order its
  child values as the constraint says, with the bounds passed down, so the whole ensemble is monotone.
* The fitted ensemble is flattened into node arrays (feature, cut, left, right, value) that score a
  batch of rows one tree level at a time with numpy.

Defined cases: null text counts as empty (and fails the base rule); null labels are ignored; without
labels, or with one class only, the verdict is the base rules' alone; rows with repeated or null ids
are judged one by one; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .docstats import COUNTS, MEASURES, document_statistics
from .shared import fold, materialize, trimmed

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
# More of these never raises the probability that a document is good.
MONOTONE = {"symbol_rate": -1, "dup_line_rate": -1, "repeat_rate": -1, "bang_rate": -1, "pipe_rate": -1}


@dataclass
class FlatTrees:
    """All trees in parallel node arrays; leaves point at themselves."""

    feature: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    cut: np.ndarray = field(default_factory=lambda: np.zeros(0))
    left: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    right: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))
    roots: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    base: float = 0.0
    depth: int = 0

    def margin(self, x: np.ndarray) -> np.ndarray:
        rows = np.arange(len(x))[:, None]
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.cut[at], self.left[at], self.right[at])
        return self.base + self.value[at].sum(axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def _best_split(hist_g, hist_h, sign, low, high, reg, min_child):
    """Best (gain, feature, bin, left value, right value) of a node's histograms, or None."""
    gl, hl = np.cumsum(hist_g, axis=1)[:, :-1], np.cumsum(hist_h, axis=1)[:, :-1]
    g, h = hist_g[0].sum(), hist_h[0].sum()
    gr, hr = g - gl, h - hl
    vl, vr = np.clip(-gl / (hl + reg), low, high), np.clip(-gr / (hr + reg), low, high)

    def loss(gg, hh, v):
        return gg * v + 0.5 * (hh + reg) * v * v

    gain = loss(g, h, np.clip(-g / (h + reg), low, high)) - loss(gl, hl, vl) - loss(gr, hr, vr)
    ok = (hl >= min_child) & (hr >= min_child) & ((sign[:, None] == 0) | ((vr - vl) * sign[:, None] >= 0))
    gain = np.where(ok, gain, -np.inf)
    f, b = np.unravel_index(np.argmax(gain), gain.shape)
    return (gain[f, b], f, b, vl[f, b], vr[f, b]) if gain[f, b] > 1e-6 else None


def fit_trees(x: np.ndarray, y: np.ndarray, sign: np.ndarray, n_trees: int = 60, depth: int = 3, rate: float = 0.15,
              reg: float = 1.0, min_child: float = 1.0, bins: int = 32) -> FlatTrees:
    """Boost on the logistic loss. ``sign`` holds -1, 0 or 1 per feature."""
    n, d = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(d)]
    binned = np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)])
    width = bins + 1
    flat = binned + np.arange(d) * width
    prior = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    out = FlatTrees(base=float(np.log(prior / (1 - prior))), depth=depth)
    feature, cut, left, right, value, roots = [], [], [], [], [], []
    margin = np.full(n, out.base)

    def leaf(v):
        k = len(feature)
        feature.append(0), cut.append(np.inf), left.append(k), right.append(k), value.append(v)
        return k

    def grow(rows, low, high, levels, v):
        k = leaf(v)
        if levels == 0 or len(rows) < 2:
            margin[rows] += v * rate
            return k
        cells = flat[rows].ravel()
        hg = np.bincount(cells, np.repeat(grad[rows], d), d * width).reshape(d, width)
        hh = np.bincount(cells, np.repeat(hess[rows], d), d * width).reshape(d, width)
        found = _best_split(hg, hh, sign, low, high, reg, min_child)
        if found is None or found[2] >= len(edges[found[1]]):
            margin[rows] += v * rate
            return k
        _, f, b, vl, vr = found
        mid = (vl + vr) / 2
        lo_l, hi_l, lo_r, hi_r = low, high, low, high
        if sign[f] < 0:
            lo_l, hi_r = mid, mid
        elif sign[f] > 0:
            hi_l, lo_r = mid, mid
        goes = binned[rows, f] <= b
        feature[k], cut[k] = f, edges[f][b]
        left[k] = grow(rows[goes], lo_l, hi_l, levels - 1, vl)
        right[k] = grow(rows[~goes], lo_r, hi_r, levels - 1, vr)
        return k

    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, p * (1 - p)
        roots.append(grow(np.arange(n), -np.inf, np.inf, depth, float(-grad.sum() / (hess.sum() + reg))))
    out.feature, out.cut = np.array(feature, np.int32), np.array(cut)
    out.left, out.right = np.array(left, np.int32), np.array(right, np.int32)
    out.value, out.roots = np.array(value) * rate, np.array(roots, np.int32)
    return out


def fit(stats: DataFrame, labels: DataFrame, max_rows: int = 20_000, **boosting) -> FlatTrees | None:
    """Trees from at most ``max_rows`` labelled rows outside the held-out fold; None without two classes."""
    known = labels.select(F.col("doc_id").alias("_k"), F.col("quality").cast("double").alias("label")).dropna()
    known = known.filter(fold(F.col("_k")) != 0)
    known = known.orderBy(F.xxhash64("_k"), "_k", "label").limit(max_rows)  # the documented bound of the sample
    rows = stats.join(known, stats["doc_id"] == known["_k"]).select("label", *MEASURES)
    table = rows.orderBy(*rows.columns).limit(max_rows).toArrow()
    y = table.column(0).to_numpy()
    if len(y) == 0 or y.min() == y.max():
        return None
    x = np.column_stack([table.column(i + 1).to_numpy() for i in range(len(MEASURES))])
    return fit_trees(x, y, np.array([MONOTONE.get(c, 0) for c in MEASURES]), **boosting)


def judge_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                    label: str = "quality", threshold: float = 0.3, **fitting) -> DataFrame:
    """(key, counts, base_failed, probability, kept) for every row of ``docs``; see the module text."""
    plain = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    stats = materialize(document_statistics(plain, ["doc_id"]), "docstats")
    trees = fit(stats, labels.select(F.col(key).alias("doc_id"), F.col(label).alias("quality")), **fitting)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = 1 + len(COUNTS)
        for batch in batches:
            x = np.column_stack([batch.column(first + i).to_numpy(zero_copy_only=False) for i in range(len(MEASURES))])
            p = np.ones(len(x))
            if trees is not None:
                for lo in range(0, len(x), 4096):
                    p[lo:lo + 4096] = trees.probability(x[lo:lo + 4096])
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(first)] + [pa.array(p)],
                                             names=["doc_id", *COUNTS, "probability"])

    schema = f"doc_id {stats.schema['doc_id'].dataType.simpleString()}, {', '.join(f'{c} long' for c in COUNTS)}, probability double"
    scored = stats.select("doc_id", *COUNTS, *MEASURES).mapInArrow(trimmed(run), schema)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return scored.withColumn("base_failed", failed).select(
        F.col("doc_id").alias(key), *COUNTS, "base_failed", "probability",
        (~F.col("base_failed") & (F.col("probability") >= threshold)).alias("kept"))
