"""Quality classifier: random Fourier features, ridge by partition-summed normal equations, isotonic calibration.

* Every document is turned into a row of statistics of its whole text (``docstats``).
* The statistics are standardised with means and deviations over all documents, and mapped to
  ``n_features`` random cosines whose inner products approximate a Gaussian kernel.
* Each task sums phi'phi and phi'y over its labelled rows; the sums of tasks are added in a few more
  tasks, and the driver solves one (n_features + 1)-square ridge system. All labelled rows count.
* Rows of one learning fold are left out of that sum; on them the raw scores are pooled into a fixed
  grid and made monotone (pool adjacent violators), which turns raw scores into probabilities.

Defined cases: null text counts as empty and is scored like any other; null, repeated or unlabelled
ids are scored row by row; labels that are null are ignored, and a document with several labels counts
once per label; with no usable labels every score is 0.5, with labels of one class only it is that
class's share; an empty table gives an empty result. Columns of ``docs`` other than the text and the
id are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .docstats import MEASURES, document_statistics
from .shared import fold, materialize, trimmed

SMALL_ROWS = 500_000  # rejected rows (two longs each) are broadcast only if counted to be at most so many
CLIP = 5.0  # standardised statistics beyond this many deviations count as this many


@dataclass
class QualityModel:
    """Everything a task needs to score rows of statistics; a few hundred kilobytes at most."""

    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray      # (statistics, features)
    phase: np.ndarray       # (features,)
    beta: np.ndarray        # (features + 1,)
    knots: np.ndarray       # raw scores, ascending
    levels: np.ndarray      # calibrated probability at each knot

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -CLIP, CLIP)
        phi = np.cos(z @ self.weight + self.phase) * np.sqrt(2.0 / len(self.phase))
        return np.hstack([phi, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.beta

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.knots):
            return np.full(len(x), self.levels[0])
        return np.interp(self.raw(x), self.knots, self.levels)


def pool_adjacent(weight: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Isotonic (non-decreasing) means of cells with the given weights and label sums."""
    blocks: list[list[float]] = []
    for w, t in zip(weight, total):
        blocks.append([w, t, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            w2, t2, n2 = blocks.pop()
            blocks[-1][0] += w2
            blocks[-1][1] += t2
            blocks[-1][2] += n2
    return np.concatenate([np.full(int(n), t / w) for w, t, n in blocks]) if blocks else np.zeros(0)


def _matrix(batch: pa.RecordBatch, first: int) -> np.ndarray:
    return np.column_stack([batch.column(first + i).to_numpy(zero_copy_only=False) for i in range(len(MEASURES))])


def normal_equations(rows: DataFrame, model: QualityModel, adders: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Sum of phi'phi and phi'y over ``rows`` (label, then MEASURES). Tasks emit one fixed-size block
    each; ``adders`` tasks add the blocks as they stream in, and the driver adds at most that many."""
    size = len(model.beta)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, right = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                phi = model.features(_matrix(batch, 1))
                gram += phi.T @ phi
                right += phi.T @ batch.column(0).to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([pa.array([gram.tobytes()]), pa.array([right.tobytes()])], names=["gram", "right"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, right = np.zeros(size * size), np.zeros(size)
        for batch in batches:
            for g, r in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                gram += np.frombuffer(g)
                right += np.frombuffer(r)
        yield pa.RecordBatch.from_arrays([pa.array([gram.tobytes()]), pa.array([right.tobytes()])], names=["gram", "right"])

    blocks = rows.select("label", *MEASURES).mapInArrow(trimmed(sums), "gram binary, right binary")
    parts = blocks.repartition(adders).mapInArrow(trimmed(add), "gram binary, right binary").collect()
    gram = sum((np.frombuffer(p["gram"]) for p in parts), np.zeros(size * size)).reshape(size, size)
    return gram, sum((np.frombuffer(p["right"]) for p in parts), np.zeros(size))


def fit(stats: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", n_features: int = 160,
        ridge: float = 1.0, width: float = 3.0, bins: int = 400, seed: int = 7) -> QualityModel:
    """Learn from the rows of ``labels`` outside the held-out fold. ``stats`` has ``key``, ``fold`` and MEASURES."""
    known = labels.select(F.col(key).alias("_k"), F.col(label).cast("double").alias("label")).dropna()
    known = known.filter(fold(F.col("_k")) != 0)
    rows = materialize(stats.join(known, stats[key] == known["_k"]).select("label", "fold", *MEASURES), "labelled")
    spread = stats.agg(*[F.avg(c).alias(f"m_{c}") for c in MEASURES],
                       *[F.stddev_pop(c).alias(f"s_{c}") for c in MEASURES]).first()
    mean = np.array([spread[f"m_{c}"] or 0.0 for c in MEASURES])
    scale = np.maximum(np.array([spread[f"s_{c}"] or 0.0 for c in MEASURES]), 1e-6)
    rng = np.random.Generator(np.random.PCG64(seed))
    model = QualityModel(mean, scale, rng.normal(size=(len(MEASURES), n_features)) / width,
                         rng.uniform(0, 2 * np.pi, n_features), np.zeros(n_features + 1), np.zeros(0), np.array([0.5]))
    classes = rows.agg(F.count("label").alias("n"), F.avg("label").alias("p")).first()
    if not classes["n"] or classes["p"] in (0.0, 1.0):
        model.levels = np.array([classes["p"] if classes["n"] else 0.5])
        return model
    gram, right = normal_equations(rows.filter("fold != 1"), model)
    model.beta = np.linalg.solve(gram + ridge * np.eye(len(right)), right)
    # Calibration on the fold that the ridge never saw (all learning rows when that fold is empty).
    lo, hi = -0.5, 1.5

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            r = np.clip((model.raw(_matrix(batch, 1)) - lo) / (hi - lo), 0, 1 - 1e-9) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array((r * bins).astype(np.int32))], names=["label", "bin"])

    def grid(part: DataFrame) -> list:
        binned = part.select("label", *MEASURES).mapInArrow(trimmed(raw), "label double, bin int")
        return binned.groupBy("bin").agg(F.count("label").alias("n"), F.sum("label").alias("y")).orderBy("bin").collect()

    cells = grid(rows.filter("fold = 1")) or grid(rows)
    model.knots = np.array([lo + (c["bin"] + 0.5) * (hi - lo) / bins for c in cells])
    model.levels = pool_adjacent(np.array([float(c["n"]) for c in cells]), np.array([c["y"] for c in cells]))
    return model


def _row_key(key: Column, text: Column) -> list[Column]:
    """Two hashes that tell rows apart by id and text (never null)."""
    return [F.xxhash64(F.lit(i), key, text.isNull(), text).alias(f"_quality_{i}") for i in range(2)]


def keep_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                   label: str = "quality", threshold: float = 0.3, **fitting) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that score ``threshold`` or more. Rows are judged
    by id and text, so equal rows share their fate. The texts are not shuffled while the rejected
    rows' hashes are few (counted); beyond that they are joined by hash."""
    own = [f"_quality_{i}" for i in range(2)]
    keyed = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), *_row_key(F.col(key), F.col(text)))
    stats = materialize(document_statistics(keyed.withColumn("fold", fold(F.col("doc_id"))), ["doc_id", "fold", *own]), "docstats")
    model = fit(stats, labels.select(F.col(key).alias("doc_id"), F.col(label).alias("quality")), **fitting)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                low = pa.array(model.score(_matrix(batch, 2)) < threshold)
                yield pa.RecordBatch.from_arrays([c.filter(low) for c in batch.columns[:2]], names=own)

    rejected = materialize(stats.select(*own, *MEASURES).mapInArrow(trimmed(run), f"{own[0]} long, {own[1]} long").distinct(), "rejected")
    if rejected.count() <= SMALL_ROWS:
        rejected = F.broadcast(rejected)
    hashed = docs.select("*", *_row_key(F.col(key), F.col(text)))
    return hashed.join(rejected, own, "left_anti").select(*docs.columns)


def score_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                    label: str = "quality", threshold: float = 0.3, **fitting) -> DataFrame:
    """(key, held_out, score, predicted) for every row of ``docs``; see the module text."""
    plain = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    plain = plain.withColumn("fold", fold(F.col("doc_id")))
    stats = materialize(document_statistics(plain, ["doc_id", "fold"]), "docstats")
    model = fit(stats, labels.select(F.col(key).alias("doc_id"), F.col(label).alias("quality")), **fitting)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = model.score(_matrix(batch, 2)) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s)], names=["doc_id", "fold", "score"])

    scored = stats.select("doc_id", "fold", *MEASURES).mapInArrow(
        trimmed(run), f"doc_id {stats.schema['doc_id'].dataType.simpleString()}, fold long, score double")
    return scored.select(F.col("doc_id").alias(key), (F.col("fold") == 0).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
