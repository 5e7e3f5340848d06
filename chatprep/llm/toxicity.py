"""Toxicity: boosted trees over dense features of whole texts, with isotonic calibration.

* Texts are normalised byte by byte (lower case, digits and signs that stand for letters read as those
  letters) and cut into tokens. Two lexicons give densities: a short fixed list of insults, and one
  learned from labelled rows, of tokens and of token beginnings (4, 5 and 6 bytes, for inflected forms).
  A learned entry is a term whose document counts in the two classes differ by a log-odds of at least
  ``MIN_Z`` standard errors; at most ``max_entries`` are kept, the most certain first.
* The other features are second-person words and lexicon hits near one, capitals, punctuation, and
  obfuscation (digits inside words, signs between letters).
* At most ``max_rows`` labelled rows (those whose hashed ids come first; a documented bound of the
  sample) fit the lexicon and the trees; rows of the held-out fold never do. A row's features for
  fitting come from a lexicon counted without its own fold, so no row supports its own label. Every
  row is then scored with the lexicon of all learning folds.
* Scores of trees that were fitted without a row's fold are pooled into a fixed grid and made monotone
  (pool adjacent violators); the final trees are fitted on all sampled rows.

Defined cases: null text counts as empty and is scored like any other; null, repeated or unlabelled ids
are scored row by row; null labels are ignored, and a document with several labels counts once per label;
without usable labels every score is 0.5, with one class only it is that class's share; an empty table
gives an empty result; other columns are never read. Texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .quality_rff import pool_adjacent
from .quality_rules import FlatTrees, fit_trees
from .shared import fold, materialize, trimmed

# General insults and second-person words of the four languages.
INSULTS = """idiot moron stupid dumb loser trash scum worthless pathetic disgusting clown jerk fool imbecile
dumm dummkopf trottel abschaum wertlos widerlich stupide imbécile débile ordure minable crétin
estúpido imbécil basura inútil asqueroso payaso""".split()
SECOND_PERSON = "you your yours yourself du dich dir dein deine euch euer tu te toi ton ta vous votre tú ti usted vosotros".split()

PREFIXES = (4, 5, 6)  # bytes
MIN_Z = 2.0
STRONG_Z = 4.0
NEAR = 5  # tokens between a hit and a second-person word
FEATURES = ["lex_word", "lex_start", "lex_best", "lex_hits", "strong_hits", "strong_rate", "fixed_hits", "fixed_rate", "near_you",
            "you_rate", "upper_rate", "caps_rate", "bang_rate", "question_rate", "mark_rate", "mark_runs", "digit_inside",
            "sign_inside", "log_tokens"]
# More of these never lowers the score.
RISING = {"lex_word", "lex_best", "strong_hits", "strong_rate", "fixed_hits"}

_READ_AS = np.arange(256, dtype=np.uint8)
_READ_AS[65:91] += 32
for _sign, _letter in zip(b"013457@", b"oieasta"):
    _READ_AS[_sign] = _letter
_TOKEN = np.array([b >= 128 or chr(b).isalnum() or b == 64 for b in range(256)])
_LETTER = np.array([b >= 128 or chr(b).isalpha() for b in range(256)])
_PLAIN = np.array([b < 128 and chr(b).isalpha() for b in range(256)])
_UPPER = np.array([65 <= b <= 90 for b in range(256)])
_DIGIT = np.array([48 <= b <= 57 or b == 64 for b in range(256)])
_MARK = np.array([33 <= b < 127 and not chr(b).isalnum() for b in range(256)])
_INNER = np.isin(np.arange(256), list(b"*#$_.-+"))


def normalised(data: np.ndarray) -> np.ndarray:
    """Bytes as read: lower case (also of two-byte Latin letters), signs as letters, the rest as spaces."""
    out = np.where(_TOKEN[data], _READ_AS[data], np.uint8(32))
    if len(data) > 1:
        second = data[1:]
        raised = (data[:-1] == 0xC3) & (second >= 0x80) & (second <= 0x9E) & (second != 0x97)
        out[1:][raised] += 32
    return out


def _word_hashes(listed: list[str]) -> np.ndarray:
    data, offsets = W.text_buffer(pa.array([" ".join(listed)]))
    read = normalised(data)
    return np.unique(W.hash_spans(read, *W.spans(read, offsets)))


def terms(read: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Hashes of every token and of its beginnings (0 where the token is no longer than that)."""
    out = [W.mix(W.hash_spans(read, starts, ends), 100)]
    for n in PREFIXES:
        h = W.mix(W.hash_spans(read, starts, np.minimum(starts + n, ends)), 100 + n)
        out.append(np.where(ends - starts > n, h, np.uint64(0)))
    return out


@dataclass
class Lexicon:
    """Learned terms, sorted by hash; column f of the arrays was counted without fold f, column 0 on all."""

    hashes: np.ndarray
    weight: np.ndarray  # (entries, 5) log-odds, 0 where not an entry
    z: np.ndarray       # (entries, 5)

    def look_up(self, hashes: np.ndarray, column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.hashes):
            return np.zeros(len(hashes)), np.zeros(len(hashes))
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        found = self.hashes[at] == hashes
        return np.where(found, self.weight[at, column], 0.0), np.where(found, self.z[at, column], 0.0)


EMPTY = Lexicon(np.zeros(0, np.uint64), np.zeros((0, 5)), np.zeros((0, 5)))
_INSULTS, _SECOND = _word_hashes(INSULTS), _word_hashes(SECOND_PERSON)


def features(data: np.ndarray, offsets: np.ndarray, column: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    """(texts, FEATURES) of a run of whole texts; ``column`` picks the lexicon's column for each text."""
    n = len(offsets) - 1

    def per_text(flags: np.ndarray) -> np.ndarray:
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[offsets[1:]] - total[offsets[:-1]]

    read = normalised(data)
    starts, ends = W.spans(read, offsets)
    doc = W.owner(offsets, starts)
    n_tokens = np.bincount(doc, minlength=n)
    some = np.maximum(n_tokens, 1)
    plain = W.hash_spans(read, starts, ends)
    whole, *begins = terms(read, starts, ends)
    weight, z = lexicon.look_up(whole, column[doc])
    start_weight, start_z = np.zeros(len(doc)), np.zeros(len(doc))
    for h in begins:
        w2, z2 = lexicon.look_up(h, column[doc])
        start_weight, start_z = np.maximum(start_weight, w2), np.maximum(start_z, z2)
    fixed = np.isin(plain, _INSULTS)
    strong = np.maximum(z, start_z) >= STRONG_Z
    best = np.zeros(n)
    np.maximum.at(best, doc, np.maximum(weight, start_weight))
    # Hits with a second-person word at most NEAR tokens away in the same text.
    you = np.flatnonzero(np.isin(plain, _SECOND))
    hits = np.flatnonzero(strong | fixed)
    near = np.zeros(len(hits), bool)
    if len(you) and len(hits):
        at = np.searchsorted(you, hits)
        for other in (you[np.minimum(at, len(you) - 1)], you[np.maximum(at - 1, 0)]):
            near |= (np.abs(other - hits) <= NEAR) & (doc[other] == doc[hits])
    size = ends - starts

    def inside(flags: np.ndarray) -> np.ndarray:
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[ends] - total[starts]

    letters, digits, uppers = inside(_PLAIN[data]), inside(_DIGIT[data]), inside(_UPPER[data])
    mixed = (digits > 0) & (letters > 0)
    caps = (uppers >= 2) & (uppers == size)
    mark = _MARK[data]
    runs, between = np.zeros(len(data), bool), np.zeros(len(data), bool)
    if len(data) > 2:
        runs[1:] = mark[1:] & (data[1:] == data[:-1])
        between[1:-1] = _INNER[data[1:-1]] & _LETTER[data[:-2]] & _LETTER[data[2:]]
    chars = np.maximum(offsets[1:] - offsets[:-1], 1)

    def count(flags: np.ndarray) -> np.ndarray:
        return np.bincount(doc[flags], minlength=n)

    strong_n, fixed_n = count(strong), count(fixed)
    table = {
        "lex_word": np.bincount(doc, weights=weight, minlength=n) / some,
        "lex_start": np.bincount(doc, weights=start_weight, minlength=n) / some,
        "lex_best": best, "lex_hits": np.log1p(count((weight > 0) | (start_weight > 0))),
        "strong_hits": np.log1p(strong_n), "strong_rate": strong_n / some,
        "fixed_hits": np.log1p(fixed_n), "fixed_rate": fixed_n / some,
        "near_you": np.bincount(doc[hits[near]], minlength=n) / some, "you_rate": np.bincount(doc[you], minlength=n) / some,
        "upper_rate": per_text(_UPPER[data]) / np.maximum(per_text(_PLAIN[data]), 1), "caps_rate": count(caps) / some,
        "bang_rate": per_text(data == 33) / some, "question_rate": per_text(data == 63) / some,
        "mark_rate": per_text(mark) / chars, "mark_runs": per_text(runs) / some, "digit_inside": count(mixed) / some,
        "sign_inside": per_text(between) / some, "log_tokens": np.log1p(n_tokens),
    }
    return np.column_stack([table[c].astype(float) for c in FEATURES])


def _slices(batch: pa.RecordBatch, text_at: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = W.text_buffer(batch.column(text_at))
    for lo, hi in W.slices(offsets):
        part = offsets[lo:hi + 1]
        yield lo, hi, data[part[0]:part[-1]], part - part[0]


def term_counts(sample: DataFrame) -> DataFrame:
    """(h, fold, label, n): in how many rows of ``sample`` (fold, label, text) each term occurs. Counted
    per slice of about 1 MB in the reading task, then summed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where = batch.column(0).to_numpy().astype(np.uint64), batch.column(1).to_numpy().astype(np.uint64)
            for lo, hi, data, offsets in _slices(batch, 2):
                read = normalised(data)
                starts, ends = W.spans(read, offsets)
                doc = W.owner(offsets, starts)
                cell = where[0][lo:hi] * np.uint64(2) + where[1][lo:hi]
                for h in terms(read, starts, ends):
                    d, k = W.distinct_per(doc[h != 0], h[h != 0])
                    order = np.lexsort((k, cell[d]))
                    c, k = cell[d][order], k[order]
                    new = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (c[1:] != c[:-1])])) if len(k) else np.zeros(0, int)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(k[new].view(np.int64)), pa.array((c[new] // 2).astype(np.int32)), pa.array((c[new] % 2).astype(np.int32)),
                         pa.array(np.diff(np.append(new, len(k))).astype(np.int64))], names=["h", "fold", "label", "n"])

    counted = sample.select("fold", "label", "text").mapInArrow(trimmed(run), "h long, fold int, label int, n long")
    return counted.groupBy("h").agg(*[F.sum(F.when((F.col("fold") == f) & (F.col("label") == y), F.col("n")).otherwise(0)).alias(f"n{f}{y}")
                                      for f in range(1, 5) for y in (0, 1)])


def learn_lexicon(sample: DataFrame, max_entries: int) -> Lexicon:
    """Terms of the sampled rows that speak for label 1. Only ``max_entries`` rows reach the driver."""
    totals = {(r["fold"], r["label"]): r["n"] for r in sample.groupBy("fold", "label").agg(F.count("*").alias("n")).collect()}

    def evidence(ones, zeros, n_ones, n_zeros, log, sqrt):
        odds = log((ones + 0.5) / (n_ones + 1.0)) - log((zeros + 0.5) / (n_zeros + 1.0))
        return odds, odds / sqrt(1.0 / (ones + 0.5) + 1.0 / (zeros + 0.5))

    def rows(label: int, without: int = 0) -> int:
        return sum(n for (f, y), n in totals.items() if y == label and f != without)

    ones, zeros = (sum((F.col(f"n{f}{y}") for f in range(1, 5)), F.lit(0)) for y in (1, 0))
    _, z = evidence(ones, zeros, rows(1), rows(0), F.log, F.sqrt)
    kept = term_counts(sample).withColumn("z", z).filter((F.col("z") >= MIN_Z) & (ones >= 2))
    table = kept.orderBy(F.desc("z"), "h").limit(max_entries).orderBy("h").toArrow()
    if not table.num_rows:
        return EMPTY
    n = {(f, y): table.column(f"n{f}{y}").to_numpy().astype(float) for f in range(1, 5) for y in (0, 1)}
    weight, zs = np.zeros((table.num_rows, 5)), np.zeros((table.num_rows, 5))
    for column in range(5):
        a, b = (sum(n[f, y] for f in range(1, 5) if f != column) for y in (1, 0))
        odds, z = evidence(a, b, rows(1, column), rows(0, column), np.log, np.sqrt)
        entry = (z >= MIN_Z) & (a >= 2)
        weight[entry, column], zs[entry, column] = odds[entry], z[entry]
    hashes = table.column("h").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return Lexicon(hashes[order], weight[order], zs[order])


@dataclass
class ToxicModel:
    """Everything a task needs to score texts: at most ``max_entries`` terms, the trees and the knots."""

    lexicon: Lexicon
    trees: FlatTrees | None
    knots: np.ndarray
    levels: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), self.levels[0])
        p = np.concatenate([np.zeros(0)] + [self.trees.probability(x[lo:lo + 4096]) for lo in range(0, len(x), 4096)])
        return np.interp(p, self.knots, self.levels)


def calibrate(p: np.ndarray, y: np.ndarray, bins: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Knots and non-decreasing levels of the label's share over a grid of tree probabilities."""
    at = np.minimum((p * bins).astype(int), bins - 1)
    n, ones = np.bincount(at, minlength=bins).astype(float), np.bincount(at, weights=y, minlength=bins)
    used = np.flatnonzero(n)
    return np.bincount(at, weights=p, minlength=bins)[used] / n[used], pool_adjacent(n[used], ones[used])


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, max_entries: int = 20_000, **boosting) -> ToxicModel:
    """Learn from at most ``max_rows`` labelled rows. ``docs`` has doc_id and text, ``labels`` doc_id and label."""
    known = labels.select(F.col("doc_id").alias("_k"), F.col("label").cast("int").alias("label")).dropna().filter("label IN (0, 1)")
    known = known.withColumn("fold", fold(F.col("_k"))).filter("fold != 0")
    known = known.orderBy(F.xxhash64("_k"), "_k", "label").limit(max_rows)  # the documented bound of the sample
    sample = docs.join(F.broadcast(known), docs["doc_id"] == known["_k"]).select(F.col("fold").cast("int").alias("fold"), "label", "text")
    sample = materialize(sample, "toxic-sample")
    classes = sample.agg(F.count("label").alias("n"), F.avg("label").alias("p")).first()
    if not classes["n"] or classes["p"] in (0.0, 1.0):
        return ToxicModel(EMPTY, None, np.zeros(0), np.array([classes["p"] if classes["n"] else 0.5]))
    lexicon = learn_lexicon(sample, max_entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0).to_numpy()
            for lo, hi, data, offsets in _slices(batch, 2):
                x = features(data, offsets, column[lo:hi], lexicon)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo)]
                                                 + [pa.array(np.ascontiguousarray(x[:, i])) for i in range(len(FEATURES))], names=["fold", "label", *FEATURES])

    schema = "fold int, label int, " + ", ".join(f"{c} double" for c in FEATURES)
    rows = sample.select("fold", "label", "text").mapInArrow(trimmed(run), schema)
    table = rows.orderBy(*rows.columns).limit(max_rows).toArrow()
    folds, y = table.column(0).to_numpy(), table.column(1).to_numpy().astype(float)
    x = np.column_stack([table.column(i + 2).to_numpy() for i in range(len(FEATURES))])
    sign = np.array([1 if c in RISING else 0 for c in FEATURES])
    unseen = np.full(len(y), y.mean())
    for f in range(1, 5):
        own = folds == f
        if own.any() and not own.all():
            unseen[own] = fit_trees(x[~own], y[~own], sign, **boosting).probability(x[own])
    return ToxicModel(lexicon, fit_trees(x, y, sign, **boosting), *calibrate(unseen, y))


def score_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
                    threshold: float = 0.5, **fitting) -> DataFrame:
    """(key, held_out, score, predicted) for every row of ``docs``; see the module text."""
    plain = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    model = fit(plain, labels.select(F.col(key).alias("doc_id"), F.col(label).alias("label")), **fitting)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in _slices(batch, 1):
                x = features(data, offsets, np.zeros(hi - lo, np.int64), model.lexicon)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(model.score(x))], names=["doc_id", "score"])

    scored = plain.mapInArrow(trimmed(run), f"doc_id {plain.schema['doc_id'].dataType.simpleString()}, score double")
    return scored.select(F.col("doc_id").alias(key), (fold(F.col("doc_id")) == 0).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
