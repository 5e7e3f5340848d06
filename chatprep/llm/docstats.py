"""Statistics of whole documents, computed batch by batch with numpy inside Spark tasks.

``document_statistics`` adds one column per statistic to the key columns it is given; both quality
operators learn from these columns. Nothing here looks at labels, language, source or ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import words as W
from .shared import trimmed

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MEASURES = ["log_words", "mean_word", "sd_word", "symbol_rate", "dup_line_rate", "repeat_rate", "distinct_rate",
            "upper_rate", "digit_rate", "mark_rate", "pipe_rate", "bang_rate", "wide_rate", "words_per_line",
            "words_per_stop", "end_rate"]

_IS = {
    "symbol": np.isin(np.arange(256), list(SYMBOLS)),
    "upper": np.isin(np.arange(256), list(range(65, 91))),
    "letter": np.isin(np.arange(256), [*range(65, 91), *range(97, 123)]),
    "digit": np.isin(np.arange(256), list(range(48, 58))),
    "mark": np.isin(np.arange(256), [b for b in range(33, 127) if not chr(b).isalnum()]),
    "pipe": np.isin(np.arange(256), [124]),
    "bang": np.isin(np.arange(256), [33]),
    "stop": np.isin(np.arange(256), list(b".!?")),
    "follow": (np.arange(256) & 0xC0) == 0x80,
}


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def statistics(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """All counts (exact) and measures of a run of whole texts."""
    n = len(offsets) - 1
    count = {k: _per_text(t[data], offsets) for k, t in _IS.items()}
    starts, ends = W.spans(data, offsets)
    doc = W.owner(offsets, starts)
    n_words = np.bincount(doc, minlength=n)
    follow = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_IS["follow"][data], out=follow[1:])
    length = (ends - starts) - (follow[ends] - follow[starts])
    word_chars = np.bincount(doc, weights=length, minlength=n).astype(np.int64)
    square = np.bincount(doc, weights=length.astype(float) ** 2, minlength=n)
    hashes = W.hash_spans(data, starts, ends)
    distinct = np.bincount(W.distinct_per(doc, hashes)[0], minlength=n)
    # Words inside 8-word windows that occur twice or more in their text.
    win, at = W.windows(hashes, doc, WINDOW)
    twice, _ = W.repeated(W.mix(win ^ W.mix(doc[at].astype(np.uint64), 7)))
    cover = np.zeros(len(doc) + 1, np.int64)
    cover[at[twice]] += 1
    np.add.at(cover, at[twice] + WINDOW, -1)
    n_repeat = np.bincount(doc[np.cumsum(cover[:-1]) > 0], minlength=n)
    # Lines that hold a word and equal an earlier line of their text.
    ls, le, ldoc = W.lines(data, offsets)
    held = np.searchsorted(starts, le) > np.searchsorted(starts, ls)
    ls, le, ldoc = ls[held], le[held], ldoc[held]
    lh = W.hash_spans(data, ls, le)
    _, again = W.repeated(W.mix(lh ^ W.mix(ldoc.astype(np.uint64), 11)))
    n_dup = np.bincount(ldoc[again], minlength=n)
    n_lines = np.bincount(ldoc, minlength=n)
    chars = (offsets[1:] - offsets[:-1]) - count["follow"]
    # Words that end in a sentence stop.
    stop_end = np.bincount(doc[_IS["stop"][data[ends - 1]]], minlength=n) if len(ends) else np.zeros(n, np.int64)

    def rate(a, b):
        return a / np.maximum(b, 1)

    mean = rate(word_chars, n_words)
    return {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": count["symbol"], "n_dup_lines": n_dup,
        "n_repeat_words": n_repeat,
        "log_words": np.log1p(n_words), "mean_word": mean,
        "sd_word": np.sqrt(np.maximum(rate(square, n_words) - mean ** 2, 0)),
        "symbol_rate": rate(count["symbol"], n_words), "dup_line_rate": rate(n_dup, n_lines),
        "repeat_rate": rate(n_repeat, n_words), "distinct_rate": rate(distinct, n_words),
        "upper_rate": rate(count["upper"], count["letter"]), "digit_rate": rate(count["digit"], chars),
        "mark_rate": rate(count["mark"], chars), "pipe_rate": rate(count["pipe"], n_words),
        "bang_rate": rate(count["bang"], n_words), "wide_rate": rate(count["follow"], chars),
        "words_per_line": np.log1p(rate(n_words, n_lines)),
        "words_per_stop": np.log1p(rate(n_words, count["stop"])), "end_rate": rate(stop_end, n_words),
    }


def document_statistics(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` plus every count (long) and measure (double) of the whole text; null counts as empty."""
    source = docs.select(*keys, text)
    schema = T.StructType([docs.schema[k] for k in keys] + [T.StructField(c, T.LongType()) for c in COUNTS]
                          + [T.StructField(c, T.DoubleType()) for c in MEASURES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W.text_buffer(batch.column(len(keys)))
            for lo, hi in W.slices(offsets):
                part = offsets[lo:hi + 1]
                s = statistics(data[part[0]:part[-1]], part - part[0])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(lo, hi - lo) for i in range(len(keys))]
                    + [pa.array(s[c], pa.int64()) for c in COUNTS] + [pa.array(s[c], pa.float64()) for c in MEASURES],
                    names=[*keys, *COUNTS, *MEASURES])

    return source.mapInArrow(trimmed(run), schema)
