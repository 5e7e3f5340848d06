"""Best-fit packing planned on a length histogram.

* Texts become token ids (byte-level BPE) plus a closing id; only documents longer than a sequence
  are cut, into full pieces after a first, possibly shorter one.
* The histogram of piece lengths (at most ``capacity`` rows) is all the driver sees. Best-fit
  decreasing runs on counts: a group of equally filled sequences takes as many pieces of a length
  as fit at once, and splits where the pieces run out. A length adds at most two groups, so the
  plan is bounded by the capacity, not by the documents.
* Pieces are numbered within their length (range partitions, counts, offsets), and each takes the
  planned slot of its rank.

Defined cases: null or empty text is one piece holding only the closing id; null or repeated ids are
packed row by row; any number of very long texts; an empty table gives an empty result. Only the id
and the text column are read.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import global_row_number
from .shared import materialize, trimmed

VOCABULARY = "byte_bpe_50k.json"
CLOSING_ID = 2
CAPACITY = 1024

_encoders: dict[str, object] = {}


class Encoder:
    """Ids of a byte-level BPE vocabulary file, as ``tokenizers`` gives them without special tokens around the text.

    The file is run by ``tiktoken``, which gives the same ids (tested, long unbroken runs included) at a
    quarter of the CPU time; a text that holds one of the file's added tokens goes to ``tokenizers`` itself."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path, self.slow = path, None
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        special = {t["content"] for t in spec.get("added_tokens", [])}
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(printable)]
        byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self.fast = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if any(token in text for token in self.added):
            if self.slow is None:
                from tokenizers import Tokenizer

                self.slow = Tokenizer.from_file(self.path)
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self.fast.encode_ordinary(text), np.uint32)


def encoder(path: str | None) -> Encoder:
    """One encoder per worker process; ``path`` None means the public vocabulary on that worker."""
    if path is None:
        import public_tokenizers

        path = str(public_tokenizers.path(VOCABULARY))
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def piece_bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: the first holds what full pieces leave over."""
    first = (n - 1) % capacity + 1
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def tokenize_pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                    vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids where asked for)."""
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                row, cols = [], ([], [], [], [], [])
                for i, t in enumerate(part.column(1).to_pylist()):
                    ids = np.append(enc.ids(t or ""), np.uint32(CLOSING_ID)).astype("<u4")
                    for p, (start, length) in enumerate(piece_bounds(len(ids), capacity)):
                        row.append(i)
                        own = ids[start:start + length]
                        for c, v in zip(cols, (p, start, length, zlib.crc32(own.tobytes()), own if with_ids else None)):
                            c.append(v)
                arrays = [part.column(0).take(pa.array(row, pa.int64())), pa.array(cols[0], pa.int32())]
                arrays += [pa.array(c, pa.int64()) for c in cols[1:4]]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array([x.astype(np.int32) for x in cols[4]], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return source.mapInArrow(trimmed(run), schema)


@dataclass
class Plan:
    """Slots by (length, rank): interval starts with their sequences, pieces per sequence and offsets."""

    length: np.ndarray
    rank: np.ndarray
    sequence: np.ndarray
    per: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.length.astype(np.int64) << 44 | self.rank, length << 44 | rank, side="right") - 1
        nth = rank - self.rank[at]
        return self.sequence[at] + nth // self.per[at], self.offset[at] + nth % self.per[at] * length


def plan_slots(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Best-fit decreasing over counts of lengths."""
    groups: dict[int, list[tuple[int, int]]] = {}  # free space -> [(first sequence, sequences)]
    free: list[int] = []                           # the keys of groups, ascending
    slots: list[tuple[int, int, int, int, int]] = []
    made = 0

    def put(space: int, first: int, count: int) -> None:
        if count:
            if space not in groups:
                groups[space] = []
                insort(free, space)
            groups[space].append((first, count))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            k = bisect_left(free, length)
            if k < len(free):
                space = free[k]
                first, count = groups[space].pop()
                if not groups[space]:
                    del groups[space]
                    free.pop(k)
            else:
                space, first = capacity, made
                count = -(-left // (capacity // length))
                made += count
            per = space // length
            full = min(count, left // per)
            if full:
                slots.append((length, rank, first, per, capacity - space))
                put(space - per * length, first, full)
            rest = min(left - full * per, per - 1) if full < count else 0
            if rest:
                slots.append((length, rank + full * per, first + full, rest, capacity - space))
                put(space - rest * length, first + full, 1)
            put(space, first + full + bool(rest), count - full - bool(rest))
            rank += full * per + rest
            left -= full * per + rest
    slots.sort()
    cols = np.array(slots, np.int64).reshape(-1, 5).T
    return Plan(*cols, made)


def pack_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                   vocabulary: str | None = None) -> DataFrame:
    """(key, piece, start, length, ids_crc32, sequence_id, offset): every piece in its planned slot."""
    pieces = materialize(tokenize_pieces(docs, key, text, capacity, vocabulary), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = plan_slots(histogram, capacity)
    ranked = global_row_number(pieces, ["doc_id", "piece", "start", "ids_crc32"], group_col="length", out="rank")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sequence, offset = plan.place(batch.column(3).to_numpy(), batch.column(5).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                                             names=[*columns, "sequence_id", "offset"])

    kind = pieces.schema["doc_id"].dataType.simpleString()
    placed = ranked.select(*columns, F.col("rank").cast("long")).mapInArrow(
        trimmed(run), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return placed.withColumnRenamed("doc_id", key)


def assemble_sequences(pieces: DataFrame) -> DataFrame:
    """Token sequences from placed pieces that carry ``ids``: (sequence_id, ids). A sequence holds at
    most ``capacity`` ids, so each group is bounded."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda s: s["ids"])
    return pieces.groupBy("sequence_id").agg(F.flatten(parts).alias("ids"))
