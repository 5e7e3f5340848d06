"""Line dedup by an exact set-similarity join with prefix, positional and length filters.

A line (split at \\n) is the set of its distinct words, A-Z in lower case. A line is removed if an
earlier line (by id, then line number; removed or not) has a Jaccard similarity of ``percent`` or
more; lines with fewer than ``min_words`` distinct words stay and match nothing. With ``min_words=1``, as
the queries call it, every line with a word takes part.

1. Word counts over all lines, added up in a fixed number of hash buckets, order words by rarity. Any
   fixed order gives the exact result; a good one makes it cheap. Very frequent words are counted by name.
2. Every line enters the groups of its rarest words: two similar lines share a word among the first
   n - ceil(t n) + 1 of each. Lines too short to be similar to any other set (n / (n + 1) < t: one or two
   words at 0.75) match equal sets only, so they enter none and are found by their set's hash. Tasks pack
   these entries (word, line set, size, position, parity bitmap) into arrays dealt by ranges of words, as many
   ranges as the counted entries need, one row per array, copies of a line set within a task only once.
   The groups of the NAMED most frequent words are dealt into block pairs at once; a task that finds
   another group larger than GROUP sends it on to be dealt into block pairs too. Any two lines of a group
   still meet, and no task compares more than two blocks at a time.
3. In a group, pairs must pass the length filter, the positional filter (enough words left at the first
   common one), and the bitmap bound (equal words cannot differ in parity, so the bits in which two
   bitmaps differ bound the overlap from above).
   Entries without a possible partner end here; only the rest is written.
4. The sets of the lines that are left are read again where the texts lie (a filter of at most 16 MB tells which
   lines to take), and candidates are verified: first each line
   set's most alike earlier partner and its group's first one; lines that are found need no more. For
   the others all candidates are verified. No group's matches are all written out.

Words are known by a 64-bit hash; line sets by two 64-bit hashes of their words' (128 bits), which decide on equal
sets; in candidate groups, words by 44 bits and line sets by the first hash, and what these suggest is verified on sets
of 64-bit words.

Defined cases: null or empty text is one empty line and stays; null ids are left alone and match
nothing; rows that repeat an id share its line numbers, and a number kept for one is kept for all; the
first of equal lines stays; an empty table gives an empty result. ``deduplicated`` keeps all columns of
``docs`` whatever their names, unless they start with ``_line_``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ranking import global_row_number
from . import words as W
from .chosen_path import confirm
from .shared import materialize, release, trimmed, whole_groups

U = np.uint64
BUCKET_BITS = 18       # buckets of the rarity table: 2 MB, whatever the input
TOKEN_BITS = 44        # of a word's hash in candidate generation; the rest of a long numbers the line
LINES_AT_ONCE = 1 << (64 - TOKEN_BITS)
CHUNK = 1 << 14        # buckets of the rarity table in one row
SLICE = 1 << 20        # bytes of text per numpy step: fewer lines with words than LINES_AT_ONCE
FREQUENT = 2048        # a word is counted by name in a task where it makes up 1 in this many words
NAMED = 4096           # so many words at most are dealt into block pairs from the start
GROUP = 8192           # entries of one block; a group of more is dealt into block pairs
PART = 1 << 20         # entries that one task may be expected to hold
SMALL_ROWS = 20_000    # a table of ids or numbers is broadcast only if counted to hold at most so many
BUFFER = 1 << 19       # entries that a task holds before it deals them out
WIDE = 8               # longs of the bitmap that verification candidates use
BITS = 2               # longs of the bitmap that an entry carries
ENTRY = np.dtype([("key", "<u4"), ("n", "<u2"), ("pos", "<u2"), ("sid", "<u8"), ("bits", "<u8", (BITS,))])


def _small(df: DataFrame, weight: Column | None = None) -> DataFrame:
    """A written table with a broadcast hint if it was counted to be small, else for a sort-merge join, so that the plan
    changes at one counted size only. ``weight`` counts what a row holds beyond itself."""
    rows = df.count() if weight is None else df.agg(F.sum(weight + 1)).first()[0] or 0
    return F.broadcast(df) if rows <= SMALL_ROWS else df.hint("merge")


def line_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(line of each word, its hash, then per line: text, number in the text) of a run of texts."""
    ls, _, ldoc = W.lines(data, offsets)
    data = W.LOWER[data]
    starts, ends = W.spans(data, offsets)
    first = np.searchsorted(ldoc, np.arange(len(offsets) - 1))
    # An empty line at the very end of a text starts where the next text starts: it holds no word,
    # and the search below finds the last line that starts at or before a word.
    line = np.searchsorted(ls, starts, side="right") - 1
    return line, W.hash_spans(data, starts, ends), ldoc, np.arange(len(ls)) - first[ldoc]


def ordered_tokens(line: np.ndarray, hashes: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (line, word) pairs with the word's token and hash, words of a line in order of rarity (then hash)."""
    low = U(TOKEN_BITS - BUCKET_BITS)
    token = (rank[(hashes >> U(64 - BUCKET_BITS)).astype(np.int64)] << low) | ((hashes >> U(64 - TOKEN_BITS)) & ((U(1) << low) - U(1)))
    wide = len(line) and line[-1] >= LINES_AT_ONCE
    both = token if wide else (line.astype(np.uint64) << U(TOKEN_BITS)) | token
    order = np.lexsort((token, line)) if wide else np.argsort(both)
    if wide:
        line, token, hashes = line[order], token[order], hashes[order]
    else:
        both, hashes = both[order], hashes[order]
        line, token = (both >> U(TOKEN_BITS)).astype(np.int64), both & ((U(1) << U(TOKEN_BITS)) - U(1))
    same = (token[1:] == token[:-1]) & (line[1:] == line[:-1])
    if (same & (hashes[1:] != hashes[:-1])).any():  # two words with one token: bring equal words together
        order = np.lexsort((hashes, token, line))
        line, token, hashes = line[order], token[order], hashes[order]
        same = (token[1:] == token[:-1]) & (line[1:] == line[:-1])
    if len(line):
        new = np.concatenate([[True], ~(same & (hashes[1:] == hashes[:-1]))])
        line, token, hashes = line[new], token[new], hashes[new]
    return line, token, hashes


def _needed(n: np.ndarray, percent: int) -> np.ndarray:
    """Words that a line of n words must share with a similar line: ceil(percent n / 100)."""
    return -(-n * percent // 100)


def _alone(n: np.ndarray, percent: int) -> np.ndarray:
    """Is a line of n words similar to equal sets only? (Unequal sets have at most n / (n + 1) in common.)"""
    return n * (100 - percent) < percent


def word_counts(docs: DataFrame) -> tuple[np.ndarray, dict[int, int], int]:
    """(rank of each bucket by count, {token bits of a frequent word: count}, all words) of ``docs`` (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = np.zeros(1 << BUCKET_BITS, np.int64)
        named: dict[int, int] = {}
        for batch in batches:
            data, offsets = W.text_buffer(batch.column(0))
            for lo, hi in W.slices(offsets):
                part = offsets[lo:hi + 1]
                lower = W.LOWER[data[part[0]:part[-1]]]
                hashes = W.hash_spans(lower, *W.spans(lower, part - part[0]))
                buckets += np.bincount((hashes >> U(64 - BUCKET_BITS)).astype(np.int64), minlength=1 << BUCKET_BITS)
                hashes.sort()
                edge = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
                count = np.diff(np.append(edge, len(hashes)))
                for i in np.flatnonzero((count > 64) & (count * FREQUENT > len(hashes))):
                    name = int(hashes[edge[i]]) >> (64 - TOKEN_BITS)
                    named[name] = named.get(name, 0) + int(count[i])
        # The buckets as CHUNK counts a row, so a task has a fixed number of rows; then at most FREQUENT names a slice.
        for lo in range(0, len(buckets), CHUNK):
            yield pa.RecordBatch.from_arrays([pa.array([lo]), pa.array([-1]), pa.array([0]), pa.array([buckets[lo:lo + CHUNK].tobytes()], pa.binary())], names=names)
        said = sorted(named)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(said), -1)), pa.array(said, pa.int64()), pa.array([named[x] for x in said], pa.int64()),
                                          pa.nulls(len(said), pa.binary())], names=names)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for lo, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[lo] = sums.get(lo, 0) + np.frombuffer(counts, np.int64)
        for lo, counts in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lo]), pa.array([counts.tobytes()], pa.binary())], names=["bucket", "counts"])

    names = ["bucket", "name", "count", "counts"]
    seen = materialize(docs.select("text").mapInArrow(trimmed(run), "bucket long, name long, count long, counts binary"), "words")
    chunks = seen.filter("bucket >= 0").select("bucket", "counts").repartition(16, "bucket").mapInArrow(trimmed(add), "bucket long, counts binary").collect()
    named = seen.filter("name >= 0").groupBy("name").agg(F.sum("count").alias("count")).filter(F.col("count") > GROUP)
    named = named.orderBy(F.desc("count"), "name").limit(NAMED).collect()
    release(seen)
    counts = np.zeros(1 << BUCKET_BITS, np.int64)
    for r in chunks:  # 2**BUCKET_BITS counts in all
        counts[r["bucket"]:r["bucket"] + CHUNK] = np.frombuffer(r["counts"], np.int64)
    rank = np.empty(1 << BUCKET_BITS, np.uint64)
    rank[np.lexsort((np.arange(len(counts)), counts))] = np.arange(len(counts), dtype=np.uint64)
    return rank, {r["name"]: r["count"] for r in named}, int(counts.sum())


def _entries(tokens: np.ndarray, line: np.ndarray, n: np.ndarray, sid: np.ndarray, bits: np.ndarray, first: np.ndarray,
             percent: int, blocks: dict[int, int]) -> np.ndarray:
    """The group entries of a run of lines: one per prefix word, more for words dealt into blocks, none for
    lines that only equal sets are similar to."""
    pos = np.arange(len(tokens)) - first[line]
    take = (pos <= (n - _needed(n, percent))[line]) & ~_alone(n, percent)[line]
    token, at, pos = tokens[take], line[take], pos[take]
    entry = np.empty(len(token), ENTRY)
    key = W.mix(token, 3)
    entry["n"], entry["pos"] = np.minimum(n[at], 65535), np.minimum(pos, 65535)
    entry["sid"], entry["bits"] = sid[at], bits[at]
    entry["key"] = (key >> U(32)).astype(np.uint32)
    if blocks:
        names = np.array(sorted(blocks), np.uint64)
        where = np.minimum(np.searchsorted(names, token), len(names) - 1)
        hot = names[where] == token
        if hot.any():
            out = [entry[~hot]]
            for name in np.unique(token[hot]):
                own, count = entry[token == name], blocks[int(name)]
                mine = (own["sid"] % U(count)).astype(np.int64)
                for other in range(count):
                    copy = own.copy()
                    pair = np.minimum(mine, other) * count + np.maximum(mine, other)
                    copy["key"] = (W.mix(W.mix(pair.astype(np.uint64), 5) ^ name, 4) >> U(32)).astype(np.uint32)
                    out.append(copy)
            entry = np.concatenate(out)
    return entry


def _parity(tokens: np.ndarray, line: np.ndarray, count: int, width: int, seed: int) -> np.ndarray:
    """Parity bitmaps (count, width) of the distinct ``tokens`` of lines: each token flips one bit."""
    h = W.mix(tokens, seed)
    bit = U(1) << (h & U(63))
    word = ((h >> U(6)) % U(width)).astype(np.int64)
    out = np.zeros((count, width), np.uint64)
    starts = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]])) if len(line) else np.zeros(0, np.int64)
    for w in range(width) if len(starts) else ():
        out[line[starts], w] = np.bitwise_xor.reduceat(np.where(word == w, bit, U(0)), starts)
    return out


def _set_hashes(word: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Two hashes of each set of words (runs that begin at ``first``), whatever their order."""
    n = np.diff(np.append(first, len(word))).astype(np.uint64)
    return [W.mix(np.add.reduceat(W.mix(word, seed), first) ^ n, seed + 1) for seed in (8, 14)]


def _again(doc: np.ndarray, sid: np.ndarray, sid2: np.ndarray) -> np.ndarray:
    """Is this line's set also that of an earlier line of its text?"""
    key = W.mix(sid ^ W.mix(doc.astype(np.uint64), 12))
    order = np.argsort(key, kind="stable")
    d, a, b = doc[order], sid[order], sid2[order]
    same = (a[1:] == a[:-1]) & (d[1:] == d[:-1])
    if (same & (b[1:] != b[:-1])).any():
        order = np.lexsort((np.arange(len(doc)), sid2, sid, doc))
        d, a, b = doc[order], sid[order], sid2[order]
        same = (a[1:] == a[:-1]) & (d[1:] == d[:-1])
    out = np.zeros(len(doc), bool)
    out[order[1:]] = same & (b[1:] == b[:-1])
    return out


def _distinct(e: np.ndarray) -> np.ndarray:
    """``e`` sorted by key, equal (key, line set) entries once (but for line sets that agree in 32 bits)."""
    e = e[np.argsort((e["key"].astype(np.uint64) << U(32)) | (e["sid"] & U(0xFFFFFFFF)))]
    new = np.ones(len(e), bool)
    new[1:] = (e["key"][1:] != e["key"][:-1]) | (e["sid"][1:] != e["sid"][:-1])
    return e[new]


def scan_lines(docs: DataFrame, rank: np.ndarray, frequent: dict[int, int], percent: int, min_words: int, parts: int) -> DataFrame:
    """One pass over the texts with two kinds of rows, both dealt by ``part``: (doc_id, line_no, sid, sid2, again) of
    every eligible line (``again``: an earlier line of the text has the same set), and a ``blob`` of packed
    group entries."""
    low = TOKEN_BITS - BUCKET_BITS
    blocks = {}
    for name, count in frequent.items():
        bucket, rest = name >> low, name & ((1 << low) - 1)
        blocks[(int(rank[bucket]) << low) | rest] = -(-count // GROUP)
    schema = T.StructType([docs.schema["doc_id"], *T._parse_datatype_string("line_no int, sid long, sid2 long, again boolean, part int, blob binary").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        kind = None

        def dealt() -> Iterator[pa.RecordBatch]:
            entries = _distinct(np.concatenate(held))  # copies of a line set give equal entries: one per task
            # Parts are ranges of keys, and the entries are sorted by key.
            cut = np.searchsorted(entries["key"], -(-(np.arange(parts + 1, dtype=np.int64) << 32) // parts))
            some = np.flatnonzero(np.diff(cut))
            for lo in range(0, len(some), 64):
                chosen = some[lo:lo + 64]
                blobs = pa.array([entries[cut[p]:cut[p + 1]].tobytes() for p in chosen], pa.binary())
                n = len(chosen)
                yield pa.RecordBatch.from_arrays([pa.nulls(n, kind), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.bool_()),
                                                  pa.array(chosen, pa.int32()), blobs], names=schema.names)

        for batch in batches:
            kind = batch.column(0).type
            data, offsets = W.text_buffer(batch.column(1))
            for lo, hi in W.slices(offsets, SLICE):
                p = offsets[lo:hi + 1]
                line, hashes, ldoc, number = line_words(data[p[0]:p[-1]], p - p[0])
                line, token, word = ordered_tokens(line, hashes, rank)
                n = np.bincount(line, minlength=len(ldoc))
                good = n >= min_words
                keep = good[line]
                line, token, word = line[keep], token[keep], word[keep]
                if not len(line):
                    continue
                index = np.cumsum(good) - 1
                line, ldoc, number, n = index[line], ldoc[good], number[good], n[good]
                first = np.concatenate([[0], np.cumsum(n)[:-1]])
                sid, sid2 = _set_hashes(word, first)
                again = _again(ldoc, sid, sid2)
                entry = _entries(token, line, n, sid, _parity(token, line, len(n), BITS, 10), first, percent, blocks)
                held.append(entry)
                size += len(entry)
                ids = batch.column(0).slice(lo, hi - lo).take(pa.array(ldoc))
                rows = len(ldoc)
                # Short lines repeat most: they are dealt evenly, not by line set.
                deal = np.where(_alone(n, percent), np.arange(rows, dtype=np.uint64) + sid[0] % U(parts), sid)
                yield pa.RecordBatch.from_arrays([ids, pa.array(number, pa.int32()), pa.array(sid.view(np.int64)), pa.array(sid2.view(np.int64)), pa.array(again),
                                                  pa.array((deal % U(parts)).astype(np.int32)), pa.nulls(rows, pa.binary())], names=schema.names)
                if size >= BUFFER:
                    yield from dealt()
                    held, size = [], 0
        if held:
            yield from dealt()

    return docs.mapInArrow(trimmed(run), schema)


def _candidates(e: np.ndarray, bitmap: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, differing bits) of entry pairs of one group that pass all filters; i has the smaller set.
    ``e`` is sorted by key and size.

    With a = ceil(p (n_i + n_j) / (100 + p)) words to share, a similar pair meets at its first common word,
    where both sides have a words left: pos <= n - a. For the smaller side a is at least
    2p / (100 + p) of its size, so entries behind that never start a pair."""
    key, n, pos = e["key"].astype(np.int64), e["n"].astype(np.int64), e["pos"].astype(np.int64)
    full = n >= 65535  # sizes that do not fit pass every filter
    # In its group, an entry meets sizes from its own up to the largest that the length filter allows.
    last = np.searchsorted(key << 20 | n, key << 20 | np.where(full, 65535, np.minimum(n * 100 // percent, 65535)), side="right")
    at, shift = np.flatnonzero((pos <= n - -(-2 * percent * n // (100 + percent))) | full), 1
    while True:
        at = at[at + shift < last[at]]
        if not len(at):
            return
        i, j = at, at + shift
        total = n[i] + n[j]
        share = -(-percent * total // (100 + percent))
        large = full[j]
        ok = ((pos[i] <= n[i] - share) & (pos[j] <= n[j] - share)) | large
        i, j, total, large = i[ok], j[ok], total[ok], large[ok]
        differ = np.bitwise_count(bitmap[i] ^ bitmap[j]).sum(axis=1, dtype=np.int64)
        ok = ((100 + percent) * (total - differ) >= 2 * percent * total) | large
        yield i[ok], j[ok], differ[ok]
        shift += 1


def _sizes(e: np.ndarray) -> np.ndarray:
    """Entries in the group of each entry of ``e``, sorted by key."""
    edge = np.flatnonzero(np.concatenate([[True], e["key"][1:] != e["key"][:-1]])) if len(e) else np.zeros(0, np.int64)
    count = np.diff(np.append(edge, len(e)))
    return np.repeat(count, count)


def active_entries(scanned: DataFrame, percent: int, parts: int) -> DataFrame:
    """The line rows as they are, (key, sid, n, pos) of the entries with a possible partner in their group, and
    unchecked the entries, with ``bits``, of groups that are too large for one task."""
    own = ("doc_id", "line_no", "sid", "sid2", "again")
    schema = T.StructType([*(scanned.schema[c] for c in own), *T._parse_datatype_string("key long, n int, pos int, bits binary, size int").fields])

    def rows(e: np.ndarray, kind: pa.DataType, size: np.ndarray | None = None) -> pa.RecordBatch:
        m = len(e)
        flat = np.ascontiguousarray(e["bits"]).view(np.uint8)
        at = np.arange(0, (m + 1) * 8 * BITS, 8 * BITS, dtype=np.int32)
        bits = pa.nulls(m, pa.binary()) if size is None else pa.Array.from_buffers(pa.binary(), m, [None, pa.py_buffer(at), pa.py_buffer(flat)])
        return pa.RecordBatch.from_arrays([pa.nulls(m, kind), pa.nulls(m, pa.int32()), pa.array(e["sid"].view(np.int64)), pa.nulls(m, pa.int64()), pa.nulls(m, pa.bool_()),
                                           pa.array(e["key"].astype(np.int64)), pa.array(e["n"].astype(np.int32)), pa.array(e["pos"].astype(np.int32)), bits,
                                           pa.nulls(m, pa.int32()) if size is None else pa.array(size.astype(np.int32))], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got, kind = [], None
        for batch in batches:
            kind = batch.column(0).type
            got += [np.frombuffer(b, ENTRY) for b in batch.column(5).filter(batch.column(5).is_valid()).to_pylist()]
            lines = batch.filter(batch.column(5).is_null())
            n = lines.num_rows
            none = pa.nulls(n, pa.int32())
            yield pa.RecordBatch.from_arrays([*lines.columns[:5], pa.nulls(n, pa.int64()), none, none, pa.nulls(n, pa.binary()), none], names=schema.names)
        if not got:
            return
        e = _distinct(np.concatenate(got))
        got.clear()
        size = _sizes(e)
        large = size > 2 * GROUP
        for lo in range(0, int(large.sum()), BUFFER):
            yield rows(e[large][lo:lo + BUFFER], kind, size[large][lo:lo + BUFFER])
        e = e[(size > 1) & ~large]
        e = e[np.lexsort((e["n"], e["key"]))]
        yield rows(e[_possible(e, percent)], kind)

    return scanned.repartition(parts, "part").select(*own, "blob").mapInArrow(trimmed(run), schema)


def _possible(e: np.ndarray, percent: int) -> np.ndarray:
    active = np.zeros(len(e), bool)
    for i, j, _ in _candidates(e, e["bits"], percent):
        active[i] = active[j] = True
    return active


def large_groups(rows: DataFrame, percent: int) -> DataFrame:
    """(key, sid, n, pos) of the entries of large groups (key, sid, n, pos, bits, size) with a possible partner, in
    block pairs of their group: a new key for every two blocks, in which any two of their entries meet."""
    blocks = F.ceil(F.col("size") / F.lit(GROUP)).cast("int")
    dealt = rows.withColumns({"c": blocks, "mine": F.pmod(F.xxhash64("sid"), blocks).cast("int")})
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("c") - 1)))
    # The new key lies beyond 32 bits, where no other group's key is.
    pair = F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other"))
    dealt = dealt.select(pair.bitwiseOR(F.lit(1 << 62)).alias("key"), "sid", "n", "pos", "bits")
    dealt = dealt.repartition("key").sortWithinPartitions("key", "n")

    def check(t: pa.Table) -> pa.RecordBatch:
        key = t.column("key").to_numpy()
        e = np.zeros(t.num_rows, ENTRY)
        edge = np.concatenate([[True], key[1:] != key[:-1]])
        e["key"] = np.cumsum(edge) - 1
        for c in ("n", "pos"):
            e[c] = t.column(c).to_numpy()
        e["bits"] = np.frombuffer(b"".join(t.column("bits").to_pylist()), np.uint64).reshape(-1, BITS)
        active = pa.array(_possible(e, percent))
        return pa.RecordBatch.from_arrays([t.column(c).combine_chunks().filter(active) for c in ("key", "sid", "n", "pos")], names=["key", "sid", "n", "pos"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from whole_groups(batches, "key", check)

    return dealt.mapInArrow(trimmed(run), "key long, sid long, n int, pos int")


def _places(h: np.ndarray, line_no: np.ndarray, bits: int) -> list[np.ndarray]:
    """The two bits of a line in a filter of 2**bits bits; ``h`` is a hash of its document's id."""
    key = W.mix(h ^ W.mix(line_no.astype(np.uint64), 20), 21)
    return [W.mix(key, seed) >> U(64 - bits) for seed in (22, 23)]


def line_filter(wanted: DataFrame) -> np.ndarray:
    """A bit filter of the lines (doc_id, line_no) of ``wanted``: 32 bits a line, 2**27 bits (16 MB) at most. Beyond
    that it lets more other lines through, never fewer wanted ones."""
    bits = min(max((32 * wanted.count()).bit_length(), 10), 27)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(np.concatenate(_places(batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy(), bits)))
            words, first = np.unique(at >> U(6), return_index=True)
            if len(words):
                value = np.bitwise_or.reduceat(U(1) << (at & U(63)), first)
                yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(value.view(np.int64))], names=["w", "v"])

    set_ = wanted.select(F.xxhash64("doc_id"), "line_no").mapInArrow(trimmed(run), "w long, v long").groupBy("w").agg(F.bit_or("v").alias("v")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[set_.column(0).to_numpy()] = set_.column(1).to_numpy().view(np.uint64)
    return out


def wanted_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cid, shingles, bitmap): the words of the line sets ``wanted`` (sid, sid2, doc_id, line_no, at), read again, as
    number ``at``. The texts do not move: the reading tasks take the lines that a filter of the wanted ones lets through,
    and their sets meet the wanted ones by both hashes, which turns away what the filter should not have let through."""
    held = docs.sparkSession.sparkContext.broadcast(line_filter(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = held.value
        bits = len(marks).bit_length() + 5
        for batch in batches:
            data, offsets = W.text_buffer(batch.column(1))
            ids = batch.column(0).to_numpy().view(np.uint64)
            for lo, hi in W.slices(offsets, SLICE):
                p = offsets[lo:hi + 1]
                part = data[p[0]:p[-1]]
                ls, le, ldoc = W.lines(part, p - p[0])
                number = np.arange(len(ls)) - np.searchsorted(ldoc, np.arange(hi - lo))[ldoc]
                pick = np.ones(len(ls), bool)
                for at in _places(ids[lo:hi][ldoc], number, bits):
                    pick &= (marks[(at >> U(6)).astype(np.int64)] >> (at & U(63))) & U(1) == 1
                ls, le = ls[pick], le[pick]
                ends = np.cumsum(le - ls)
                if not len(ends) or not ends[-1]:
                    continue
                starts = ends - (le - ls)
                text = W.LOWER[part[np.repeat(ls - starts, le - ls) + np.arange(ends[-1])]]
                bounds = np.append(starts, ends[-1])
                ws, we = W.spans(text, bounds)
                line, word = W.distinct_per(W.owner(bounds, ws), W.hash_spans(text, ws, we))
                if not len(line):
                    continue
                new = np.concatenate([[True], line[1:] != line[:-1]])
                first, line = np.flatnonzero(new), np.cumsum(new) - 1
                sid, sid2 = _set_hashes(word, first)
                sets = pa.ListArray.from_arrays(pa.array(np.append(first, len(word)), pa.int32()), pa.array(word.view(np.int64)))
                blobs = pa.array([b.tobytes() for b in _parity(word, line, len(first), WIDE, 10)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(sid.view(np.int64)), pa.array(sid2.view(np.int64)), sets, blobs], names=["sid", "sid2", "shingles", "bitmap"])

    read = docs.select(F.xxhash64("doc_id"), "text").mapInArrow(trimmed(run), "sid long, sid2 long, shingles array<long>, bitmap binary")
    return read.join(wanted.select("sid", "sid2", F.col("at").alias("cid")), ["sid", "sid2"]).select("cid", "shingles", "bitmap").dropDuplicates(["cid"])


def partners(entries: DataFrame, percent: int, every: bool) -> DataFrame:
    """Candidate pairs (a earlier than b) within groups of ``entries`` (key, sid, n, pos, bitmap, at, done).

    ``every`` False: for each entry the most alike earlier partner, and the earliest possible one.
    ``every`` True: all earlier partners of entries that are not ``done``."""
    ordered = entries.select("key", "sid", "n", "pos", "bitmap", "at", "done").repartition("key").sortWithinPartitions("key", "n")

    def pairs(t: pa.Table) -> pa.RecordBatch:
        e = np.zeros(t.num_rows, [("key", "<i8"), ("n", "<i8"), ("pos", "<i8")])
        key = t.column("key").to_numpy()
        e["key"] = np.cumsum(np.concatenate([[True], key[1:] != key[:-1]])) - 1
        for c in ("n", "pos"):
            e[c] = t.column(c).to_numpy()
        sid, done, place = t.column("sid").to_numpy(), t.column("done").to_numpy(), t.column("at").to_numpy()
        bitmap = np.frombuffer(b"".join(t.column("bitmap").to_pylist()), np.uint64).reshape(-1, WIDE)
        left, right = [], []
        best, alike = np.full(len(e), -1), np.full(len(e), 1 << 40)
        first, early = np.full(len(e), -1), np.full(len(e), np.iinfo(np.int64).max)
        for i, j, differ in _candidates(e, bitmap, percent):
            other = place[i] != place[j]
            i, j, differ = i[other], j[other], differ[other]
            i, j = np.where(place[i] < place[j], i, j), np.where(place[i] < place[j], j, i)  # i is the earlier line set
            if every:
                open_ = ~done[j]
                left.append(i[open_]), right.append(j[open_])
            else:
                # In one pass an entry is the earlier of at most one pair and the later of at most one from
                # each side, so the updates are made one side at a time.
                for side in (i < j, i > j):
                    x, y, d = i[side], j[side], differ[side]
                    better = d < alike[y]
                    best[y[better]], alike[y[better]] = x[better], d[better]
                    better = place[x] < early[y]
                    first[y[better]], early[y[better]] = x[better], place[x][better]
        if not every:
            for found in (best, first):
                ok = np.flatnonzero(found >= 0)
                left.append(found[ok]), right.append(ok)
        x, y = (np.concatenate(s) if s else np.zeros(0, np.int64) for s in (left, right))
        return pa.RecordBatch.from_arrays([pa.array(sid[x]), pa.array(sid[y])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from whole_groups(batches, "key", pairs)

    return ordered.mapInArrow(trimmed(run), "a long, b long").distinct()


def gone_lines(docs: DataFrame, percent: int = 75, min_words: int = 3) -> DataFrame:
    """(doc_id, line_no) of every line of ``docs`` (doc_id, text) that is removed, as a written table."""
    docs = docs.filter(F.col("doc_id").isNotNull())
    rank, frequent, words = word_counts(docs)
    # A line of n words has at most n - ceil(percent n / 100) + 1 entries, and none if it has fewer than three.
    expected = words * (100 - percent) // 100 + words // 3
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), expected // PART)
    dealt = materialize(active_entries(scan_lines(docs, rank, frequent, percent, min_words, parts), percent, parts), "dealt")
    lines = dealt.filter("key IS NULL").select("doc_id", "line_no", "sid", "sid2", "again")
    active = dealt.filter("key IS NOT NULL AND bits IS NULL").select("key", "sid", "n", "pos")
    beyond = dealt.filter("bits IS NOT NULL").select("key", "sid", "n", "pos", "bits", "size")
    if not beyond.isEmpty():
        active = active.unionByName(large_groups(beyond, percent))
    active = materialize(active, "active")
    fresh = lines.filter(~F.col("again"))
    # Line sets that several documents hold, with the first of these.
    held = fresh.groupBy("sid", "sid2").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("c"))
    held = materialize(held.filter("c > 1").select("sid", "sid2", "first_id"), "held")
    near = _small(held)
    copied = fresh.join(near, ["sid", "sid2"]).filter(F.col("doc_id") != F.col("first_id"))
    # First places of the line sets that may be like others, numbered in order. Two sets with one first hash (a
    # matter of chance) are told apart by a number of their own, and each has the other's entries as well.
    possible = materialize(active.select("sid").distinct(), "possible")
    wanted = fresh.join(_small(possible), "sid", "left_semi").groupBy("sid", "sid2").agg(F.min(F.struct("doc_id", "line_no")).alias("f"))
    first = materialize(wanted.select("sid", "sid2", "f.doc_id", "f.line_no"), "wanted")
    wanted = materialize(global_row_number(first, ["doc_id", "line_no", "sid"], out="at"), "numbered")
    sets = materialize(wanted_sets(docs, wanted), "sets")
    info = sets.select(F.col("cid").alias("at"), "bitmap").join(wanted.select("sid", "at"), "at")
    entries = active.join(info, "sid").select("key", F.col("at").alias("sid"), "n", "pos", "bitmap", "at")
    entries = materialize(entries, "entries")
    release(active, possible, first)
    plain = sets.select("cid", "shingles")
    likely = materialize(partners(entries.withColumn("done", F.lit(False)), percent, False), "likely")
    found = materialize(confirm(likely, plain, percent).select(F.col("b").alias("sid")).distinct(), "found")
    flagged = entries.join(found.withColumn("done", F.lit(True)), "sid", "left").withColumn("done", F.coalesce("done", F.lit(False)))
    rest = materialize(partners(flagged, percent, True), "rest")
    more = confirm(rest, plain, percent).select(F.col("b").alias("sid"))
    gone = materialize(found.unionByName(more).distinct().withColumnRenamed("sid", "at").join(wanted, "at"), "gone")
    release(entries, sets, likely, rest, found, wanted)
    place = ["doc_id", "line_no"]
    out = lines.filter("again").select(*place).unionByName(copied.select(*place)).unionByName(gone.select(*place))
    # Rows that repeat an id share its line numbers: one that stays for any of them stays.
    repeated = materialize(docs.groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated")
    if not repeated.isEmpty():
        both = ["sid", "sid2"]
        own = lines.join(_small(repeated), "doc_id", "left_semi").join(near, both, "left").join(gone.select(*both, F.lit(True).alias("like")), both, "left")
        stay = own.filter(~F.col("again") & (F.col("first_id").isNull() | (F.col("first_id") == F.col("doc_id"))) & F.col("like").isNull())
        out = out.join(stay.select(*place).distinct(), place, "left_anti")
    out = materialize(out, "lines-gone")
    release(dealt, held, gone, repeated)
    return out


def removed_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 75, min_words: int = 3) -> DataFrame:
    """(key, n_lines, n_removed, removed): per row of ``docs`` the numbers (from 0) of its removed lines, comma-joined."""
    plain = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    gone = gone_lines(plain, percent, min_words).groupBy("doc_id").agg(F.sort_array(F.collect_set("line_no")).alias("gone"))
    breaks = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
    counted = plain.select("doc_id", (breaks + 1).cast("long").alias("n_lines"))
    out = counted.join(gone, "doc_id", "left").withColumn("gone", F.coalesce("gone", F.array().cast("array<int>")))
    # Only rows that repeat an id can be shorter than the numbers removed for it.
    own = F.filter("gone", lambda x: x < F.col("n_lines"))
    return out.select(F.col("doc_id").alias(key), "n_lines", F.size(own).cast("long").alias("n_removed"),
                      F.array_join(F.transform(own, lambda x: x.cast("string")), ",").alias("removed"))


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 75, min_words: int = 3) -> DataFrame:
    """``docs`` without the removed lines. A document that had words and keeps none is left out."""
    plain = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    places = gone_lines(plain, percent, min_words)
    # A text's removed lines as a byte per line up to the last of them: built and read in linear time.
    ordered = F.sort_array(F.collect_set("line_no"))
    gaps = F.transform("_l", lambda x, i: F.concat(F.repeat(F.lit("0"), x - F.when(i > 0, F.get("_l", i - 1)).otherwise(-1) - 1), F.lit("1")))
    gone = places.groupBy(F.col("doc_id").alias("_line_id")).agg(ordered.alias("_l"))
    gone = materialize(gone.select("_line_id", F.array_join(gaps, "").cast("binary").alias("_line_gone")), "gone")
    release(places)
    joined = docs.join(_small(gone, F.length("_line_gone")), F.col(key) == F.col("_line_id"), "left")
    stay = F.filter(F.split(F.col(text), "\n", -1), lambda x, i: F.substring("_line_gone", i + 1, F.lit(1)) != F.lit(b"1"))
    joined = joined.withColumn("_line_text", F.when(F.col("_line_gone").isNull(), F.col(text)).otherwise(F.array_join(stay, "\n")))
    empty = F.col("_line_gone").isNotNull() & ~F.col("_line_text").rlike("[^\\x20\\x09-\\x0D]")
    return joined.filter(~empty).select(*[F.col("_line_text").alias(c) if c == text else F.col(c) for c in docs.columns])
