"""Vectorised word, line and window tables over a batch of texts (numpy inside a Spark task).

A batch of texts is one UTF-8 byte buffer with offsets, as Arrow hands it over. A word is a run of
bytes other than space and 0x09-0x0D (these never occur inside a multi-byte character, so byte runs
and code-point runs agree). Every function treats the texts of a batch independently.

Words are hashed by value to 64 bits: a random table maps each byte to 64 bits, the word is the
polynomial in an odd base modulo 2**64 (prefix sums make all words of a segment one subtraction),
and a finaliser mixes the result. Equal words have equal hashes in every task and every run.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
SEGMENT = 1 << 15  # bytes hashed at a time: the prefix sums stay in the processor's cache
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_WINDOW_BASE = 0xD6E8FEB86659FD93

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, by doubling."""
    out = np.ones(max(n, 1), dtype=np.uint64)
    have = 1
    while have < n:
        take = min(have, n - have)
        out[have:have + take] = out[:take] * U(pow(base, have, 1 << 64))
        have += take
    return out


_POW: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    if base not in _POW or len(_POW[base]) < n:
        table = powers(base, max(n, SEGMENT + 1))
        if n > 1 << 22:  # a single huge word: do not keep its table
            return table
        _POW[base] = table
    return _POW[base][:n]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit finaliser (a bijection), a different one per seed."""
    x = x + U(((seed + 1) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    offs = offs.astype(np.int64)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def slices(offsets: np.ndarray, most: int = 1 << 20) -> list[tuple[int, int]]:
    """Cut a batch into runs of whole texts of about ``most`` bytes."""
    out, lo, n = [], 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        out.append((lo, hi))
        lo = hi
    return out


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of all words."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = (data > 32) | (data < 9) | ((data > 13) & (data < 32))
    turn = np.flatnonzero(word[1:] != word[:-1]) + 1
    opens = word[turn]
    starts, ends = turn[opens], turn[~opens]
    if word[0]:
        starts = np.concatenate([[0], starts])
    if word[-1]:
        ends = np.concatenate([ends, [len(data)]])
    edge = np.unique(offsets[(offsets > 0) & (offsets < len(data))])
    edge = edge[word[edge] & word[edge - 1]]  # a word ends with its text
    if len(edge):
        starts = np.insert(starts, np.searchsorted(starts, edge), edge)
        ends = np.insert(ends, np.searchsorted(ends, edge), edge)
    return starts, ends


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Value hash of data[start:end] for ascending, non-overlapping spans."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = int(np.searchsorted(ends, starts[i] + SEGMENT, side="right"))
        j = max(j, i + 1)
        lo, hi = int(starts[i]), int(ends[j - 1])
        pre = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_BYTE[data[lo:hi]] * _powers(_BASE, hi - lo), out=pre[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (pre[e] - pre[s]) * _powers(_BASE_INV, hi - lo + 1)[s]
        i = j
    return mix(out ^ (ends - starts).astype(np.uint64))


def owner(offsets: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Index of the text that holds each (ascending) byte position."""
    return np.searchsorted(offsets, positions, side="right") - 1


def windows(hashes: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``size``-word windows that lie in one text, and the index of their first word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = np.flatnonzero(doc[:n] == doc[size - 1:])
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h *= U(_WINDOW_BASE)
        h += hashes[k:k + n]
    return mix(h[inside]), inside


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """\\n-split lines of all texts: byte starts, ends (without the \\n), and the text of each.

    Like a string split: an empty text has one empty line, a final \\n opens one more empty line."""
    n = len(offsets) - 1
    breaks = np.flatnonzero(data == 10)
    of = owner(offsets, breaks)
    starts = np.concatenate([offsets[:-1], breaks + 1])
    doc = np.concatenate([np.arange(n), of])
    order = np.lexsort((starts, doc))
    starts, doc = starts[order], doc[order]
    ends = np.concatenate([offsets[1:], breaks])
    edoc = np.concatenate([np.arange(n), of])
    ends = ends[np.lexsort((ends, edoc))]
    return starts, ends, doc


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: does it occur twice or more; is this not its first occurrence."""
    n = len(keys)
    if not n:
        return np.zeros(0, bool), np.zeros(0, bool)
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    same = k[1:] == k[:-1]
    again = np.concatenate([[False], same])
    twice = again | np.concatenate([same, [False]])
    a, b = np.empty(n, bool), np.empty(n, bool)
    a[order], b[order] = twice, again
    return a, b


def distinct_per(doc: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (doc, key) pairs for ascending ``doc``; returned sorted by doc, then key."""
    if not len(keys):
        return doc[:0], keys[:0]
    order = np.lexsort((keys, doc))
    d, k = doc[order], keys[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
    return d[new], k[new]
