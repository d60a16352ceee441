"""Vectorised text kernels over UTF-8 buffers (numpy, no per-row Python).

Words are maximal runs of bytes other than space and \\t..\\r; all of these
are ASCII, so splitting bytes equals splitting code points. Hash arithmetic is
modulo 2**64 on purpose (unsigned numpy integers wrap).
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

_ODD = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Masks of the first 0..8 bytes of a little-endian word.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Spans of more bytes are digested one by one.
LONG_SPAN = 256


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets of each; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offs[0] : offs[-1]], offs - offs[0]


def chunks(offs: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about limit bytes; a document is never cut."""
    at, n = 0, len(offs) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
        yield at, to
        at = to


class Words:
    """Words of a range of documents: byte spans, and the first word of each document."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray):
        self.buf, self.offs, n = buf, offs, len(buf)
        word = ~IS_SPACE[buf]
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = word[:-1], word[1:]
        cut = offs[1:-1]
        before[cut[cut < n]] = False
        after[cut[cut > 0] - 1] = False
        self.starts = np.flatnonzero(word & ~before)
        self.ends = np.flatnonzero(word & ~after) + 1
        self.first = np.searchsorted(self.starts, offs)
        self.counts = np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self, lower: bool = False, lane: int = 0) -> np.ndarray:
        return span_hashes(self.buf, self.starts, self.ends, lower, lane)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False, lane: int = 0) -> np.ndarray:
    """64-bit hashes of byte spans; lanes 0 and 1 are independent of each other.

    A span is read in words of 8 bytes, all spans at once, and each word goes
    through a mixing step that isn't linear; spans of over ``LONG_SPAN`` bytes
    get a keyed BLAKE2b.
    """
    if lower:
        buf = _LOWER[buf]
    size = ends - starts
    key = _M1 if lane == 0 else _M2
    h = mix((size.astype(np.uint64) + np.uint64(1)) * _ODD + key)
    padded = np.zeros(len(buf) + 8, np.uint8)
    padded[: len(buf)] = buf
    eight = np.ndarray((len(buf) + 1,), "<u8", padded, 0, (1,))  # the 8 bytes from each byte on
    short = size <= LONG_SPAN
    live = np.flatnonzero((size > 0) & short)
    at, left = starts[live], size[live]
    while len(live):
        word = eight[at] & _FIRST[np.minimum(left, 8)]
        old = h[live]
        h[live] = mix((old ^ word) + key) if lane == 0 else mix(old + (word ^ key) * _ODD)
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    for k in np.flatnonzero(~short).tolist():
        h[k] = int.from_bytes(blake2b(buf[starts[k] : ends[k]].data, digest_size=8, key=b"%d" % lane).digest(), "little")
    return h


def joined_words(w: Words, kept: np.ndarray, lower: bool = False) -> tuple[bytes, np.ndarray]:
    """Kept words of each document joined by one space, as bytes of all documents and the bounds of each."""
    edge = np.zeros(len(w.buf) + 1, np.int8)
    edge[w.starts[kept]] += 1
    edge[w.ends[kept]] -= 1
    inside = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    doc = w.doc[kept]
    sep = np.zeros(len(w.buf), np.uint8)
    later = np.flatnonzero(doc[1:] == doc[:-1]) + 1
    sep[w.starts[kept][later]] = 1  # each kept word but a document's first has a space before it
    to = np.cumsum(inside.astype(np.int64) + sep)
    joined = np.full(int(to[-1]) if len(to) else 0, 32, np.uint8)
    joined[to[inside] - 1] = (_LOWER[w.buf] if lower else w.buf)[inside]
    return joined.tobytes(), np.concatenate([[0], to])[w.offs]


def ngrams(words: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word windows inside documents, and the index of each window's first word."""
    if len(words) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    k = np.uint64(0xA0761D6478BD642F)
    w, m = words, len(words) - n + 1
    h = w[:m].copy()
    for j in range(1, n):
        h *= k
        h += w[j : j + m]
    left = np.repeat(np.cumsum(counts), counts) - np.arange(len(w))
    at = np.flatnonzero(left[:m] >= n)
    return mix(h[at] + np.uint64(n)), at


def sums_by(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values between consecutive bounds in first."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n words lie in a window of the given width that begins at one of starts."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + width, n), -1)
    return np.cumsum(edge[:-1]) > 0
