"""Words of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow column.

No Python string is made per word: boundaries, hashes, n-grams and sliding minima are array
operations over slices of a few megabytes, so memory follows the slice and not the table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20
BLANKS = b" \t\n\x0b\x0c\r"

_U = np.uint64
_STEP = 0xD6E8FEB86659FD93 | 1


def byte_table(members: bytes) -> np.ndarray:
    """A lookup table that is True for the given byte values."""
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


BLANK_TABLE = byte_table(BLANKS)
LOWER_TABLE = np.arange(256, dtype=np.uint8)
LOWER_TABLE[65:91] += 32


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    values = np.sort(values)
    if not len(values):
        return values
    first = np.empty(len(values), bool)
    first[0] = True
    np.not_equal(values[1:], values[:-1], out=first[1:])
    return values[first]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices whose ``column`` holds at most ``limit`` bytes; a longer value is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.diff(offsets_of(batch.column(column))[1])
        begin = size = 0
        for row, more in enumerate(sizes.tolist()):
            if row > begin and size + more > limit:
                yield batch.slice(begin, row - begin)
                begin, size = row, 0
            size += more
        yield batch.slice(begin)


def offsets_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and the ``n + 1`` offsets of its values; NULL is empty."""
    kind = pa.large_binary()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    if pa.types.is_string(column.type):
        column = column.cast(pa.large_string())
    elif pa.types.is_binary(column.type):
        column = column.cast(kind)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


class Words:
    """Words of a column: ``data`` holds them in order, each followed by one space.

    ``start`` and ``end`` are byte positions in ``data``; document ``d`` has the words
    ``doc[d] .. doc[d + 1]``.
    """

    def __init__(self, column: pa.Array, breaks: np.ndarray = BLANK_TABLE, lower: bool = False):
        raw, at = offsets_of(column)
        if lower:
            raw = LOWER_TABLE[raw]
        self.n_docs = len(at) - 1
        blank = breaks[raw]
        edge = np.zeros(len(raw) + 1, dtype=bool)
        edge[at] = True
        before = np.ones(len(raw), dtype=bool)
        before[1:] = blank[:-1]
        first = np.flatnonzero(~blank & (before | edge[:-1]))
        after = np.ones(len(raw), dtype=bool)
        after[:-1] = blank[1:]
        last = np.flatnonzero(~blank & (after | edge[1:]))
        self.doc = np.searchsorted(first, at).astype(np.int64)
        size = last - first + 1
        self.end = np.cumsum(size + 1) - 1
        self.start = self.end - size
        self.data = np.full(int(size.sum()) + len(size), 32, dtype=np.uint8)
        held = np.ones(len(self.data), dtype=bool)
        held[self.end] = False
        self.data[held] = raw[~blank]
        self.n = len(size)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word."""
        return xxh64(self.data, self.start, self.end - self.start, 0)

    def text(self, d: int) -> bytes:
        """Words of a document joined by one space."""
        a, b = self.doc[d], self.doc[d + 1]
        return self.data[self.start[a]:self.end[b - 1]].tobytes() if b > a else b""

    def counts(self) -> np.ndarray:
        return np.diff(self.doc)

    def room(self, width: int) -> np.ndarray:
        """For each word, whether ``width`` words from it on lie in its own document."""
        ok = np.zeros(self.n, dtype=bool)
        if self.n:
            stop = np.repeat(self.doc[1:], self.counts())
            ok = np.arange(self.n) + width <= stop
        return ok


def gram_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` values from each place on, by doubling; shorter by ``width - 1``."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, _U)
    out, done, step, part = np.zeros(n, _U), 0, 1, h
    while True:
        if width & step:
            out += part[done:done + n] * _U(pow(_STEP, done, 1 << 64))
            done += step
        if step * 2 > width:
            return mix(out)
        part = part[:-step] + part[step:] * _U(pow(_STEP, step, 1 << 64))
        step *= 2


def sliding(values: np.ndarray, width: int, pick=np.minimum) -> np.ndarray:
    """Minimum (or maximum) of every ``width`` neighbours; shorter by ``width - 1``."""
    if len(values) < width:
        return values[:0]
    span, part = 1, values
    while span * 2 <= width:
        part = pick(part[:-span], part[span:])
        span *= 2
    rest = width - span
    return pick(part[:len(part) - rest], part[rest:]) if rest else part


_P1, _P2, _P3, _P4, _P5 = (_U(x) for x in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x << _U(by)) | (x >> _U(64 - by))


def _round(lane: np.ndarray) -> np.ndarray:
    return _turn(lane * _P2, 31) * _P1


def xxh64(data: np.ndarray, start: np.ndarray, length: np.ndarray, seed: int) -> np.ndarray:
    """XXH64 of many byte ranges of one buffer."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    wide = np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))
    narrow = np.ndarray(len(data) + 1, dtype="<u4", buffer=padded, strides=(1,))
    at, left = start.astype(np.int64), length.astype(np.int64)
    with np.errstate(over="ignore"):
        out = np.full(len(at), _U(seed) + _P5, dtype=_U)
        long = np.flatnonzero(left >= 32)
        if len(long):
            acc = [np.full(len(long), x, dtype=_U) for x in (_U(seed) + _P1 + _P2, _U(seed) + _P2, _U(seed), _U(seed) - _P1)]
            go = np.arange(len(long))
            while len(go):
                p = at[long[go]]
                for k in range(4):
                    acc[k][go] = _turn(acc[k][go] + wide[p + 8 * k] * _P2, 31) * _P1
                at[long[go]] += 32
                left[long[go]] -= 32
                go = go[left[long[go]] >= 32]
            total = _turn(acc[0], 1) + _turn(acc[1], 7) + _turn(acc[2], 12) + _turn(acc[3], 18)
            for a in acc:
                total = (total ^ _round(a)) * _P1 + _P4
            out[long] = total
        out += length.astype(_U)
        go = np.flatnonzero(left >= 8)
        while len(go):
            p = at[go]
            out[go] = _turn(out[go] ^ _round(wide[p]), 27) * _P1 + _P4
            at[go] = p + 8
            left[go] -= 8
            go = go[left[go] >= 8]
        go = np.flatnonzero(left >= 4)
        if len(go):
            p = at[go]
            out[go] = _turn(out[go] ^ (narrow[p].astype(_U) * _P1), 23) * _P2 + _P3
            at[go] = p + 4
            left[go] -= 4
        go = np.flatnonzero(left >= 1)
        while len(go):
            p = at[go]
            out[go] = _turn(out[go] ^ (padded[p].astype(_U) * _P5), 11) * _P1
            at[go] = p + 1
            left[go] -= 1
            go = go[left[go] >= 1]
        out = (out ^ (out >> _U(33))) * _P2
        out = (out ^ (out >> _U(29))) * _P3
        return out ^ (out >> _U(32))
