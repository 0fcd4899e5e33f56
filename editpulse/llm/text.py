"""Words, window hashes and local minima of many texts at once, in numpy.

Everything works on the UTF-8 bytes of an Arrow column, without a Python
object per word. Separators are ASCII, so bytes suffice to find words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
FULL = U64(0xFFFFFFFFFFFFFFFF)
# Arrays over a piece of text stay within a core's cache.
PIECE_BYTES = 1 << 17
RUN_BYTES = 1 << 20
_ODD = 0x9E3779B97F4A7C15
# The first 0 to 8 bytes of a number.
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], U64)


def _spread(n: int) -> np.ndarray:
    """``n`` fixed, well mixed 64-bit values."""
    return mix(np.arange(1, n + 1, dtype=U64) * U64(_ODD))


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


BYTE_VALUES = _spread(256)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

# Everything but space and the control bytes 9 to 13.
NON_SPACE = np.ones(256, bool)
NON_SPACE[[9, 10, 11, 12, 13, 32]] = False
# ASCII digits and letters, and every byte of a non-ASCII character.
ALNUM = np.zeros(256, bool)
ALNUM[ord("0") : ord("9") + 1] = ALNUM[ord("a") : ord("z") + 1] = True
ALNUM[ord("A") : ord("Z") + 1] = ALNUM[0x80:] = True


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and where each begins (one more at the end)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    starts = np.frombuffer(offsets, np.int64 if wide else np.int32)
    starts = starts[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[starts[0] : starts[-1]], starts - starts[0]


def runs_of(starts: np.ndarray, limit: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``limit`` bytes together, never less than one text."""
    first, n = 0, len(starts) - 1
    while first < n:
        last = int(np.searchsorted(starts, starts[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


@dataclass
class Words:
    """Words of several texts, in order."""

    start: np.ndarray  # first byte
    end: np.ndarray  # byte after the last
    doc: np.ndarray  # number of the text
    hash: np.ndarray

    def counts(self, texts_: int) -> np.ndarray:
        return np.bincount(self.doc, minlength=texts_)


def words(
    data: np.ndarray, starts: np.ndarray, inside: np.ndarray = NON_SPACE, fold: np.ndarray | None = None
) -> Words:
    """Maximal runs of ``inside`` bytes; ``fold`` gives the byte that each is hashed as."""
    found = []
    begin, total = 0, len(data)
    edges = starts[(starts > 0) & (starts < total)]
    while begin < total:
        stop = min(begin + PIECE_BYTES, total)
        while stop < total and inside[data[stop]] and inside[data[stop - 1]]:
            stop += 1
        piece = data[begin:stop]
        lo, hi = np.searchsorted(edges, [begin, stop])
        found.append(_piece_words(piece, edges[lo:hi] - begin, begin, inside, fold))
        begin = stop
    if not found:
        none = np.zeros(0, np.int64)
        return Words(none, none, none, np.zeros(0, U64))
    first, last, hashes = (np.concatenate(x) for x in zip(*found))
    return Words(first, last, np.searchsorted(starts, first, "right") - 1, hashes)


def _piece_words(piece, edges, begin, inside, fold):
    within = inside[piece]
    opens = within.copy()
    opens[1:] &= ~within[:-1]
    closes = within.copy()
    closes[:-1] &= ~within[1:]
    opens[edges] = within[edges]
    after = edges[edges > 0] - 1
    closes[after] = within[after]
    first, last = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    hashes = _word_hashes(piece if fold is None else fold[piece], first, last)
    return first + begin, last + begin, hashes


def _word_hashes(piece: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A hash of the bytes of every word: its eights of bytes, each mixed with its place, in a sum.

    A polynomial of the bytes modulo 2 ** 64 would give two long words of a
    simple kind (the Thue-Morse ones) the same hash.
    """
    padded = np.concatenate([piece, np.zeros(8, np.uint8)])
    eights = np.ndarray(len(piece) + 1, "<u8", padded, strides=(1,))
    length = last - first
    counts = (length + 7) >> 3
    ends = np.cumsum(counts)
    place = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)
    at = np.repeat(first, counts) + 8 * place
    left = np.minimum(np.repeat(last, counts) - at, 8)
    parts = mix((eights[at] & _FIRST_BYTES[left]) ^ mix(place.astype(U64)))
    sums = np.concatenate([np.zeros(1, U64), np.cumsum(parts, dtype=U64)])
    return mix((sums[ends] - sums[ends - counts]) ^ (length.astype(U64) * U64(_ODD)))


def windows(values: np.ndarray, length: int) -> np.ndarray:
    """A hash of every ``length`` consecutive values, by doubling."""
    if len(values) < length:
        return np.zeros(0, U64)
    part, size, done, have = values, 1, None, 0
    while True:
        if length & size:
            if done is None:
                done, have = part, size
            else:
                count = len(values) - size - have + 1
                done = part[:count] * U64(pow(_ODD, have, 1 << 64)) + done[size : size + count]
                have += size
        if size * 2 > length:
            return done
        count = len(part) - size
        part = part[:count] * U64(pow(_ODD, size, 1 << 64)) + part[size : size + count]
        size *= 2


def sliding(values: np.ndarray, width: int, pick=np.minimum) -> np.ndarray:
    """``pick`` of every ``width`` consecutive values."""
    size = 1
    while size * 2 <= width:
        values = pick(values[:-size], values[size:])
        size *= 2
    return pick(values[: len(values) - (width - size)], values[width - size :]) if size < width else values


def minima(values: np.ndarray, width: int) -> np.ndarray:
    """Positions that are the least of some ``width`` consecutive values.

    Equal runs of ``width`` values have theirs at equal places, whatever stands
    around them. Values equal to ``FULL`` are never taken.
    """
    if len(values) < width:
        return np.zeros(0, np.int64)
    least = sliding(values, width)
    padded = np.concatenate([np.zeros(width - 1, U64), least, np.zeros(width - 1, U64)])
    return np.flatnonzero((sliding(padded, width, np.maximum) == values) & (values != FULL))


def sha256(data) -> str:
    return hashlib.sha256(data).hexdigest()


def cover(starts: np.ndarray, ends: np.ndarray, total: int) -> np.ndarray:
    """Which of ``total`` places lie in any of the spans from ``starts`` up to ``ends``."""
    steps = np.zeros(total + 1, np.int8)
    if len(starts):
        order = np.argsort(starts)
        starts, ends = starts[order], np.maximum.accumulate(ends[order])
        apart = starts[1:] > ends[:-1]
        steps[starts[np.concatenate([[True], apart])]] = 1
        steps[ends[np.concatenate([apart, [True]])]] = -1
    return np.cumsum(steps[:total], dtype=np.int8).view(bool)
