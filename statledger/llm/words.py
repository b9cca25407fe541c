"""Word hashes of whole Arrow string columns with numpy, in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 19  # bytes looked at together
U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: The six ASCII white-space bytes.
BLANKS = np.zeros(256, bool)
BLANKS[[32, 9, 10, 11, 12, 13]] = True
#: Every ASCII byte that is neither a letter nor a digit.
NO_WORD = np.ones(256, bool)
NO_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on all of them."""
    h = h ^ (h >> U(33))
    h = h * U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U(33))
    h = h * U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U(33))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, U)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, PIECE + 1)
            for name, value in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(size, value, U)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def slices(column: pa.Array, limit: int = PIECE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, UTF-8 bytes and row offsets (one more than rows) of consecutive rows, about ``limit`` bytes each.

    A row longer than the limit comes alone; nulls are empty rows.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    n = len(column)
    if not n:
        return
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        to = min(to, n)
        yield row, data[offsets[row] : offsets[to]], offsets[row : to + 1] - offsets[row]
        row = to


def _cut(raw: np.ndarray, offsets: np.ndarray, pos: int, parted: np.ndarray) -> int:
    """Where a piece that starts at ``pos`` may end without parting a word."""
    n = len(raw)
    end = pos + PIECE
    if end >= n:
        return n
    start = int(offsets[np.searchsorted(offsets, end, "right") - 1])
    blank = np.flatnonzero(parted[raw[max(pos, start) : end]])
    if len(blank):
        return max(pos, start) + int(blank[-1]) + 1
    if start > pos:
        return start
    while end < n:  # one word longer than a piece
        blank = np.flatnonzero(parted[raw[end : end + PIECE]])
        if len(blank):
            return end + int(blank[0]) + 1
        end += PIECE
    return n


def hashes(
    raw: np.ndarray, offsets: np.ndarray, parted: np.ndarray = BLANKS, fold_latin: bool = False, fold: bool = True,
) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word, and the first word of each row (one more than rows).

    ``parted`` says which bytes stand between words. A-Z count as a-z; with ``fold_latin`` so do the capital
    letters of the Latin-1 block. ``fold=False`` keeps case.
    """
    found, begins, pos, n = [], [], 0, len(raw)
    while pos < n:
        end = _cut(raw, offsets, pos, parted)
        b = raw[pos:end]
        blank = parted[b]
        first = offsets[np.searchsorted(offsets, pos, "left") : np.searchsorted(offsets, end, "left")] - pos
        before = np.empty(len(b), bool)
        before[0], before[1:] = True, blank[:-1]
        before[first] = True
        after = np.empty(len(b), bool)
        after[-1], after[:-1] = True, blank[1:]
        after[first[first > 0] - 1] = True
        solid = ~blank
        starts, stops = np.flatnonzero(solid & before), np.flatnonzero(solid & after) + 1
        if fold:
            b = _LOWER[b]
        if fold_latin:
            high = np.flatnonzero(b[:-1] == 0xC3) + 1
            high = high[(b[high] >= 0x80) & (b[high] <= 0x9E) & (b[high] != 0x97)]
            b = b.copy()
            b[high] += 0x20
        up, down = _POWERS.of(len(b) + 1)
        total = np.zeros(len(b) + 1, U)
        np.cumsum((b.astype(U) + U(1)) * up[: len(b)], out=total[1:])
        found.append(mix((total[stops] - total[starts]) * down[starts]))
        begins.append(starts + pos)
        pos = end
    if not found:
        return np.zeros(0, U), np.zeros(len(offsets), np.int64)
    return np.concatenate(found), np.searchsorted(np.concatenate(begins), offsets, "left")


_PLACE = mix(np.arange(1, 12, dtype=U) * U(_BASE)) | U(1)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words; of the whole sequence where it is shorter; none without words."""
    n = len(words)
    width = min(n, size)
    if not n:
        return words
    total = np.full(n - width + 1, U(width) * _PLACE[10], U)
    for i in range(width):
        total += words[i : n - width + 1 + i] * _PLACE[i]
    return mix(total)
