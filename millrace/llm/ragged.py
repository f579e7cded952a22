"""Arrow string columns as flat numpy arrays of words and lines.

A *word* is a maximal run of bytes other than space and ``\\t\\n\\v\\f\\r``.
All functions work on whole texts; a chunk holds whole rows only, so the memory
in use is bounded by :data:`CHUNK_BYTES` or by the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_ODD = 0x9E3779B97F4A7C15
BYTE = np.random.Generator(np.random.PCG64(20)).integers(0, 2**64, 256, np.uint64) | np.uint64(1)


class _Powers:
    """Powers of an odd number modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, base in (("up", _ODD), ("down", pow(_ODD, -1, 1 << 64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:n], self.down[:n]


_powers = _Powers()


def mix(h: np.ndarray) -> np.ndarray:
    """Finish 64-bit hashes so that every bit depends on all of the input."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(29)
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def rolling(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``values[start:end]`` for each span, equal for equal spans anywhere."""
    up, down = _powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    lengths = (ends - starts).astype(np.uint64)
    return mix((total[ends] - total[starts]) * down[starts] + lengths * np.uint64(0xD6E8FEB86659FD93))


class Texts:
    """Rows ``first .. first + rows`` of a column: bytes, row bounds and word bounds."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, first: int = 0) -> None:
        self.data, self.bounds, self.first, self.rows = data, bounds, first, len(bounds) - 1

    def split(self, between: np.ndarray = SPACE) -> Texts:
        """Find the words: ``starts``, ``ends`` and, for each row, its range ``at[row]:at[row + 1]``."""
        n = len(self.data)
        self.space = between[self.data]
        before, after = np.ones(n, bool), np.ones(n, bool)
        before[1:] = self.space[:-1]
        after[:-1] = self.space[1:]
        before[self.bounds[:-1][self.bounds[:-1] < n]] = True
        after[self.bounds[1:][self.bounds[1:] > 0] - 1] = True
        self.starts = np.flatnonzero(~self.space & before)
        self.ends = np.flatnonzero(~self.space & after) + 1
        self.at = np.searchsorted(self.starts, self.bounds)
        return self

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.at)

    def word_hashes(self) -> np.ndarray:
        return rolling(BYTE[self.data], self.starts, self.ends)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts (word numbers in the chunk) and row numbers of all windows of ``size`` words inside a row."""
        counts = np.maximum(self.n_words - size + 1, 0)
        rows = np.repeat(np.arange(self.rows), counts)
        first = np.cumsum(counts) - counts
        return np.arange(counts.sum()) - first[rows] + self.at[rows], rows

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and row numbers of the ``\\n``-separated lines."""
        breaks = np.flatnonzero(self.data == 10)
        starts = np.concatenate([self.bounds[:-1], breaks + 1])
        rows = np.concatenate([np.arange(self.rows), np.searchsorted(self.bounds, breaks, "right") - 1])
        order = np.lexsort((starts, rows))
        starts, rows = starts[order], rows[order]
        ends = np.empty_like(starts)
        ends[:-1] = starts[1:] - 1
        last = np.ones(len(rows), bool)
        last[:-1] = rows[1:] != rows[:-1]
        ends[last] = self.bounds[1:]
        return starts, ends, rows

    def joined(self, data: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all words with one space after each, and where each word starts."""
        lengths = self.ends - self.starts
        begin = np.cumsum(lengths + 1) - lengths - 1
        inside = np.ones(int((lengths + 1).sum()), bool)
        inside[begin + lengths] = False
        plain = np.full(len(inside), 32, np.uint8)
        plain[inside] = (self.data if data is None else data)[~self.space]
        return plain, begin

    def per_row(self, values: np.ndarray) -> np.ndarray:
        """Sum of byte-wise ``values`` within each row."""
        total = np.zeros(len(values) + 1, np.int64)
        np.cumsum(values, out=total[1:])
        return np.diff(total[self.bounds])


def chunks(column: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[Texts]:
    """Whole rows of a string column in pieces of about ``limit`` bytes; nulls are empty."""
    for part in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        if len(part) == 0:
            continue
        if part.null_count:
            part = part.fill_null("")
        wide = pa.types.is_large_string(part.type) or pa.types.is_large_binary(part.type)
        kind = np.int64 if wide else np.int32
        bounds = np.frombuffer(part.buffers()[1], kind)[part.offset : part.offset + len(part) + 1].astype(np.int64)
        raw = part.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
        row = 0
        while row < len(part):
            upto = max(row + 1, int(np.searchsorted(bounds, bounds[row] + limit, "right")) - 1)
            lo, hi = bounds[row], bounds[upto]
            yield Texts(data[lo:hi], bounds[row : upto + 1] - lo, row)
            row = upto


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of ``n`` words lie in a window of ``size`` words at one of ``starts``."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + size, -1)
    return np.cumsum(step[:-1]) > 0
