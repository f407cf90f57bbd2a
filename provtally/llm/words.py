"""Vectorised words, shingles and minimisers over Arrow text columns.

Bytes stay in one buffer; words are slices of it. A word's hash comes from prefix sums of
position-weighted byte values modulo 2**64, a window's hash in the same way from its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer text is handled alone.
CHUNK_BYTES = 1 << 20
_U = np.uint64
_STEP_BYTE = 0x9E3779B97F4A7C15
_STEP_WORD = 0xD6E8FEB86659FD93


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def mixed(value: int) -> np.uint64:
    return mix(np.array([value % (1 << 64)], dtype=np.uint64))[0]


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64, grown when longer texts come."""

    def __init__(self, base: int):
        self.base, self.inverse, self.up, self.down = base, pow(base, -1, 1 << 64), None, None

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if self.up is None or len(self.up) < n:
            size = max(n, CHUNK_BYTES + 1)
            self.up = self._of(self.base, size)
            self.down = self._of(self.inverse, size)
        return self.up[:n], self.down[:n]

    @staticmethod
    def _of(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)


_BYTES, _WORDS = _Powers(_STEP_BYTE), _Powers(_STEP_WORD)
_VALUES = mix(np.arange(1, 257, dtype=np.uint64))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: _Powers) -> np.ndarray:
    up, down = powers.get(len(values) + 1)
    total = np.empty(len(values) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(values * up[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw, at


def chunks(at: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most so many bytes each, one row at least."""
    first, n = 0, len(at) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, side="right")) - 1)
        yield first, last
        first = last


class Words:
    """The words of a range of rows: byte slices, hashes, and each row's first word."""

    def __init__(self, raw: np.ndarray, at: np.ndarray, first: int, last: int):
        low, high = int(at[first]), int(at[last])
        self.raw = raw[low:high]
        edges = at[first : last + 1] - low
        inside = ~_SPACE[self.raw]
        begins, stops = inside.copy(), inside.copy()
        cut = edges[(edges > 0) & (edges < len(inside))]
        begins[1:] &= ~inside[:-1]
        stops[:-1] &= ~inside[1:]
        begins[cut] |= inside[cut]
        stops[cut - 1] |= inside[cut - 1]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        self.first = np.searchsorted(self.start, edges)
        self.row = np.repeat(np.arange(last - first), np.diff(self.first))
        self.hash = _sums(_VALUES[self.raw], self.start, self.end, _BYTES)
        self.count = np.diff(self.first)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of all windows of n words inside one row, and the windows' hashes."""
        if len(self.hash) < n:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        start = np.flatnonzero(self.row[: len(self.row) - n + 1] == self.row[n - 1 :])
        return start, _sums(self.hash, start, start + n, _WORDS)

    def joined(self, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Each row's words (those of keep) joined by one space: bytes, row offsets, words' begins and ends."""
        chosen = np.arange(len(self.start)) if keep is None else np.flatnonzero(keep)
        edge = np.zeros(len(self.raw) + 1, dtype=np.int8)
        edge[self.start[chosen]] += 1
        edge[self.end[chosen]] -= 1
        mask = np.cumsum(edge[:-1], dtype=np.int8) > 0
        last = np.ones(len(chosen), dtype=bool)
        last[:-1] = self.row[chosen[1:]] != self.row[chosen[:-1]]
        gaps = self.end[chosen[~last]]
        raw = self.raw
        if len(gaps):
            raw = raw.copy()
            raw[gaps] = 0x20
            mask[gaps] = True
        length = self.end[chosen] - self.start[chosen]
        stop = np.cumsum(length + ~last)
        per_row = np.zeros(len(self.count) + 1, dtype=np.int64)
        np.add.at(per_row, self.row[chosen] + 1, length + ~last)
        return raw[mask], np.cumsum(per_row), stop - length - ~last, stop - ~last


def minimisers(words: Words, window: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window of so many words: its first word, and place and hash of its minimiser.

    The minimiser is the leftmost k-word run of least hash in the window, so equal windows
    select the same place whatever surrounds them.
    """
    start, _ = words.windows(window)
    if not len(start):
        return start, start, np.zeros(0, dtype=np.uint64)
    every = _sums(words.hash, np.arange(len(words.hash) - k + 1), np.arange(k, len(words.hash) + 1), _WORDS)
    view = np.lib.stride_tricks.sliding_window_view(every, window - k + 1)
    place = np.empty(len(start), dtype=np.int64)
    for low in range(0, len(start), 1 << 16):
        part = start[low : low + (1 << 16)]
        dense = part[-1] - part[0] + 1 == len(part)
        rows = view[part[0] : part[-1] + 1] if dense else view[part]
        place[low : low + len(part)] = part + rows.argmin(axis=1)
    return start, place, every[place]


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64, copy=False).view(np.int64)


def unsigned(x: np.ndarray) -> np.ndarray:
    return x.astype(np.int64, copy=False).view(np.uint64)


def lists(values: pa.Array, counts: np.ndarray) -> pa.Array:
    """A list column of so many values in each row."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def whole_groups(batches: Iterator[pa.RecordBatch], key: tuple[str, ...]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by key; a group at a batch's end waits for the next."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        n = held.num_rows
        same = np.ones(n, dtype=bool)
        for name in key:
            column = held.column(name)
            same &= pc.equal(column, column[n - 1]).combine_chunks().to_numpy(zero_copy_only=False)
        begin = n - int(np.argmin(same[::-1])) if not same.all() else 0
        if begin:
            yield held.slice(0, begin).combine_chunks()
            held = held.slice(begin)
    if held is not None and held.num_rows:
        yield held.combine_chunks()
