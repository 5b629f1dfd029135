"""Words of whole Arrow batches at once, found and hashed with numpy.

A batch of texts is one byte buffer with offsets, so words of all its rows are found with a handful of array
operations. Words are runs of bytes of one class; bytes of class 0 separate them. Text is UTF-8, and every byte
of a character beyond ASCII is at least 0x80, so classes over bytes give the same words as classes over characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 21
"""Bytes hashed at once; bounds working memory to about 50 bytes for each."""

_ODD = np.uint64(0x9E3779B97F4A7C15)
_SEED = np.random.Generator(np.random.PCG64(20250601))
BYTE_KEYS = _SEED.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0xD6E8FEB86659FD93)


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


class _Powers:
    """Powers of the hash base and of its inverse modulo 2^64, made once in a Python process."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, PIECE_BYTES + 1)
            for name, base in (("up", int(_BASE)), ("down", _inverse(int(_BASE)))):
                out = np.empty(size, dtype=np.uint64)
                out[0], done, step = 1, 1, base
                while done < size:  # doubling: out[done:2*done] = out[:done] * base^done
                    more = min(done, size - done)
                    out[done : done + more] = out[:more] * np.uint64(step)
                    done, step = done + more, step * step % (1 << 64)
                setattr(self, name, out)
        return self.up, self.down


POWERS = _Powers()


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on all bits (splitmix64's finish)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def byte_classes(**ranges: list[tuple[int, int]]) -> np.ndarray:
    """A table of 256 classes: 1 for the first keyword's byte ranges, 2 for the second's, and so on; else 0."""
    table = np.zeros(256, dtype=np.uint8)
    for number, spans in enumerate(ranges.values(), 1):
        for low, high in spans:
            table[low : high + 1] = number
    return table


def lower_ascii() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


SPACE = [(0x20, 0x20), (0x09, 0x0D)]
NOT_SPACE = byte_classes(word=[(0x00, 0x08), (0x0E, 0x1F), (0x21, 0xFF)])
ALNUM = byte_classes(word=[(0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)])
LOWER = lower_ascii()


@dataclass
class Words:
    """Words of a batch in text order. Row ``i`` has words ``first[i]`` to ``first[i + 1]``."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray
    kind: np.ndarray


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offsets of each; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], name: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Rows in batches whose texts have about ``limit`` bytes together; a longer text is a batch of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(at, stop - at)
            at = stop


def _cuts(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pieces of the buffer of about PIECE_BYTES that end between words."""
    at, end = 0, len(data)
    while at < end:
        stop = min(end, at + PIECE_BYTES)
        while stop < end:
            gaps = np.flatnonzero(classes[data[stop : stop + 4096]] == 0)
            row = offsets[np.searchsorted(offsets, stop)]
            if len(gaps) or row < stop + 4096:
                stop = min(stop + int(gaps[0]) if len(gaps) else end, int(row))
                break
            stop = min(end, stop + 4096)
        yield at, stop
        at = stop


def words(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray, fold: np.ndarray | None = None) -> Words:
    """Words of all rows. ``fold`` replaces bytes first, for example capitals by small letters."""
    starts, ends, hashes, kinds = [], [], [], []
    for low, high in _cuts(data, offsets, classes):
        piece = data[low:high] if fold is None else fold[data[low:high]]
        kind = classes[piece]
        change = np.empty(len(piece) + 1, dtype=bool)
        change[0] = change[-1] = True
        np.not_equal(kind[1:], kind[:-1], out=change[1:-1])
        rows = offsets[np.searchsorted(offsets, low) : np.searchsorted(offsets, high, "right")] - low
        change[rows] = True
        bounds = np.flatnonzero(change)
        begin, finish = bounds[:-1], bounds[1:]
        keep = kind[begin] != 0
        begin, finish = begin[keep], finish[keep]
        up, down = POWERS.get(len(piece) + 1)
        sums = np.empty(len(piece) + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(BYTE_KEYS[piece] * up[: len(piece)], out=sums[1:])
        starts.append(begin + low)
        ends.append(finish + low)
        hashes.append(mix((sums[finish] - sums[begin]) * down[begin]))
        kinds.append(kind[begin])
    if not starts:
        none = np.zeros(0, dtype=np.int64)
        return Words(none, none, none.astype(np.uint64), np.zeros(len(offsets), dtype=np.int64), none.astype(np.uint8))
    start = np.concatenate(starts)
    return Words(start, np.concatenate(ends), np.concatenate(hashes), np.searchsorted(start, offsets), np.concatenate(kinds))


def word_hash(word: str, fold: np.ndarray | None = None) -> int:
    """The hash that ``words`` gives this word."""
    data = np.frombuffer(word.encode(), dtype=np.uint8)
    data = data if fold is None else fold[data]
    up, _ = POWERS.get(len(data) + 1)
    return int(mix(np.sum(BYTE_KEYS[data] * up[: len(data)], dtype=np.uint64).reshape(1))[0])


def set_bits(values: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as Spark's signed ones, bit for bit."""
    return values.view(np.int64)


def shingles(found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word shingles of each row: (row, hash), sorted by both. Fewer words than ``size`` are one shingle."""
    counts = np.diff(found.first)
    total = len(found.hash)
    salts = [np.uint64(pow(int(_ODD), k + 1, 1 << 64)) for k in range(size)]
    out = np.zeros(total, dtype=np.uint64)
    for k, salt in enumerate(salts):
        if total > k:
            out[: total - k] += (found.hash[k:] + np.uint64(k + 1)) * salt
    left = np.repeat(found.first[1:], counts) - np.arange(total)  # words from here to the row's end
    whole = left >= size
    values = mix(out)
    rows, parts = [], []
    for row in np.flatnonzero(counts):
        low, high = found.first[row], found.first[row + 1]
        if high - low >= size:
            own = np.unique(values[low:high][whole[low:high]])
        else:
            own = np.full(1, high - low, dtype=np.uint64)
            for k in range(high - low):
                own = own + (found.hash[low + k : low + k + 1] + np.uint64(k + 1)) * salts[k] * _ODD
            own = mix(own)
        rows.append(np.full(len(own), row))
        parts.append(own)
    if not rows:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    return np.concatenate(rows), np.concatenate(parts)
