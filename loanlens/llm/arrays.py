"""Texts of an Arrow batch as one byte array, and hashes of their words and shingles."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 4 << 20
_WORD_MULTIPLIER = np.uint64(0x9E3779B97F4A7C13)  # odd, and 3 modulo 8
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _flags(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[np.frombuffer(chars, dtype=np.uint8)] = True
    return out


SPACE = _flags(b" \t\n\x0b\f\r")
#: White space and ASCII punctuation.
SEPARATOR = SPACE | _flags(bytes(c for c in range(33, 127) if not chr(c).isalnum()))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BYTE_VALUE = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def chunks(
    batches: Iterable[pa.RecordBatch], column: str = "text", max_bytes: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``max_bytes`` of text, or one longer text."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, offsets = byte_view(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + max_bytes, side="right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column without a copy, and where each row starts and ends."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, dtype=np.uint8), offsets - offsets[0]
    values = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
    return values, offsets - offsets[0]


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of all words, lower-cased A to Z, the word number each row starts at, and the
    byte each word starts at. The last entry of the second array is the number of words."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), np.zeros(0, np.int64)
    inside = ~separator[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = offsets[:-1][offsets[:-1] < n]
    begins[first] = inside[first]
    starts = np.flatnonzero(begins)
    if len(starts) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), starts
    lengths = np.diff(np.append(starts, n))
    kind = np.int32 if n < 1 << 31 else np.int64
    place = np.arange(starts[0], n, dtype=kind) - np.repeat(starts.astype(kind), lengths)
    powers = np.full(int(lengths.max()), _WORD_MULTIPLIER, dtype=np.uint64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    values = np.where(separator, np.uint64(0), _BYTE_VALUE[LOWER])[data[starts[0] :]]
    values *= powers[place]
    hashes = mix(np.add.reduceat(values, starts - starts[0]))
    return hashes, np.searchsorted(starts, offsets), starts


def shingle_hashes(
    hashes: np.ndarray, bounds: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words of each row, and the run number each row starts at.

    A row with fewer words, but at least one, has a single run of all its words.
    """
    counts = np.diff(bounds)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    starts = np.concatenate([[0], np.cumsum(runs)])
    total = int(starts[-1])
    if total == 0:
        return np.zeros(0, np.uint64), starts
    first = np.arange(total, dtype=np.int64) + np.repeat(bounds[:-1] - starts[:-1], runs)
    padded = np.concatenate([hashes, np.zeros(size, np.uint64)])
    out = np.zeros(total, np.uint64)
    factors = np.full(size, _WORD_MULTIPLIER, dtype=np.uint64)
    factors[0] = 1
    np.multiply.accumulate(factors, out=factors)
    for j in range(size):
        out += padded[first + j] * factors[j]
    short = (counts > 0) & (counts < size)
    for row in np.flatnonzero(short):
        own = hashes[bounds[row] : bounds[row + 1]]
        # the word count keeps these apart from full runs
        out[starts[row]] = (own * factors[: len(own)]).sum() ^ np.uint64(int(counts[row]) << 56)
    return mix(out), starts
