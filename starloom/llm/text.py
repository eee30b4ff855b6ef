"""Vectorised helpers over many texts at once: words, hashes and shingles as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are worked on in runs of about this many bytes, so memory does not follow the batch.
CHUNK_BYTES = 1 << 19

_RNG = np.random.default_rng(20240229)
_BYTE_CODE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of an odd number modulo 2**64, grown on demand."""

    def __init__(self, base: np.uint64):
        self.base, self.values = base, np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.values) < n:
            values = np.full(max(n, 1 << 16), self.base, np.uint64)
            values[0] = 1
            self.values = np.multiply.accumulate(values)
        return self.values[:n]


_UP, _DOWN = _Powers(_BASE), _Powers(_BASE_INV)


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Array c of length n + 1; ``span_hashes`` takes the hash of any range from it."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODE[data] * _UP.upto(len(data)), out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte ranges [start, end); equal bytes and length give equal hashes."""
    down = _DOWN.upto(len(prefix))
    raw = (prefix[end] - prefix[start]) * down[start]
    return mix(raw + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer text stands alone. Nulls count as empty."""
    sizes = texts_lengths(texts)
    start, held = 0, 0
    for row, size in enumerate(sizes):
        if held and held + size > limit:
            yield start, row
            start, held = row, 0
        held += int(size)
    if start < len(sizes):
        yield start, len(sizes)


def texts_lengths(texts: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows laid end to end, and the rows' offsets (one more than rows)."""
    rows = [b"" if x is None else x for x in texts.cast(pa.large_binary()).to_pylist()]
    offsets = np.zeros(len(rows) + 1, np.int64)
    np.cumsum([len(x) for x in rows], out=offsets[1:])
    return np.frombuffer(b"".join(rows), np.uint8), offsets


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each maximal run of bytes that are not white space, and its row.

    White space is space and U+0009 to U+000D. Words never reach over a row's end.
    """
    inside = np.zeros(len(data) + 1, bool)
    inside[: len(data)] = ~_SPACE[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[: len(data) - 1]
    starts_row = np.zeros(len(data) + 1, bool)
    starts_row[offsets] = True
    start = np.flatnonzero(inside[:-1] & (~before | starts_row[:-1]))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | starts_row[1:])) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    return start, end, row


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A to Z in lower case; other bytes stay."""
    return _LOWER[data]


def word_shingles(texts: pa.Array, n: int) -> list[np.ndarray]:
    """For each row the sorted distinct hashes of its n-word shingles, letters A-Z lower-cased.

    A row of fewer words has its whole sequence as the one shingle; without words it has none.
    """
    data, offsets = joined(texts)
    if not len(data):
        return [np.empty(0, np.uint64)] * len(texts)
    start, end, row = words(data, offsets)
    prefix = prefix_hashes(lower_ascii(data))
    code = span_hashes(prefix, start, end)
    first = np.searchsorted(row, np.arange(len(texts) + 1))
    total = np.zeros(max(len(code) - n + 1, 0), np.uint64)
    factor = 1
    for k in range(n):
        factor = factor * 0xD1342543DE82EF95 % (1 << 64)
        total += code[k : len(code) - n + 1 + k] * np.uint64(factor) if len(total) else total
    total = mix(total + np.uint64(n)) if len(total) else total
    out = []
    for i in range(len(texts)):
        a, b = first[i], first[i + 1]
        if b - a >= n:
            out.append(np.unique(total[a : b - n + 1]))
        elif b > a:
            value, factor = int(b - a), 1
            for k in range(a, b):
                factor = factor * 0xD1342543DE82EF95 % (1 << 64)
                value = (value + int(code[k]) * factor) % (1 << 64)
            out.append(mix(np.array([value], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out
