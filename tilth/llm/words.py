"""Words of many texts at once: spans of one byte array, and hashes of the spans."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: The base of the span hashes and its inverse modulo 2^64; any odd base has one.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Bytes hashed at a time.
STRETCH = 1 << 18
BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_codes = [np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for seed in (5, 6)]
_powers: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}


def _power(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, int(n).bit_length())
    if (which, size) not in _powers:
        _powers.pop((which, size // 2), None)
        base = BASES[which]
        both = []
        for step in (base, pow(base, -1, 1 << 64)):
            row = np.full(size, step, np.uint64)
            row[0] = 1
            both.append(np.cumprod(row, dtype=np.uint64))
        _powers[which, size] = both[0], both[1]
    return _powers[which, size]


def span_hash(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """64-bit hash of each span's bytes, the same wherever the span stands. Starts and ends rise."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):  # a stretch of the buffer at a time, a span at least
        a = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, a + STRETCH, side="right")))
        out[i:j] = _hashes(buffer[a : ends[j - 1]], starts[i:j] - a, ends[i:j] - a, which)
        i = j
    return out


def _hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int) -> np.ndarray:
    up, down = _power(which, len(buffer) + 1)
    sums = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum(_codes[which][buffer] * up[: len(buffer)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts with a line end after each, place of each text's first byte and the end)."""
    buffer = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1, out=at[1:])
    return buffer, at


def word_spans(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs without ASCII blanks."""
    blank = BLANK[buffer]
    edge = np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def chunks(texts: list[bytes], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes each, one text at least."""
    first = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield first, i
            first, size = i, 0
        size += len(t) + 1
    if size:
        yield first, len(texts)
