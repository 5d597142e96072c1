"""Array helpers that tasks apply to a batch of texts: words, names of substrings, sliding minima.

Texts are UTF-8 bytes. A name is a 64-bit value of a substring or of a word sequence; equal strings have equal
names. Names come from one prefix sum over the batch, so the name of any substring costs a few array operations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}
_BYTE_VALUES = np.random.Generator(np.random.PCG64(20240117)).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)

#: bytes of text that a task works on at once; arrays of a text take some 50 times as much, and a long-lived worker keeps what they took
PIECE = 1 << 18

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x = x * U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _powers(which: str, n: int) -> np.ndarray:
    have = _POWERS.get(which)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        out = np.full(size, U64(_BASE if which == "up" else _INVERSE))
        out[0] = 1
        have = _POWERS[which] = np.multiply.accumulate(out)
    return have[:n]


def prefix_names(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``substring_names`` reads; one value more than there are bytes."""
    out = np.zeros(len(data) + 1, U64)
    np.cumsum(_BYTE_VALUES[data] * _powers("up", len(data)), out=out[1:])
    return out


def substring_names(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Names of data[start:end]."""
    raw = (prefix[end] - prefix[start]) * _powers("down", len(prefix))[start]
    return mix(raw + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93))


def word_bounds(data: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes that are no separator."""
    inside = np.empty(len(data) + 2, bool)
    inside[0] = inside[-1] = False
    np.logical_not(separator[data], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[0::2], edges[1::2]


def join_texts(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """One array with a line feed after each text, and where each text begins (one offset more than texts)."""
    parts = [t or b"" for t in texts]
    data = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8) if parts else np.zeros(0, np.uint8)
    offsets = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=offsets[1:])
    return data, offsets


def chained_names(words: np.ndarray, n: int) -> np.ndarray:
    """Names of n consecutive words, one for each start; empty if there are fewer words."""
    if len(words) < n:
        return np.zeros(0, U64)
    out = words[: len(words) - n + 1].copy()
    for i in range(1, n):
        out *= U64(0xD1342543DE82EF95)
        out += words[i: len(words) - n + 1 + i]
        out ^= out >> U64(29)
    return mix(out)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of ``width`` values, one for each start, by block-wise running minima."""
    n = len(values)
    if n < width:
        return np.zeros(0, values.dtype)
    blocks = -(-n // width)
    grid = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    grid[:n] = values
    grid = grid.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1: n])


def batches_of(sizes: list[int], most: int) -> Iterator[slice]:
    """Slices of consecutive rows whose sizes sum to about ``most``; a larger row stands alone."""
    first, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield slice(first, i)
            first, total = i, 0
        total += size
    if first < len(sizes):
        yield slice(first, len(sizes))
