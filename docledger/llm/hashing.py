"""64-bit hashes of words and word windows, for many texts at a time in numpy.

A word is a maximal run of bytes other than space and 0x09-0x0D (as in bytes.split()). Its hash is a polynomial of its
bytes, taken from prefix sums and mixed; equal words have equal hashes wherever they stand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    if base not in _POWERS or len(_POWERS[base]) < n:
        size = max(n, 1 << 20)
        x = np.full(size, base, U)
        x[0] = 1
        _POWERS[base] = np.multiply.accumulate(x)
    return _POWERS[base][:n]


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x + U((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def word_hashes(texts: list[bytes], salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts in order, and where each text's words start (one more entry than texts)."""
    data = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)
    gap = SPACE[data]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    starts, ends = edge[::2], edge[1::2]
    with np.errstate(over="ignore"):
        sums = np.cumsum((data.astype(U) + U(1 + 2 * salt)) * powers(BASE, len(data)))
        h = mix((sums[ends - 1] - sums[starts - 1]) * powers(INVERSE, len(data))[starts] + (ends - starts).astype(U), salt)
    at = np.cumsum([1] + [len(t) + 1 for t in texts])
    return h, np.searchsorted(starts, at)


def windows(h: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """Hashes of the windows of n consecutive words."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, U)
    with np.errstate(over="ignore"):
        c = np.concatenate([np.zeros(1, U), np.cumsum(h * powers(BASE, len(h)))])
        return mix((c[n:] - c[:-n]) * powers(INVERSE, m), salt)


def blocks(texts: list[str | None], limit: int = 1 << 19) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts as UTF-8 of about `limit` bytes, and where each run starts. A longer text is a run of its own."""
    at, held, size = 0, [], 0
    for k, t in enumerate(texts):
        b = (t or "").encode()
        if held and size + len(b) > limit:
            yield at, held
            at, held, size = k, [], 0
        held.append(b)
        size += len(b)
    if held:
        yield at, held
