"""Shingle sets as sorted arrays of 64-bit hashes, made from bytes in numpy."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

U = np.uint64
_draw = np.random.default_rng(2024)
BYTE = _draw.integers(1, 2**63, 256).astype(U)
STEP = U(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
BACK = U(pow(int(STEP), -1, 2**64))


def mixed(values: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spread 64-bit values evenly (the finaliser of splitmix64); a salt gives another spread."""
    x = values + U(salt * 0x632BE59BD9B4E019 % 2**64)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(base: np.uint64, count: int) -> np.ndarray:
    out = np.full(count, base, U)
    out[:1] = 1
    return np.cumprod(out, dtype=U)


def shingle_sets(texts: Sequence[bytes], words: int) -> list[np.ndarray]:
    """Distinct shingles of ``words`` words of each text, sorted; of fewer words, the whole sequence as one.

    A-Z count as a-z. Words are runs of bytes other than space and 0x09 to 0x0D.
    """
    joined = np.frombuffer(b"".join(t + b"\n" for t in texts).lower(), np.uint8)
    blank = (joined == 32) | ((joined >= 9) & (joined <= 13))
    before = np.concatenate([[True], blank[:-1]])
    starts, ends = np.flatnonzero(~blank & before), np.flatnonzero(blank & ~before)
    # A word's hash is a polynomial in its bytes: a difference of running sums, shifted back to its start.
    sums = np.concatenate([np.zeros(1, U), np.cumsum(BYTE[joined] * _powers(STEP, len(joined)), dtype=U)])
    word = mixed((sums[ends] - sums[starts]) * _powers(BACK, len(joined) + 1)[starts])
    count = max(0, len(word) - words + 1)
    run = np.zeros(count, U)
    for k in range(words):
        run += word[k : k + count] * U((2 * k + 1) * int(STEP) % 2**64)
        run = (run << U(7)) | (run >> U(57))
    run = mixed(run)
    edges = np.searchsorted(starts, np.cumsum([0, *[len(t) + 1 for t in texts]]))
    out = []
    for first, end in zip(edges[:-1], edges[1:], strict=True):
        if end - first >= words:
            out.append(np.unique(run[first : end - words + 1]))
        elif end > first:
            few = np.array([end - first], U)
            for w in word[first:end]:
                few = mixed(few * STEP + w)
            out.append(few)
        else:
            out.append(np.zeros(0, U))
    return out
