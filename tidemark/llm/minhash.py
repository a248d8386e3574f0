"""b-bit MinHash signatures: full minima make band keys, their low bits are packed for estimates."""

from __future__ import annotations

import numpy as np

from .text import mix

#: Shingles hashed at once, so that one very long text needs bounded memory.
BLOCK = 1 << 15


def seeds(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Fixed odd multipliers and offsets, one pair for each permutation."""
    drawn = mix(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (drawn[:count] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (drawn[count:] >> np.uint64(32)).astype(np.uint32)


def minima(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least permuted hash under each permutation; repeats of a shingle don't matter."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(a), np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(x), BLOCK):
        part = x[at : at + BLOCK]
        for lo in range(0, len(a), 16):  # small enough for the processor's cache
            y = part[None, :] * a[lo : lo + 16, None] + b[lo : lo + 16, None]
            y ^= y >> np.uint32(15)
            y *= np.uint32(0x2C1B3C6D)
            out[lo : lo + 16] = np.minimum(out[lo : lo + 16], y.min(axis=1))
    return out


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """(texts, bands): one 64-bit key for each band of ``rows`` minima."""
    texts, count = signatures.shape
    bands = count // rows
    parts = signatures[:, : bands * rows].reshape(texts, bands, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), (texts, bands))
    for i in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return key


def planes(signatures: np.ndarray, bits: int) -> np.ndarray:
    """(texts, bits * permutations / 64): the low bits of the minima, bit plane after bit plane."""
    texts, count = signatures.shape
    out = []
    for bit in range(bits):
        plane = ((signatures >> np.uint32(bit)) & np.uint32(1)).astype(np.uint8).reshape(texts, count // 64, 64)
        out.append(np.packbits(plane, axis=2, bitorder="little").view(np.uint64).reshape(texts, count // 64))
    return np.concatenate(out, axis=1)
