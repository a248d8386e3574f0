"""Whole Arrow batches of texts as numpy arrays of words and hashes.

A word is a maximal run of bytes outside ``\\x20\\x09-\\x0D``.  Hashes depend on content only, so they agree
between tasks, runs and machines.  Those of words and runs are 64-bit, made of mixing steps that aren't linear; what
must be equal as words is compared by cryptographic digests of 128 bits.  Null texts count as empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"
IS_WORD = np.ones(256, bool)
IS_WORD[list(WHITE)] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of text handled at once inside a task; one longer text is handled alone, its bytes in steps of STEP.
PIECE, STEP = 1 << 19, 1 << 16

#: Odd multipliers of the hashes.
_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)
#: Words of more bytes are hashed one by one.
LONG_WORD = 64
#: The lowest bytes of a number, by how many of them belong to a word.
_KEEP = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)


class Words(NamedTuple):
    """starts, ends: byte ranges of the words; first: index of each text's first word, and the end."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    return mixed(x.copy())


def mixed(x: np.ndarray) -> np.ndarray:
    """mix() in place, by steps that fit the processor's cache."""
    flat = x.reshape(-1)
    for s in range(0, len(flat), STEP):
        part = flat[s : s + STEP]
        part ^= part >> np.uint64(30)
        part *= np.uint64(0xBF58476D1CE4E5B9)
        part ^= part >> np.uint64(27)
        part *= np.uint64(0x94D049BB133111EB)
        part ^= part >> np.uint64(31)
    return x


def byte_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for each pair, the same wherever the bytes stand.

    Eight bytes at a time are added to what has been mixed before, so no arithmetic structure of the bytes
    carries over; ranges of more than LONG_WORD bytes get a cryptographic hash.
    """
    out = np.empty(len(starts), np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, np.uint64, padded, strides=(1,))  # the eight bytes from each place on
    for s in range(0, len(starts), STEP):
        begin, size = starts[s : s + STEP], ends[s : s + STEP] - starts[s : s + STEP]
        h = size.astype(np.uint64) * _P
        h ^= eight[begin] & _KEEP[np.minimum(size, 8)]
        mixed(h)
        more = np.flatnonzero((size > 8) & (size <= LONG_WORD))
        done = 8
        while len(more):
            next_ = eight[begin[more] + done] & _KEEP[np.minimum(size[more] - done, 8)]
            h[more] = mixed(h[more] * _Q + next_)
            done += 8
            more = more[size[more] > done]
        for i in np.flatnonzero(size > LONG_WORD):
            h[i] = int.from_bytes(hashlib.blake2b(data[begin[i] : begin[i] + size[i]], digest_size=8).digest(), "little")
        out[s : s + STEP] = h
    return out


def run_hashes(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, salt: int = 0) -> np.ndarray:
    """Hash of values[lo:hi] for each pair, the same wherever the values stand.

    A run is cut into stretches of 1, 2, 4, ... values by the bits of its length, and a stretch's hash mixes those of its
    halves: a tree whose every step is mixed.  Only one level of the tree is held at a time.
    """
    size = hi - lo
    out = mixed(size.astype(np.uint64) * _P + np.uint64(salt))
    if not len(size):
        return out
    most, at, step = int(size.max()), lo.copy(), 1
    level = mix(values ^ np.uint64(salt)) if salt else values
    while step <= most:
        for s in range(0, len(size), STEP):
            some = np.flatnonzero(size[s : s + STEP] & step) + s
            out[some] = mixed(out[some] * _P + level[at[some]])
            at[some] += step
        if 2 * step <= most:
            longer = level[: len(level) - step] * _Q
            longer += level[step:]
            longer += np.uint64(step)
            level = mixed(longer)
        step *= 2
    return out


def joined(w: Words, text: int) -> np.ndarray:
    """The bytes of a text's words, joined by one blank."""
    a, b = w.first[text], w.first[text + 1]
    if a == b:
        return w.data[:0]
    part = w.data[w.starts[a] : w.ends[b - 1]].copy()
    ends = w.ends[a : b - 1] - w.starts[a]
    keep = IS_WORD[part]
    keep[ends], part[ends] = True, 0x20
    return part[keep]


def _digest(data) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def text_digests(w: Words) -> pa.Array:
    """A 128-bit cryptographic hash of each text's whole word sequence, as 16 bytes."""
    return pa.array([_digest(joined(w, t)) for t in range(len(w.first) - 1)], pa.binary())


def run_digests(w: Words, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """A 128-bit cryptographic hash, as two numbers, of the words lo..hi of one text each; lo must not fall."""
    out = bytearray()
    text = np.searchsorted(w.first, lo, "right") - 1
    for t in np.unique(text):
        a, b = w.first[t], w.first[t + 1]
        begin = np.concatenate([[0], np.cumsum(w.ends[a:b] - w.starts[a:b] + 1)])  # of each word, once they are joined
        data = joined(w, t).tobytes()
        i, j = np.searchsorted(text, [t, t + 1])
        for x, y in zip(begin[lo[i:j] - a].tolist(), begin[hi[i:j] - a].tolist()):
            out += _digest(data[x : y - 1])
    return np.frombuffer(bytes(out), np.uint64).reshape(-1, 2)


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, bytes, offsets) of runs of rows with about ``limit`` bytes."""
    col = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    _, where, data = col.buffers()
    offs = np.frombuffer(where, np.int64, len(col) + 1, col.offset * 8) if len(col) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(col):
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        hi = min(hi, len(col))
        yield lo, hi, raw[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


def split(data: np.ndarray, offs: np.ndarray, lower: bool = False, table: np.ndarray = IS_WORD) -> Words:
    """The words of each text; lower: A-Z become a-z; table: which bytes belong to words."""
    if lower:
        data = LOWER[data]
    cuts = offs[(offs > 0) & (offs < len(data))]
    starts, ends = [], []
    before = False
    for s in range(0, len(data), PIECE):
        e = min(len(data), s + PIECE)
        here = np.empty(e - s + 1, bool)  # the byte before, then those of this step
        here[0] = before
        here[1:] = table[data[s:e]]
        before = here[-1]
        begins, stops = here[1:] & ~here[:-1], here[:-1] & ~here[1:]
        inner = cuts[np.searchsorted(cuts, s) : np.searchsorted(cuts, e)] - s  # where another text begins
        stops[inner] |= here[inner]
        begins[inner] |= here[inner + 1]
        starts.append(np.flatnonzero(begins) + s)
        ends.append(np.flatnonzero(stops) + s)
    if before:
        ends.append(np.array([len(data)]))
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    starts = join(starts)
    return Words(data, starts, join(ends), np.searchsorted(starts, offs))


def word_hashes(w: Words) -> np.ndarray:
    """One 64-bit hash for each word."""
    return byte_hashes(w.data, w.starts, w.ends)


def gram_hashes(words: np.ndarray, lo: np.ndarray, hi: np.ndarray, salt: int = 0) -> np.ndarray:
    """One 64-bit hash for each run of words lo..hi; other salts give other hashes of the same words' hashes."""
    return run_hashes(words, lo, hi, salt)


def shingle_ranges(first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lo, hi, bounds): every run of k words of one text; texts of 1 to k - 1 words give one run of all.

    bounds has the index of each text's first run, and the end.
    """
    counts = np.diff(first)
    runs = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(runs)])
    lo = np.arange(bounds[-1])
    lo -= np.repeat(bounds[:-1] - first[:-1], runs)
    hi = lo + k
    np.minimum(hi, np.repeat(first[1:], runs), out=hi)
    return lo, hi, bounds


def longs(values: np.ndarray) -> pa.Array:
    """A uint64 array as Spark's long."""
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def long_lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Consecutive uint64 runs as array<long>."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), longs(values))
