"""Words of texts as 64-bit hashes, whole Arrow batches at a time.

A word is a run of bytes outside ``\\x20`` and ``\\x09-\\x0D``, which in UTF-8 is the pattern
``[^\\x20\\x09-\\x0D]+``.  Word hashes are polynomial hashes over random byte codes: with prefix
sums modulo 2**64 every word of a chunk comes from two lookups, without a Python loop over words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
CHUNK_BYTES = 1 << 20  # texts are taken together up to this size; one longer text is a chunk of its own

_rng = np.random.default_rng(20240607)
_CODES = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_CODES_LOWER = _CODES[_LOWER]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_NOT_ALNUM = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])
_MIX = [U64(int(x) | 1) for x in _rng.integers(1, 2**63, 64)]


def _powers(n: int, base: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, by doubling."""
    out = np.ones(max(n, 1), U64)
    done, step = 1, base
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * U64(step)
        done += more
        step = step * step % 2**64
    return out


BLOCK = CHUNK_BYTES  # bytes hashed at a time, so that a very long text needs no more room than a chunk
NEAR = 1 << 14  # bytes taken through several steps at a time, as their numbers then stay in a core's cache
_UP, _DOWN = _powers(BLOCK + 1, BASE), _powers(BLOCK + 1, pow(BASE, -1, 2**64))


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer: every input bit reaches every output bit."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def _prefixes(codes: np.ndarray, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of code * BASE**place over the bytes before each place of at (two ascending halves)."""
    out, carry = np.zeros(len(at), U64), 0
    halves = [(0, len(at) // 2), (len(at) // 2, len(at))]
    for start in range(0, max(len(data), 1), BLOCK):
        block = data[start : start + BLOCK]
        total = np.zeros(len(block) + 1, U64)
        for i in range(0, len(block), NEAR):
            part = codes.take(block[i : i + NEAR])
            part *= _UP[i : i + len(part)]
            part[:1] += total[i : i + 1]
            np.cumsum(part, out=total[i + 1 : i + 1 + len(part)])
        scale, last = pow(BASE, start, 2**64), start + len(block) == len(data)
        for i, j in halves:
            lo, hi = np.searchsorted(at[i:j], [start, start + len(block) + last]) + i
            out[lo:hi] = U64(carry) + U64(scale) * total[at[lo:hi] - start]
        carry = (carry + scale * int(total[-1])) % 2**64
    return out


def _down(at: np.ndarray) -> np.ndarray:
    """BASE**-place of ascending places."""
    out = np.empty(len(at), U64)
    for start in range(0, int(at[-1]) + 1 if len(at) else 0, BLOCK):
        lo, hi = np.searchsorted(at, [start, start + BLOCK])
        out[lo:hi] = U64(pow(BASE, -start, 2**64)) * _DOWN[at[lo:hi] - start]
    return out


class Chunk:
    """Words of some consecutive texts of a batch.

    first, last: rows of the batch; bounds: word index at which each text begins, and the end;
    hashes: one per word; starts, ends: byte offsets of the words in data.
    """

    __slots__ = ("first", "last", "data", "bounds", "hashes", "starts", "ends", "text_starts")

    def __init__(self, first, last, data, text_starts, lower, alnum):
        self.first, self.last, self.data, self.text_starts = first, last, data, text_starts
        n = len(data)
        space = np.ones(n + 2, bool)
        space[1:-1] = (_NOT_ALNUM if alnum else _SPACE)[data]
        edges = text_starts[1:-1]
        begins = ~space[1:-1] & space[:-2]
        begins[edges[edges < n]] = ~space[1:-1][edges[edges < n]]
        after = space[2:].copy()
        after[edges[edges > 0] - 1] = True
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(~space[1:-1] & after) + 1
        codes = _CODES_LOWER if lower else _CODES
        total, back = _prefixes(codes, data, np.r_[self.starts, self.ends]), _down(self.starts)
        m = len(self.starts)
        self.hashes = mix((total[m:] - total[:m]) * back + (self.ends - self.starts).astype(U64))
        self.bounds = np.searchsorted(self.starts, text_starts)

    def words(self, i: int) -> np.ndarray:
        """Word hashes of text i of the chunk."""
        return self.hashes[self.bounds[i] : self.bounds[i + 1]]


def binary(column: pa.Array) -> pa.Array:
    """Bytes of a string column; null counts as empty. The text itself isn't copied."""
    column = column.cast(pa.large_binary())
    return column.fill_null(b"") if column.null_count else column


def chunks(column: pa.Array, lower: bool = False, alnum: bool = False) -> Iterator[Chunk]:
    """Chunks of a string column; null counts as empty.

    lower: A-Z count as a-z; alnum: all ASCII but letters and digits separates words.
    """
    column = binary(column)
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    i, n = 0, len(column)
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK_BYTES, side="right")) - 1)
        j = min(j, n)
        yield Chunk(i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], lower, alnum)
        i = j


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive words; none if there are fewer than k."""
    m = len(hashes) - k + 1
    if m <= 0:
        return np.zeros(0, U64)
    if k <= 8:
        out = hashes[:m] * _MIX[0]
        for j in range(1, k):
            out += hashes[j : j + m] * _MIX[j]
        return mix(out)
    out = np.empty(m, U64)
    for start in range(0, m, BLOCK - k):
        part = hashes[start : start + BLOCK]
        total = np.zeros(len(part) + 1, U64)
        np.cumsum(part * _UP[: len(part)], out=total[1:])
        n = len(part) - k + 1
        out[start : start + n] = mix((total[k:] - total[:-k]) * _DOWN[:n] + U64(k))
    return out


def shingle_set(hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct k-word shingles; the whole sequence as one when it is shorter."""
    if not len(hashes):
        return np.zeros(0, U64)
    n = len(hashes)
    g = np.sort(grams(hashes, k) if n >= k else grams(hashes, n) + U64(n))
    return g[np.r_[True, g[1:] != g[:-1]]]


def as_long(a: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(a).view(np.int64)
