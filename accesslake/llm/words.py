"""Vectorised word hashing of Arrow string columns.

A text is cut into tokens (maximal runs of bytes of one class) and every token
gets a 64-bit hash, with numpy passes over the column's byte buffer instead of
a Python loop over words.  The hash is a polynomial with random byte values
modulo 2**64, finished by a mixing step.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_BASE = U(0x9E3779B97F4A7C15)
_BASE_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 2**64))
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
#: Byte classes: 0 separates tokens, runs of any other class are tokens.
SPACES = np.ones(256, np.uint8)
SPACES[[32, *range(9, 14)]] = 0
MARKS = SPACES.copy()
MARKS[[c for c in range(33, 127) if not chr(c).isalnum()]] = 2
CHUNK = 1 << 21


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(33))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            t = np.full(max(n, CHUNK + 1), base, np.uint64)
            t[0] = 1
            _powers[k] = np.cumprod(t, dtype=np.uint64)
    return _powers[0], _powers[1]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; null counts as the empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, off, data = texts.buffers()
    off = np.frombuffer(off, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return off, (np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8))


def _span(off: np.ndarray, data: np.ndarray, classes: np.ndarray, fold: bool) -> tuple[np.ndarray, np.ndarray]:
    """Token starts of each text and token hashes, of neighbouring texts."""
    base, b = off[0], data[off[0] : off[-1]]
    at = off - base
    if not len(b):
        return np.zeros(len(off), np.int64), np.empty(0, np.uint64)
    c = classes[b]
    first = np.empty(len(b), bool)
    first[0] = True
    np.not_equal(c[1:], c[:-1], out=first[1:])
    first[at[:-1][at[:-1] < len(b)]] = True
    edge = np.flatnonzero(first)
    stop = np.append(edge[1:], len(b))
    keep = c[edge] != 0
    start, stop = edge[keep], stop[keep]
    up, down = _power_tables(len(b) + 1)
    total = np.empty(len(b) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE[_FOLD[b] if fold else b] * up[: len(b)], dtype=np.uint64, out=total[1:])
    h = (total[stop] - total[start]) * down[start]
    return np.searchsorted(start, at).astype(np.int64), mix(h + (stop - start).astype(np.uint64))


def word_hashes(texts: pa.Array, classes: np.ndarray = SPACES, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """``(starts, hashes)``: text i has the tokens ``hashes[starts[i]:starts[i + 1]]``.

    ``fold`` lower-cases A-Z.  Works in pieces of about CHUNK bytes, cut
    between texts.
    """
    off, data = buffers(texts)
    starts, hashes, done, i = [np.zeros(1, np.int64)], [], 0, 0
    while i < len(off) - 1:
        j = max(i + 1, int(np.searchsorted(off, off[i] + CHUNK, "right")) - 1)
        s, h = _span(off[i : j + 1], data, classes, fold)
        starts.append(s[1:] + done)
        hashes.append(h)
        done += len(h)
        i = j
    return np.concatenate(starts), np.concatenate(hashes) if hashes else np.empty(0, np.uint64)


def shingles(starts: np.ndarray, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``(starts, shingle hashes)`` in text order; a text with fewer words has them all as one shingle."""
    n = np.diff(starts)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    out = np.zeros(len(starts), np.int64)
    np.cumsum(count, out=out[1:])
    if not len(hashes):
        return out, np.empty(0, np.uint64)
    pos = np.arange(out[-1]) - np.repeat(out[:-1] - starts[:-1], count)
    width = np.repeat(np.minimum(n, size), count)
    h = width.astype(np.uint64) * U(0x2545F4914F6CDD1D)
    for k in range(size):
        inside = k < width
        term = mix(h * U(0x100000001B3) + hashes[np.minimum(pos + k, len(hashes) - 1)])
        h = term if inside.all() else np.where(inside, term, h)
    return out, h
