"""Words and shingles of whole Arrow batches as 64-bit hashes, in numpy.

A word is a run of bytes other than space and \\t to \\r; A-Z count as a-z. A word's hash
is a polynomial over a random table of its bytes, modulo 2**64, then mixed: it depends
on the word alone, not on the batch, the task or the process.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

STEP = 1 << 18  # bytes hashed at a time: bounds the memory for long texts
_ODD = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_CODE = np.random.Generator(np.random.PCG64(20240229)).integers(0, 2**64, 256, dtype=np.uint64)
_CODE[65:91] = _CODE[97:123]
U = np.uint64


@functools.lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_ODD, pow(_ODD, -1, 1 << 64)):
        p = np.full(n + 1, base, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p))
    return out[0], out[1]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U(31))
    h *= U(0xBF58476D1CE4E5B9)
    h ^= h >> U(29)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(32)
    return h


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where each text starts (one more at the end). Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def _hash_step(raw: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the words of raw; a word also ends at each of breaks."""
    n = len(raw)
    inside = ~_SPACE[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cut = breaks[(breaks > 0) & (breaks < n)]
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _powers(1 << max(19, (n + 1).bit_length()))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_CODE[raw] * up[:n], out=total[1:])
    return mix((total[end] - total[start]) * down[start]), start


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts one after another, and where each text's words start."""
    raw, at = text_bytes(column)
    hashes, starts, pos = [], [], 0
    while pos < len(raw):
        stop = min(pos + STEP, len(raw))
        while stop < len(raw) and not _SPACE[raw[stop]]:
            ahead = np.flatnonzero(_SPACE[raw[stop : stop + 4096]])
            stop = stop + int(ahead[0]) if len(ahead) else min(stop + 4096, len(raw))
        low, high = np.searchsorted(at, [pos, stop])
        h, s = _hash_step(raw[pos:stop], at[low:high] - pos)
        hashes.append(h)
        starts.append(s + pos)
        pos = stop
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), at)


def shingles(h: np.ndarray, at: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of width words inside each text, and where each text's runs start.

    A text with some words but fewer than width has one run, all its words.
    """
    count = np.diff(at)
    runs = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    out_at = np.concatenate([[0], np.cumsum(runs)])
    full = max(0, len(h) - width + 1)
    every = np.zeros(full, np.uint64)
    for k in range(width):
        every = every * U(_ODD) + h[k : k + full]
    out = np.zeros(out_at[-1], np.uint64)
    doc = np.repeat(np.arange(len(count)), runs)
    inside = np.arange(out_at[-1]) - out_at[doc] + at[doc]
    long = (count >= width)[doc]
    out[long] = every[inside[long]]
    for i in np.flatnonzero((count > 0) & (count < width)):
        total = int(count[i])
        for x in h[at[i] : at[i + 1]]:
            total = (total * _ODD + int(x)) % (1 << 64)
        out[out_at[i]] = total
    return mix(out), out_at


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that their texts have about most bytes; no text is cut."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(np.diff(text_bytes(batch.column(column))[1]))
        begin = 0
        while begin < batch.num_rows:
            base = size[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(size, base + most, "right")))
            yield batch.slice(begin, end - begin)
            begin = end
