"""Words of whole texts as 64-bit hashes, many texts at once.

A word is a run of bytes other than ASCII white space, with A-Z lower-cased.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = np.uint64(0x9E3779B97F4A7C15)
SLICE_BYTES = 2_000_000
TILE = 1 << 20

_code = np.arange(256)
IS_SPACE = (_code == 0x20) | ((_code >= 0x09) & (_code <= 0x0D))
LOWER = np.where((_code >= 0x41) & (_code <= 0x5A), _code + 0x20, _code).astype(np.uint8)
#: For words without marks: every ASCII byte that is no letter or digit ends a word.
IS_MARK = (_code < 0x80) & ~np.array([chr(c).isalnum() for c in range(128)] + [False] * 128)
VALUE = LOWER.astype(np.uint64) + np.uint64(1)


class Words(NamedTuple):
    """``hashes`` of all words; text ``i`` has those from ``bounds[i]`` to ``bounds[i + 1]``. ``at``: first bytes."""

    hashes: np.ndarray
    bounds: np.ndarray
    at: np.ndarray


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over the whole range, one to one."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after another, and where each begins; a null is an empty text."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64."""
    out = []
    for base in (BASE, np.uint64(pow(int(BASE), -1, 1 << 64))):
        p = np.full(size, base)
        p[0] = 1
        out.append(np.cumprod(p))
    return out[0], out[1]


def _tiles(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Parts of about TILE bytes that begin and end between words; ``ends``: the bytes that end a word."""
    lo = 0
    while lo < len(ends):
        hi = min(lo + TILE, len(ends))
        if hi < len(ends):
            back = int(ends[lo:hi][::-1].argmax())
            hi = hi - back if ends[hi - back - 1] else hi + int(np.append(ends[hi:], True).argmax())
        yield lo, hi
        lo = hi


def words(data: np.ndarray, offsets: np.ndarray, ends: np.ndarray = IS_SPACE) -> Words:
    """``ends``: which of the 256 bytes end a word.

    A word's hash is the polynomial of its bytes, taken from running sums and freed of its place in the buffer.
    """
    if not len(data):
        return Words(np.empty(0, np.uint64), np.zeros(len(offsets), np.int64), np.empty(0, np.int64))
    over = ends[data]
    inside = ~over
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= over[:-1]
    stops[:-1] &= over[1:]
    edge = offsets[1:-1][offsets[1:-1] < len(data)]
    begins[edge] = inside[edge]
    edge = edge[edge > 0] - 1
    stops[edge] = inside[edge]
    at, last = np.flatnonzero(begins), np.flatnonzero(stops)
    bounds = np.searchsorted(at, offsets)
    hashes = np.empty(len(at), np.uint64)
    for lo, hi in _tiles(over):
        size = max(TILE, 1 << (hi - lo - 1).bit_length())
        power, inverse = _powers(size)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(VALUE[data[lo:hi]] * power[: hi - lo], out=sums[1:])
        a, b = np.searchsorted(at, (lo, hi))
        hashes[a:b] = (sums[last[a:b] + 1 - lo] - sums[at[a:b] - lo]) * inverse[at[a:b] - lo]
    return Words(mix(hashes), bounds, at)


def shingles(found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` words in a row and each text's bounds; a text with fewer words gives all of them as one."""
    n = np.diff(found.bounds)
    counts = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    bounds = np.concatenate([[0], np.cumsum(counts)])
    start = np.repeat(found.bounds[:-1], counts) + np.arange(bounds[-1]) - np.repeat(bounds[:-1], counts)
    have = np.minimum(np.repeat(n, counts), size)
    padded = np.concatenate([found.hashes, np.zeros(size, np.uint64)])
    out = mix(have.astype(np.uint64))
    for j in range(size):
        out = out * BASE + np.where(j < have, padded[start + j], np.uint64(0))
    return mix(out), bounds


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """``batches`` cut so that each holds about SLICE_BYTES of text, and one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(sizes) // SLICE_BYTES)) + 1), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)
