"""Word shingles of whole texts as 64-bit hashes, a batch at a time.

Words: `[^\\x20\\x09-\\x0D]+` after A-Z are lower-cased. A text with fewer than `width` words has its whole word sequence as
one shingle; one without words has none; null counts as empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from .shared import level

WIDTH = 5
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(33))) * _M2
    return x ^ (x >> np.uint64(33))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash for every word and the texts' bounds among them."""
    low = pc.ascii_lower(pc.fill_null(level(texts).cast(pa.large_string()), ""))
    parts = pc.ascii_split_whitespace(low)
    flat = parts.flatten()
    off = parts.offsets.to_numpy().astype(np.int64)
    coded = flat.dictionary_encode()
    words = coded.dictionary
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words.cast(pa.large_binary()).to_pylist()), dtype=np.uint64, count=len(words))
    which = coded.indices.to_numpy(zero_copy_only=False)
    full = pc.not_equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)[which] if len(which) else np.zeros(0, bool)
    kept = np.concatenate([[0], np.cumsum(full)])
    return h[which[full]] if len(which) else np.zeros(0, np.uint64), kept[off]


def shingle_hashes(texts: pa.Array, width: int = WIDTH) -> list[np.ndarray]:
    """For each text, its distinct shingles' hashes in ascending order."""
    h, off = word_hashes(texts)
    n = np.diff(off)
    long = n >= width
    rolled = np.full(len(h), np.uint64(width))
    if len(h) >= width:
        m = len(h) - width + 1
        x = rolled[:m]
        for k in range(width):
            x = _mix(x ^ h[k : k + m]) + np.uint64(k + 1)
        rolled[:m] = x
    out = []
    for i, j, full in zip(off[:-1].tolist(), off[1:].tolist(), long.tolist()):
        if full:
            s = np.sort(rolled[i : j - width + 1])
            out.append(s[np.r_[True, s[1:] != s[:-1]]])
        elif j > i:
            x = np.array([j - i], dtype=np.uint64)
            for k in range(i, j):
                x = _mix(x ^ h[k : k + 1]) + np.uint64(k - i + 1)
            out.append(x)
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out
