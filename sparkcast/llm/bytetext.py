"""Vectorised passes over the UTF-8 bytes of Arrow text columns: words, lines, shingles and their 64-bit hashes.

A hash is a polynomial over random byte values modulo 2**64 (A-Z count as a-z), scrambled afterwards. Any span's hash comes
from prefix sums, so a pass costs a few array operations a byte however many spans there are. Such polynomials are safe for
short spans only (strings of 1024 bytes that differ in a Thue-Morse pattern collide), so words of more than LONG_WORD bytes
are hashed by a digest of their bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from sparkcast.llm.common import mix64

#: Bytes of text handled at once; longer texts are handled alone.
SLICE_BYTES = (1 << 19) - 1
LONG_WORD = 64
#: White space is space and the control characters 9 to 13.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
_LETTERS = np.random.default_rng(7).integers(1, 2**63, (3, 256), dtype=np.uint64)
_LETTERS[:2, 65:91] = _LETTERS[:2, 97:123]
_PLACES = np.random.default_rng(11).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def _powers(which: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    p = _MULTIPLIERS[which]
    out = []
    for base in (p, pow(p, -1, 1 << 64)):
        v = np.full(size, base, np.uint64)
        v[0] = 1
        out.append(np.cumprod(v, dtype=np.uint64))
    return out[0], out[1]


_usual_powers = lru_cache(3)(lambda which: _powers(which, SLICE_BYTES + 1))  # 24 MB together


def text_slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Yields (first row, bytes, offsets) for runs of rows of about SLICE_BYTES; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + SLICE_BYTES, "right")) - 1)
        yield lo, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """Hashes of data[start:end]; `which` picks one of three independent hashes, of which 2 tells A-Z from a-z."""
    power, inverse = _usual_powers(which) if len(data) <= SLICE_BYTES else _powers(which, len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTERS[which][data] * power[: len(data)], out=total[1:])
    h = (total[ends] - total[starts]) * inverse[starts]
    return mix64(h + (ends - starts).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and document numbers of all words; words never cross documents."""
    inside = ~SPACE[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    return starts, np.flatnonzero(inside & ~after) + 1, np.searchsorted(offsets, starts, "right") - 1


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all word shingles in order, with each document's bounds in them. Fewer words than `size` make one shingle."""
    starts, ends, doc = word_spans(data, offsets)
    word = span_hashes(data, starts, ends)
    for k in np.flatnonzero(ends - starts > LONG_WORD):
        digest = hashlib.blake2b(data[starts[k] : ends[k]].tobytes().lower(), digest_size=8).digest()
        word[k] = np.frombuffer(digest, np.uint64)[0]
    n_docs, n = len(offsets) - 1, len(word)
    words = np.bincount(doc, minlength=n_docs)
    first = np.concatenate([[0], np.cumsum(words)])
    count = np.where(words >= size, words - size + 1, np.minimum(words, 1))
    bounds = np.concatenate([[0], np.cumsum(count)])
    out = np.zeros(bounds[-1], np.uint64)
    if n >= size:
        g = np.zeros(n - size + 1, np.uint64)
        for j in range(size):
            g += word[j : n - size + 1 + j] * _PLACES[j]
        full = np.flatnonzero(doc[: n - size + 1] == doc[size - 1 :])
        out[bounds[doc[full]] + full - first[doc[full]]] = mix64(g[full])
    for d in np.flatnonzero((words > 0) & (words < size)):
        w = word[first[d] : first[d + 1]]
        out[bounds[d]] = mix64(np.array([(w * _PLACES[8 : 8 + len(w)]).sum(dtype=np.uint64) + np.uint64(len(w))]))[0]
    return out, bounds


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Starts, ends and documents of all lines (split at \\n), and each line's bounds without white space at its ends."""
    n_docs = len(offsets) - 1
    breaks = np.flatnonzero(data == 10)
    at, every = np.searchsorted(offsets, breaks, "right") - 1, np.arange(n_docs)
    doc = np.concatenate([every, at])
    starts, ends = np.concatenate([offsets[:-1], breaks + 1]), np.concatenate([offsets[1:], breaks])
    first, last = np.lexsort((starts, doc)), np.lexsort((ends, doc))
    doc, starts, ends = doc[first], starts[first], ends[last]
    full = np.flatnonzero(~SPACE[data])
    a, b = np.searchsorted(full, starts, "left"), np.searchsorted(full, ends, "left")
    some = a < b
    key_starts, key_ends = starts.copy(), starts.copy()
    key_starts[some], key_ends[some] = full[a[some]], full[b[some] - 1] + 1
    return starts, ends, doc, key_starts, key_ends
