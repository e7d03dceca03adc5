"""Periodic runs of words: all maximal stretches that repeat themselves, found by block convolutions at dyadic scales.

At scale L a text is cut into blocks of L words. A run with a period q from 2 L - 1 to 4 L - 2 that is at least twice as long
as q holds a whole block together with its copy q words later. So each block is looked for in the window of these distances:
with words as numbers, the sum of squared differences between the block and the window at a distance is zero if they agree.
These sums come from one convolution, computed as a number-theoretic transform modulo the prime 65537, exactly and for many
blocks at once. Zeros are seeds: (place of the block, distance). A seed is compared word by word and extended to both sides as
far as words q apart are equal, which gives a run, if q is its smallest period.

What can't match is left out before: a block with a word that doesn't return within the window's distances. What is known
already is left out after: seeds inside a run whose period divides their distance, which would give that run again.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A Fermat prime, for which 2**16 is -1, a generator of its 2**16 units, and the longest transform.
PRIME, GENERATOR, LONGEST = 65537, 3, 1 << 16
#: Least number of words in a run.
LEAST = 12
#: Words of texts handled at once (a longer text is handled alone); elements of a stack of transforms.
WORDS_AT_ONCE, STACK = 1 << 18, 1 << 19


@lru_cache(1)
def _units() -> np.ndarray:
    """The powers of the generator in order."""
    out = np.ones(LONGEST, np.int64)
    for k in range(16):  # doubles what is there
        out[1 << k : 2 << k] = out[: 1 << k] * pow(GENERATOR, 1 << k, PRIME) % PRIME
    return out


def _reduced(x: np.ndarray) -> np.ndarray:
    """A smaller number of the same remainder: 2**16 is -1."""
    return (x & 0xFFFF) - (x >> 16)


def transform(x: np.ndarray) -> np.ndarray:
    """Forward transforms of the columns of x (a power of two of rows), rows in bit-reversed order; numbers stay below 2**35."""
    n = len(x)
    half = n // 2
    while half:
        y = x.reshape(n // (2 * half), 2, half, -1)
        turn = _units()[:: LONGEST // (2 * half)][:half, None]
        x = np.stack([y[:, 0] + y[:, 1], _reduced((y[:, 0] - y[:, 1]) * turn)], axis=1)
        half //= 2
    return x.reshape(n, -1)


def inverse(x: np.ndarray) -> np.ndarray:
    """Undoes `transform`, up to a factor of the number of rows."""
    n, half = len(x), 1
    while half < n:
        y = x.reshape(n // (2 * half), 2, half, -1)
        turn = _units()[-np.arange(half) * (LONGEST // (2 * half))][:, None]
        v = _reduced(y[:, 1] * turn)
        x = np.stack([y[:, 0] + v, y[:, 0] - v], axis=1)
        half *= 2
    return x.reshape(n, -1)


def correlate(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """For columns of blocks and windows (numbers below the prime) the sums over j of blocks[j] * windows[i + j], modulo the
    prime, for every i at which a block fits its window."""
    size, width = len(blocks), len(windows)
    n = 1 << (width - 1).bit_length()
    a, b = np.zeros((n, blocks.shape[1]), np.int64), np.zeros((n, blocks.shape[1]), np.int64)
    a[-np.arange(size)] = blocks
    b[:width] = windows
    both = _reduced(_reduced(transform(a))) * _reduced(_reduced(transform(b)))
    return inverse(_reduced(both))[: width - size + 1] % PRIME * pow(n, -1, PRIME) % PRIME


def zeros(values: np.ndarray, squares: np.ndarray, at: np.ndarray, size: int, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) where the block of `size` values at a place has no squared difference to what lies `first` to `last`
    further on; squares are running sums of squared values. What goes beyond the end is the caller's to drop."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    reach = min(last - first + 1, LONGEST - size + 1)
    stack = max(1, STACK // (1 << (size + reach - 2).bit_length()))
    for lo in range(0, len(at), stack):
        s = at[lo : lo + stack]
        blocks = values[s + np.arange(size)[:, None]]
        own = squares[s + size] - squares[s]
        for q in range(first, last + 1, reach):
            distances = np.arange(q, min(last, q + reach - 1) + 1)[:, None]
            windows = values[np.minimum(s + q + np.arange(size + len(distances) - 1)[:, None], len(values) - 1)]
            there = np.minimum(s + distances, len(values) - size)
            sums = own + squares[there + size] - squares[there] - 2 * correlate(blocks, windows)
            d, k = np.nonzero(sums % PRIME == 0)
            found.append((s[k], d + q))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2


@lru_cache(1 << 16)
def _prime_factors(q: int) -> tuple[int, ...]:
    out, r = [], 2
    while r * r <= q:
        if q % r == 0:
            out.append(r)
            while q % r == 0:
                q //= r
        r += 1
    return (*out, q) if q > 1 else tuple(out)


def _stretch(ids: np.ndarray, at: int, size: int, q: int, lo: int, hi: int) -> tuple[int, int] | None:
    """The longest stretch [a, b) around the block at `at` where ids q apart are equal, within [lo, hi); None if not even the
    block's are."""
    if not np.array_equal(ids[at : at + size], ids[at + q : at + q + size]):
        return None
    a, b, step = at, at + size, 64
    while b < hi - q:
        end = min(b + step, hi - q)
        differ = np.flatnonzero(ids[b:end] != ids[b + q : end + q])
        if len(differ):
            b += int(differ[0])
            break
        b, step = end, 2 * step
    step = 64
    while a > lo:
        start = max(lo, a - step)
        differ = np.flatnonzero(ids[start:a] != ids[start + q : a + q])
        if len(differ):
            a = start + int(differ[-1]) + 1
            break
        a, step = start, 2 * step
    return a, b


def _returns(ids: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word how far on it comes next and last in its text; 0 if it doesn't."""
    key = text * (int(ids.max()) + 1) + ids
    order = np.argsort(key, kind="stable")
    ends = np.flatnonzero(np.append(np.diff(key[order]) != 0, True))
    following, final = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
    following[order[:-1]] = order[1:] - order[:-1]
    following[order[ends]] = 0
    final[order] = np.repeat(order[ends], np.diff(ends, prepend=-1)) - order
    return following, final


def find_runs(ids: np.ndarray, bounds: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) by start, then period, of the texts ids[bounds[k] : bounds[k + 1]]."""
    runs: list[list[tuple[int, int, int]]] = [[] for _ in bounds[1:]]
    sizes = np.diff(bounds)
    if not len(ids):
        return runs
    text = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(ids)) - bounds[:-1][text]
    left = bounds[1:][text] - np.arange(len(ids))
    following, final = _returns(ids, text)
    values = (ids + 1) * 40503 % PRIME
    squares = np.concatenate([[0], np.cumsum(values * values)])
    cover_end, cover_period = np.zeros(len(ids), np.int64), np.ones(len(ids), np.int64)
    scale = 2
    while True:
        first, last = (1 if scale == 2 else 2 * scale - 1), 4 * scale - 2
        if sizes.max() < max(LEAST, 2 * first):
            break
        size = min(scale, LONGEST // 4)
        fits = (following > 0) & (following <= last) & (final >= first)
        so_far = np.concatenate([[0], np.cumsum(fits)])
        at = np.flatnonzero((place % scale == 0) & (left >= first + size) & fits)
        at = at[so_far[at + size] - so_far[at] == size]
        s, q = zeros(values, squares, at, size, first, min(last, int(sizes.max()) // 2))
        new = (left[s] >= q + size) & ~((cover_end[s] >= s + q) & (q % cover_period[s] == 0) & (cover_period[s] < q))
        s, q = s[new], q[new]
        order = np.lexsort((s, q, text[s]))
        s, q = s[order], q[order]
        edges = np.flatnonzero((np.diff(q) != 0) | (np.diff(text[s]) != 0)) + 1
        for lo, hi in zip([0, *edges], [*edges, len(s)], strict=True):
            if lo == hi:
                break
            d, period = int(text[s[lo]]), int(q[lo])
            while lo < hi:
                found = _stretch(ids, int(s[lo]), size, period, int(bounds[d]), int(bounds[d + 1]))
                if found is None:
                    lo += 1
                    continue
                a, b = found
                lo += int(np.searchsorted(s[lo:hi], b))
                length = b + period - a
                divisors = (period // r for r in _prime_factors(period))
                if length >= max(LEAST, 2 * period) and not any(np.array_equal(ids[a : a + period - p], ids[a + p : a + period]) for p in divisors):
                    runs[d].append((a - int(bounds[d]), length, period))
                    own = slice(a, a + length)
                    longer = cover_end[own] < a + length
                    cover_period[own][longer] = period
                    cover_end[own][longer] = a + length
        scale *= 2
    return [sorted(r, key=lambda x: (x[0], x[2])) for r in runs]


_RUN = pa.struct([(k, pa.int64()) for k in ("start", "length", "period")])


def _texts(column: pa.Array) -> Iterator[list[list[bytes]]]:
    """The words of texts, some texts at a time."""
    out, n = [], 0
    for t in column:
        words = (t.as_py() or "").encode().split()  # of bytes: white space as in \x20\x09-\x0D
        if out and n + len(words) > WORDS_AT_ONCE:
            yield out
            out, n = [], 0
        out.append(words)
        n += len(words)
    if out:
        yield out


def _runs_of_batches(batches):
    for batch in batches:
        lo = 0
        for texts in _texts(batch.column(1)):
            known: dict[bytes, int] = {}
            ids = np.array([known.setdefault(w, len(known)) for words in texts for w in words], np.int64)
            found = find_runs(ids, np.cumsum([0, *map(len, texts)]))
            collapsed = []
            for words, runs in zip(texts, found, strict=True):
                if runs:
                    kept = np.ones(len(words), bool)
                    for start, length, period in runs:
                        kept[start + period : start + length] = False
                    words = [words[k] for k in np.flatnonzero(kept)]
                collapsed.append(b" ".join(words).decode())
            rows = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs] for runs in found]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(texts)), pa.array(map(len, texts), pa.int64()), pa.array(rows, pa.list_(_RUN)), pa.array(collapsed, pa.string())], ["doc_id", "n_words", "runs", "collapsed"])
            lo += len(texts)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Returns (doc_id, n_words, runs, collapsed), one row for each row of docs, whatever its id.

    runs holds (start, length, period), ordered by start, then period: every stretch of consecutive words of the whole text
    (words between ASCII white space, numbered from 0, compared as they are) with smallest period q and at least max(12, 2 q)
    words that no neighbouring word extends keeping that period. collapsed has the words joined by one space, without those
    that some run contains after its first q words. Null and empty texts have no words and no runs. Texts may be of any
    length; a text is handled whole, in memory in proportion to it. Rows that repeat an id are rows of their own. Extra columns
    are ignored; an empty table gives an empty result. Nothing is shuffled.
    """
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return given.mapInArrow(_runs_of_batches, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
