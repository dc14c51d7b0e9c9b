"""Periodic runs inside documents, by seed and extend on diagonals.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) of at least ``max(min_words, 2q)`` words that no neighbouring
word extends. Two words q apart lie on *diagonal* (lag) q; a run of period q
is a maximal match on it, at least ``max(min_words - q, q)`` words long.

1. **Index.** Lags fall into bands: those below ``2k`` with
   ``k = ceil(min_words / 2)``, then ``[2k, 4k)`` and so on. Every run with a
   lag in a band ``[K, 2K)`` matches for K words at least, so the K-grams of a
   document are that band's index. K-gram ids are exact: a gram of twice the
   length is a pair of ids, and only grams that recur in their document stay.
2. **Pairs.** Two places of one K-gram whose distance lies in the band are a
   seed. Where a K-gram recurs within K/2 words the text there repeats with
   that distance p; if both places of a pair have such a predecessor, the pair
   p words before lies on the same diagonal and in the same match. So only
   pairs with a *fresh* place (no such predecessor) are made: at most a few per
   place, however often a word is repeated.
3. **Extension.** Seeds are taken lag by lag from left to right. One below its
   lag's furthest-covered mark is suppressed: the words before both its places
   are then equal, and the match that reaches it was extended from its own
   first seed. The others are extended to the right over the ids of doubling
   grams, so an extension of n words takes log n steps.

All documents of a slice of a batch are worked on together in NumPy.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.words import Words, mix, ready, slices, text_buffers

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _grams(a: np.ndarray, b: np.ndarray, off: int) -> np.ndarray:
    """Ids of the grams made of the gram at i (``a``) and the one at i + off
    (``b``); -1 where the gram does not recur."""
    out = np.full(len(a), -1, dtype=np.int64)
    if off >= len(a):
        return out
    at = np.flatnonzero((a[:len(a) - off] >= 0) & (b[off:] >= 0))
    if len(at):
        _, same, n = np.unique(a[at] * np.int64(len(a) + 1) + b[at + off], return_inverse=True, return_counts=True)
        again = n[same] > 1
        out[at[again]] = same[again]
    return out


def _seeds(ids: np.ndarray, k: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of equal k-grams with low <= j - i < high, at least one
    of them fresh."""
    at = np.flatnonzero(ids >= 0)
    at = at[np.argsort(ids[at], kind="stable")]
    of = ids[at]
    fresh = np.ones(len(at), dtype=bool)
    fresh[1:] = (of[1:] != of[:-1]) | (at[1:] - at[:-1] > k // 2)
    key = of * np.int64(len(ids) + high) + at
    f = np.flatnonzero(fresh)

    def within(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = np.searchsorted(key, lo), np.searchsorted(key, hi)
        n = hi - lo
        other = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        return at[np.repeat(f, n)], at[other]

    after = within(key[f] + low, key[f] + high)
    before = within(key[f] - high + 1, key[f] - low + 1)
    return np.concatenate([after[0], before[1]]), np.concatenate([after[1], before[0]])


def find_runs(words: np.ndarray, doc: np.ndarray, min_words: int = 12):
    """(start, length, period) of the runs, ``start`` an index into ``words``
    (hashes), ordered by start and period. ``doc`` numbers the document of
    each word; no run crosses documents."""
    n, k = len(words), max(1, -(-min_words // 2))
    none = np.zeros(0, dtype=np.int64)
    if not n:
        return none, none, none
    _, one, times = np.unique(mix(words + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)),
                              return_inverse=True, return_counts=True)
    one = np.where(times[one] > 1, one, -1).astype(np.int64)
    steps = [(1, one)]
    while 2 * steps[-1][0] <= k:
        size, ids = steps[-1]
        steps.append((2 * size, _grams(ids, ids, size)))
    size, ids = steps[-1]
    grams, low = (k, ids if size == k else _grams(ids, ids, k - size)), 1
    if size != k:
        steps.append(grams)
    starts, lags = [], []
    while (grams[1] >= 0).any():
        size, ids = grams
        i, j = _seeds(ids, size, low, 2 * size)
        covered = (i > 0) & (one[i - 1] >= 0) & (one[i - 1] == one[j - 1])
        starts.append(i[~covered])
        lags.append((j - i)[~covered])
        low, grams = 2 * size, (2 * size, _grams(ids, ids, size))
        steps.append(grams)
    if not starts:
        return none, none, none
    start, lag = np.concatenate(starts), np.concatenate(lags)
    reach = start.copy()
    for size, ids in reversed(steps):
        here = np.full(len(reach), False)
        ok = np.flatnonzero(reach + lag + size <= n)
        here[ok] = (ids[reach[ok]] >= 0) & (ids[reach[ok]] == ids[reach[ok] + lag[ok]])
        reach += size * here
    end = reach + lag
    good = end - start >= np.maximum(min_words, 2 * lag)
    start, end, lag = start[good], end[good], lag[good]
    # A match at a multiple of a run's period spans the same words: keep the
    # smallest lag of each stretch.
    by = np.lexsort((lag, end, start))
    start, end, lag = start[by], end[by], lag[by]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, lag = start[new], end[new], lag[new]
    by = np.lexsort((lag, start))
    return start[by], (end - start)[by], lag[by]


def _collapse(texts: pa.Array, min_words: int) -> pa.Array:
    data, offs = text_buffers(texts)
    counts, parts, n_runs, kept = [], [], [], []
    for lo, hi in slices(offs):
        first = offs[lo:hi + 1] - offs[lo]
        raw = data[offs[lo]:offs[hi]]
        w = Words(raw, first)
        start, length, period = find_runs(w.hash, w.doc, min_words)
        at = w.doc[start]
        counts.append(w.count)
        n_runs.append(np.bincount(at, minlength=hi - lo))
        parts.append((start - w.first[at], length, period))
        # Words after their run's first period go: +1 and -1 at its ends.
        step = np.zeros(len(w.hash) + 1, dtype=np.int64)
        np.add.at(step, start + period, 1)
        np.add.at(step, start + length, -1)
        stay = np.cumsum(step)[:-1] == 0
        for d in range(hi - lo):
            own = raw[first[d]:first[d + 1]].tobytes().split()
            if n_runs[-1][d]:
                own = [x for x, s in zip(own, stay[w.first[d]:w.first[d + 1]]) if s]
            kept.append(b" ".join(own))
    runs = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 3
    edge = np.zeros(len(kept) + 1, dtype=np.int32)
    if n_runs:
        edge[1:] = np.cumsum(np.concatenate(n_runs))
    lists = pa.ListArray.from_arrays(pa.array(edge), pa.StructArray.from_arrays(
        [pa.array(c.astype(np.int64)) for c in runs], names=["start", "length", "period"]))
    n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    return pa.StructArray.from_arrays(
        [pa.array(n.astype(np.int64)), lists, pa.array(kept, pa.binary()).cast(pa.string())],
        names=["n_words", "runs", "kept"])


def collapse_runs(docs: DataFrame, min_words: int = 12, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (array of start, length and period,
    ordered by start and period; places are word numbers from 0) and ``kept``
    (the words that are in no run after its first period, joined by a blank).

    Words are ``[^\\x20\\x09-\\x0D]+``. Rows are independent: nothing is
    shuffled, equal rows get equal results, and a text of any length is worked
    on whole. A null or empty text has no words, no runs and an empty ``kept``;
    an empty table gives an empty one. Columns of ``docs`` that have one of
    these names are replaced; all others, ``text_col`` too, stay as they are.
    """
    if min_words < 2:
        raise ValueError("min_words must be at least 2")
    ready(docs.sparkSession)
    find = F.arrow_udf(lambda texts: _collapse(texts, min_words), f"n_words bigint, runs {RUNS}, kept string")
    names = {"n_words", "runs", "kept"}
    own = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in names]
    return docs.select(*own, find(F.col(text_col)).alias("_run")).select(*own, "_run.*")
