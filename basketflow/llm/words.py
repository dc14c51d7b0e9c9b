"""Vectorised word hashing over Arrow string columns.

A batch of texts is handled as one byte buffer: words are the maximal runs of
bytes other than ``20 09-0D``, and each gets a 64-bit hash (a polynomial over
its bytes, then a mixing step). No Python object is made per word.
"""

from __future__ import annotations

import os
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_rng = np.random.Generator(np.random.PCG64(20240601))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_GRAM = np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers = np.ones(1, dtype=np.uint64)

#: Bytes of text that one vectorised step works on.
SLICE_BYTES = 512 << 10


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(n: int) -> np.ndarray:
    """The first n powers of the hash base, modulo 2**64."""
    global _powers
    if len(_powers) < n:
        p = np.full(max(n, 256), _BASE, dtype=np.uint64)
        p[0] = 1
        _powers = np.multiply.accumulate(p)
    return _powers[:n]


def ready(spark: SparkSession, rows: int = 1024) -> None:
    """Prepare a session for Python functions over texts: Arrow batches hold
    at most ``rows`` rows, so a run of long texts does not fill a worker (the
    setting is only ever lowered), and workers look for this package where the
    driver has it. Where executors have other disks, ship it with --py-files.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if ``df`` has such a column already."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def word_count(text: Column) -> Column:
    """Number of words of a text, in the JVM (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8)[offs[0]:offs[-1]] if data is not None and len(data) else np.zeros(0, np.uint8)
    return raw, offs - offs[0]


def slices(offs: np.ndarray, limit: int = SLICE_BYTES):
    """Row ranges (lo, hi) of about ``limit`` bytes each; a longer text is
    alone in its range."""
    n, lo = len(offs) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


class Words:
    """The words of some texts: ``start``/``end`` byte positions, ``hash``,
    ``count`` per text and ``first`` (index of a text's first word, with the
    total at the end)."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, lower: bool = False):
        self.data = data = _LOWER[data] if lower else data
        n_docs = len(offs) - 1
        space = np.ones(len(data) + 1, dtype=bool)
        space[:-1] = _SPACE[data]
        cut = np.zeros(len(data) + 1, dtype=bool)
        cut[offs] = True
        before = np.ones(len(data) + 1, dtype=bool)
        before[1:] = space[:-1]
        begins = ~space & (before | cut)
        self.start = np.flatnonzero(begins)
        ends = ~before & (space | cut)
        ends[0] = False
        self.end = np.flatnonzero(ends)
        self.first = np.searchsorted(self.start, offs).astype(np.int64)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(n_docs), self.count)
        self.hash = self._hashes(~space[:-1])

    def _hashes(self, inside: np.ndarray) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, dtype=np.uint64)
        size = self.end - self.start
        where = np.flatnonzero(inside)
        at = where - np.repeat(self.start, size)
        part = _BYTE[self.data[where]] * powers(int(size.max()))[at]
        edge = np.zeros(len(size), dtype=np.int64)
        np.cumsum(size[:-1], out=edge[1:])
        return mix(np.add.reduceat(part, edge) + size.astype(np.uint64) * _GRAM)

    def grams(self, k: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, word index) of every run of k words inside one text."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        g = np.full(n, np.uint64(seed + k), dtype=np.uint64)
        for j in range(k):
            g = g * _GRAM + self.hash[j:j + n]
        at = np.flatnonzero(self.doc[:n] == self.doc[k - 1:])
        return mix(g[at]), at
