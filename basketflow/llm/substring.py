"""Exact substring deduplication by seed and extend.

Seeds: every run of ``min_words`` words holds one winnowed anchor, the
smallest hash among its ``k``-word grams, so equal runs have equal anchors at
equal offsets. Documents are joined on anchors; only anchors that occur in
more than one document go on. Extension: a shared anchor is extended to both
sides in every way that makes a run of ``min_words`` words around it, and runs
that agree are matches; matched runs that overlap grow together into maximal
repeats. No pairs of documents are formed, so a passage in a million documents
costs a million entries.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.blocks import PLACES, Packer, buckets_of, by_bucket, gathered, places_blocks
from basketflow.llm.words import Words, mix, slices, ready, text_buffers

#: Words in an anchor gram.
K = 5


def anchors(words: Words, t: int, k: int) -> np.ndarray:
    """For each word that starts a run of t words inside one text, the word at
    which the run's anchor starts; -1 for the others."""
    n = len(words.hash)
    out = np.full(n, -1, dtype=np.int64)
    m = n - t + 1
    if m <= 0:
        return out
    g = np.full(n - k + 1, np.uint64(k), dtype=np.uint64)
    for j in range(k):
        g = g * np.uint64(0xD6E8FEB86659FD93) + words.hash[j:j + len(g)]
    g = mix(g)
    best, at = g[:m].copy(), np.zeros(m, dtype=np.int64)
    for j in range(1, t - k + 1):
        less = g[j:j + m] < best
        best[less] = g[j:j + m][less]
        at[less] = j
    whole = words.doc[:m] == words.doc[t - 1:]
    out[:m][whole] = (np.arange(m) + at)[whole]
    return out


def _run_keys(words: Words, start: np.ndarray, t: int) -> list[np.ndarray]:
    """Two 64-bit hashes of the runs of t words at ``start``."""
    keys = []
    for base in (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)):
        g = np.full(len(start), np.uint64(t), dtype=np.uint64)
        for j in range(t):
            g = g * base + words.hash[start + j]
        keys.append(mix(g))
    return keys


def _texts(batch, *columns: int):
    """(Words, rows lo:hi) of a batch's slices of texts."""
    data, offs = text_buffers(batch.column(columns[0]))
    for lo, hi in slices(offs):
        yield Words(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]), lo, hi


def _place(check: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A word's place with its text's check number, should an id repeat."""
    return (check.astype(np.int64) << 32) | at


def _seeds(docs: DataFrame, t: int, k: int, buckets: int) -> DataFrame:
    """(doc_id, places) of the anchors that two or more documents hold."""
    def hash_anchors(batches):
        packer = Packer(buckets, 1, lambda doc, low, high: low != high)
        for batch in batches:
            ids, check = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            for w, lo, hi in _texts(batch, 1):
                found = np.unique(anchors(w, t, k))
                found = found[found >= 0]
                g = np.full(len(found), np.uint64(k), dtype=np.uint64)
                for j in range(k):
                    g = g * np.uint64(0xD6E8FEB86659FD93) + w.hash[found + j]
                d = w.doc[found]
                yield from packer.add([mix(g)], ids[lo:hi][d], _place(check[lo:hi][d], found - w.first[d]))
        yield from packer.flush()

    def shared(keys, doc, place):
        if keys is not None:
            from basketflow.llm.blocks import groups

            low, high = groups(keys, doc)
            doc, place = doc[low != high], place[low != high]
        yield from places_blocks(doc, place, buckets)

    blocks = docs.mapInArrow(hash_anchors, Packer.schema)
    return by_bucket(blocks, buckets, 1, shared, PLACES)


def _matches(seeded: DataFrame, t: int, k: int, buckets: int) -> DataFrame:
    """(doc_id, places) of the runs, around seeds, that also stand in a
    document with a smaller id."""
    def hash_runs(batches):
        packer = Packer(buckets, 2, lambda doc, low, high: doc > low)
        for batch in batches:
            ids, check, places = batch.column(0).to_numpy(), batch.column(2).to_numpy(), batch.column(3).to_pylist()
            for w, lo, hi in _texts(batch, 1):
                seed = np.zeros(len(w.hash) + 1, dtype=bool)
                for i in range(lo, hi):
                    seed[_own(places[i], check[i]) + w.first[i - lo]] = True
                seed[-1] = False
                start = np.flatnonzero(seed[anchors(w, t, k)])
                d = w.doc[start]
                yield from packer.add(_run_keys(w, start, t), ids[lo:hi][d], _place(check[lo:hi][d], start - w.first[d]))
        yield from packer.flush()

    def later(keys, doc, place):
        if keys is not None:
            from basketflow.llm.blocks import groups

            low, _ = groups(keys, doc)
            doc, place = doc[doc > low], place[doc > low]
        yield from places_blocks(doc, place, buckets)

    blocks = seeded.mapInArrow(hash_runs, Packer.schema)
    return by_bucket(blocks, buckets, 2, later, PLACES)


def _own(places: bytes | None, check: int) -> np.ndarray:
    """The word indexes among packed places that belong to this text."""
    p = np.frombuffer(places or b"", "<i8")
    return p[(p >> 32) == int(check)] & 0xFFFFFFFF


def remove_repeats(docs: DataFrame, min_words: int = 13, k: int = K, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Cut from every text the words that repeat a document with a smaller id.

    A repeat is a run of at least ``min_words`` words (split at ASCII white
    space) that also stands in a document with a smaller id; all runs are
    judged on the input. Returns per row ``(id_col, n_words, n_removed, spans
    array<struct<start, end>>, kept)``: the maximal repeated spans in words
    and the kept words joined by single spaces.

    Ids are integers. A row without an id is compared with nothing and kept; a
    null text is empty; rows that repeat an id are cut each by itself, never
    against each other; texts below ``min_words`` words are kept; an empty
    table gives an empty result; other columns are ignored.
    """
    if not 1 <= k <= min_words:
        raise ValueError("an anchor gram must fit into the shortest repeat")
    ready(docs.sparkSession)
    buckets = buckets_of(docs)
    # No renaming where none is needed: then both joins read one exchange.
    doc_id = F.col(id_col) if id_col == "doc_id" and docs.schema[id_col].dataType.typeName() == "long" \
        else F.col(id_col).cast("long").alias("doc_id")
    text = F.col(text_col) if text_col == "text" else F.col(text_col).alias("text")
    rows = docs.select(doc_id, text, F.xxhash64(text_col).bitwiseAND(0x7FFFFFFF).alias("check"))
    named = rows.where("doc_id is not null")
    seeds = gathered(_seeds(named, min_words, k, buckets), buckets)
    seeded = named.join(seeds, "doc_id")
    hits = gathered(_matches(seeded, min_words, k, buckets), buckets)
    both = named.join(hits, "doc_id", "left") \
        .union(rows.where("doc_id is null").withColumn("places", F.lit(None).cast("binary")))
    schema = "doc_id long, n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept string"
    return both.mapInArrow(_cutter(min_words), schema).withColumnRenamed("doc_id", id_col)


def _cutter(t: int):
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        from itertools import compress

        for batch in batches:
            n_words, n_removed, spans, kept = [], [], [], []
            for text, check, places in zip(batch.column(1), batch.column(2), batch.column(3)):
                words = (text.as_buffer().to_pybytes() if text.is_valid else b"").split()
                start = _own(places.as_py(), check.as_py())
                found = []
                if len(start):
                    step = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(step, start, 1)
                    np.add.at(step, start + t, -1)
                    gone = np.cumsum(step)[:-1] > 0
                    edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
                    found = [{"start": a, "end": b} for a, b in edge.reshape(-1, 2).tolist()]
                    rest = list(compress(words, (~gone).tolist()))
                else:
                    rest = words
                n_words.append(len(words))
                n_removed.append(len(words) - len(rest))
                spans.append(found)
                kept.append(b" ".join(rest).decode())
            yield pa.record_batch([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                                   pa.array(spans, span), pa.array(kept, pa.string())],
                                  names=["doc_id", "n_words", "n_removed", "spans", "kept"])

    return run
