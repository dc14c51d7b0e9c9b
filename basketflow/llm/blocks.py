"""Grouping hashed features through a shuffle of packed blocks.

A task that hashes texts makes millions of small (feature, document, place)
entries. Instead of one row each, it packs those of one bucket (a residue of
the feature hash) into a binary block; Spark shuffles the blocks by bucket and
the receiving task groups a bucket's entries with NumPy. A feature that many
documents of one task share is settled there: only the entries of its smallest
document go to the bucket, and the others pass as already shared. So a bucket
gets at most one document per task and feature, however common it is.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries that a task gathers before it packs them.
GATHER = 250_000
#: Entries in a block at most: an Arrow batch of blocks then stays small.
BLOB = 2048
#: Bytes of a key that travel: within a bucket, whose number is part of the
#: key, a chance agreement is rare enough for candidates; what must be exact
#: uses two keys or is compared afterwards.
KEY_BYTES = 6


def buckets_of(df: DataFrame) -> int:
    """One bucket per shuffle partition: that setting follows the input."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _runs(*sorted_keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal keys."""
    new = np.ones(len(sorted_keys[0]), dtype=bool)
    new[1:] = False
    for k in sorted_keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def groups(keys: list[np.ndarray], doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(smallest, largest) document of each entry's group of equal keys."""
    order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
    starts = _runs(*(k[order] for k in keys))
    size = np.diff(np.append(starts, len(doc)))
    d = doc[order]
    low, high = np.empty_like(doc), np.empty_like(doc)
    low[order] = np.repeat(np.minimum.reduceat(d, starts), size)
    high[order] = np.repeat(np.maximum.reduceat(d, starts), size)
    return low, high


def _repeated(key: np.ndarray) -> np.ndarray:
    """Places of the keys that occur more than once."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    same = key[1:] == key[:-1]
    many = np.zeros(len(order), dtype=bool)
    many[1:] |= same
    many[:-1] |= same
    return order[many]


class Packer:
    """Gathers entries (keys, doc, place) of one task and packs them."""

    schema = "bucket int, settled boolean, data binary"
    arrow = pa.schema([("bucket", pa.int32()), ("settled", pa.bool_()), ("data", pa.binary())])

    def __init__(self, buckets: int, n_keys: int, settled, named: bool = False):
        """``settled(doc, low, high)`` marks the entries whose answer is known
        from the groups inside the task. With ``named`` a settled entry's place
        is its (first) key, and another's is doubled, plus 1 if it asks for
        settled ones."""
        import zstandard

        self.buckets, self.n_keys, self.settled, self.named = buckets, n_keys, settled, named
        self.parts: list[tuple] = []
        self.n = self.turn = 0
        self.zip = zstandard.ZstdCompressor(level=1).compress

    def add(self, keys: list[np.ndarray], doc: np.ndarray, place: np.ndarray):
        """Take entries; yields a record batch when enough have come."""
        if len(doc):
            self.parts.append((*keys, doc, place))
            self.n += len(doc)
        if self.n >= GATHER:
            yield from self.flush()

    def flush(self):
        if not self.n:
            return
        cols = [np.concatenate(c) for c in zip(*self.parts)]
        self.parts, self.n = [], 0
        keys, doc, place = cols[:-2], cols[-2], cols[-1]
        low, high = groups(keys, doc)
        known = self.settled(doc, low, high)
        rows: list[tuple[int, bool, bytes]] = []
        some = np.flatnonzero(known)
        settled_doc, settled_place = doc[some], keys[0][some].view(np.int64) if self.named else place[some]
        # Spread over buckets by turns: these entries need no meeting.
        for lo in range(0, len(settled_doc), BLOB):
            part = slice(lo, lo + BLOB)
            self.turn += 1
            rows.append((int((int(keys[0][0]) ^ self.turn) % self.buckets), True,
                         self._pack([], settled_doc[part], settled_place[part])))
        if self.named:
            place = place * 2 + (low != high)
        ask = np.flatnonzero(doc == low)
        both = ask[low[ask] != high[ask]]
        if len(both):
            # A feature shared inside the task asks through one entry.
            order = both[np.argsort(keys[0][both], kind="stable")]
            extra = np.ones(len(order), dtype=bool)
            extra[_runs(*(k[order] for k in keys))] = False
            drop = np.zeros(len(doc), dtype=bool)
            drop[order[extra]] = True
            drop &= known
            ask = ask[~drop[ask]]
        bucket = (keys[0][ask] >> np.uint64(24)) % np.uint64(self.buckets)
        order = np.argsort(bucket, kind="stable")
        ask, bucket = ask[order], bucket[order]
        for lo, hi in _spans(_runs(bucket), len(ask)) if len(ask) else ():
            at = ask[lo:hi]
            rows.append((int(bucket[lo]), False, self._pack([k[at] for k in keys], doc[at], place[at])))
        for lo in range(0, len(rows), 256):
            part = rows[lo:lo + 256]
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*part), self.arrow)], schema=self.arrow)

    def _pack(self, keys: list[np.ndarray], doc: np.ndarray, place: np.ndarray) -> bytes:
        raw = b"".join(k.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES].tobytes() for k in keys)
        slow = self.zip(np.diff(doc, prepend=0).astype("<i8").tobytes() + np.diff(place, prepend=0).astype("<i8").tobytes())
        return struct.pack("<I", len(doc)) + raw + slow


def _spans(starts: np.ndarray, n: int):
    """(lo, hi) of the runs, cut into at most BLOB entries."""
    for lo, end in zip(starts.tolist(), [*starts[1:].tolist(), n]):
        for at in range(lo, end, BLOB):
            yield at, min(at + BLOB, end)


def unpack(data: bytes, n_keys: int) -> list[np.ndarray]:
    """[*keys, doc, place] of a packed block."""
    import zstandard

    n = struct.unpack_from("<I", data)[0]
    keys, at = [], 4
    for _ in range(n_keys):
        wide = np.zeros((n, 8), dtype=np.uint8)
        wide[:, :KEY_BYTES] = np.frombuffer(data, np.uint8, n * KEY_BYTES, at).reshape(n, KEY_BYTES)
        keys.append(wide.view("<u8")[:, 0])
        at += n * KEY_BYTES
    slow = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[at:], max_output_size=16 * n), "<i8")
    return [*keys, np.cumsum(slow[:n]), np.cumsum(slow[n:])]


def by_bucket(blocks: DataFrame, buckets: int, n_keys: int, reduce, schema: str) -> DataFrame:
    """Shuffle packed blocks by bucket and give ``reduce(keys, doc, place)`` a
    bucket's entries whose first key occurs more than once (and ``reduce(None, doc, place)`` settled ones); it yields
    record batches of ``schema``."""
    dealt = blocks.repartition(buckets, "bucket").sortWithinPartitions("bucket", "settled")

    def run(batches):
        now, held = None, []

        def done():
            if held:
                at = _repeated(np.concatenate([c[0] for c in held]))
                cols = [np.concatenate([c[i] for c in held])[at] for i in range(n_keys + 2)]
                held.clear()
                if len(at):
                    yield from reduce(cols[:n_keys], cols[-2], cols[-1])

        for batch in batches:
            for bucket, settled, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if settled:
                    yield from reduce(None, *unpack(data, 0))
                    continue
                if bucket != now:
                    yield from done()
                    now, held = bucket, []
                held.append(unpack(data, n_keys))
        yield from done()

    return dealt.mapInArrow(run, schema)


def places_blocks(doc: np.ndarray, place: np.ndarray, buckets: int):
    """Record batches (bucket, data) with the places of documents, packed by a
    residue of the document id."""
    import zstandard

    if not len(doc):
        return
    shrink = zstandard.ZstdCompressor(level=1).compress
    home = ((doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(buckets)
    order = np.lexsort((place, doc, home))
    doc, place, home = doc[order], place[order], home[order]
    rows = []
    for lo, hi in _spans(_runs(home), len(home)):
        d, p = np.diff(doc[lo:hi], prepend=0), np.diff(place[lo:hi], prepend=0)
        rows.append((int(home[lo]), struct.pack("<I", hi - lo) + shrink(d.astype("<i8").tobytes() + p.astype("<i8").tobytes())))
    yield pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())],
                          names=["bucket", "data"])


PLACES = "bucket int, data binary"


def gathered(places: DataFrame, buckets: int) -> DataFrame:
    """(doc_id, places): one row per document with its distinct places as
    packed 64-bit integers."""
    dealt = places.repartition(buckets, "bucket").sortWithinPartitions("bucket")

    def emit(held):
        doc, place = (np.concatenate(c) for c in zip(*held))
        order = np.lexsort((place, doc))
        doc, place = doc[order], place[order].astype("<i8")
        once = _runs(doc, place)
        doc, place = doc[once], place[once]
        starts = _runs(doc)
        for lo in range(0, len(starts), 2048):
            part = np.append(starts[lo:lo + 2048], starts[lo + 2048] if lo + 2048 < len(starts) else len(doc))
            offs = ((part - part[0]) * 8).astype(np.int32)
            data = place[part[0]:part[-1]].tobytes()
            yield pa.record_batch([pa.array(doc[part[:-1]], pa.int64()),
                                   pa.Array.from_buffers(pa.binary(), len(part) - 1, [None, pa.py_buffer(offs.tobytes()), pa.py_buffer(data)])],
                                  names=["doc_id", "places"])

    def run(batches):
        now, held = None, []
        for batch in batches:
            for bucket, data in zip(*(batch.column(i).to_pylist() for i in range(2))):
                if bucket != now and held:
                    yield from emit(held)
                    held = []
                now = bucket
                held.append(unpack(data, 0))
        if held:
            yield from emit(held)

    return dealt.mapInArrow(run, "doc_id long, places binary")


def by_spot(compare):
    """A mapInArrow function that gives ``compare`` the columns of whole groups
    of equal first column from a partition sorted by it."""
    def run(batches):
        held = None
        for batch in batches:
            rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)]
            if held is not None:
                rows = [np.concatenate(c) for c in zip(held, rows)]
            last = int(np.searchsorted(rows[0], rows[0][-1]))
            if last:
                yield from compare([c[:last] for c in rows])
            held = [c[last:] for c in rows]
        if held is not None:
            yield from compare(held)

    return run


def in_blocks(rows: DataFrame, place: list[str], member: str, limit: int) -> DataFrame:
    """``rows`` with ``spot``, ``block`` and ``cross``: groups by ``place`` of
    more than ``limit`` rows are cut into blocks by a hash of ``member``, and
    each row goes to the spots of its block with every block. In a cross spot
    only pairs of different blocks count."""
    crowded = rows.groupBy(*place).count().where(F.col("count") > limit) \
        .select(*place, F.ceil(F.col("count") / limit).cast("int").alias("_blocks"))
    cut = rows.join(crowded, place, "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1))) \
        .withColumn("block", F.pmod(F.xxhash64(member), "_blocks").cast("int")) \
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return cut.withColumn("spot", F.xxhash64(*place, F.least("block", "_other"), F.greatest("block", "_other"))) \
        .withColumn("cross", F.col("block") != F.col("_other")).drop("_blocks", "_other")


#: Bits of the table that thins rows out before a join.
WANTED_BITS = 1 << 24


def thinned(rows: DataFrame, wanted: DataFrame, key: str, bits: int = WANTED_BITS) -> DataFrame:
    """``rows`` without most of those whose ``key`` is none of ``wanted``'s,
    to be joined with ``wanted`` afterwards: none that the join needs goes.

    The keys' hashes fill a bit table that is broadcast: at most ``bits / 64``
    rows of two longs, whatever the data (4 MB by default). Far more than
    ``bits`` keys fill it up and thin out nothing. Rows without a key go."""
    at = F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(bits))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("_at") % 64).cast("int"))
    table = wanted.where(F.col(key).isNotNull()).select(at.alias("_at")) \
        .groupBy(F.shiftright("_at", 6).alias("_word")).agg(F.bit_or(one).alias("_bits"))
    tagged = rows.where(F.col(key).isNotNull()).withColumn("_word", F.shiftright(at, 6)).withColumn("_bit", (at % 64).cast("int"))
    return tagged.join(F.broadcast(table), "_word").where(F.getbit("_bits", F.col("_bit")) == 1) \
        .drop("_word", "_bits", "_bit")
