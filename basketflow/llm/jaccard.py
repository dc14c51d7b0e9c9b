"""Set-similarity join on word shingles with PartEnum signatures.

A document is the set of its distinct word shingles. Two sets with Jaccard
similarity of at least g differ in at most k = (1-g)/(1+g) * (sum of sizes)
shingles. Sizes fall into bands; a set signs for its own band and, if a
similar set could be in the next one, for that too. Within a band of largest
size r, the shingle domain is hashed into n1 = floor(k/2) + 1 + s parts, so at
least s + 1 parts hold at most one difference each; every part is hashed into
three again, and the three subsets of two are its signatures: similar sets
share one in each of those parts, whatever their common shingles are. A
signature over an empty projection says nothing and is not given. The slack s
makes up for a set's first s parts with empty projections; a set with more
signs again under another hash of the domain (so would a similar one, if none
but empty projections agreed), and on the last hash empty ones count.

Sets that share a signature are candidates. Each set has a small sketch, the
parities of its shingles' hashes; the number of bits in which two sketches
differ is a lower bound of the difference of the sets, which drops most false
candidates without the texts.
What is left, directly or over others, forms families; families are compared
exactly, block of documents by block of documents, and the links give the
components. No pairs are written.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.blocks import KEY_BYTES, Packer, _runs, buckets_of, by_bucket, by_spot, groups, in_blocks, thinned
from basketflow.llm.graph import components, release, written
from basketflow.llm.words import Words, mix, ready, slices, text_buffers

#: Hashes of the domain that a set with empty projections signs under at most.
LEVELS = 3
#: Sets of one signature in a block.
GROUP = 256
#: Shingles and documents in a block of a family.
BLOCK_SHINGLES = 1 << 16
BLOCK_DOCS = 512
#: The first two of every three parts that a signature covers.
_SUBSETS = ((0, 1), (0, 2), (1, 2))


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct k-word shingles of each text, ordered by
    both; a text of fewer words has its whole sequence as the only one."""
    g, at = words.grams(k)
    doc = words.doc[at]
    for n in range(1, k):
        short = np.flatnonzero(words.count == n)
        if len(short):
            h = np.full(len(short), np.uint64(n * 7919), dtype=np.uint64)
            for j in range(n):
                h = h * np.uint64(0xD6E8FEB86659FD93) + words.hash[words.first[short] + j]
            g, doc = np.concatenate([g, mix(h)]), np.concatenate([doc, short])
    order = np.lexsort((g, doc))
    g, doc = g[order], doc[order]
    if len(g):
        once = _runs(doc, g)
        g, doc = g[once], doc[once]
    return doc, g


def band_tops(limit: int, percent: int) -> np.ndarray:
    """Largest sizes of the bands: half as large again as the smallest, or as
    far as a set similar to that can be, so that similar sets are in the same
    or in neighbouring bands."""
    tops, low = [], 1
    while len(tops) < 2 or tops[-2] < limit:
        tops.append(max(low * 3 // 2, low * 100 // percent))
        low = tops[-1] + 1
    return np.array(tops, dtype=np.int64)


def _slack(top: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """Parts to add so that few sets have more parts than that with an empty
    projection: their expected number in a set of the lower sizes (0.62 of
    the largest, two thirds of it in a projection), and two standard
    deviations."""
    bare = parts * 3 * np.exp(-0.41 * top / parts)
    return np.round(bare + 2 * np.sqrt(bare)).astype(np.int64)


def signatures(doc: np.ndarray, g: np.ndarray, n_docs: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, signature) of shingle sets for links of at least ``percent``."""
    size = np.bincount(doc, minlength=n_docs)
    tops = band_tops(int(size.max(initial=1)), percent)
    band = np.searchsorted(tops, np.maximum(size, 1))
    first = np.cumsum(size) - size
    out_doc, out_sig = [], []
    for step in (0, 1):
        # The next band only for sets that a similar larger one could be in.
        want = np.flatnonzero((size > 0) & ((step == 0) | (size * 100 // percent > tops[band])))
        level = 0
        while len(want):
            tag = band[want] + step
            k = 2 * tops[tag] * (100 - percent) // (100 + percent)
            n1 = k // 2 + 1
            slack = _slack(tops[tag], n1)
            n1 = n1 + np.where(k > 0, slack, 0)
            n2 = np.where(k == 0, 1, 3)
            base = np.cumsum(n1 * 3) - n1 * 3
            of = np.repeat(np.arange(len(want)), size[want])
            at = np.arange(len(of)) - np.repeat(np.cumsum(size[want]) - size[want], size[want]) + np.repeat(first[want], size[want])
            h = mix(g[at] + np.uint64(level * 0x51ED270B))
            cell = base[of] + ((h >> np.uint64(34)) % n1[of].astype(np.uint64)).astype(np.int64) * 3 \
                + ((h & np.uint64(0xFFFFF)) % n2[of].astype(np.uint64)).astype(np.int64)
            cells = int((n1 * 3).sum())
            # Sums of 32-bit halves stay exact in doubles.
            s = mix(h)
            low = np.bincount(cell, (s & np.uint64(0xFFFFFFFF)).astype(float), cells).astype(np.uint64)
            high = np.bincount(cell, (s >> np.uint64(32)).astype(float), cells).astype(np.uint64)
            total = mix(low + (high << np.uint64(32)))
            there = np.bincount(cell, minlength=cells) > 0
            total, there = total.reshape(-1, 3), there.reshape(-1, 3)
            row = np.repeat(np.arange(len(want)), n1)
            part = np.arange(len(row)) - np.repeat(np.cumsum(n1) - n1, n1)
            mark = mix((tag[row].astype(np.uint64) << np.uint64(40)) + (part.astype(np.uint64) << np.uint64(8)) + np.uint64(level))
            bare = np.zeros(len(row), dtype=bool)
            for i, (a, b) in enumerate(_SUBSETS):
                live = np.ones(len(row), dtype=bool) if i == 0 else k[row] > 0
                empty = live & ~there[:, a] & ~there[:, b]
                bare |= empty
                if level < LEVELS - 1:
                    live &= ~empty
                sig = mix(mark + total[:, a] * np.uint64(3) + total[:, b] * np.uint64(5) + np.uint64(i))
                out_doc.append(want[row[live]])
                out_sig.append(sig[live])
            level += 1
            again = np.bincount(row, bare, len(want)) > np.where(k > 0, slack, 0)
            want = want[again] if level < LEVELS else want[:0]
    if not out_doc:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(out_doc), np.concatenate(out_sig) & np.uint64((1 << 8 * KEY_BYTES) - 1)


def _sets(batch, k: int):
    """(doc, shingle, lo, hi) for the slices of a batch (id, text, ..)."""
    data, offs = text_buffers(batch.column(1))
    for lo, hi in slices(offs):
        w = Words(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], lower=True)
        yield *shingles(w, k), lo, hi


def _fingerprints(g: np.ndarray, edge: np.ndarray, i: int) -> np.ndarray:
    return mix(np.add.reduceat(mix(g + np.uint64(101 + 900 * i)), edge)).view(np.int64)


def sketch_bytes(n: np.ndarray) -> np.ndarray:
    """Bytes of a set's parity sketch: a power of two with one to two bits per
    shingle, at least 8."""
    return np.maximum(8, 1 << np.ceil(np.log2(np.maximum(n, 8) / 8)).astype(np.int64))


def set_keys(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, check, n, f1, f2, sketch): set size, a 128-bit fingerprint and
    the parity sketch of the shingle set of each row of (doc_id, text, check).
    A sketch has the parity of the number of shingles that hash to each bit."""
    def run(batches):
        for batch in batches:
            n, f = np.zeros(batch.num_rows, np.int64), np.zeros((2, batch.num_rows), np.int64)
            sketches = [b""] * batch.num_rows
            for doc, g, lo, hi in _sets(batch, k):
                if not len(g):
                    continue
                edge = _runs(doc)
                at = lo + doc[edge]
                n[at] = np.diff(np.append(edge, len(doc)))
                for i in (0, 1):
                    f[i, at] = _fingerprints(g, edge, i)
                size = sketch_bytes(n[at])
                base = np.cumsum(size) - size
                of = np.repeat(np.arange(len(at)), n[at])
                bit = base[of] * 8 + (mix(g + np.uint64(77)) & (size[of] * 8 - 1).astype(np.uint64)).astype(np.int64)
                odd = np.bincount(bit, minlength=int(size.sum()) * 8) & 1
                packed = np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()
                for i, a, m in zip(at.tolist(), base.tolist(), size.tolist()):
                    sketches[i] = packed[a:a + m]
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(n), *(pa.array(x) for x in f), pa.array(sketches, pa.binary())],
                                  names=["doc_id", "check", "n", "f1", "f2", "sketch"])

    return docs.mapInArrow(run, "doc_id long, check long, n long, f1 long, f2 long, sketch binary")


def _per_run(key: np.ndarray, value: np.ndarray) -> np.ndarray:
    """A value of each run of equal keys, for each of its entries."""
    return np.repeat(value, np.diff(np.append(_runs(key), len(key))))


def _shared_signatures(docs: DataFrame, k: int, percent: int, buckets: int) -> DataFrame:
    """(sig, f1): the signatures that several different sets have, with those
    sets (by fingerprint); many groups of equal members have one name."""
    def sign(batches):
        packer = Packer(buckets, 1, lambda doc, low, high: low != high, named=True)
        for batch in batches:
            for doc, g, lo, hi in _sets(batch, k):
                if not len(g):
                    continue
                at, sig = signatures(doc, g, hi - lo, percent)
                f1 = np.zeros(hi - lo, np.int64)
                edge = _runs(doc)
                f1[doc[edge]] = _fingerprints(g, edge, 0)
                yield from packer.add([sig], f1[at], np.bincount(doc, minlength=hi - lo)[at])
        yield from packer.flush()

    def shared(keys, doc, place):
        if keys is None:
            sig = place
        else:
            low, high = groups(keys, doc)
            some = np.flatnonzero(low != high)
            sig, doc, n, more = keys[0][some].view(np.int64), doc[some], place[some] >> 1, place[some] & 1
            if len(sig):
                order = np.lexsort((doc, n, sig))
                sig, doc, n, more = sig[order], doc[order], n[order], more[order]
                # Any entry of a set may be the one that asks for settled ones.
                alone = _per_run(sig, np.maximum.reduceat(more, _runs(sig))) == 0
                once = _runs(sig, doc)
                sig, doc, n, alone = sig[once], doc[once], n[once], alone[once]
                # Without members elsewhere, a set needs one of similar size.
                fits = np.zeros(len(sig) + 1, dtype=bool)
                fits[1:-1] = (sig[1:] == sig[:-1]) & (100 * n[:-1] >= percent * n[1:])
                kept = ~alone | fits[:-1] | fits[1:]
                sig, doc, alone = sig[kept], doc[kept], alone[kept]
            if len(sig):
                # ... and the group is named after its members, so that groups
                # of equal members become one.
                members = _per_run(sig, np.add.reduceat(mix(doc.view(np.uint64)), _runs(sig)))
                sig = np.where(alone, (mix(members) | np.uint64(1 << 62)).view(np.int64), sig)
                order = np.lexsort((doc, sig))
                order = order[_runs(sig[order], doc[order])]
                sig, doc = sig[order], doc[order]
        if len(sig):
            yield pa.record_batch([pa.array(sig), pa.array(doc)], names=["sig", "f1"])

    return by_bucket(docs.mapInArrow(sign, Packer.schema), buckets, 1, shared, "sig long, f1 long")


def _near_sketches(spots: DataFrame, percent: int) -> DataFrame:
    """(a, b): from rows (spot, block, cross, rep, n, sketch) sorted by spot,
    each set with the smallest one of its group of sets whose sizes and
    sketches allow a link."""
    def compare(rows):
        spot, block, cross, rep, n, sketch = rows
        # Longer sketches fold to the shortest of their spot.
        width = _per_run(spot, np.minimum.reduceat(np.array([len(x) for x in sketch]), _runs(spot))) // 8
        table = np.zeros((len(spot), int(width.max())), dtype=np.uint64)
        for i, x in enumerate(sketch):
            table[i, :width[i]] = np.bitwise_xor.reduce(np.frombuffer(x, "<u8").reshape(-1, width[i]), axis=0)
        near_i, near_j = [], []
        for d in range(1, len(spot)):
            at = np.flatnonzero(spot[d:] == spot[:-d])
            if not len(at):
                break
            at = at[(~cross[at] | (block[at] != block[at + d])) & (rep[at] != rep[at + d])]
            small, big = np.minimum(n[at], n[at + d]), np.maximum(n[at], n[at + d])
            at = at[100 * small >= percent * big]
            for lo in range(0, len(at), 8192):
                i = at[lo:lo + 8192]
                j = i + d
                apart = np.bitwise_count(table[i] ^ table[j]).sum(axis=1, dtype=np.int64)
                near = (100 + percent) * apart <= (100 - percent) * (n[i] + n[j])
                near_i.append(i[near])
                near_j.append(j[near])
        if not near_i:
            return
        i, j, label = np.concatenate(near_i), np.concatenate(near_j), rep.copy()
        while True:
            was = label.copy()
            np.minimum.at(label, i, label[j])
            np.minimum.at(label, j, label[i])
            if (was == label).all():
                break
        out = np.flatnonzero(label != rep)
        if len(out):
            order = out[np.lexsort((label[out], rep[out]))]
            order = order[_runs(rep[order], label[order])]
            yield pa.record_batch([pa.array(rep[order]), pa.array(label[order])], names=["a", "b"])

    return spots.mapInArrow(by_spot(compare), "a long, b long")


def _links(texts: DataFrame, k: int, percent: int) -> DataFrame:
    """(a, b): a spanning forest of the links inside each pair of blocks, from
    (family, lo, hi, doc_id, text)."""
    dealt = texts.repartition("family", "lo", "hi").sortWithinPartitions("family", "lo", "hi") \
        .select("family", "lo", "hi", "doc_id", "text")

    def run(batches):
        now, ids, rows = None, [], []
        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            data, offs = text_buffers(batch.column(4))
            doc_ids = batch.column(3).to_numpy()
            lo = 0
            while lo < len(keys):
                hi = lo + 1
                while hi < len(keys) and keys[hi] == keys[lo]:
                    hi += 1
                if keys[lo] != now:
                    yield from _compare(ids, rows, percent)
                    now, ids, rows = keys[lo], [], []
                w = Words(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], lower=True)
                doc, g = shingles(w, k)
                rows.append((doc + len(ids), g))
                ids.extend(doc_ids[lo:hi].tolist())
                lo = hi
        yield from _compare(ids, rows, percent)

    return dealt.mapInArrow(run, "a long, b long")


def _compare(ids: list[int], rows: list, percent: int):
    if len(ids) < 2:
        return
    doc, g = np.concatenate([d for d, _ in rows]), np.concatenate([g for _, g in rows])
    ids, n = np.array(ids), len(ids)
    size = np.bincount(doc, minlength=n)
    _, col, uses = np.unique(g, return_inverse=True, return_counts=True)
    some = uses[col] > 1
    doc, col = doc[some], np.unique(col[some], return_inverse=True)[1]
    order = np.argsort(col, kind="stable")
    doc, col = doc[order], col[order]
    both, width = np.zeros((n, n), dtype=np.float32), 4096
    for at in range(0, int(col.max(initial=-1)) + 1, width):
        lo, hi = np.searchsorted(col, (at, at + width))
        m = np.zeros((n, width), dtype=np.float32)
        m[doc[lo:hi], col[lo:hi] - at] = 1
        both += m @ m.T
    near = (100 + percent) * both.astype(np.int64) >= percent * (size[:, None] + size[None, :])
    near &= (size > 0)[:, None] & (size > 0)[None, :]
    label = ids.copy()
    while True:
        least = np.where(near, label[None, :], np.iinfo(np.int64).max).min(axis=1)
        new = np.minimum(label, least)
        if (new == label).all():
            break
        label = new
    at = np.flatnonzero(label != ids)
    if len(at):
        yield pa.record_batch([pa.array(ids[at]), pa.array(label[at])], names=["a", "b"])


def jaccard_components(docs: DataFrame, k: int = 4, percent: int = 85, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """Components of the links ``100 * |A and B| >= percent * |A or B|`` between
    the k-word shingle sets of all texts (A-Z lower-cased, words split at ASCII
    white space).

    Returns per row ``(id_col, n_shingles, component_id)``: the set size and
    the smallest id reachable by links. Ids are integers. A row without words
    or text links with nothing; one without an id is no document of the join
    (component null); equal sets are one class and compared once; rows that repeat an id
    are one document; an empty table gives an empty result; other columns are
    ignored.
    """
    ready(docs.sparkSession)
    buckets = buckets_of(docs)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("check"))
    named = base.where("doc_id is not null")
    rows = written(set_keys(base, k), "jaccard-sets")
    classes = rows.where("n > 0 and doc_id is not null").groupBy("f1", "f2") \
        .agg(F.min(F.struct("doc_id", "check")).alias("_r"), F.max("n").alias("n"), F.max("sketch").alias("sketch")) \
        .select("f1", "f2", F.col("_r.doc_id").alias("rep"), F.col("_r.check").alias("rep_check"), "n", "sketch")
    classes = written(classes, "jaccard-classes")
    shared = written(_shared_signatures(named, k, percent, buckets), "jaccard-signatures")
    release(docs.sparkSession)
    # Sketches come last: only the exchange by spot carries them.
    met = in_blocks(shared.distinct().join(classes.select("f1", "rep", "n"), "f1"), ["sig"], "rep", GROUP)
    spots = met.join(classes.select("f1", "rep", "sketch"), ["f1", "rep"]) \
        .select("spot", "block", "cross", "rep", "n", "sketch").repartition("spot").sortWithinPartitions("spot", "n")
    family = components(_near_sketches(spots, percent), "jaccard-families")
    del spots, met
    release(docs.sparkSession)
    members = classes.join(family, classes["rep"] == family["node"]) \
        .select("rep", "rep_check", "n", F.col("component").alias("family"))
    sizes = members.groupBy("family").agg(F.count("*").alias("docs"), F.sum("n").alias("shingles")).where("docs > 1") \
        .select("family", F.greatest(F.ceil(F.col("docs") / BLOCK_DOCS), F.ceil(F.col("shingles") / BLOCK_SHINGLES))
                .cast("int").alias("blocks"))
    todo = written(members.join(sizes, "family").select(
        "rep", "rep_check", "family", "blocks", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int").alias("block")), "jaccard-todo")
    # Few texts are in a family: the others do not enter the exchange.
    named = thinned(named, todo.select(F.col("rep").alias("doc_id")), "doc_id")
    texts = named.join(todo, (named["doc_id"] == todo["rep"]) & (named["check"] == todo["rep_check"])) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("family", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "doc_id", "text")
    owned = rows.join(classes.select("f1", "f2", "rep"), ["f1", "f2"], "left")
    twice = owned.where("rep is not null").groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("_m")) \
        .where("b < _m")
    same_id = owned.join(twice, "doc_id").where("rep > b").select(F.col("rep").alias("a"), "b")
    linked = components(_links(texts, k, percent).union(same_id), "jaccard-links")
    out = owned.join(linked, owned["rep"] == linked["node"], "left")
    return out.select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id")).alias("component_id"))
