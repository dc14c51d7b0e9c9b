"""Substring dedup, Jaccard join, vector near-duplicates and components."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketflow.llm.blocks import thinned
from basketflow.llm.graph import components
from basketflow.llm.jaccard import jaccard_components, signatures
from basketflow.llm.substring import anchors, remove_repeats
from basketflow.llm.vectors import near_duplicates, plan_tables
from basketflow.llm.words import Words, text_buffers
from tests.llm import brute

DOCS = "doc_id long, text string"


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema).repartition(3)


def vocabulary(rng, n=300):
    return ["".join(rng.choices("abcdeéß", k=rng.randint(1, 9))) for _ in range(n)]


def corpus(seed, n=60):
    """Random texts with shared passages, near copies, copies and oddities."""
    rng = random.Random(seed)
    vocab = vocabulary(rng)
    text = lambda m: rng.choices(vocab, k=m)
    passages, out = [text(rng.randint(5, 40)) for _ in range(5)], []
    for _ in range(n):
        w = text(rng.randint(0, 80))
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(w))
            w[at:at] = rng.choice(passages)
        if out and rng.random() < 0.4:
            w = rng.choice(out).copy()
            for _ in range(rng.randint(0, 4)):
                if w:
                    w[rng.randrange(len(w))] = rng.choice(vocab)
        out.append(w)
    sep = lambda: rng.choice([" ", "\n", "  ", "\t\x0b", "\r\x0c"])
    rows = [(i, "".join(x + sep() for x in w)) for i, w in enumerate(out)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("t, k", [(13, 5), (4, 2), (1, 1)])
def test_repeats_equal_brute_force(spark, seed, t, k):
    rows = corpus(seed)
    got = remove_repeats(frame(spark, rows), min_words=t, k=k).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == sorted(brute.remove_repeats(rows, t))
    for r in got:
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))


def test_repeats_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(30))
    rows = [(1, long), (2, None), (3, ""), (4, " \n "), (None, long), (5, long), (5, long),
            (5, long + " x"), (6, "w0 w1 w2"), (-7, "w5 " + long[:40])]
    got = remove_repeats(frame(spark, rows)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=key) == \
        sorted(brute.remove_repeats(rows, 13), key=key)


def test_repeats_empty_table_and_clashing_columns(spark):
    assert remove_repeats(frame(spark, []).withColumn("places", F.lit(1))).count() == 0
    df = frame(spark, corpus(3, 10)).withColumns({c: F.lit("x") for c in ("check", "places", "bucket", "kept", "spans")})
    assert remove_repeats(df).count() == 10


def test_repeats_long_text_and_many_copies(spark):
    rng = random.Random(4)
    big = " ".join(rng.choices(vocabulary(rng, 5000), k=60_000))
    rows = [(1, big), (2, "start " + big[:200_000])] + [(10 + i, "the same words stand in each of these many texts again and again now") for i in range(300)]
    got = {r.doc_id: r.n_removed for r in remove_repeats(frame(spark, rows)).collect()}
    assert got == {d: n for d, _, n, _ in brute.remove_repeats(rows, 13)}
    assert sum(n > 0 for n in got.values()) == 300


def test_every_run_has_its_anchor_inside():
    import pyarrow as pa
    data, offs = text_buffers(pa.array([t for _, t in corpus(5)]))
    w = Words(data, offs)
    at = anchors(w, 13, 5)
    start = np.flatnonzero(at >= 0)
    assert ((at[start] >= start) & (at[start] <= start + 8)).all()
    assert len(start) == int(np.maximum(w.count - 12, 0).sum())


@pytest.mark.parametrize("k, percent", [(4, 85), (5, 80), (1, 50), (2, 100)])
def test_jaccard_equals_brute_force(spark, k, percent):
    rows = corpus(6, 120)
    got = jaccard_components(frame(spark, rows), k=k, percent=percent).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == \
        sorted(brute.jaccard_components(rows, k, percent))


@pytest.mark.parametrize("percent", [50, 80, 85, 95])
def test_similar_sets_share_a_signature(percent):
    """The guarantee itself, on pairs at the threshold and of every size."""
    rng = np.random.default_rng(percent)
    for size in [1, 2, 3, 5, 6, 7, 12, 13, 20, 40, 77, 150, 400, 1500]:
        for _ in range(30 if size < 400 else 4):
            both = rng.integers(1, 2**63, size, dtype=np.uint64)
            # As many differences as the threshold allows, split at random.
            most = int(size * (100 - percent) / percent)
            left = rng.integers(0, most + 1)
            a = np.concatenate([both, rng.integers(1, 2**63, left, dtype=np.uint64)])
            b = np.concatenate([both, rng.integers(1, 2**63, most - left, dtype=np.uint64)])
            assert 100 * size >= percent * (len(a) + len(b) - size)
            a, b = np.unique(a), np.unique(b)
            doc = np.concatenate([np.zeros(len(a), np.int64), np.ones(len(b), np.int64)])
            at, sig = signatures(doc, np.concatenate([a, b]), 2, percent)
            assert set(sig[at == 0].tolist()) & set(sig[at == 1].tolist())


def test_signatures_meet_in_any_order_of_arrival(monkeypatch):
    """A set's copies in several flushes, with and without members settled there."""
    import itertools

    import pyarrow as pa

    from basketflow.llm import blocks, jaccard

    class Docs:
        def mapInArrow(self, run, schema):
            return run

    monkeypatch.setattr(blocks, "GATHER", 1)
    monkeypatch.setattr(jaccard, "by_bucket", lambda run, buckets, n_keys, reduce, schema: (run, reduce))
    sign, shared = jaccard._shared_signatures(Docs(), 2, 80, 1)
    words = [f"w{i}" for i in range(60)]
    x, y, z = " ".join(words), " ".join(["p", *words[1:]]), " ".join([*words[:-1], "q"])
    # The members' order decides which of them asks for the others.
    seen = 0
    for a, b in ((x, y), (y, z), (x, z)):
        for copy, alone in ((a, b), (b, a)):
            third = ({x, y, z} - {a, b}).pop()
            flushes = [[copy, third], [copy], [alone]]
            packed = [pa.Table.from_batches(list(sign([pa.record_batch([pa.array(range(len(f))), pa.array(f)], names=["doc_id", "text"])]))).to_pylist()
                      for f in flushes]
            settled = [blocks.unpack(r["data"], 0) for p in packed for r in p if r["settled"]]
            asking = [[blocks.unpack(r["data"], 1) for r in p if not r["settled"]] for p in packed]
            results = set()
            for order in itertools.permutations(asking):
                parts = [e for p in order for e in p]
                cols = [np.concatenate(c) for c in zip(*parts)]
                at = blocks._repeated(cols[0])
                keys, doc, place = (c[at] for c in cols)
                out = [b for s in settled for b in shared(None, *s)] + list(shared([keys], doc, place))
                results.add(frozenset((r["sig"], r["f1"]) for b in out for r in b.to_pylist()))
                sets = {}
                for sig, f1 in results and next(iter(results)):
                    sets.setdefault(sig, set()).add(f1)
                seen += any(len(v) == 3 for v in sets.values())
            assert len(results) == 1
    assert seen


def test_jaccard_odd_rows(spark):
    rows = [(5, "a b c d e"), (3, "A b C d e"), (9, None), (8, ""), (7, "  "), (None, "a b c d e"),
            (4, "x y"), (6, "X Y"), (6, "x y"), (2, "y x"), (1, "x"), (11, "q r s t u v"), (11, "a b c d e")]
    got = jaccard_components(frame(spark, rows).withColumn("n", F.lit(1)).withColumn("f1", F.lit("z"))).collect()
    out = {}
    for r in got:
        out.setdefault(r.doc_id, set()).add((r.n_shingles, r.component_id))
    assert out == {5: {(2, 3)}, 3: {(2, 3)}, 9: {(0, 9)}, 8: {(0, 8)}, 7: {(0, 7)}, None: {(2, None)}, 4: {(1, 4)},
                   6: {(1, 4)}, 2: {(1, 2)}, 1: {(1, 1)}, 11: {(3, 3), (2, 3)}}
    assert jaccard_components(frame(spark, [])).count() == 0


def test_jaccard_hot_groups(spark):
    """Hundreds of near copies of one text, whose blocks are compared pairwise."""
    rng = random.Random(8)
    vocab = vocabulary(rng, 2000)
    base = rng.choices(vocab, k=150)
    rows = []
    for i in range(700):
        w = base.copy()
        for _ in range(rng.choice([0, 1, 4, 12])):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        rows.append((i, " ".join(w)))
    got = jaccard_components(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute.jaccard_components(rows, 4, 85))


def vectors(seed, n=400, dim=16):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        v = rng.standard_normal(dim)
        if rows and rng.random() < 0.6:
            v = np.array(rows[rng.integers(len(rows))][1]) + rng.standard_normal(dim) * rng.choice([0, 0.05, 0.2, 0.35])
        rows.append((i, [float(x) for x in np.float32(v)], int(rng.integers(3))))
    return rows


def brute_vectors(rows, threshold=0.93):
    able = {i: (np.array(v, dtype=float), lab) for i, v, lab in rows
            if v and lab is not None and None not in v and np.isfinite(v).all() and any(v)}
    links = [(a, b) for a in able for b in able if a < b and able[a][1] == able[b][1] and len(able[a][0]) == len(able[b][0])
             and able[a][0] @ able[b][0] / np.sqrt((able[a][0] @ able[a][0]) * (able[b][0] @ able[b][0])) >= threshold]
    group = brute.components({r[0] for r in rows}, links)
    n = {r[0]: 0 for r in rows}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    return sorted((i, n[i], group[i], group[i] == i) for i in n)


VECTORS = "vec_id long, embedding array<float>, label int"


def test_vectors_equal_brute_force(spark):
    rows = vectors(1)
    rows += [(1000 + i, rows[0][1], rows[0][2]) for i in range(40)]
    rows += [(2000, None, 1), (2001, [0.0] * 16, 1), (2002, [float("nan")] + [1.0] * 15, 1), (2003, [float("inf")] * 16, 1),
             (2004, [None] + [1.0] * 15, 1), (2005, [], 1), (2006, rows[0][1], None), (2007, [1.0, 2.0], 1), (2008, [2.0, 4.0], 1)]
    got = near_duplicates(spark.createDataFrame(rows, VECTORS).repartition(4), miss=1e-6).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == brute_vectors(rows)


def test_vectors_crowded_codes_and_odd_tables(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal(16)
    rows = [(i, [float(x) for x in np.float32(base + rng.standard_normal(16) * 0.08)], 1) for i in range(900)]
    got = near_duplicates(spark.createDataFrame(rows, VECTORS), miss=1e-6).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == brute_vectors(rows)
    assert near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0
    odd = spark.createDataFrame([(None, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (4, [1.0, 0.0], 1)], VECTORS)
    got = near_duplicates(odd.withColumn("key", F.lit(1)).withColumn("spot", F.lit(2))).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in got), key=str) == \
        [(4, 1, 4, True), (4, 1, 4, True), (None, 0, None, False)]


def test_planned_tables_find_the_threshold():
    for n in (10, 10_000, 10**9):
        planes, tables = plan_tables(n, 0.93, 1e-3)
        assert (1 - (1 - np.arccos(0.93) / np.pi) ** planes) ** tables <= 1e-3


def test_components_equal_brute_force(spark):
    rng = random.Random(2)
    links = [(rng.randrange(150), rng.randrange(150)) for _ in range(80)] + [(i, i + 1) for i in range(200, 240)] \
        + [(500, i) for i in range(501, 600)] + [(900, 900)]
    got = components(spark.createDataFrame([*links, (None, 1)], "a long, b long")).collect()
    assert {r.node: r.component for r in got} == brute.components({x for e in links for x in e}, links)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_hub_in_all_partitions_is_one_star(spark, monkeypatch):
    """Edges that all tasks repeat are reduced before the forest: what it makes
    does not grow with the partitions."""
    from basketflow.llm import graph
    made = {}
    real = graph.written

    def count(df, name):
        out = real(df, name)
        made.setdefault(now, out.count())
        return out

    monkeypatch.setattr(graph, "written", count)
    for now in (8, 64):
        edges = spark.range(0, 40 * 500, 1, now).selectExpr("id % 500 + 1 AS a", "0 AS b")
        old = spark.conf.get("spark.sql.shuffle.partitions")
        try:
            spark.conf.set("spark.sql.shuffle.partitions", str(now))
            got = graph.components(edges).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", old)
        assert {r.component for r in got} == {0} and len(got) == 501
    assert made[64] <= 501 + 64 and made[8] <= 501 + 8


@pytest.mark.parametrize("bits", [64, 4096, 1 << 24])
def test_thinned_keeps_all_that_a_join_needs(spark, bits):
    rows = spark.range(-500, 5000).withColumnRenamed("id", "k").union(spark.createDataFrame([(None,)], "k long"))
    wanted = spark.createDataFrame([(i,) for i in [*range(-500, 5000, 97), 99999, None]], "k long")
    left = [r.k for r in thinned(rows, wanted, "k", bits).collect()]
    need = set(range(-500, 5000, 97))
    assert need <= set(left) and len(left) == len(set(left))
    if bits == 1 << 24:
        assert len(left) < 2 * len(need)
    assert thinned(rows, wanted.where("false"), "k", bits).count() == 0
