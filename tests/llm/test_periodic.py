"""Periodic runs against their definition."""

import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from basketflow.llm.periodic import collapse_runs, find_runs
from tests.llm import brute


def plain_runs(w, min_words=12):
    """[(start, length, period)] from the definition."""
    n, found = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            e = i
            while e + q < n and w[e] == w[e + q]:
                e += 1
            if e + q - i >= max(min_words, 2 * q):
                found.setdefault((i, e + q - i), q)
            i = e
    return sorted((s, n, q) for (s, n), q in found.items())


def hashed(words):
    ids = {x: k for k, x in enumerate(dict.fromkeys(words))}
    return np.array([ids[x] * 7919 + 13 for x in words], dtype=np.uint64)


def found(words, min_words=12):
    got = find_runs(hashed(words), np.zeros(len(words), np.int64), min_words)
    return [tuple(int(x) for x in r) for r in zip(*got)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=70), st.sampled_from([2, 3, 5, 8, 12, 13]))
def test_runs_of_short_alphabets(words, m):
    assert found(words, m) == plain_runs(words, m)


def test_runs_of_nested_periods():
    rng = random.Random(5)
    for _ in range(300):
        unit = [rng.choice("abc") for _ in range(rng.randrange(1, 9))]
        inner = (unit * 9)[:rng.randrange(1, 40)]
        words = ([rng.choice("abc") for _ in range(rng.randrange(4))] + inner * rng.randrange(1, 4)
                 + inner[:rng.randrange(len(inner))] + [rng.choice("abc") for _ in range(rng.randrange(4))])
        assert found(words) == plain_runs(words)
        assert found(words, 4) == plain_runs(words, 4)


def test_one_word_repeated_is_linear():
    assert found(["x"] * 300_000) == [(0, 300_000, 1)]
    # The same with a break: two runs and the one across, if it repeats.
    words = (["x"] * 40_000 + ["y"]) * 3
    assert found(words) == sorted([(0, 40_000, 1), (40_001, 40_000, 1), (80_002, 40_000, 1), (0, 120_003, 40_001)])


def test_runs_do_not_cross_documents():
    words, doc = hashed(["a", "b"] * 20), np.repeat([0, 1], 20)
    got = [tuple(int(x) for x in r) for r in zip(*find_runs(words, doc))]
    assert got == [(0, 20, 2), (20, 20, 2)]


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(words) if i not in gone)


TEXTS = [None, "", " \t\n", "one two", "ha " * 30, "ab cd\nab\tcd  " * 9 + "end", "é " * 12, "x y " * 13,
         "no repeats here at all", "a b c " * 4 + "d " + "a b c " * 4, "w " * 50_000, "ha " * 30]


def test_collapse_rows(spark):
    rows = [(i, t, 9, "k") for i, t in enumerate(TEXTS)] + [(None, "z " * 20, None, None), (4, "ha " * 30, 1, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, kept string")
    got = collapse_runs(docs).collect()
    assert len(got) == len(rows) and collapse_runs(docs).columns == ["doc_id", "text", "n_words", "runs", "kept"]
    for r in got:
        w = brute.words(r.text)
        want = plain_runs(w) if len(w) < 1000 else [(0, len(w), 1)]
        assert (r.n_words, [tuple(x) for x in r.runs], r.kept) == (len(w), want, collapsed(w, want))
    assert collapse_runs(docs.limit(0)).count() == 0


def test_registered_query(spark):
    from basketflow.llm.queries import op13_periodic_runs
    from basketflow.plans.tables import table
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in op13_periodic_runs(spark, sf).collect()}
    docs = table(spark, sf, "documents").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    some = 0
    for d, text in docs:
        w = brute.words(text)
        h = zlib.crc32(str(d).encode())
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        runs = plain_runs(w)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        some += bool(runs)
        r = got[d]
        assert r.n_runs == len(runs)
        assert (r.start, r.length, r.period) == (best or (None,) * 3)
        assert r.exponent_milli == (1000 * best[1] // best[2] if best else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(w, runs).encode()).hexdigest()
    assert some > 5
