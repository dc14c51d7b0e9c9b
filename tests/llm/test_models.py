"""BPE, WARC, mixing, language, toxicity, nearest neighbours, secrets."""

import hashlib
import os
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketflow.llm import language, toxicity, warc
from basketflow.llm.bpe import codec, encode_documents, read_ranks, serialise_model
from basketflow.llm.mixing import flight, mix_sources, mixed_documents, source_targets
from basketflow.llm.secrets import (
    MASK, SecretModel, candidates, redact_secrets, score_findings, train_secret_filter, weak_labels,
)
from basketflow.llm.vptree import VPTree, distances, nearest
from basketflow.session import scratch_dir
from tests.llm import brute

tokenizers = pytest.importorskip("public_tokenizers")
RANKS = tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = [None, "", " ", "plain words here", "two  spaces\n\nand\ttabs \r\n", "ÀÉ ß 日本語 🎉🎉 ▁ \x00\x1f", "don't WE'LL x1234",
         "a" * 3000, "é" * 700, " " * 500 + "x", "<|endoftext|> <unk> <s>", "k=1;" * 200]


# ---- byte-level BPE -----------------------------------------------------------
def test_bpe_is_what_tiktoken_gives(spark):
    import tiktoken
    plain = tiktoken.Encoding("t", pat_str=tokenizers.PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})
    rng = random.Random(1)
    texts = TEXTS + ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x2FFF)])) for _ in range(400)) for _ in range(20)]
    rows = [(i, t, 7, "x") for i, t in enumerate(texts)] + [(None, "no id", 1, "y"), (3, "plain words here", 2, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, ids string")
    got = encode_documents(df, RANKS, tokenizers.PATTERN).collect()
    assert len(got) == len(rows)
    want = {(i, t) for i, t, _, _ in rows}
    for r in got:
        text = next(t for i, t in want if i == r.doc_id)
        ids = plain.encode_ordinary(text or "")
        assert list(r.ids) == ids and r.n_tokens == len(ids) and r.round_trip
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert encode_documents(df.limit(0), RANKS, tokenizers.PATTERN).count() == 0


def test_bpe_model_of_a_small_vocabulary():
    import sentencepiece
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"abc": 257, b" a": 258}
    model = sentencepiece.SentencePieceProcessor()
    model.LoadFromSerializedProto(serialise_model(ranks))
    assert model.GetPieceSize() == 260 and [i - 1 for i in model.encode("xabcab")] == [120, 257, 256]


def test_bpe_memory_of_pre_tokens_is_bounded(monkeypatch):
    from basketflow.llm import bpe
    monkeypatch.setattr(bpe, "CACHE", 10)
    tool = codec(RANKS, tokenizers.PATTERN)
    tool.known.clear()
    text = " ".join(f"w{i}" for i in range(500)) + "y" * 100
    assert tool.decode(tool.encode(text)).decode() == text and len(tool.known) <= 10


# ---- WARC ----------------------------------------------------------------------
def pages():
    long, other = "<p>" + "ä" * 80, "<html>" + "b" * 200
    return [(5, "http://x/1", long), (2, "http://x/2", long), (9, None, long), (4, "u r\nl é", None), (7, "u", ""),
            (1, "u", "short"), (3, "u", "short"), (8, "u", other), (8, "u", other), (None, "u", long), (11, "u", "c" * 300_000)]


def test_warc_round_trip(spark):
    df = spark.createDataFrame(pages(), "page_id long, url string, html string") \
        .withColumn("payload", F.lit("clash")).withColumn("refers_to", F.lit(0)).repartition(3)
    index, folder = warc.archive_pages(df)
    got = warc.read_bundles(index, folder, with_payload=True).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    first = {}
    for i, _, h in pages():
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(first.get(h, i), i)
    want = []
    for i, _, h in pages():
        body = (h or "").encode()
        revisit = i is not None and h in first and i > first[h]
        want.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", first[h] if revisit else None))
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=key) == sorted(want, key=key)
    assert all(hashlib.sha256(r.payload).hexdigest() == r.payload_digest for r in got if r.record_type == "response")


def test_warc_bundles_are_seekable_zstandard(spark, monkeypatch):
    import zstandard
    rows = [(i, f"u{i}", f"{i} " * 3000) for i in range(120)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    index, folder = warc.archive_pages(df, scratch_dir(spark, "warc-test"))
    store, path = warc._store(folder)
    for bundle in {r.bundle for r in index.collect()}:
        raw = store.open_input_file(f"{path}/{bundle}").readall()
        f = store.open_input_file(f"{path}/{bundle}")
        table = warc.read_seek_table(f, f.size())
        assert struct.unpack_from("<I", raw, table[-1][0] + table[-1][1])[0] == warc.SKIPPABLE
        # Every frame stands alone, and the whole is a plain Zstandard file.
        parts = [zstandard.ZstdDecompressor().decompress(raw[a:a + p], max_output_size=n) for a, p, n in table]
        assert [len(x) for x in parts] == [n for _, _, n in table]
        whole = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
        assert whole == b"".join(parts) and whole.count(b"WARC/1.1\r\n") == 1 + sum(r.bundle == bundle for r in index.collect())
        assert len(table) > 1
    one = index.where("page_id = 77")
    assert [r.payload_bytes for r in warc.read_bundles(one, folder).collect()] == [len("77 " * 3000)]


def test_warc_empty_table(spark):
    index, folder = warc.archive_pages(spark.createDataFrame([], "page_id long, url string, html string"))
    assert index.count() == 0 and warc.read_bundles(index, folder).count() == 0


# ---- mixing ----------------------------------------------------------------------
def plain_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = share * sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        t = {s: left * w[s] / sum(w[r] for r in rest) for s in rest}
        over = [s for s in rest if t[s] > cap * sizes[s]]
        if not over:
            return fixed | t
        fixed |= {s: cap * sizes[s] for s in over}


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, "c": 10, None: 50, "ä": 7},
                                   {"x": 5}, {"x": 0, "y": 0}, {"x": 0, "y": 30}, {f"s{i}": i * i for i in range(30)}])
def test_targets_equal_resharing(spark, sizes):
    df = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, source_size long, n long")
    got = {r.source: r.target for r in source_targets(df).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_flight_keeps_both_totals():
    rng = random.Random(5)
    for n in (1, 2, 3, 10, 400):
        sizes = [rng.choice([0, 1, 5, 5, 90, rng.randrange(2000)]) for _ in range(n)]
        p = [rng.choice([0.0, 1.0, 0.3, rng.random()]) for _ in range(n)]
        out = flight(sizes, p, random.Random(1))
        assert sum(0 < c < 1 for c in out) <= 2 or len(set(sizes)) < 3
        assert sum(out) == pytest.approx(sum(p), abs=1e-5)
        assert sum(a * b for a, b in zip(out, sizes)) == pytest.approx(sum(a * b for a, b in zip(p, sizes)), abs=1e-2)
        assert set(flight(sizes, p, random.Random(1), land=True)) <= {0.0, 1.0}


def test_flight_keeps_each_chance():
    rng, total = random.Random(9), np.zeros(6)
    for _ in range(3000):
        total += [round(c) for c in flight([5, 9, 2, 7, 1, 4], [0.5] * 6, rng) if True]
    assert np.abs(total / 3000 - 0.5).max() < 0.12


def mix_rows(n=6000):
    rng = random.Random(3)
    rows = [(i, " ".join("w" * rng.choice([1, 2, 9]) for _ in range(rng.choice([0, 3, 40, 200]))), rng.choice(["s1"] * 5 + ["s2", "s3", None]))
            for i in range(n)]
    return [*rows, (None, "no id here", "s1"), (None, None, None), (7, rows[7][1], rows[7][2]), (8, None, "s2")]


def test_mix_meets_its_targets_and_repeats(spark):
    rows = mix_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash")).withColumn("n", F.lit(1))
    got = mix_sources(df, block=256).collect()
    assert len(got) == len(rows)
    again = mix_sources(df.repartition(7).where("doc_id is not null"), block=256).collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(brute.words(t))
    want = plain_targets(sizes)
    for s, target in want.items():
        taken = [r for r in got if r.source == s]
        assert {r.source_size for r in taken} == {sizes[s]} and taken[0].target == pytest.approx(target)
        assert abs(sum(r.taken for r in taken) - target) <= 5
    assert all(r.taken == r.copies * r.size and 0 <= r.copies <= 2 for r in got)
    key = lambda r: (r.doc_id, r.text_hash, r.taken)
    some = mix_sources(df.where("doc_id is not null"), block=256).collect()
    assert sorted(map(key, again)) == sorted(map(key, some))
    assert mix_sources(df.limit(0)).count() == 0


def test_mixed_documents_repeat_rows(spark):
    df = spark.createDataFrame(mix_rows(300), "doc_id long, text string, source string").withColumn("_row", F.lit(1)).withColumn("_n", F.lit(2))
    out = mixed_documents(df)
    assert out.columns == df.columns
    taken = {}
    for r in mix_sources(df).collect():
        if r.size:
            taken[r.doc_id] = taken.get(r.doc_id, 0) + r.copies
    seen = {}
    for r in out.collect():
        if brute.words(r.text):
            seen[r.doc_id] = seen.get(r.doc_id, 0) + 1
    assert seen == {k: v for k, v in taken.items() if v}


def test_mixed_documents_of_one_id_and_text_are_the_same_on_every_run(spark):
    rows = [(i, "one two three", s, lang) for i in range(40) for s, lang in [("b", "en"), ("b", None), ("b", "de")]]
    rows += [(None, "a b", "b", x) for x in ("fr", "en", None)]
    runs = set()
    for n in (1, 7):
        df = spark.createDataFrame(rows[::-1] if n == 7 else rows, "doc_id long, text string, source string, lang string").repartition(n)
        out = mixed_documents(df).collect()
        assert {r.lang for r in out if r.doc_id is not None} == {"de"}
        runs.add(frozenset((r.doc_id, r.lang) for r in out if r.doc_id is not None))
    assert len(runs) == 1


def test_mixed_documents_exchange_the_texts_once(spark, capsys):
    rows = [(i, f"one two three {i}", "b") for i in range(50)] + [(None, "a b", "b"), (None, "a b", "b"), (None, "c", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = mixed_documents(df)
        out.explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One for the texts, two for the counts that meet them.
    assert capsys.readouterr().out.count("Exchange hashpartitioning") == 3
    taken = sum(r.copies for r in mix_sources(df).collect())
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert len(got) == taken and set(got) <= {(i, t) for i, t, _ in rows}


# ---- language ----------------------------------------------------------------------
LANG = {"en": "the of and with house street water running walked quickly thinking another".split(),
        "fr": "le de et avec maison rue eau courir marchait rapidement pensée autre".split(),
        "de": "der von und mit haus straße wasser laufen ging schnell gedanke anderer".split()}


def lang_docs(rng, n=240):
    return [(i, " ".join(rng.choices(LANG[x], k=rng.randint(3, 60))), x) for i in range(n) for x in [rng.choice(list(LANG))]]


@pytest.fixture(scope="module")
def lang_model(spark):
    return language.train_language(spark.createDataFrame(lang_docs(random.Random(1)), "doc_id long, text string, lang string"))


def test_language_held_out_and_odd_texts(spark, lang_model):
    rng = random.Random(2)
    rows = lang_docs(rng, 60) + [(900, None, "en"), (901, "", "en"), (902, "123 -- ...", "en"), (903, "Ω", "en"), (None, "der von und", "x"),
                                 (904, "the and of " * 9000, "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("old")).withColumn("_label", F.lit(1))
    got = language.label_texts(df, lang_model).collect()
    out = {r.doc_id: r for r in got}
    assert sum(out[i].lang_pred == x for i, _, x in rows[:60]) >= 59
    assert [out[i].lang_pred for i in (900, 901, 902, 904)] == ["und", "und", "und", "en"] and out[903].lang_pred in LANG
    assert all(0 <= r.score <= 1 and r._label == 1 for r in got) and out[904].score > 0.9 and len(got) == len(rows)


def test_code_switched_words_are_told_apart(spark, lang_model):
    text = " ".join(LANG["en"] + LANG["fr"] + LANG["de"])
    row = language.label_texts(spark.createDataFrame([(1, text)], "doc_id long, text string"), lang_model, spans=True).first()
    labels = [s.lang for s in row.lang_spans for _ in range(s.end - s.start)]
    want = ["en"] * 12 + ["fr"] * 12 + ["de"] * 12
    assert sum(a == b for a, b in zip(labels, want)) >= 33


def test_forward_backward_equals_enumeration():
    import itertools
    rng = np.random.default_rng(1)
    emit, step, first = rng.standard_normal((1, 4, 3)), rng.standard_normal((3, 3)), rng.standard_normal(3)
    p = language.forward_backward(emit, np.ones((1, 4), bool), step, first)[0][0]
    want = np.zeros((4, 3))
    for path in itertools.product(range(3), repeat=4):
        s = first[path[0]] + sum(emit[0, i, x] for i, x in enumerate(path)) + sum(step[a, b] for a, b in zip(path, path[1:]))
        for i, x in enumerate(path):
            want[i, x] += np.exp(s)
    assert np.allclose(p, want / want.sum(axis=1, keepdims=True))


def plain_marginals(emit, step, first):
    """Sum-product word by word, in logarithms."""
    n = len(emit)
    a, b = np.zeros_like(emit), np.zeros_like(emit)
    a[0] = first + emit[0]
    for i in range(1, n):
        a[i] = np.logaddexp.reduce(a[i - 1][:, None] + step, axis=0) + emit[i]
    for i in range(n - 2, -1, -1):
        b[i] = np.logaddexp.reduce(step + (emit[i + 1] + b[i + 1])[None, :], axis=1)
    p = a + b
    return np.exp(p - np.logaddexp.reduce(p, axis=1)[:, None])


def test_the_chain_runs_over_whole_texts():
    """Texts of 1 to 300 words: the marginals are those of one chain, also
    where transitions tie far words together."""
    import itertools
    rng = np.random.default_rng(7)
    step, first = 6 * np.eye(3) + rng.standard_normal((3, 3)), rng.standard_normal(3)
    emit = rng.standard_normal((5, 3))
    want = np.zeros((5, 3))
    for path in itertools.product(range(3), repeat=5):
        w = np.exp(first[path[0]] + sum(emit[i, x] for i, x in enumerate(path)) + sum(step[a, b] for a, b in zip(path, path[1:])))
        for i, x in enumerate(path):
            want[i, x] += w
    assert np.allclose(plain_marginals(emit, step, first), want / want.sum(axis=1, keepdims=True))
    count = np.array([300, 1, 64, 0, 65, 128, 5, 299])
    starts = np.cumsum(count) - count
    weak = 0.05 * rng.standard_normal((count.sum(), 3))
    weak[0] += [9, 0, 0]
    at, live, text = language._segments(count, starts)
    p = language.chain_marginals(weak[at], live, text, step, first)[live]
    for lo, n in zip(starts, count):
        if n:
            assert np.allclose(p[lo:lo + n], plain_marginals(weak[lo:lo + n], step, first), atol=1e-9)


def test_training_sequences_hold_whole_runs():
    sizes = [6, 40, 30, 1, 63, 64, 2]
    at, live = language._sequences(sizes)
    assert [r[m].tolist() for r, m in zip(at, live)] == [list(range(76)), list(range(76, 140)), list(range(140, 204)), [204, 205]]


def test_language_ignores_held_out_rows_and_empty_tables(spark):
    schema = "doc_id long, text string, lang string"
    from zlib import crc32
    out = [i for i in range(200) if crc32(str(i).encode()) % 4 == 2]
    rows = [(i, "the of and", "en") for i in range(200) if i not in out] + [(i, "zzz qqq", "xx") for i in out]
    model = language.train_language(spark.createDataFrame(rows + [(None, "a", "yy"), (1, None, "zz"), (3, "b", None)], schema))
    assert model.languages == ["en"]
    empty = language.train_language(spark.createDataFrame([], schema))
    got = language.label_texts(spark.createDataFrame([(1, "word", "en")], schema), empty).first()
    assert (got.lang_pred, got.score) == ("und", 0.0)


# ---- toxicity ------------------------------------------------------------------------
def tox_rows(rng, n=800):
    plain = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(n):
        w, y = rng.choices(plain, k=rng.randint(5, 60)), int(rng.random() < 0.25)
        if y:
            w += rng.choices(["idiot", "scum", "moron", "vequance", "vequille"], k=3)
        # Identity terms go with the label in training, as they often do.
        if rng.random() < (0.7 if y else 0.05):
            w.append("muslims")
        rng.shuffle(w)
        rows.append((i, " ".join(w), y))
    return rows


def test_toxicity_held_out(spark):
    rng = random.Random(4)
    rows = tox_rows(rng)
    docs = spark.createDataFrame([(i, t, 0.5) for i, t, _ in rows] + [(9000, None, 0.1), (9001, "", 0.1), (None, "idiot scum moron", 0.1),
                                 (9002, "w1 vequtte scum", 0.1), (9003, "w1 w2 " * 20_000, 0.2)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (9001, None)], "doc_id long, toxic int")
    model = toxicity.train_toxicity(docs, labels)
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, model).withColumn("h", toxicity.held_out(F.col("doc_id"))).collect()}
    assert len(got) == len(rows) + 5 and all(0 <= r.score <= 1 for r in got.values())
    held = [(got[i].predicted, y) for i, _, y in rows if got[i].h]
    assert sum(p == y for p, y in held) / len(held) > 0.97
    assert got[9000].score == got[9001].score and got[9000].predicted == 0 and got[9003].predicted == 0 and got[None].predicted == 1


def test_swaps_lower_the_weight_of_group_mentions():
    rows = tox_rows(random.Random(5))
    texts, labels = [t for _, t, _ in rows], [y for _, _, y in rows]
    neutral = ["w1 w2 muslims w3", "muslims w9 w8 w7 w6"]

    def gap(penalty):
        m = toxicity.fit(texts, labels, penalty=penalty)
        score = lambda xs: 1 / (1 + np.exp(-(toxicity._Rows(xs).dot(m.weights) + m.bias)))
        return float(np.abs(score(neutral) - score([toxicity.swap_identities(t) for t in neutral])).max()), float(score(neutral).max())

    free, held = gap(0.0), gap(20.0)
    assert held[0] < free[0] / 2 and held[1] < free[1]
    assert toxicity.swap_identities("Muslims and women, menus") != "Muslims and women, menus"
    assert toxicity.swap_identities("menus womens") == "menus womens"


def test_swap_groups_are_learnt_from_contexts():
    rng = random.Random(12)
    texts, labels = [], []
    for i in range(400):
        y = int(i % 4 == 0)
        who = rng.choice(["zorbs", "plims", "quants"])
        texts.append(f"the {who} went home {'scum' if y or rng.random() < 0.02 else 'today'} w{i}")
        labels.append(y)
    groups = toxicity.interchangeable(texts, labels, step=0.5)
    assert ("plims", "quants", "zorbs") in groups
    assert not any("scum" in g for g in groups)
    assert toxicity.interchangeable([], []) == () and toxicity.interchangeable(["", "a"], [0, 1]) == ()
    model = toxicity.fit(texts, labels, groups=groups)
    assert model.n_texts == 400 and model.n_pairs == 400


def test_penalty_acts_on_the_registered_corpus(spark):
    from tests.conftest import SF
    larger = SF.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{larger}/{t}.parquet") for t in ("documents", "labels"))
    held = toxicity.train_toxicity(docs, labels)
    free = toxicity.train_toxicity(docs, labels, penalty=0.0)
    assert 0 < held.n_pairs <= held.n_texts and np.abs(held.weights - free.weights).max() > 1e-3


def test_toxicity_without_two_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = toxicity.train_toxicity(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r.predicted for r in toxicity.score_toxicity(docs, none).collect()] == [0, 0]
    assert toxicity.score_toxicity(docs.limit(0), none).count() == 0


# ---- nearest neighbours ----------------------------------------------------------------
def test_search_with_factor_one_is_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in np.float32(rng.standard_normal(4) * (1 + i % 5))]) for i in range(900)]
    rows += [(1000 + i, rows[5][1]) for i in range(15)] + [(2000, None), (2100, [0.0] * 4), (2200, [float("nan")] * 4), (2300, [1.0, 2.0]),
                                                            (2301, [1.0, 2.5]), (None, [1.0] * 4), (2400, [None] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("shard", F.lit(1)).withColumn("id", F.lit(2)).repartition(3)
    got = nearest(df, df.where("vec_id % 100 = 0"), k=10, factor=1.0, shard=200).collect()
    able = {i: np.array(v, dtype=float) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    want = []
    for q in able:
        if q % 100 == 0:
            d = sorted((float(np.sqrt(((able[q] - able[c]) ** 2).sum())), c) for c in able if c != q and len(able[c]) == len(able[q]))
            want += [(q, r + 1, c, s) for r, (s, c) in enumerate(d[:10])]
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got)
    assert [x[:3] for x in got] == [x[:3] for x in sorted(want)]
    assert np.allclose([x[3] for x in got], [x[3] for x in sorted(want)], rtol=1e-12)
    assert (2300, 1, 2301) in [x[:3] for x in got]
    assert nearest(df.limit(0), df).count() == 0 and nearest(df, df.limit(0)).count() == 0


def test_tree_prunes_and_keeps_its_recall():
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((40, 8)) * 6
    x = centres[rng.integers(40, size=6000)] + rng.standard_normal((6000, 8)) * 0.5
    ids, q = np.arange(6000), np.arange(0, 6000, 100)
    d = distances(x[q], x)
    d[np.arange(len(q)), q] = np.inf
    want = np.argsort(d, axis=1, kind="stable")[:, :10]
    seen = []
    for factor, least in ((1.0, 1.0), (2.0, 0.9)):
        tree = VPTree(ids, x)
        got = tree.search(q, x[q], 10, factor)[1]
        assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(got, want)]) >= least
        seen.append(tree.seen / d.size)
    assert seen[1] < seen[0] < 0.9


def test_registered_search_equals_sql_on_clusters(spark, tmp_path):
    import duckdb
    import pyarrow as pa
    import pyarrow.parquet as pq

    from basketflow.llm.queries import OP6_SQL, op6_vp_tree_search

    rng = np.random.default_rng(3)
    centres = rng.standard_normal((40, 8)) * 6
    x = np.float32(centres[rng.integers(40, size=6000)] + rng.standard_normal((6000, 8)) * 0.5)
    path = str(tmp_path / "embeddings.parquet")
    pq.write_table(pa.table({"vec_id": pa.array(range(6000), pa.int64()), "embedding": pa.array(x.tolist(), pa.list_(pa.float32())),
                             "label": pa.array([0] * 6000, pa.int32())}), path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{path}')")
    want = sorted(con.execute(OP6_SQL).fetchall())
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in op6_vp_tree_search(spark, str(tmp_path)).collect())
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want], rtol=1e-9)


# ---- secrets -----------------------------------------------------------------------------
def secret_docs(rng, n=300):
    hexa = lambda k: "".join(rng.choices("0123456789abcdef", k=k))
    rows = []
    for i in range(n):
        w = rng.choices("the of and with house street water running".split(), k=30)
        kind = rng.choice(["none", "token", "akia", "pass", "mail", "ip", "card", "url", "sample"])
        x = {"none": "", "token": f'token = "{hexa(40)}"', "akia": "AKIA" + "".join(rng.choices("ABCDEFGHJKLMNPQR0123456789", k=16)),
             "pass": f"password={hexa(18)}", "mail": f"bob.{rng.randrange(99)}@mail{rng.randrange(9)}.example.com", "ip": "192.168.100.200",
             "card": "".join(rng.choices("0123456789", k=16)), "url": f"https://host.org/path/page{rng.randrange(999)}/index",
             "sample": "api_key=your_key_example_123456"}[kind]
        w.insert(rng.randrange(len(w)), x)
        rows.append((i, " ".join(w), kind))
    return rows


def test_secrets_are_found_and_masked(spark):
    rows = secret_docs(random.Random(6))
    schema = "doc_id long, text string, kind string"
    df = spark.createDataFrame(rows, schema).withColumn("_f", F.lit(1)).withColumn("_row", F.lit(2))
    found = candidates(df).cache()
    texts = {i: t for i, t, _ in rows}
    assert all(texts[r.doc_id][r.start:r.start + len(r.finding)] == r.finding for r in found.collect())
    model = train_secret_filter(weak_labels(found), df)
    kind = {i: k for i, _, k in rows}
    real = {"token", "akia", "pass"}
    scored = score_findings(found, model).collect()
    assert [(kind[r.doc_id], r.finding, r.before[-12:], r.score) for r in scored if r.secret != (kind[r.doc_id] in real)] == []
    assert {r.doc_id for r in scored if r.secret} == {i for i, k in kind.items() if k in real}
    out = redact_secrets(df, model)
    assert out.columns == df.columns
    for r in out.collect():
        hidden = [x.finding for x in scored if x.doc_id == r.doc_id and x.secret]
        want = texts[r.doc_id]
        for h in hidden:
            want = want.replace(h, MASK)
        assert r.text == want


def test_secrets_without_early_digits_are_candidates(spark):
    key = "AKIA" + "QWERTYUIOPASDFGH"
    cases = [('password = "correcthorsebattery" x', "correcthorsebattery"), ('{"api_key": "QwErTyUiOpAsDfGhJkLz"}', "QwErTyUiOpAsDfGhJkLz"),
             ("password: hunter2x", "hunter2x"), ("secret: abcd1234", "abcd1234"), (f"see {key}, then", key), (f"dir/{key}/x", key),
             ("db_pass_2\t:=" + " " * 999 + "`hunter$x` y", "hunter$x"), ("token=>'abcdefgh'", "abcdefgh"),
             ("a/" * 300 + "9f8e7d6c5b4a", "a/" * 300 + "9f8e7d6c5b4a"), ("-" * 500 + "k9f8e7d6c5b4a", "-" * 500 + "k9f8e7d6c5b4a"),
             ("é\ufdd0 pwd=\ufdd0\ufdd2bcdefg\ufdd1 \ufdd0", "\ufdd0\ufdd2bcdefg\ufdd1")]
    none = ["The secretary: Johnsonville", "a compass: northwards", "the password is unknown", "passengers = plentiful"]
    rows = [(i, t) for i, t in enumerate([c[0] for c in cases] + none)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = candidates(df).collect()
    assert {(r.doc_id, r.start, r.finding) for r in found} == {(i, t.index(c), c) for i, (t, c) in enumerate(cases)}
    texts = [t.replace(c, MASK) for t, c in cases] + none
    assert [r.text for r in redact_secrets(df, SecretModel()).orderBy("doc_id").collect()] == texts
    assert [r.text for r in redact_secrets(df, SecretModel(prior=0.0)).orderBy("doc_id").collect()] == [t for _, t in rows]


def test_secrets_odd_texts(spark):
    many = " ".join(f"password=abc{i}defghi" for i in range(400))
    rows = [(1, None), (2, ""), (3, "nothing"), (None, "token=abcdef123456"), (4, many), (4, "AKIA" + "Q1" * 8), (5, "x" * 200_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = candidates(df)
    assert found.where("doc_id = 4").count() == 401 and found.where("doc_id is null").count() == 1 and found.count() == 402
    # One label only: every candidate scores it; none: nothing can be called false.
    assert train_secret_filter(weak_labels(found), df).prior == 1.0
    assert train_secret_filter(weak_labels(found.limit(0)), df) == SecretModel()
    out = {(r.doc_id, len(r.text or "")) for r in redact_secrets(df, SecretModel()).collect()}
    assert (None, len("token=" + MASK)) in out and (5, 200_000) in out and (1, 0) in out
    kept = redact_secrets(df, SecretModel(prior=0.0)).collect()
    assert sorted((str(r.doc_id), r.text or "") for r in kept) == sorted((str(i), t or "") for i, t in rows)
    assert candidates(df.limit(0)).count() == 0


def test_scan_plans_have_no_python(spark):
    df = spark.createDataFrame([(1, "password=abc123def")], "doc_id long, text string")
    for out in (score_findings(candidates(df), SecretModel()), redact_secrets(df, SecretModel())):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_places_of_very_many_candidates(spark):
    """Places and masks of a text with 200,000 candidates, and of texts around
    a piece's size, against plain sums."""
    from basketflow.llm.secrets import SUM_PIECE, _sums_before
    rows = [([],)] + [([(7 * i) % 11 for i in range(n)],) for n in (1, SUM_PIECE - 1, SUM_PIECE, SUM_PIECE + 1, 5000)]
    got = spark.createDataFrame(rows, "v array<int>").select("v", _sums_before(F.col("v")).alias("s")).collect()
    for v, sums in got:
        assert sums == [sum(v[:i]) for i in range(len(v))]
    keys = [f"k{i:06d}Zq8wT3x" for i in range(200_000)]
    docs = spark.createDataFrame([(1, " ".join(keys))], "doc_id long, text string")
    found = candidates(docs).select("nth", "start", "finding").orderBy("nth").collect()
    assert [(r.nth, r.start, r.finding) for r in found] == [(i, 15 * i, k) for i, k in enumerate(keys)]
    assert redact_secrets(docs, SecretModel()).first().text == " ".join([MASK] * 200_000)


def test_context_is_that_of_the_text(spark):
    rows = [(1, "aws_access_key_id_1 = wJalrXUtnFEMI7 x"), (2, " ".join(f"k{i}Zq8wT3xyz" for i in range(30))),
            (3, "host7.example.com:8080/path/9f8e7d6c5b4a3"), (4, "é" * 60 + " abcdef123456 " + "ü" * 60)]
    found = candidates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) > 20
    for r in found:
        text, end = dict(rows)[r.doc_id], r.start + len(r.finding)
        assert (r.before, r.after) == (text[max(0, r.start - 48):r.start], text[end:end + 48])


def test_secrets_that_no_label_rule_matches(spark):
    """Keys without a name beside them, which weak_labels leaves unlabelled."""
    rng = random.Random(8)
    df = spark.createDataFrame(secret_docs(rng, 600), "doc_id long, text string, kind string")
    model = train_secret_filter(weak_labels(candidates(df)), df)
    bare = [(i, f"the {''.join(rng.choices('0123456789abcdef', k=rng.choice([32, 40])))} of") for i in range(100)]
    plain = [(i, f"the house{rng.randrange(99)}.water.street.running of 10.20.{rng.randrange(99)}.40.50 and") for i in range(100, 200)]
    found = score_findings(weak_labels(candidates(spark.createDataFrame(bare + plain, "doc_id long, text string"))), model).collect()
    keys, others = [r for r in found if r.doc_id < 100], [r for r in found if r.doc_id >= 100]
    assert len(keys) == 100 and all(r.label is None for r in keys)
    assert sum(r.secret for r in keys) >= 90 and sum(r.secret for r in others) <= len(others) / 10


def test_scored_findings_keep_clashing_columns(spark):
    row = spark.createDataFrame([("abc123def456", "", "", 7, "s", 5, "r")] * 2, "finding string, before string, after string, _x int, score string, _s int, _row string")
    got = score_findings(row, SecretModel(prior=0.25))
    assert got.columns == ["finding", "before", "after", "_x", "_s", "_row", "score", "secret"]
    assert [(r._x, r._s, r._row, r.score, r.secret) for r in got.collect()] == [(7, 5, "r", 0.25, False)] * 2
    assert score_findings(row.limit(0), SecretModel()).count() == 0
