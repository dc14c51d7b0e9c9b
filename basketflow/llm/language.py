"""Language identification with a linear-chain conditional random field.

Every word of a text gets a language by forward-backward over affix, character
n-gram and lexicon features and learned transitions, so code-switched texts
keep their parts apart; a text's language is the one with the largest mean
word marginal.
"""

from __future__ import annotations

import pickle
import random
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketflow.llm.toxicity import held_out
from basketflow.llm.words import Words, free_name, mix, powers, ready, slices, text_buffers

#: Training texts per language at most, those with the smallest id hash.
SAMPLE = 120
BITS = 16
#: Words that are worked on side by side: a text's chain runs over as many
#: segments as it needs. Also the least words of a training sequence.
SEGMENT = 64
_LETTER = np.full(256, 0x20, dtype=np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


@dataclass
class LanguageModel:
    languages: list[str]
    emit: np.ndarray        # (features, languages)
    step: np.ndarray        # (languages, languages) transition weights
    first: np.ndarray       # (languages,) weights of a sequence's first word
    lexicon: np.ndarray     # sorted hashes of the words typical of a language
    lexicon_of: np.ndarray  # that language, for each


def words_of(data: np.ndarray, offs: np.ndarray) -> Words:
    """Runs of letters (a-z in either case, and all bytes beyond ASCII)."""
    return Words(_LETTER[data], offs)


def word_features(w: Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, feature), ordered by word, of the words at the indexes ``at``:
    beginnings and ends of 1 to 4 bytes, inner 2- and 3-grams, the whole word
    and its length class."""
    start, size = w.start[at], w.end[at] - w.start[at]
    word, code = [np.arange(len(at))], [mix(w.hash[at] + np.uint64(1))]

    def put(of: np.ndarray, begin: np.ndarray, n: int, kind: int) -> None:
        byte = w.data[begin[:, None] + np.arange(n)].astype(np.uint64) + np.uint64(1)
        word.append(of)
        code.append(mix((byte * powers(n + 1)[1:]).sum(axis=1, dtype=np.uint64) + np.uint64(1 + (kind * 8 + n) * 7919)))

    for n in (1, 2, 3, 4):
        of = np.flatnonzero(size >= n)
        put(of, start[of], n, 1)
        put(of, start[of] + size[of] - n, n, 2)
    for n in (2, 3):
        count = np.maximum(size - n + 1, 0)
        of = np.repeat(np.arange(len(at)), count)
        inner = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
        put(of, start[of] + inner, n, 3)
    word.append(np.arange(len(at)))
    code.append(mix(np.minimum(size, 20).astype(np.uint64) + np.uint64(11)))
    word, code = np.concatenate(word), np.concatenate(code) >> np.uint64(64 - BITS)
    order = np.argsort(word, kind="stable")
    return word[order], code[order].astype(np.int64)


def _lexicon_features(model_lexicon: np.ndarray, lexicon_of: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The language in whose lexicon each word stands, or -1."""
    if not len(model_lexicon):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(model_lexicon, hashes), len(model_lexicon) - 1)
    return np.where(model_lexicon[at] == hashes, lexicon_of[at], -1)


def _emissions(model: LanguageModel, w: Words) -> np.ndarray:
    """(words, languages) weights, worked out once per distinct word."""
    _, one, back = np.unique(w.hash, return_index=True, return_inverse=True)
    word, code = word_features(w, one)
    edge = np.searchsorted(word, np.arange(len(one)))
    e = np.add.reduceat(model.emit[code], edge, axis=0) if len(one) else np.zeros((0, len(model.languages)))
    lex = _lexicon_features(model.lexicon, model.lexicon_of, w.hash[one])
    known = np.flatnonzero(lex >= 0)
    e[known] += model.emit[(1 << BITS) + lex[known]]
    return e[back]


def forward_backward(emit: np.ndarray, live: np.ndarray, step: np.ndarray, first: np.ndarray):
    """Marginals of sequences: ``emit`` (sequences, places, languages) weights,
    ``live`` (sequences, places) which places are words. Returns (marginals,
    the scaled forward and backward messages needed for a gradient)."""
    n, length, k = emit.shape
    e = np.exp(emit - emit.max(axis=2, keepdims=True))
    t = np.exp(step)
    alpha, beta = np.empty_like(e), np.ones_like(e)
    a = np.exp(first - first.max()) * e[:, 0]
    alpha[:, 0] = a / a.sum(axis=1, keepdims=True)
    for i in range(1, length):
        a = (alpha[:, i - 1] @ t) * e[:, i]
        alpha[:, i] = a / a.sum(axis=1, keepdims=True)
    for i in range(length - 2, -1, -1):
        b = (e[:, i + 1] * beta[:, i + 1]) @ t.T
        b /= b.sum(axis=1, keepdims=True)
        beta[:, i] = np.where(live[:, i + 1, None], b, 1.0)
    p = alpha * beta
    return p / p.sum(axis=2, keepdims=True), alpha, beta, e, t


def chain_marginals(emit: np.ndarray, live: np.ndarray, text: np.ndarray, step: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Marginals of whole texts, each one chain over its segments: ``emit``
    (segments, places, languages), ``live`` which places are words, ``text`` the
    text of each segment (a text's segments in order, all but the last full).

    A segment passes messages on through the product of its places' matrices,
    so all segments are worked on at once and only one small product per
    segment runs along a text: forward messages from its first word to its
    last, backward ones from the last to the first.
    """
    n, length, k = emit.shape
    e = np.exp(emit - emit.max(axis=2, keepdims=True))
    t = np.exp(step)
    through = np.broadcast_to(np.eye(k), (n, k, k)).copy()
    for i in range(1, length):
        at = np.flatnonzero(live[:, i])
        m = (through[at] @ t) * e[at, i][:, None, :]
        through[at] = m / m.sum(axis=(1, 2), keepdims=True)
    new = np.ones(n, dtype=bool)
    new[1:] = text[1:] != text[:-1]
    heads = np.flatnonzero(new)
    count = np.diff(np.append(heads, n))
    by_length = heads[np.argsort(-count, kind="stable")]
    per = np.sort(count)[::-1]
    begin, end = np.empty((n, k)), np.ones((n, k))
    carry = np.exp(first - first.max()) * e[by_length, 0]
    for j in range(int(per[0]) if n else 0):
        at = by_length[:np.searchsorted(-per, -j, "left")] + j
        if j:
            carry = (carry[:len(at)] @ t) * e[at, 0]
        begin[at] = carry / carry.sum(axis=1, keepdims=True)
        carry = np.einsum("nk,nkl->nl", begin[at], through[at])
    for j in range(int(per[0]) - 2 if n else -1, -1, -1):
        # Texts that go on after their segment j.
        at = by_length[:np.searchsorted(-per, -(j + 1), "left")] + j
        back = np.einsum("nkl,nl->nk", through[at + 1], end[at + 1]) * e[at + 1, 0]
        back = back @ t.T
        end[at] = back / back.sum(axis=1, keepdims=True)
    alpha, beta = np.empty_like(e), np.empty_like(e)
    alpha[:, 0], beta[:, length - 1] = begin, end
    for i in range(1, length):
        a = (alpha[:, i - 1] @ t) * e[:, i]
        alpha[:, i] = a / a.sum(axis=1, keepdims=True)
    for i in range(length - 2, -1, -1):
        b = (e[:, i + 1] * beta[:, i + 1]) @ t.T
        b /= b.sum(axis=1, keepdims=True)
        beta[:, i] = np.where(live[:, i + 1, None], b, beta[:, i + 1])
    p = alpha * beta
    return p / p.sum(axis=2, keepdims=True)


def _segments(count: np.ndarray, first: np.ndarray):
    """(word index, live) of the segments that the words of each text are laid
    out in, and the text of each segment."""
    per = -(-count // SEGMENT)
    text = np.repeat(np.arange(len(count)), per)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
    at = (first[text] + nth * SEGMENT)[:, None] + np.arange(SEGMENT)
    live = at < (first[text] + count[text])[:, None]
    return np.where(live, at, 0), live, text


def _sequences(sizes: list[int]):
    """(place, live) of training sequences: successive runs, whole, until
    there are SEGMENT words."""
    starts, n, total = [0], 0, 0
    for size in sizes:
        if n >= SEGMENT:
            starts.append(total)
            n = 0
        n, total = n + size, total + size
    starts = np.array([*starts, total])
    at = starts[:-1, None] + np.arange(int(np.diff(starts).max()))
    live = at < starts[1:, None]
    return np.where(live, at, 0), live


def fit(texts: list[str], labels: list[str], steps: int = 50, rate: float = 0.25, ridge: float = 2e-6,
        seed: int = 11) -> LanguageModel:
    """Maximise the field's likelihood by Adam on code-switched sequences: the
    sample's texts, whole, are cut into runs of 6 to 40 words, the runs are
    shuffled and joined to sequences of whole runs, so that the transitions learn
    how languages change."""
    languages = sorted(set(labels))
    k, width = len(languages), (1 << BITS) + len(languages)
    data, offs = text_buffers(pa.array([t.lower() for t in texts], pa.large_string()))
    w = words_of(data, offs)
    y = np.array([languages.index(x) for x in labels], dtype=np.int64)
    rng, runs = random.Random(seed), []
    for d in range(len(texts)):
        lo, n = int(w.first[d]), int(w.count[d])
        at = 0
        while at < n:
            size = min(rng.randint(6, 40), n - at)
            runs.append((lo + at, size, y[d]))
            at += size
    rng.shuffle(runs)
    model = LanguageModel(languages, np.zeros((width, k)), np.zeros((k, k)), np.zeros(k),
                          np.zeros(0, np.uint64), np.zeros(0, np.int64))
    if not runs or k < 2:
        return model
    token = np.concatenate([np.arange(a, a + n) for a, n, _ in runs])
    gold = np.concatenate([np.full(n, v) for _, n, v in runs])
    _, one, back = np.unique(w.hash[token], return_index=True, return_inverse=True)
    # Lexicon: words of at least 3 uses, four fifths of them in one language.
    uses = np.zeros((len(one), k))
    np.add.at(uses, (back, gold), 1)
    top = uses.max(axis=1)
    typical = np.flatnonzero((top >= 3) & (top >= 0.8 * uses.sum(axis=1)))
    hashes = w.hash[token[one]]
    model.lexicon, model.lexicon_of = hashes[typical], uses[typical].argmax(axis=1)
    word, code = word_features(w, token[one])
    word = np.concatenate([word, typical])
    code = np.concatenate([code, (1 << BITS) + model.lexicon_of])
    order = np.argsort(word, kind="stable")
    word, code = word[order], code[order]
    edge = np.searchsorted(word, np.arange(len(one)))
    at, live = _sequences([n for _, n, _ in runs])
    truth = np.eye(k)[gold[at]] * live[:, :, None]
    pairs = live[:, 1:]
    true_steps = np.einsum("sik,sil->kl", truth[:, :-1] * pairs[:, :, None], truth[:, 1:])
    params = [model.emit, model.step, model.first]
    m, v = [np.zeros_like(x) for x in params], [np.zeros_like(x) for x in params]
    for n in range(1, steps + 1):
        e = np.add.reduceat(model.emit[code], edge, axis=0)[back]
        p, alpha, beta, x, t = forward_backward(e[at], live, model.step, model.first)
        right = x[:, 1:] * beta[:, 1:]
        z = np.einsum("sik,kl,sil->si", alpha[:, :-1], t, right)
        expect = np.einsum("sik,sil->kl", alpha[:, :-1] * (pairs / z)[:, :, None], right) * t
        off = ((truth - p) * live[:, :, None])[live]
        by_word = np.stack([np.bincount(back, off[:, j], len(one)) for j in range(k)], axis=1)
        g_emit = np.stack([np.bincount(code, by_word[word, j], width) for j in range(k)], axis=1)
        total = len(token)
        grads = [g_emit / total - ridge * model.emit, (true_steps - expect) / total - ridge * model.step,
                 (truth[:, 0] - p[:, 0]).sum(axis=0) / total]
        for i, (w_, g) in enumerate(zip(params, grads)):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.99 * v[i] + 0.01 * g * g
            w_ += rate * (1 - n / (steps + 1)) * (m[i] / (1 - 0.9 ** n)) / (np.sqrt(v[i] / (1 - 0.99 ** n)) + 1e-10)
    return model


def train_language(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
                   lang_col: str = "lang") -> LanguageModel:
    """Fit on at most ``sample`` texts per language (smallest id hash) whose
    ``crc32(id as text) mod 4`` is not 2; rows without id, text or language are
    not learnt from. The bounded sample is gathered in one task."""
    ready(docs.sparkSession)
    ids = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull()) \
        .select(F.col(id_col).alias("_id"), F.col(lang_col).cast("string").alias("_y")).where(~held_out(F.col("_id")))
    by_hash = Window.partitionBy("_y").orderBy(F.xxhash64("_id"), "_id")
    picked = ids.withColumn("_n", F.row_number().over(by_hash)).where(F.col("_n") <= sample).select("_id", "_y")
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_t"),
                                                           F.col(lang_col).cast("string").alias("_l"))
    rows = texts.join(F.broadcast(picked), "_id").where("_l = _y").select("_id", "_t", "_y", F.lit(0).alias("_g"))

    def learn(table: pa.Table) -> pa.Table:
        data = sorted(zip(*(table.column(c).to_pylist() for c in ("_id", "_t", "_y"))), key=lambda r: (str(r[0]), r[1]))
        return pa.table({"m": [pickle.dumps(fit([t for _, t, _ in data], [y for _, _, y in data]))]})

    got = rows.groupBy("_g").applyInArrow(learn, "m binary").first()
    if got is None:
        return LanguageModel([], np.zeros((0, 0)), np.zeros((0, 0)), np.zeros(0), np.zeros(0, np.uint64), np.zeros(0, np.int64))
    return pickle.loads(got.m)


def label_texts(docs: DataFrame, model: LanguageModel, text_col: str = "text", spans: bool = False) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (the language's mean word
    marginal), and with ``spans`` the runs of words of one language:
    ``lang_spans array<struct<start, end, lang>>`` in words.

    One narrow pass over whole texts. A null text, one without letters, or a
    model without languages gives ``und`` and score 0. Existing columns of
    those names are replaced; all other columns and rows are kept.
    """
    ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = "struct<lang_pred:string,score:double,lang_spans:array<struct<start:int,end:int,lang:string>>>"

    @F.arrow_udf(kind)
    def label(texts: pa.Array) -> pa.Array:
        m = shared.value
        names = np.array([*m.languages, "und"], dtype=object)
        data, offs = text_buffers(texts)
        best, score, parts = np.full(len(texts), len(names) - 1), np.zeros(len(texts)), [[] for _ in range(len(texts))]
        for lo, hi in slices(offs) if m.languages else ():
            w = words_of(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
            if not len(w.hash):
                continue
            at, live, text = _segments(w.count, w.first)
            p = chain_marginals(_emissions(m, w)[at], live, text, m.step, m.first) * live[:, :, None]
            seen = np.flatnonzero(w.count)
            total = np.add.reduceat(p.sum(axis=1), np.searchsorted(text, seen), axis=0) / w.count[seen, None]
            best[lo + seen] = total.argmax(axis=1)
            score[lo + seen] = np.clip(total.max(axis=1), 0, 1)
            if spans:
                word_best = p.argmax(axis=2)[live]
                for d in seen:
                    mine = word_best[w.first[d]:w.first[d + 1]]
                    cut = np.flatnonzero(np.diff(mine, prepend=-1, append=-1))
                    parts[lo + d] = [{"start": a, "end": b, "lang": names[mine[a]]} for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))
        return pa.StructArray.from_arrays([pa.array(names[best], pa.string()), pa.array(score), pa.array(parts, span)],
                                          names=["lang_pred", "score", "lang_spans"])

    letters = F.coalesce(F.regexp_like(F.col(text_col), F.lit("\\p{L}")), F.lit(False))
    at = free_name(docs, "_label")
    new = {"lang_pred": F.when(letters, F.col(f"{at}.lang_pred")).otherwise("und"),
           "score": F.when(letters, F.col(f"{at}.score")).otherwise(0.0)}
    if spans:
        new["lang_spans"] = F.when(letters, F.col(f"{at}.lang_spans")).otherwise(F.array())
    return docs.withColumn(at, label(F.lower(F.col(text_col)))).withColumns(new).drop(at)
