"""Counterfactually regularised toxicity classifier.

A logistic model over hashed words and word beginnings. Besides the usual loss
it is charged for every change of score between a labelled text and its
counterfactual, the same text with its identity terms swapped for others of
their kind. So a mere mention of a group cannot carry weight, which is what
makes false positives on neutral mentions.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.words import Words, mix, powers, slices, ready, text_buffers

# Identity terms by kind; a term is swapped for another of its
# own list.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "females", "males"),
    ("woman", "man", "girl", "boy", "female", "male"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("gay", "straight", "lesbian", "bisexual", "heterosexual", "homosexual", "transgender", "queer"),
    ("black", "white", "asian", "latino", "hispanic", "african", "european", "american"),
    ("immigrants", "natives", "refugees", "foreigners", "citizens"),
    ("disabled", "blind", "deaf", "old", "young", "elderly"),
    ("frauen", "männer", "mädchen", "jungen"), ("muslime", "christen", "juden"),
    ("femmes", "hommes", "filles", "garçons"), ("musulmans", "chrétiens", "juifs"),
    ("mujeres", "hombres", "chicas", "chicos"), ("musulmanes", "cristianos", "judíos"),
)
#: Training rows per label at most, those with the smallest id hash.
SAMPLE = 3000
#: Swap groups that are learnt from the labelled sample: terms at most, labelled
#: texts that a term must stand in, and label shares that count as alike.
TERMS, TERM_TEXTS, SHARE_STEP = 400, 10, 0.05
BITS = 17
#: Bytes of a word's beginning that are a feature of their own.
PREFIXES = (4, 5, 6)


@dataclass
class ToxicityModel:
    weights: np.ndarray
    bias: float
    threshold: float = 0.3
    #: Labelled texts learnt from, and how many of them had a counterfactual.
    n_texts: int = 0
    n_pairs: int = 0


def features(data: np.ndarray, offs: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of the distinct features of each text, in order of
    text: every word and every word beginning of PREFIXES bytes, hashed. Words
    are lower-cased (A-Z) and stripped of ASCII punctuation at both ends."""
    w = Words(_PLAIN[data], offs)
    size = w.end - w.start
    keys, docs = [w.hash], [w.doc]
    for n in PREFIXES:
        long = np.flatnonzero(size > n)
        at = w.start[long][:, None] + np.arange(n)
        h = (w.data[at].astype(np.uint64) * powers(n)).sum(axis=1, dtype=np.uint64)
        keys.append(mix(h + np.uint64(n)))
        docs.append(w.doc[long])
    key = np.concatenate(keys) >> np.uint64(64 - bits)
    code = np.unique((np.concatenate(docs).astype(np.uint64) << np.uint64(bits)) | key)
    return (code >> np.uint64(bits)).astype(np.int64), (code & np.uint64((1 << bits) - 1)).astype(np.int64)


_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
_PLAIN[[b for b in range(33, 128) if not chr(b).isalnum()]] = 0x20


def swap_identities(text: str, turn: int = 1, groups: tuple = IDENTITY_TERMS) -> str:
    """The text with each term of ``groups`` replaced by the one ``turn``
    places on in its group, going round the others of the group."""
    return _swap(text, turn, groups, _places(groups))


def _places(groups) -> dict:
    return {w: (k, i) for k, kind in enumerate(groups) for i, w in enumerate(kind)}


def _swap(text: str, turn: int, groups, places: dict) -> str:
    def other(m):
        at = places.get(m.group(0).lower())
        if at is None:
            return m.group(0)
        kind = groups[at[0]]
        # One to size - 1 places on: never the term itself.
        return kind[(at[1] + 1 + (turn - 1) % (len(kind) - 1)) % len(kind)]

    return re.sub(r"\w+", other, text)


def interchangeable(texts: list[str], labels: list[int], terms: int = TERMS, least: int = TERM_TEXTS,
                    step: float = SHARE_STEP) -> tuple:
    """Swap groups found in labelled texts: words of texts of both labels that
    stand between the same neighbours (commonest one on either side) and whose
    texts have alike shares of label 1 (same multiple of ``step``). So words
    that mark a label are never swapped for words that do not. The ``terms``
    commonest such words are grouped; a word counts once a text, ties go by
    the word. Each text is read once, linear in its words."""
    n, toxic, left, right = Counter(), Counter(), defaultdict(Counter), defaultdict(Counter)
    for text, y in zip(texts, labels):
        words = [w.lower() for w in re.findall(r"\w+", text)]
        seen = set(words)
        n.update(seen)
        if y:
            toxic.update(seen)
    some = sorted((w for w in n if n[w] >= least and 0 < toxic[w] < n[w] and w.isalpha()), key=lambda w: (-n[w], w))[:terms]
    wanted = set(some)
    for text in texts:
        words = ["", *(w.lower() for w in re.findall(r"\w+", text)), ""]
        for i in range(1, len(words) - 1):
            if words[i] in wanted:
                left[words[i]][words[i - 1]] += 1
                right[words[i]][words[i + 1]] += 1
    top = lambda c: min(c, key=lambda w: (-c[w], w))
    groups = defaultdict(list)
    for w in some:
        groups[top(left[w]), top(right[w]), int(toxic[w] / n[w] / step)].append(w)
    return tuple(tuple(sorted(g)) for _, g in sorted(groups.items()) if len(g) > 1)


class _Rows:
    """Texts as rows of hashed binary features."""

    def __init__(self, texts: list[str]):
        data, offs = text_buffers(pa.array(texts, pa.large_string()))
        row, feature = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for lo, hi in slices(offs):
            r, f = features(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
            row.append(r + lo)
            feature.append(f)
        self.row, self.feature, self.n = np.concatenate(row), np.concatenate(feature), len(texts)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.feature], self.n)

    def back(self, g: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.feature, g[self.row], width)


def fit(texts: list[str], labels: list[int], penalty: float = 2.0, ridge: float = 1e-4, steps: int = 150,
        rate: float = 0.1, groups: tuple | None = None) -> ToxicityModel:
    """Minimise log loss + penalty * (score change under identity swaps)^2 +
    ridge by Adam on the whole sample. Every labelled text is paired with its
    counterfactual, if it has terms of the swap ``groups``: by default the
    identity terms and what :func:`interchangeable` finds beside them. Without
    both labels in the sample every score is the share of label 1."""
    y = np.asarray(labels, dtype=float)
    if not len(y) or y.min() == y.max():
        return ToxicityModel(np.zeros(1 << BITS), 12.0 if len(y) and y[0] else -12.0, n_texts=len(y))
    width, rows = 1 << BITS, _Rows(texts)
    if groups is None:
        known = _places(IDENTITY_TERMS)
        found = (tuple(w for w in g if w not in known) for g in interchangeable(texts, labels))
        groups = IDENTITY_TERMS + tuple(g for g in found if len(g) > 1)
    places = _places(groups)
    swapped = [(i, _swap(t, 1 + i % 3, groups, places)) for i, t in enumerate(texts)]
    swapped = [(i, s) for i, s in swapped if s != texts[i]]
    pair, twin = np.array([i for i, _ in swapped], dtype=np.int64), _Rows([s for _, s in swapped])
    # A feature counts by how surely it marks one label: rare ones are shrunk.
    n1 = rows.back(y, width)
    n0 = rows.back(1 - y, width)
    share = y.mean()
    scale = np.abs((n1 + 2 * share) / (n1 + n0 + 2) - share) / np.sqrt(share * (1 - share)) * np.sqrt(n1 + n0) / 6
    scale = np.minimum(1.0, scale) ** 2
    rows_dot, rows_back = (lambda w: rows.dot(w * scale)), (lambda g: rows.back(g, width) * scale)
    w, b = np.zeros(width), float(np.log(share / (1 - share)))
    m, v, mb, vb = np.zeros(width), np.zeros(width), 0.0, 0.0
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-(rows_dot(w) + b)))
        g = (p - y) / len(y)
        grad, gb = rows_back(g) + ridge * w, g.sum()
        if len(pair):
            q = 1 / (1 + np.exp(-(twin.dot(w * scale) + b)))
            d = 2 * penalty * (p[pair] - q) / len(y)
            up = np.zeros(len(y))
            up[pair] = d * p[pair] * (1 - p[pair])
            down = d * q * (1 - q)
            grad += rows_back(up) - twin.back(down, width) * scale
            gb += up.sum() - down.sum()
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        w -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        b -= rate * (mb / (1 - 0.9 ** step)) / (np.sqrt(vb / (1 - 0.999 ** step)) + 1e-8)
    return ToxicityModel(w * scale, b, n_texts=len(y), n_pairs=len(pair))


def train_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id",
                   text_col: str = "text", label_col: str = "toxic", penalty: float = 2.0,
                   groups: tuple | None = None) -> ToxicityModel:
    """Fit on at most ``sample`` labelled rows per label, those with the
    smallest hash of the id, whose ``crc32(id as text) mod 4`` is not 2. Rows
    without id, text or label are not learnt from; empty tables give a model
    that calls nothing toxic. ``penalty`` and swap ``groups`` as in :func:`fit`. The bounded sample is
    gathered in one task, which trains and returns the model."""
    ready(docs.sparkSession)
    known = labels.where(F.col(label_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")) \
        .where((~held_out(F.col("_id"))) & F.col("_y").isin(0, 1))
    order = [F.xxhash64("_id"), F.col("_id")]
    picked = None
    for y in (0, 1):
        part = known.where(F.col("_y") == y).orderBy(*order).limit(sample)
        picked = part if picked is None else picked.union(part)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_t")).where("_t is not null")
    rows = texts.join(F.broadcast(picked), "_id").select("_id", "_t", "_y", F.lit(0).alias("_g"))

    def learn(table: pa.Table) -> pa.Table:
        data = sorted(zip(*(table.column(c).to_pylist() for c in ("_id", "_t", "_y"))), key=lambda r: (str(r[0]), r[1]))
        model = fit([t for _, t, _ in data], [y for _, _, y in data], penalty, groups=groups)
        return pa.table({"w": [model.weights.astype("<f4").tobytes()], "b": [model.bias], "n": [model.n_texts], "p": [model.n_pairs]})

    got = rows.groupBy("_g").applyInArrow(learn, "w binary, b double, n long, p long").first()
    if got is None:
        return ToxicityModel(np.zeros(1 << BITS), -12.0)
    return ToxicityModel(np.frombuffer(got.w, "<f4").astype(float), got.b, n_texts=got.n, n_pairs=got.p)


def held_out(doc_id):
    """Whether an id belongs to the held-out rows (a null id does not)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (score >= threshold),
    in one narrow pass over whole texts. A null text scores as the empty one;
    repeated rows score alike; an empty table gives an empty one. Existing
    columns of those names are replaced, all others stay."""
    ready(docs.sparkSession)
    weights, bias = docs.sparkSession.sparkContext.broadcast(model.weights.astype("<f4")), model.bias

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        w = weights.value
        data, offs = text_buffers(texts)
        total = np.full(len(texts), bias)
        for lo, hi in slices(offs):
            row, feature = features(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
            total[lo:hi] += np.bincount(row, w[feature], hi - lo)
        return pa.array(1 / (1 + np.exp(-np.clip(total, -30, 30))))

    return docs.withColumn("score", score(F.col(text_col))) \
        .withColumn("predicted", (F.col("score") >= model.threshold).cast("int"))
