"""Secret scan with a random forest that removes false positives.

Candidates are runs of key-like characters, keys of issued formats and values
given to a secret's name, found with one regular expression.
A random forest over their length, character transitions, dictionary coverage,
path parts and neighbouring words, trained from labelled findings, scores how
likely each is a real secret. Everything is DataFrame functions: the fitted
trees become a Column expression, so scanning and redacting are one pass over
the texts without Python workers.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters of context kept on each side of a candidate.
CONTEXT = 48
#: Labelled findings per label that the forest learns from at most.
SAMPLE = 4000
TREES, DEPTH = 15, 6
#: Learned letter pairs and dictionary words at most.
PAIRS, WORDS = 120, 1000
MASK = "[SECRET]"
#: Candidates whose places are added up in one go.
SUM_PIECE = 256
# A run of 12 or more key-like characters with a digit in it, a key
# of an issued format, or the value given to a name that says it is secret.
_RUN = r"(?<![A-Za-z0-9_+/.\-])(?=[A-Za-z_+/.\-]*+[0-9])[A-Za-z0-9_+/.\-]{11,}[A-Za-z0-9_+/\-]={0,2}"
_ISSUED = (r"(?:AKIA[0-9A-Z]{16}|ASIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}"
           r"|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)")
# A value is marked in the text before the search, as a look-behind would bound
# the name and the blanks; a text's own marks are told apart by what follows.
_MARK, _OWN = "\uFDD0\uFDD2", "\uFDD0\uFDD1"
_GIVEN = (r"(?i)(?:password|passwd|passphrase|(?<![a-z])pass|pwd|secret|token|api[_-]?key|access[_-]?key|credential)s?(?![a-z])[\w-]*+"
          r"['\"`]?\s*+[=:]++>?+\s*+['\"`]?+(?=[^\s\"',;]{6})")
_VALUE = f"(?<=`{_MARK})[^\\s\"'`,;]{{6,}}|(?<={_MARK})[^\\s\"',;]{{6,}}"
CANDIDATE = f"{_RUN}|(?<![A-Za-z0-9]){_ISSUED}(?![A-Za-z0-9])|{_VALUE}"
_NAMES = r"(?i)(pass(word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential|bearer|private)"
_ASSIGNED = r"(?i)(pass(word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|credential)[\w-]*['\"`]?\s*[=:]+>?\s*['\"`]?$"
_FORMATS = f"^{_ISSUED}$"
# Code that gets a value from elsewhere.
_REFERENCE = r"^[A-Za-z_][\w.:>-]*[(\[]|^(\$[{(]|\{\{|<[A-Za-z])"
_PLACEHOLDER = r"(?i)(example|sample|dummy|changeme|placeholder|your[_-]|x{6,}|0{8,}|123456)"


@dataclass
class SecretModel:
    """Trees as nested (feature, threshold, left, right) or leaf chances, with
    the learned letter pairs and words. Without trees every candidate scores
    ``prior``."""
    trees: list = field(default_factory=list)
    pairs: list[str] = field(default_factory=list)
    words: list[str] = field(default_factory=list)
    prior: float = 1.0
    threshold: float = 0.5


def _marked(text: Column) -> Column:
    """``text`` with a mark before each value given to a secret's name."""
    return F.regexp_replace(F.replace(text, F.lit(_MARK[0]), F.lit(_OWN)), _GIVEN, "$0" + _MARK)


def _plain(marked: Column) -> Column:
    return F.replace(F.replace(marked, F.lit(_MARK), F.lit("")), F.lit(_OWN), F.lit(_MARK[0]))


def _pieces(marked: Column) -> tuple[Column, Column]:
    """(candidates, texts between them) of a marked text."""
    return tuple(F.transform(x, _plain) for x in (
        F.regexp_extract_all(marked, F.lit(CANDIDATE), F.lit(0)), F.split(marked, CANDIDATE, -1)))


def _once(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, as a lambda variable."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _sums_before(sizes: Column) -> Column:
    """For each element of an int array the sum of those before it. An array
    that is grown one by one is copied each time, so sums run inside pieces of
    SUM_PIECE, then over the pieces."""
    def running(values, of, onto):
        return F.aggregate(values, F.struct(F.lit(0).alias("at"), onto.alias("all")), lambda a, x: F.struct(
            (a["at"] + of(x)).alias("at"), F.concat(a["all"], F.array(a["at"])).alias("all")))

    none = F.array().cast("array<int>")
    numbers = lambda v: F.when(F.size(v) > 0, F.sequence(F.lit(0), F.floor((F.size(v) - 1) / SUM_PIECE).cast("int"))) \
        .otherwise(none)
    pieces = _once(sizes, lambda v: F.transform(numbers(v), lambda b: running(
        F.slice(v, b * SUM_PIECE + 1, F.lit(SUM_PIECE)), lambda x: x, none)))
    return _once(pieces, lambda p: F.flatten(F.zip_with(
        p, running(p, lambda x: x["at"], none)["all"], lambda x, at: F.transform(x["all"], lambda y: y + at))))


def _items(found: Column, between: Column) -> Column:
    """One struct per candidate: nth, start (characters from 0), finding and
    the CONTEXT characters of the text on both sides, other candidates
    included."""
    # A candidate has six characters or more, which bounds the pieces around it.
    near, edge = range(CONTEXT // 6 + 1), F.lit(CONTEXT)
    or_none = lambda x: F.coalesce(x, F.lit(""))
    tails = F.transform(between, lambda b, i: F.concat(F.right(or_none(F.get(found, i - 1)), edge), F.right(b, edge)))
    heads = F.transform(between, lambda b, i: F.concat(F.left(b, edge), F.left(or_none(F.get(found, i)), edge)))

    def items(tails: Column, heads: Column) -> Column:
        return F.transform(found, lambda c, i: F.struct(
            i.alias("nth"), c.alias("finding"), F.length(F.get(between, i)).alias("gap"),
            F.right(F.concat(*[or_none(F.get(tails, i - k)) for k in reversed(near)]), edge).alias("before"),
            F.left(F.concat(*[or_none(F.get(heads, i + 1 + k)) for k in near]), edge).alias("after")))

    item = _once(tails, lambda t: _once(heads, lambda h: items(t, h)))
    sizes = F.transform(found, lambda c, i: F.length(F.get(between, i)) + F.length(c))
    return F.zip_with(item, _sums_before(sizes), lambda x, at: F.struct(
        x["nth"], (at + x["gap"]).alias("start"), x["finding"], x["before"], x["after"]))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, nth, start, finding, before, after): every candidate of every
    whole text. A null or empty text has none, nor has an empty table; rows
    that repeat an id give their candidates each; other columns are ignored."""
    rows = docs.select(F.col(id_col), _marked(F.col(text_col)).alias("_t")).where(F.regexp_like("_t", F.lit(CANDIDATE))) \
        .select(id_col, *(c.alias(n) for n, c in zip(("_f", "_b"), _pieces(F.col("_t")))))
    return rows.select(id_col, F.explode(_items(F.col("_f"), F.col("_b"))).alias("_i")).select(id_col, "_i.*")


def weak_labels(findings: DataFrame) -> DataFrame:
    """Labelled findings where none are given: 0 for placeholders, else 1 for
    issued key formats and values assigned to a secret's name (not what code
    gets from elsewhere), else 0 for plain and dotted numbers and parts of
    addresses; the rest stay without a label."""
    c, before, after = F.col("finding"), F.col("before"), F.col("after")
    real = c.rlike(_FORMATS) | before.rlike(_ASSIGNED) & ~c.rlike(_REFERENCE)
    known = c.rlike(r"^[0-9]+$") | c.rlike(r"^v?[0-9]+([.\-][0-9]+)+$") \
        | before.rlike(r"(@|://|www\.)[^\s]*$") | after.rlike(r"^@")
    return findings.withColumn("label", F.when(c.rlike(_PLACEHOLDER), 0).when(real, 1).when(known, 0))


def features(c: Column, before: Column, after: Column, model: SecretModel) -> list[Column]:
    """The forest's inputs, in order."""
    size = F.length(c)
    share = lambda pattern: F.regexp_count(c, F.lit(pattern)) / size
    low = F.lower(c)
    pairs = F.regexp_count(low, F.lit(f"(?=({'|'.join(map(re.escape, model.pairs))}))")) if model.pairs else F.lit(0)
    cover = size - F.length(F.regexp_replace(low, "|".join(map(re.escape, model.words)), "")) if model.words else F.lit(0)
    flag = lambda x: x.cast("double")
    return [
        size, F.size(F.array_distinct(F.split(c, ""))) / size, share("[0-9]"), share("[A-Z]"), share("[a-z]"),
        share("[A-Za-z]"), share("[0-9a-fA-F]"), share(r"[_+/.=\-]"), share("(?<=[A-Za-z])[0-9]|(?<=[0-9])[A-Za-z]"),
        share("(?<=[a-z])[^a-z]|(?<=[A-Z])[^A-Z]|(?<=[0-9])[^0-9]"), share("(?<=[0-9])[0-9]"), share("(?<=[a-z])[a-z]"),
        pairs / size, cover / size,
        F.regexp_count(c, F.lit("/")), F.regexp_count(c, F.lit(r"\.")), flag(before.rlike(r"(@|://|[\\/]|www\.)[^\s]*$")),
        flag(before.rlike(r"(=|:)\s*['\"`]?$")), flag(before.rlike(r"['\"`]$")), flag(before.rlike(_NAMES + r"\W{0,4}$")),
        flag(F.concat(before, after).rlike(_NAMES)), flag(F.concat_ws(" ", before, c, after).rlike(_PLACEHOLDER)),
        flag(after.rlike(r"^(\s|$)")), flag(before.rlike(r"(^|\s)$")),
    ]


def common_words(docs: DataFrame, text_col: str = "text", n: int = WORDS) -> list[str]:
    """The dictionary: the ``n`` commonest words of 3 to 14 letters over all
    whole texts, lower-cased; ties by the word. Words that name secrets are
    left out. Only these ``n`` words reach the driver."""
    word = docs.select(F.explode(F.split(F.lower(text_col), r"[^\p{L}]+")).alias("w"))
    return _top(word.where(F.length("w").between(3, 14) & ~F.col("w").rlike(_NAMES)), n)


def _top(words: DataFrame, n: int) -> list[str]:
    return [r.w for r in words.groupBy("w").count().orderBy(F.desc("count"), "w").limit(n).collect()]


def common_pairs(words: list[str], n: int = PAIRS) -> list[str]:
    """The ``n`` commonest pairs of neighbouring letters of the dictionary."""
    count = Counter(w[i:i + 2] for w in words for i in range(len(w) - 1))
    return sorted(count, key=lambda p: (-count[p], p))[:n]


def train_secret_filter(labelled: DataFrame, docs: DataFrame, text_col: str = "text", sample: int = SAMPLE, seed: int = 3) -> SecretModel:
    """Fit the forest on at most ``sample`` findings per label (0 or 1; those
    with the smallest hash) of (finding, before, after, label), with the
    dictionary of all ``docs``. Each finding is learnt twice, in its context
    and without one: else the forest would only learn back what the labels
    were read from. With one label only, every candidate scores that label;
    with none nothing can be called false and every candidate scores 1."""
    order = [F.xxhash64("finding", "before", "after"), F.col("finding"), F.col("before"), F.col("after")]
    parts = [labelled.where(F.col("label") == y).select("finding", "before", "after", "label").orderBy(*order).limit(sample) for y in (0, 1)]
    # The bounded sample, as it goes through many passes of the fit.
    rows = parts[0].union(parts[1]).coalesce(4).persist()
    try:
        seen = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
        if len(seen) < 2:
            return SecretModel(prior=float(next(iter(seen), 1)))
        model = SecretModel(words=common_words(docs, text_col))
        model.pairs = common_pairs(model.words)
        f = features(F.col("finding"), F.col("before"), F.col("after"), model)
        bare = rows.withColumns({"before": F.lit(""), "after": F.lit("")})
        data = rows.union(bare).select(array_to_vector(F.array(*[x.cast("double") for x in f])).alias("features"), F.col("label").cast("double").alias("label"))
        forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=seed, featureSubsetStrategy="sqrt").fit(data)
        model.trees = [_tree(t._java_obj.rootNode()) for t in forest.trees]
        return model
    finally:
        rows.unpersist()


def _tree(node):
    if node.getClass().getSimpleName() == "LeafNode":
        stats = list(node.impurityStats().stats())
        return stats[1] / sum(stats)
    split = node.split()
    return int(split.featureIndex()), float(split.threshold()), _tree(node.leftChild()), _tree(node.rightChild())


def forest_score(f: Column, model: SecretModel) -> Column:
    """The forest as an expression over an array of its features."""
    def expr(tree) -> Column:
        if isinstance(tree, float):
            return F.lit(tree)
        k, at, left, right = tree
        return F.when(F.get(f, F.lit(k)) <= F.lit(at), expr(left)).otherwise(expr(right))

    if not model.trees:
        return F.lit(model.prior)
    total = F.lit(0.0)
    for t in model.trees:
        total = total + expr(t)
    return total / F.lit(float(len(model.trees)))


def score_findings(findings: DataFrame, model: SecretModel) -> DataFrame:
    """``findings`` with ``score`` and ``secret`` (score >= threshold). Columns
    of those names are replaced, all others stay; repeated rows score alike
    and an empty table gives an empty one."""
    f = features(F.col("finding"), F.col("before"), F.col("after"), model)
    got = findings.select(F.struct("*").alias("_row"), F.array(*[x.cast("double") for x in f]).alias("_x")) \
        .select("_row", forest_score(F.col("_x"), model).alias("_s"))
    kept = [F.col(f"_row.`{c}`") for c in findings.columns if c not in ("score", "secret")]
    return got.select(*kept, F.col("_s").alias("score"), (F.col("_s") >= model.threshold).alias("secret"))


def redact_secrets(docs: DataFrame, model: SecretModel, text_col: str = "text") -> DataFrame:
    """``docs`` with every candidate that the model takes for a secret replaced
    by MASK: rows, order and columns stay, other texts are untouched."""
    found, between = _pieces(F.col("_t"))
    rows = docs.select(F.struct("*").alias("_row"))
    text = F.col(f"_row.`{text_col}`")
    some = rows.withColumn("_t", _marked(text))
    some = some.withColumn("_t", F.when(F.regexp_like("_t", F.lit(CANDIDATE)), F.col("_t")))
    some = some.withColumn("_f", F.when(F.col("_t").isNotNull(), found)).withColumn("_b", F.when(F.col("_t").isNotNull(), between))
    some = some.withColumn("_i", F.transform(_items(F.col("_f"), F.col("_b")), lambda x: F.struct(
        x["nth"].alias("nth"), x["finding"].alias("finding"),
        F.array(*[v.cast("double") for v in features(x["finding"], x["before"], x["after"], model)]).alias("x"))))
    cut = F.transform(F.col("_i"), lambda x: F.concat(
        F.get("_b", x["nth"]), F.when(forest_score(x["x"], model) >= model.threshold, F.lit(MASK)).otherwise(x["finding"])))
    whole = F.concat(F.array_join(cut, ""), F.element_at("_b", -1))
    return some.select(F.col("_row").withField(f"`{text_col}`", F.when(F.col("_t").isNotNull(), whole).otherwise(text)).alias("_row")) \
        .select("_row.*")
