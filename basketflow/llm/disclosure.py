r"""Information-theoretic sanitisation of personal data.

*Base* personal data is found by form: e-mail addresses, IP addresses, payment
cards (12 to 19 digits, Luhn) and phone numbers. Every distinct value is a
protected **entity**. A **term** (a word near an entity, in lower case)
discloses it as far as the corpus ties the two together. With document counts
over all documents, N of them:

    I(t; e) = log(N * n(t, e) / (n(t) * n(e)))     pointwise mutual information
    IC(e)   = log(N / n(e))                        information content

``I / IC`` is 1 if the term occurs only with the entity and 0 if they are
independent. A term whose ratio reaches ``threshold`` in at least
``min_docs`` documents gives the entity away to who knows the corpus, and is
sanitised beside it: **generalised** to the beginning of the word (its first
``STEM`` letters and ``*``) if that class of words stays below the threshold,
else **removed**. Beside means within ``window`` words of an occurrence of the
entity, which is also how n(t, e) counts.

Scratch tables hold entities only as hashes.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left, bisect_right
from hashlib import blake2b

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.graph import written
from basketflow.llm.words import ready

#: Kinds in the order that breaks ties of equal starts.
KINDS = ("email", "ip", "card", "phone", "term")
WINDOW, MIN_DOCS, THRESHOLD, STEM, MIN_LETTERS = 10, 3, 0.8, 3, 4

_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A match begins at the first of its digits: without the look-behind a long
# run of digits would be tried from each of them.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = r"\p{L}{%d,}" % MIN_LETTERS
_TERMS = regex.compile(_TERM)
_ANY_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_NO_DIGIT = re.compile(r"[^0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

FOUND = ("struct<spans:array<struct<kind:string,start:int,end:int,entity:string>>,"
         "near:array<struct<entity:string,term:string,start:int,end:int>>>")
_EXTRA = "array<struct<start:int,rank:int,kind:string,end:int,instead:string>>"


def entity_hash(kind: int, value: str) -> str:
    return blake2b(f"{KINDS[kind]}:{value}".encode(), digest_size=12).hexdigest()


def luhn(digits: str) -> bool:
    twice = "0246813579"
    return sum(map(int, digits[-1::-2])) % 10 == -sum(int(twice[int(d)]) for d in digits[-2::-2]) % 10


def emails(text: str):
    """(start, end) of e-mail addresses, leftmost and not overlapping: around
    each @, so that a long text without one costs a search only."""
    at, after = text.find("@"), 0
    while at >= 0:
        start = at
        while start > after and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        # What stands left of this @ can't be in a later match's local part.
        after = host.end() if host else at + 1
        if host:
            yield start, after
        at = text.find("@", after)


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, normalised value) in order."""
    out = [(s, 0, e, text[s:e].lower()) for s, e in emails(text)]
    for m in _IP.finditer(text):
        # A part of more than three digits may still be small: leading zeros.
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end(), m.group()))
    for m in _CARD.finditer(text):
        digits = _NO_DIGIT.sub("", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end(), digits))
    if "+" in text:
        for m in _PHONE.finditer(text):
            digits = _NO_DIGIT.sub("", m.group())
            if 9 <= len(digits) <= 15:
                out.append((m.start(), 3, m.end(), digits))
    return sorted(out)


def _near(text: str, spans, window: int) -> list[tuple[str, str, int, int]]:
    """(entity, term, start, end) of the terms within ``window`` words of each
    span that touch no base span themselves."""
    starts = array("q", (m.start() for m in _ANY_WORD.finditer(text)))
    ends = array("q", (m.end() for m in _ANY_WORD.finditer(text)))
    covered, reach = [], 0
    for s, _, e, _ in spans:
        if e > reach:
            covered.append((max(s, reach), e))
            reach = e
    froms = [s for s, _ in covered]
    seen = {}
    for s, kind, e, value in spans:
        entity = entity_hash(kind, value)
        lo, hi = max(0, bisect_right(ends, s) - window), min(len(starts), bisect_left(starts, e) + window)
        for a, b in zip(starts[lo:hi], ends[lo:hi]):
            for m in _TERMS.finditer(text, a, b):
                i = bisect_right(froms, m.end() - 1) - 1
                if i < 0 or covered[i][1] <= m.start():
                    seen[entity, m.group(), m.start(), m.end()] = None
    return list(seen)


def _scan(window: int):
    places = [("start", pa.int32()), ("end", pa.int32())]
    kind = pa.list_(pa.struct([("kind", pa.string()), *places, ("entity", pa.string())]))
    near = pa.list_(pa.struct([("entity", pa.string()), ("term", pa.string()), *places]))

    def scan(texts: pa.Array) -> pa.Array:
        spans, terms = [], []
        for value in texts:
            text = value.as_py() or ""
            got = base_spans(text)
            spans.append([(KINDS[k], s, e, entity_hash(k, v)) for s, k, e, v in got])
            terms.append(_near(text, got, window) if got else [])
        return pa.StructArray.from_arrays([pa.array(spans, kind), pa.array(terms, near)], names=["spans", "near"])

    return scan


def _clear(texts: pa.Array) -> pa.Array:
    return pa.array([not base_spans(t.as_py() or "") for t in texts], pa.bool_())


def _masked(texts: pa.Array, spans: pa.Array) -> pa.Array:
    """Texts with their spans replaced; a span that begins inside another goes
    with it."""
    out = []
    for value, own in zip(texts, spans.to_pylist()):
        text, at, parts = value.as_py(), 0, []
        for s in own:
            if s["start"] >= at:
                parts += (text[at:s["start"]], s["instead"])
            at = max(at, s["end"])
        out.append("".join(parts) + text[at:])
    return pa.array(out, pa.string())


def find_personal(docs: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` with personal data: ``row`` (a struct of the input's
    columns, so no name clashes) with a number ``at``, its base ``spans`` (kind,
    start, end, entity hash; code points, end exclusive; ordered by start, then
    kind) and the terms ``near`` them. Written once, so the numbers stay what
    they are. A null text has none."""
    ready(docs.sparkSession)
    scan = F.arrow_udf(_scan(window), FOUND)
    rows = docs.select(F.struct("*").alias("row"), scan(F.col(text_col)).alias("f")).where(F.size("f.spans") > 0)
    return written(rows.select(F.monotonically_increasing_id().alias("at"), "row", "f.spans", "f.near"), "personal")


def _stem(term):
    """The class that a term generalises to."""
    return F.concat(F.substring(term, 1, STEM), F.lit("*"))


def disclosing_terms(found: DataFrame, texts: DataFrame, text_col: str = "text", min_docs: int = MIN_DOCS,
                     threshold: float = THRESHOLD) -> DataFrame:
    """(entity, term, ratio, general) of the terms that give an entity away;
    ``general`` is the class to write instead, null: remove.

    Joint counts come from ``found`` (:func:`find_personal`), term counts from
    all rows of ``texts``. Both are documents, counted with partial
    aggregation; a document counts a class once, whatever terms it has of it.
    Without entities in ``min_docs`` documents the result is empty.
    """
    n_docs = float(texts.count())
    both = F.flatten(F.transform("near", lambda x: F.array(
        F.struct(x["entity"].alias("entity"), F.lower(x["term"]).alias("term")),
        F.struct(x["entity"].alias("entity"), _stem(F.lower(x["term"])).alias("term")))))
    joint = written(found.select(F.explode(F.array_distinct(both)).alias("p")).groupBy("p.entity", "p.term")
                    .agg(F.count("*").alias("both")).where(F.col("both") >= min_docs), "personal-joint")
    entities = found.select(F.explode(F.array_distinct("spans.entity")).alias("entity")).groupBy("entity") \
        .agg(F.count("*").alias("n_entity"))
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(f"({_TERM})"), F.lit(1)))
    terms = F.array_distinct(F.concat(words, F.transform(words, _stem)))
    counts = texts.select(F.explode(terms).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    n = F.lit(n_docs)
    scored = joint.join(entities, "entity").join(counts, "term").select("entity", "term", F.try_divide(
        F.log(n * F.col("both") / (F.col("n_term") * F.col("n_entity"))), F.log(n / F.col("n_entity"))).alias("ratio"))
    loud = written(scored.where(F.col("ratio") >= threshold), "personal-ratios")
    classes = loud.where(F.col("term").endswith("*")).select("entity", F.col("term").alias("general"), F.lit(True).alias("_loud"))
    return loud.where(~F.col("term").endswith("*")).withColumn("general", _stem(F.col("term"))) \
        .join(classes, ["entity", "general"], "left") \
        .select("entity", "term", "ratio", F.when(F.col("_loud").isNull(), F.col("general")).alias("general"))


def sanitise(docs: DataFrame, text_col: str = "text", window: int = WINDOW, min_docs: int = MIN_DOCS,
             threshold: float = THRESHOLD) -> DataFrame:
    """``row`` (the input's columns as a struct), ``spans`` and ``clean``.

    ``spans`` are the personal data of the row's text: (kind, start, end, text
    to write instead), code points, end exclusive, ordered by start, then kind;
    kind ``term`` marks what the method adds beside base data. ``clean`` is the
    text with them replaced; null stays null.

    A null or empty text has no spans; equal texts get equal spans; an empty
    table gives an empty one. Rows are kept as they are, without or with equal
    ids. Counts cover all rows and whole texts. Rows without personal data (most)
    are not moved: only the others are written, and their terms looked up by a
    join whose smaller side is written, so that Spark can split the other.
    """
    ready(docs.sparkSession)
    found = find_personal(docs, text_col, window)
    flagged = written(disclosing_terms(found, docs.select(text_col), text_col, min_docs, threshold), "personal-terms")
    near = found.select("at", F.explode("near").alias("x")) \
        .select("at", "x.entity", F.lower("x.term").alias("term"), "x.start", "x.end")
    term = F.struct("start", F.lit(KINDS.index("term")).alias("rank"), F.lit("term").alias("kind"), "end",
                    F.when(F.col("gone"), F.lit("")).otherwise(F.col("general")).alias("instead"))
    added = near.join(flagged.select("entity", "term", "general"), ["entity", "term"]).groupBy("at", "start", "end") \
        .agg(F.max(F.col("general").isNull()).alias("gone"), F.max("general").alias("general")) \
        .groupBy("at").agg(F.collect_list(term).alias("extra"))
    rank = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    base = F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["kind"].alias("kind"), s["end"].alias("end"),
        F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("instead")))
    every = F.array_sort(F.concat(base, F.coalesce("extra", F.array().cast(_EXTRA))))
    spans = F.transform("all", lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["instead"].alias("instead")))
    text = F.col("row")[text_col]
    rows = found.join(written(added, "personal-added"), "at", "left") \
        .select("row", every.alias("all")).select("row", spans.alias("spans"))
    masked = F.arrow_udf(_masked, "string")
    clear = F.arrow_udf(_clear, "boolean")
    rest = docs.select(F.struct("*").alias("row")).where(clear(text)) \
        .select("row", F.array().cast(rows.schema["spans"].dataType).alias("spans"), text.alias("clean"))
    return rows.select("row", "spans", masked(text, F.col("spans")).alias("clean")).union(rest)
