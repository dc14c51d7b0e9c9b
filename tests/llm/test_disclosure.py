"""Personal data: forms against plain patterns, disclosure against plain counts."""

import hashlib
import math
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from basketflow.llm.disclosure import KINDS, base_spans, disclosing_terms, find_personal, luhn, sanitise

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and max(map(int, m.group().split("."))) > 255:
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and plain_luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), KINDS.index(kind), m.end()))
    return sorted(out)


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="ab1.@-+ ()5é_%0", max_size=60))
def test_base_forms(text):
    assert [s[:3] for s in base_spans(text)] == plain_spans(text)


def test_base_forms_of_joined_parts():
    rng = random.Random(2)
    parts = ["a.b@c.d", "@", "x@y", "1.2.3.4", "256.1.1.1", "01.002.3.255", "4111 1111 1111 1111", "4111111111111112",
             "+1 (743) 555-3824", "+12", ".", "-", " ", "é", "9" * 25, "5500-0000-0000-0004", "+1 2.3.4.5 6", "_q@r-.s.t"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 7)))
        assert [s[:3] for s in base_spans(text)] == plain_spans(text)
    for n in (12, 13, 19):
        d = "".join(rng.choice("0123456789") for _ in range(n))
        assert luhn(d) == plain_luhn(d)


def test_long_texts_without_matches_are_linear():
    for c in ("a", "1", "1..", "+1 ", "a@", "1 ", "@"):
        assert base_spans(c * (1_000_000 // len(c))) == []


def corpus():
    """Six documents around one address, whose neighbour 'zanzibar' occurs
    nowhere else and 'harbour' everywhere; two about another."""
    rows = [(i, f"the harbour of zanzibar writes to jo@x.example.com about p{i} things") for i in range(6)]
    rows += [(10 + i, "harbour news zandvoort beach day and more harbour") for i in range(40)]
    rows += [(60 + i, f"rarely bo@x.example.com meets quixote{'ab'[i]}") for i in range(2)]
    return rows + [(70, None), (71, ""), (None, "mail jo@x.example.com zanzibar now"), (0, rows[0][1]), (72, "ZANZIBAR 10.0.0.1")]


def test_terms_that_disclose(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.entity, r.term): r for r in disclosing_terms(find_personal(docs), docs).collect()}
    with_jo = [t for _, t in rows if t and "jo@x" in t]
    n, words = len(rows), lambda t: set(re.findall(r"[^\W\d_]{4,}", (t or "").lower()))
    want = {}
    for term in set().union(*map(words, with_jo)):
        both = sum(term in words(t.replace("jo@x.example.com", "")) for t in with_jo)
        total = sum(term in words(t) for _, t in rows)
        ratio = math.log(n * both / (total * len(with_jo))) / math.log(n / len(with_jo)) if both else 0
        if both >= 3 and ratio >= 0.8:
            want[term] = ratio
    assert want and "zanzibar" in want and "harbour" not in want
    assert {t: round(r.ratio, 9) for (_, t), r in got.items()} == {t: round(r, 9) for t, r in want.items()}
    # 'zan*' is also zandvoort, which is common: general enough. 'wri*' is not.
    general = {t: r.general for (_, t), r in got.items()}
    assert general["zanzibar"] == "zan*" and general["writes"] is None


def test_sanitised_rows(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string") \
        .selectExpr("doc_id", "text", "'s' as spans", "1 as row", "2 as clean", "3 as at")
    got = sanitise(docs).collect()
    assert sorted(str((r.row.doc_id, r.row.text)) for r in got) == sorted(str(r) for r in rows)
    for r in got:
        text = r.row.text or ""
        assert [(s.start, KINDS.index(s.kind), s.end) for s in r.spans if s.kind != "term"] == plain_spans(text)
        if r.row.text is None:
            assert r.clean is None
        if not plain_spans(text):
            assert r.clean == r.row.text and not r.spans
    clean = {r.row.doc_id: r.clean for r in got}
    assert clean[1] == "the harbour of zan*  to [EMAIL]  p1 " and clean[72] == "ZANZIBAR [IP]"
    assert clean[60] == "rarely [EMAIL] meets quixotea"
    assert sanitise(docs.limit(0)).count() == 0
    assert sanitise(docs.where("doc_id < 0")).count() == 0


def test_an_entity_of_every_document(spark):
    docs = spark.createDataFrame([(i, "same words jo@x.example.com again") for i in range(9)], "doc_id long, text string")
    assert {len(r.spans) for r in sanitise(docs).collect()} == {1}


def test_registered_query(spark):
    from basketflow.llm.queries import op12_sanitise
    from basketflow.plans.tables import table
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in op12_sanitise(spark, sf).collect()}
    docs = table(spark, sf, "documents").select("doc_id", "text").collect()
    assert len(got) == len(docs) and any(r.n_email for r in got.values())
    for d, text in docs:
        want = plain_spans(text or "")
        line = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in want)
        r = got[d]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in want) for i in range(4)]
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert ",".join(x for x in r.spans.split(",") if not x.startswith("term")) == line


def test_equal_rows_and_repeats(spark):
    docs = spark.createDataFrame([(1, "card 4111 1111 1111 1111 x")] * 3, "doc_id long, text string")
    got = sanitise(docs).select(F.col("clean")).collect()
    assert [r.clean for r in got] == ["card [CARD] x"] * 3
