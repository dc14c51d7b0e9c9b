"""Registered queries of the training-data operators, one per operator.

Each applies its operator, with production parameters, to its whole table.
The digest columns a query returns are derived from the operator's output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.plans.tables import table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from basketflow.llm.substring import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"), min_words=13) \
        .select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 12], chr(10))) AS h
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
low AS (SELECT h, min(doc_id) AS first_id FROM win GROUP BY h),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS j
         FROM win JOIN low USING (h) WHERE first_id < doc_id),
cut AS (SELECT doc_id, list(j) AS js FROM gone GROUP BY doc_id),
k AS (SELECT d.doc_id, len(w) AS n_words, coalesce(len(js), 0) AS n_removed,
             CASE WHEN js IS NULL THEN w
                  ELSE list_transform(list_filter(list_zip(w, range(1, len(w) + 1)),
                                                  lambda x: NOT list_contains(js, x[2])), lambda x: x[1]) END AS kept
      FROM d LEFT JOIN cut USING (doc_id))
SELECT doc_id, n_words, n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k
"""


def op2_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from basketflow.llm.warc import archive_pages, read_bundles

    index, folder = archive_pages(table(spark, sf_dir, "pages"))
    return read_bundles(index, folder) \
        .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP2_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h)) AS payload_bytes, sha256(h) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY 1)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
       CASE WHEN d.page_id > f.first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN d.page_id > f.first_id THEN f.first_id END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)
"""


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from basketflow.llm.jaccard import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"), k=4, percent=85)


OP3_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 3], chr(10))) AS h
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b USING (h) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM pair JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.b) AS component_id
FROM d JOIN r ON r.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY 1
"""


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from basketflow.llm.language import label_texts, train_language
    from basketflow.llm.toxicity import held_out

    docs = table(spark, sf_dir, "documents")
    return label_texts(docs.select("doc_id", "text"), train_language(docs)) \
        .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from basketflow.llm.bpe import encode_documents

    return encode_documents(table(spark, sf_dir, "documents"),
                            public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
                            keep_ids=False)


def op6_vp_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from basketflow.llm.vptree import nearest

    rows = table(spark, sf_dir, "embeddings")
    return nearest(rows, rows.where(F.col("vec_id") % 100 == 0), k=10, factor=VP_FACTOR)


#: Pruning of the registered search: exact. Larger factors lose neighbours on
#: clustered vectors (README).
VP_FACTOR = 1.0

OP6_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_distance(q.e, c.e) AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from basketflow.llm.mixing import mix_sources

    return mix_sources(table(spark, sf_dir, "documents")) \
        .select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from basketflow.llm.toxicity import held_out, score_toxicity, train_toxicity

    docs = table(spark, sf_dir, "documents")
    model = train_toxicity(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs.select("doc_id", "text"), model) \
        .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op9_vector_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from basketflow.llm.vectors import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from basketflow.llm.graph import written
    from basketflow.llm.secrets import candidates, score_findings, train_secret_filter, weak_labels

    docs = table(spark, sf_dir, "documents")
    found = written(candidates(docs), "secret-candidates")
    model = train_secret_filter(weak_labels(found), docs)
    return score_findings(found, model).select("doc_id", "nth", "start", "finding", "score", "secret")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from basketflow.llm.graph import written
    from basketflow.llm.trie import prefix_trie, turn_paths

    return prefix_trie(with_shared_heads(written(turn_paths(table(spark, sf_dir, "conversations")), "turn-paths")))


def with_shared_heads(paths: DataFrame) -> DataFrame:
    """(conv_id, keys) rebuilt as the contract of op11 asks: the first
    h = crc32(conv_id) % 4 turns come from the conversation c - c % 20."""
    heads = paths.where("conv_id % 20 = 0").select(F.col("conv_id").alias("_base"), F.slice("keys", 1, 3).alias("_head"))
    rows = paths.select("conv_id", "keys", (F.col("conv_id") - F.col("conv_id") % 20).alias("_base"),
                        (F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % 4).cast("int").alias("_h"))
    head = F.slice(F.coalesce("_head", F.array().cast("array<string>")), F.lit(1), F.col("_h"))
    rest = F.slice("keys", F.col("_h") + 1, F.size("keys"))
    return rows.join(heads, "_base", "left").select("conv_id", F.concat(head, rest).alias("keys"))


#: CRC-32 of a decimal number: per character one step with it, eight without.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
  string_split({0}::VARCHAR, ''), lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END),
  4294967295::BIGINT)"""

OP11_SQL = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list({'k': md5(concat(length(r), ':', r, x)), 'w': len(regexp_extract_all(x, '[^ 	-
]+'))}
                           ORDER BY turn NULLS FIRST, r, x) AS ts FROM t GROUP BY 1),
h AS (SELECT conv_id, ts, CRC % 4 AS h FROM o),
b AS (SELECT h.conv_id, list_concat(coalesce(p.ts[1:h.h], []), h.ts[h.h + 1:]) AS ts
      FROM h LEFT JOIN o p ON p.conv_id = h.conv_id - h.conv_id % 20),
m AS (SELECT conv_id, len(ts) AS n, unnest(range(0, len(ts) + 1)) AS d, ts,
             array_to_string(list_transform(ts, lambda e: e.k), '') AS ks FROM b),
nodes AS (SELECT d, ks[1:32 * d] AS k, min(conv_id) AS conv_id, count(*) AS n_convs,
                 any_value(CASE WHEN d > 0 THEN ts[d].w ELSE 0 END) AS w,
                 sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
          FROM m GROUP BY 1, 2),
kids AS (SELECT k[1:32 * (d - 1)] AS k, count(*) AS c FROM nodes WHERE d > 0 GROUP BY 1),
up AS (SELECT k[1:32 * a] AS k, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens
       FROM (SELECT nodes.k, unnest(range(0, d + 1)) AS a, (kids.c IS NULL)::INT AS leaf, (n_convs - 1) * w AS saved
             FROM nodes LEFT JOIN kids USING (k)) GROUP BY 1)
SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.c, 0) AS n_children,
       up.n_leaves::BIGINT AS n_leaves, up.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN up USING (k) LEFT JOIN kids USING (k)
LEFT JOIN nodes p ON n.d > 0 AND p.d = n.d - 1 AND p.k = n.k[1:32 * (n.d - 1)]
""".replace("CRC", _CRC.format("conv_id"))


def op12_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    from basketflow.llm.disclosure import KINDS, sanitise

    found = sanitise(table(spark, sf_dir, "documents").select("doc_id", "text"))
    place = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    base = F.filter("spans", lambda s: s["kind"] != "term")
    kinds = F.transform("spans", lambda s: s["kind"])
    n = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("row.doc_id", *n, F.sha2(F.encode(F.array_join(F.transform(base, place), ","), "UTF-8"), 256)
                        .alias("base_sha256"), F.array_join(F.transform("spans", place), ",").alias("spans"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from basketflow.llm.periodic import collapse_runs

    return run_digests(collapse_runs(repeat_tails(table(spark, sf_dir, "documents"))))


def repeat_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with the texts the contract of op13 asks for: where
    h = crc32(doc_id) is a multiple of 10, the words from number a on repeat the
    first p of them."""
    crc = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    w = F.regexp_extract_all("text", F.lit("([^\\x20\\x09-\\x0D]+)"), F.lit(1))
    rows = docs.select("doc_id", "text", crc.alias("_h"), F.floor(crc / 10).alias("_g"),
                       F.when(crc % 10 == 0, w).alias("_w"))
    n = F.size("_w")
    rows = rows.select("*", F.when(n > 0, F.col("_g") % n).alias("_a"))
    tail = F.floor((n - F.col("_a")) / (F.lit(3) + F.col("_g") % 8)) + 1
    rows = rows.select("*", tail.alias("_p"))
    again = F.transform("_w", lambda x, i: F.when(i < F.col("_a"), x).otherwise(
        F.get("_w", (F.col("_a") + (i - F.col("_a")) % F.col("_p")).cast("int"))))
    return rows.select("doc_id", F.when(n > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """Digest columns over the runs of each document."""
    top = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("p"), r.alias("run"))))["run"]
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit(""))
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), top.alias("_top"),
                        F.sha2(F.encode(lines, "UTF-8"), 256).alias("runs_sha256"),
                        F.sha2(F.encode("kept", "UTF-8"), 256).alias("collapsed_sha256"))
    return rows.select("doc_id", "n_runs", "_top.start", "_top.length", "_top.period",
                       F.floor(1000 * F.col("_top.length") / F.col("_top.period")).alias("exponent_milli"),
                       "runs_sha256", "collapsed_sha256")


OP13_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, CRC AS h FROM documents),
a AS (SELECT doc_id, w, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d),
x AS (SELECT doc_id, CASE WHEN a IS NULL THEN w ELSE list_transform(range(0, len(w)), lambda i:
        w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (len(w) - a) // (3 + g % 8)) END]) END AS w FROM a),
t AS (SELECT doc_id, len(w) AS n, unnest(w) AS w, unnest(range(0, len(w))) AS i FROM x),
p AS (SELECT t.doc_id, u.i - t.i AS q, t.i FROM t JOIN t u ON u.doc_id = t.doc_id AND u.w = t.w AND u.i > t.i AND 2 * (u.i - t.i) <= t.n),
s AS (SELECT doc_id, q, min(i) AS s, max(i) + 1 + q AS e
      FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS g FROM p)
      GROUP BY doc_id, q, g HAVING max(i) + 1 + q - min(i) >= greatest(12, 2 * q)),
r AS (SELECT doc_id, s, e, min(q) AS q FROM s GROUP BY 1, 2, 3),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, e)) AS i FROM r),
k AS (SELECT t.doc_id, string_agg(t.w, ' ' ORDER BY t.i) AS kept FROM t ANTI JOIN gone USING (doc_id, i) GROUP BY 1),
c AS (SELECT doc_id, count(*) AS n_runs, string_agg(concat(s, ',', e - s, ',', q, chr(10)), '' ORDER BY s, q) AS runs,
             first({'s': s, 'n': e - s, 'q': q} ORDER BY e - s DESC, s, q) AS b FROM r GROUP BY 1)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, b.s AS start, b.n AS length, b.q AS period, 1000 * b.n // b.q AS exponent_milli,
       sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN k USING (doc_id)
""".replace("CRC", _CRC.format("doc_id"))


LLM_QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_warc_round_trip": op2_warc_round_trip,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_language_id": op4_language_id,
    "op5_bpe_round_trip": op5_bpe_round_trip,
    "op6_vp_tree_search": op6_vp_tree_search,
    "op7_mix_sources": op7_mix_sources,
    "op8_toxicity": op8_toxicity,
    "op9_vector_near_dedup": op9_vector_near_dedup,
    "op10_secret_scan": op10_secret_scan,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_sanitise": op12_sanitise,
    "op13_periodic_runs": op13_periodic_runs,
}

LLM_ORACLES: dict[str, str] = {
    "op1_substring_dedup": OP1_SQL,
    "op2_warc_round_trip": OP2_SQL,
    "op3_jaccard_join": OP3_SQL,
    "op11_prefix_trie": OP11_SQL,
    "op13_periodic_runs": OP13_SQL,
}
