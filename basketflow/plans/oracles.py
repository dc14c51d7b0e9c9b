"""DuckDB SQL oracles of the registered queries (same column names)."""

# Distinct (basket, item) rows; item compared as text, like the Spark side.
_ORDER_PART = ("SELECT DISTINCT l_orderkey AS u, CAST(l_partkey AS VARCHAR) AS i "
               "FROM lineitem WHERE l_orderkey IS NOT NULL AND l_partkey IS NOT NULL")
_ORDER_SUPP = ("SELECT DISTINCT l_orderkey AS u, CAST(l_suppkey AS VARCHAR) AS i "
               "FROM lineitem WHERE l_orderkey IS NOT NULL AND l_suppkey IS NOT NULL")


def _pairs(views_sql: str) -> str:
    return f"""
    WITH v AS ({views_sql})
    SELECT x.i AS a, y.i AS b, COUNT(*)::BIGINT AS cnt
    FROM v x JOIN v y ON x.u = y.u AND x.i < y.i
    GROUP BY x.i, y.i HAVING COUNT(*) > 1"""


def _flat(views_sql: str) -> str:
    return f"""
    WITH p AS ({_pairs(views_sql)})
    SELECT a AS item, b AS other, cnt FROM p
    UNION ALL SELECT b AS item, a AS other, cnt FROM p"""


def _text(views_sql: str) -> str:
    return f"""
    WITH f AS ({_flat(views_sql)})
    SELECT item,
           '(' || item || ',[' ||
           string_agg('(' || other || ',' || CAST(cnt AS VARCHAR) || ')', ', '
                      ORDER BY cnt DESC, other) || '])' AS payload
    FROM f GROUP BY item"""


_DOC_TOKENS_KEEP = "SELECT unnest(string_split(text, ' ')) AS word FROM documents"
_DOC_TOKENS_DROP = """
    SELECT unnest(CASE WHEN t <> '' AND rtrim(t, ' ') = '' THEN []::VARCHAR[]
                       ELSE string_split(rtrim(t, ' '), ' ') END) AS word
    FROM (SELECT ' ' || text || '  ' AS t FROM documents)"""

def _top_text(views_sql: str, n: int) -> str:
    return f"""
    WITH f AS ({_flat(views_sql)}),
    r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY cnt DESC, other) AS rn
          FROM f)
    SELECT item,
           '(' || item || ',[' ||
           string_agg('(' || other || ',' || CAST(cnt AS VARCHAR) || ')', ', '
                      ORDER BY cnt DESC, other) || '])' AS payload
    FROM r WHERE rn <= {n} GROUP BY item"""


BATCH_ORACLES = {
    "cooc_pairs": f"""
        WITH p AS ({_pairs(_ORDER_PART)})
        SELECT a AS item_a, b AS item_b, cnt FROM p""",
    "cooc_pairs_pruned": f"""
        WITH p AS ({_pairs(_ORDER_PART)})
        SELECT a AS item_a, b AS item_b, cnt FROM p""",
    "cooc_pairs_bucketed": f"""
        WITH p AS ({_pairs(_ORDER_PART)})
        SELECT a AS item_a, b AS item_b, cnt FROM p""",
    "cooc_pairs_blocked": f"""
        WITH p AS ({_pairs(_ORDER_PART)})
        SELECT a AS item_a, b AS item_b, cnt FROM p""",
    "cooc_top_recs": _top_text(_ORDER_SUPP, 3),
    "cooc_recs_chunked": f"""
        SELECT item, other, cnt, 1 AS ordered FROM ({_flat(_ORDER_SUPP)})""",
    "cooc_hot_baskets": f"""
        WITH p AS ({_pairs(
            "SELECT DISTINCT event_type AS u, CAST(user_id AS VARCHAR) AS i FROM events "
            "WHERE event_type IS NOT NULL AND user_id IS NOT NULL")})
        SELECT a AS item_a, b AS item_b, cnt FROM p""",
    "cooc_customer_pairs": f"""
        WITH p AS ({_pairs(
            "SELECT DISTINCT o.o_custkey AS u, CAST(l.l_partkey AS VARCHAR) AS i "
            "FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey "
            "WHERE o.o_custkey IS NOT NULL AND l.l_partkey IS NOT NULL")})
        SELECT a AS item_a, b AS item_b, cnt FROM p""",
    "cooc_recs_flat": _flat(_ORDER_SUPP),
    "cooc_recs_text": _text(_ORDER_SUPP),
    "cooc_baskets": f"""
        WITH v AS ({_ORDER_PART})
        SELECT u AS order_key, string_agg(i, ',' ORDER BY i) AS basket,
               COUNT(*)::BIGINT AS n
        FROM v GROUP BY u HAVING COUNT(*) > 1""",
    "parse_views": """
        SELECT CAST(o_custkey AS VARCHAR) AS "user", CAST(o_orderkey AS VARCHAR) AS item
        FROM orders""",
    "parse_edge_lines": """
        WITH l AS (SELECT o_custkey, o_orderkey, o_orderkey % 5 AS k, o_orderstatus AS st FROM orders)
        SELECT CASE k WHEN 2 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS "user",
               CASE k WHEN 0 THEN '' WHEN 2 THEN CAST(o_custkey AS VARCHAR)
                      ELSE CAST(o_orderkey AS VARCHAR) END AS item
        FROM l WHERE k <> 4""",
    "binary_values": """
        SELECT event_type AS word, COUNT(*)::BIGINT AS cnt FROM events GROUP BY 1""",
    "merge_count_maps": """
        SELECT user_id, event_type, COUNT(*)::BIGINT AS cnt FROM events GROUP BY 1, 2""",
    "cooc_text_recs": _text(
        "SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS u, CAST(l_suppkey AS VARCHAR) AS i "
        "FROM lineitem"),
    "wc_batch": f"""
        SELECT word, COUNT(*)::BIGINT AS cnt FROM ({_DOC_TOKENS_KEEP}) GROUP BY word""",
    "wc_drop_trailing": f"""
        SELECT word, COUNT(*)::BIGINT AS cnt FROM ({_DOC_TOKENS_DROP}) GROUP BY word""",
}


# ---- streaming queries: micro-batch k = k-th non-empty 10-day slice --------
_EVENT_BATCH = ("dense_rank() OVER (ORDER BY floor(date_diff('day', DATE '2024-01-01', "
                "CAST(ts AS DATE)) / 10)) - 1")
_EVENT_VIEWS = f"""
    SELECT DISTINCT bid, u, i FROM (
        SELECT {_EVENT_BATCH} AS bid, CAST(user_id AS VARCHAR) AS u,
               event_type || CAST(event_id % 7 AS VARCHAR) AS i
        FROM events)"""
_STREAM_PAIRS = f"""
    WITH d AS ({_EVENT_VIEWS})
    SELECT x.bid AS bid, x.i AS a, y.i AS b, COUNT(*) AS cnt
    FROM d x JOIN d y ON x.bid = y.bid AND x.u = y.u AND x.i < y.i
    GROUP BY 1, 2, 3"""
_STREAM_RUNNING = f"""
    WITH p AS ({_STREAM_PAIRS}),
    f AS (SELECT bid, a AS item, b AS other, cnt FROM p
          UNION ALL SELECT bid, b AS item, a AS other, cnt FROM p),
    touched AS (SELECT DISTINCT bid, item FROM f)
    SELECT t.bid::BIGINT AS batch_id, t.item, f.other, SUM(f.cnt)::BIGINT AS cnt
    FROM touched t JOIN f ON f.item = t.item AND f.bid <= t.bid
    GROUP BY 1, 2, 3"""
_UPDATE_COUNTS = f"""
    WITH s AS (SELECT {_EVENT_BATCH} AS batch_id, event_type AS word FROM events),
    c AS (SELECT batch_id, word, COUNT(*) AS n FROM s GROUP BY 1, 2)
    SELECT batch_id::BIGINT AS batch_id, word,
           (SUM(n) OVER (PARTITION BY word ORDER BY batch_id))::BIGINT AS cnt
    FROM c"""

STREAM_ORACLES = {
    "wc_stream_update": f"""
        SELECT batch_id, word, cnt, '(' || word || ',' || CAST(cnt AS VARCHAR) || ')' AS payload
        FROM ({_UPDATE_COUNTS})""",
    "wc_stream_delivered": f"""
        SELECT batch_id, '(' || word || ',' || CAST(cnt AS VARCHAR) || ')' AS payload
        FROM ({_UPDATE_COUNTS})""",
    "wc_stream_warm_start": f"""
        SELECT batch_id, word, cnt, '(' || word || ',' || CAST(cnt AS VARCHAR) || ')' AS payload
        FROM ({_UPDATE_COUNTS}) WHERE batch_id >= 1""",
    "stream_restart_counts": """
        SELECT event_type AS word, COUNT(*)::BIGINT AS cnt FROM events GROUP BY 1""",
    "wc_stream_complete": """
        WITH d AS (SELECT dense_rank() OVER (ORDER BY lang) - 1 AS r, text FROM documents),
        t AS (SELECT r, unnest(string_split(text, ' ')) AS word FROM d),
        c AS (SELECT r, word, COUNT(*) AS n FROM t GROUP BY 1, 2),
        b AS (SELECT DISTINCT r AS batch_id FROM d)
        SELECT b.batch_id::BIGINT AS batch_id, c.word, SUM(c.n)::BIGINT AS cnt
        FROM b JOIN c ON c.r <= b.batch_id GROUP BY 1, 2""",
    "reco_stream_pairs": f"""
        SELECT bid::BIGINT AS batch_id, a, b, cnt::BIGINT AS cnt FROM ({_STREAM_PAIRS})""",
    "reco_stream_running": _STREAM_RUNNING,
    "reco_stream_state": f"""
        SELECT item, other, MAX(cnt)::BIGINT AS cnt FROM ({_STREAM_RUNNING}) GROUP BY 1, 2""",
    "wc_stream_state": """
        SELECT event_type AS word, COUNT(*)::BIGINT AS cnt FROM events GROUP BY 1""",
    "reco_window_pairs": """
        WITH d AS (
            SELECT DISTINCT date_trunc('day', ts) AS w, CAST(user_id AS VARCHAR) AS u,
                   event_type || CAST(event_id % 7 AS VARCHAR) AS i
            FROM events)
        SELECT strftime(x.w, '%Y-%m-%d %H:%M:%S') AS window_start, x.i AS a, y.i AS b,
               COUNT(*)::BIGINT AS cnt
        FROM d x JOIN d y ON x.w = y.w AND x.u = y.u AND x.i < y.i
        GROUP BY 1, 2, 3""",
    "reco_stream_warm_start": f"SELECT * FROM ({_STREAM_RUNNING}) WHERE batch_id >= 1",
    "reco_stream_payload": f"""
        SELECT batch_id, item,
               '(' || item || ',[' ||
               string_agg('(' || other || ',' || CAST(cnt AS VARCHAR) || ')', ', '
                          ORDER BY cnt DESC, other) || '])' AS payload
        FROM ({_STREAM_RUNNING}) GROUP BY batch_id, item""",
}


# ---- model queries ---------------------------------------------------------
def _train(key: str) -> str:
    return f"(('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8))::BIGINT % 10 < 7)"


def _rank(col: str, source: str) -> str:
    return (f"SELECT {col}, (row_number() OVER (ORDER BY COUNT(*) DESC, {col}) - 1)::DOUBLE "
            f"AS idx FROM {source} WHERE {col} IS NOT NULL GROUP BY {col}")


_LABELLED = "(SELECT d.* FROM documents d JOIN labels l USING (doc_id))"
_AUROC = """
    WITH g AS (
        SELECT CAST(c_acctbal AS DOUBLE) AS s,
               SUM(CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END) AS pos,
               SUM(CASE WHEN c_mktsegment = 'BUILDING' THEN 0 ELSE 1 END) AS neg
        FROM customer WHERE c_acctbal IS NOT NULL AND c_mktsegment IS NOT NULL
        GROUP BY 1),
    c AS (SELECT pos, neg, coalesce(SUM(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED
                 PRECEDING AND 1 PRECEDING), 0) AS below FROM g)
    SELECT round(SUM(pos * (below + neg / 2.0)) / (SUM(pos) * SUM(neg)), 6) AS auroc,
           SUM(pos)::BIGINT AS n_pos, SUM(neg)::BIGINT AS n_neg
    FROM c"""
_DOC_TEST_COUNT = (f"SELECT COUNT(*)::BIGINT AS n_test FROM {_LABELLED} t "
                   f"WHERE NOT {_train('doc_id')}")
_FLAGGED = f"""
    SELECT doc_id, CASE WHEN {_train('doc_id')} THEN 'train' ELSE 'test' END AS side,
           CASE WHEN lang IN ('de', 'es') THEN 1 ELSE 0 END AS prediction, 1 AS prob_ok
    FROM documents"""
_PART_HITS_FLAT = "SELECT 's' || CAST(p_partkey AS VARCHAR) AS session_id, " \
    "CAST(p_partkey AS VARCHAR) AS product_id, p_type AS category_title, " \
    "CAST(p_retailprice AS DOUBLE) AS price, p_brand AS characteristic_1, " \
    "CAST(p_size AS VARCHAR) AS characteristic_2, " + ", ".join(
        f"NULL::VARCHAR AS characteristic_{i}" for i in range(3, 11)) + " FROM part"

ML_ORACLES = {
    "hash_split": f"""
        SELECT c_custkey, CASE WHEN {_train('c_custkey')} THEN 'train' ELSE 'test' END AS side
        FROM customer""",
    "string_index_error": f"""
        SELECT source, idx AS source_idx FROM ({_rank('source', _LABELLED)})""",
    "string_index_keep": f"""
        WITH c AS (SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS nation, c_mktsegment
                   FROM customer),
        tr AS (SELECT * FROM c WHERE nation <> '7' AND {_train('c_custkey')}),
        n AS ({_rank('nation', 'tr')}),
        s AS ({_rank('c_mktsegment', 'tr')})
        SELECT c.c_custkey,
               coalesce(n.idx, (SELECT COUNT(*) FROM n))::DOUBLE AS nation_idx,
               coalesce(s.idx, (SELECT COUNT(*) FROM s))::DOUBLE AS segment_idx
        FROM c LEFT JOIN n ON n.nation = c.nation
        LEFT JOIN s ON s.c_mktsegment = c.c_mktsegment""",
    "assemble_features": f"""
        WITH l AS ({_rank('lang', 'documents')}), s AS ({_rank('source', 'documents')})
        SELECT d.doc_id, CAST(d.n_chars AS DOUBLE) AS f0, l.idx AS f1, s.idx AS f2
        FROM documents d JOIN l ON l.lang = d.lang JOIN s ON s.source = d.source""",
    "auroc_rank": _AUROC,
    "auroc_evaluator": f"SELECT auroc FROM ({_AUROC})",
    "rf_score": _FLAGGED,
    "dt_score": _FLAGGED,
    "gbt_score": _FLAGGED,
    "dtr_score": _FLAGGED,
    "rf_auroc": f"""
        WITH q AS (SELECT l.quality FROM documents d JOIN labels l USING (doc_id)
                   WHERE NOT {_train('doc_id')}),
        t AS (SELECT l.quality, COUNT(*) AS n FROM documents d JOIN labels l USING (doc_id)
              WHERE {_train('doc_id')} GROUP BY 1),
        rare AS (SELECT quality FROM t ORDER BY n, quality DESC LIMIT 1)
        SELECT SUM(CASE WHEN quality = (SELECT quality FROM rare) THEN 1 ELSE 0 END)::BIGINT AS n_pos,
               SUM(CASE WHEN quality = (SELECT quality FROM rare) THEN 0 ELSE 1 END)::BIGINT AS n_neg,
               1 AS agree FROM q""",
    "model_reload": f"SELECT n_test, 0::BIGINT AS n_diff FROM ({_DOC_TEST_COUNT})",
    "csv_declared_schema": """
        SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""",
    "json_views_flat": _PART_HITS_FLAT,
    "product_flag_score": f"""
        SELECT CAST(p_partkey AS VARCHAR) AS product_id,
               CASE WHEN {_train('p_partkey')} THEN 'train' ELSE 'test' END AS side,
               CASE WHEN regexp_matches(p_brand, '^Brand#[12]') THEN 1 ELSE 0 END AS prediction
        FROM part""",
    "product_views_wide": """
        SELECT CAST(l_orderkey AS VARCHAR) AS session_id,
               l_orderkey || '-' || l_linenumber || '-' || l_partkey AS product_id,
               l_returnflag AS category_title, l_extendedprice AS price,
               l_returnflag || '-1' AS characteristic_1, l_returnflag || '-10' AS characteristic_10,
               l_returnflag || '-11,' || l_returnflag || '-12' AS further
        FROM lineitem""",
    "string_index_table": f"""
        SELECT c_custkey, n.idx AS name_idx, s.idx AS segment_idx FROM customer c
        JOIN ({_rank('c_name', 'customer')}) n ON n.c_name = c.c_name
        JOIN ({_rank('c_mktsegment', 'customer')}) s ON s.c_mktsegment = c.c_mktsegment""",
    "string_index_table_keep": f"""
        WITH tr AS (SELECT CAST(l_partkey AS VARCHAR) AS part FROM lineitem WHERE {_train('l_orderkey')}),
        r AS ({_rank('part', 'tr')})
        SELECT l_partkey, coalesce(r.idx, (SELECT COUNT(*) FROM r))::DOUBLE AS part_idx, COUNT(*) AS n
        FROM lineitem LEFT JOIN r ON r.part = CAST(l_partkey AS VARCHAR) GROUP BY 1, 2""",
    "exact_split": """
        SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY substr(md5(o_orderkey::VARCHAR), 1, 15), o_orderkey)
                                     <= floor(0.7 * (SELECT COUNT(*) FROM orders) + 0.5)
                                THEN 'train' ELSE 'test' END AS side FROM orders""",
    "hit_arrays": """
        SELECT p_partkey::VARCHAR AS product_id, CAST(p_retailprice AS DECIMAL(18, 2)) AS price, p_size % 2 = 0 AS enabled,
               printf('2024-01-%02d 10:00:00', p_size % 28 + 1) AS viewed_at, p_brand || ',' || p_type AS tags,
               array_to_string(list_transform(range(0, p_size % 3 + 1), lambda i: 'n' || i || '=' || p_brand || '/' || i), ',')
                   AS characteristics
        FROM part""",
}
