"""Batch queries: co-occurrence recommender, parsing, word counts."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.functions.maps import merge_count_maps
from basketflow.functions.parse import message_value, parse_view_line
from basketflow.functions.payload import recommendation_payload
from basketflow.operators.recommender import (
    DEFAULT_BUCKETS,
    baskets, cooccurrence, nest_recommendations, pair_support, placed_pair_support,
    recommendations_flat, top_neighbours,
)
from basketflow.operators.wordcount import word_counts
from basketflow.plans.tables import table
from basketflow.session import scratch_dir
from basketflow.sources.views import views_from_table, views_from_text


def order_part_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baskets = orders, items = parts."""
    return views_from_table(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey")


def order_supplier_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baskets = orders, items = suppliers."""
    return views_from_table(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_suppkey")


def customer_part_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baskets = customers (all their orders), items = parts: a join of
    lineitem to orders on the order key, then only the two ids are kept."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    joined = li.join(orders, li["l_orderkey"] == orders["o_orderkey"])
    return views_from_table(joined, "o_custkey", "l_partkey")


def cooc_customer_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P6-P8 + A1 over customer baskets (tens of parts each): parts bought by
    more than one common customer."""
    return (placed_pair_support(customer_part_views(spark, sf_dir), min_support=2)
            .select(F.col("a").alias("item_a"), F.col("b").alias("item_b"), "cnt"))


def cooc_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P6-P8 + A1: pairs of parts ordered together in more than one order."""
    return (pair_support(order_part_views(spark, sf_dir), min_support=2)
            .select(F.col("a").alias("item_a"), F.col("b").alias("item_b"), "cnt"))


def cooc_recs_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 + P9, flat: supplier -> co-ordered supplier with count."""
    return recommendations_flat(order_supplier_views(spark, sf_dir), min_support=2)


def cooc_recs_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 + A3 + K2: the rendered recommendation per supplier."""
    recs = cooccurrence(order_supplier_views(spark, sf_dir), min_support=2)
    return recs.select("item", recommendation_payload("item", "recs").alias("payload"))


def cooc_pairs_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same result as ``cooc_pairs`` through the exact support pruning path
    (items in fewer than two orders removed before pairing)."""
    return (pair_support(order_part_views(spark, sf_dir), min_support=2, prune=True)
            .select(F.col("a").alias("item_a"), F.col("b").alias("item_b"), "cnt"))


def cooc_pairs_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same result as ``cooc_pairs`` through the exact two-pass bucket filter
    (pairs of rare hash buckets removed before the counting shuffle)."""
    return (pair_support(order_part_views(spark, sf_dir), min_support=2, buckets=DEFAULT_BUCKETS)
            .select(F.col("a").alias("item_a"), F.col("b").alias("item_b"), "cnt"))


def cooc_pairs_blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same result as ``cooc_pairs`` with 3-item join blocks, so every order
    with more than three parts takes the hot-basket (multi-block) path."""
    return (pair_support(order_part_views(spark, sf_dir), min_support=2, block_size=3)
            .select(F.col("a").alias("item_a"), F.col("b").alias("item_b"), "cnt"))


def cooc_top_recs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 with the exact top-3 report: the three strongest co-ordered
    suppliers per supplier (count desc, id asc), rendered as K2 text."""
    flat = recommendations_flat(order_supplier_views(spark, sf_dir), min_support=2)
    recs = nest_recommendations(top_neighbours(flat, 3))
    return recs.select("item", recommendation_payload("item", "recs").alias("payload"))


def cooc_hot_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skewed workload: baskets = event types (five baskets, each holding
    about a fifth of all rows), items = users; pairs of users active in more
    than one common event type. Blocks of 32 items, so every hot basket takes
    the multi-block path."""
    views = views_from_table(table(spark, sf_dir, "events"), "event_type", "user_id")
    return (placed_pair_support(views, min_support=2, block_size=32)
            .select(F.col("a").alias("item_a"), F.col("b").alias("item_b"), "cnt"))


def cooc_recs_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 with bounded rows (``max_per_row=8``): every supplier's list is
    split into rows of about 8 entries. Returns every entry of every row, and
    whether its row is ordered (count descending, then id)."""
    recs = cooccurrence(order_supplier_views(spark, sf_dir), min_support=2, max_per_row=8)
    key = F.transform("recs", lambda e: F.struct((-e["cnt"]).alias("k"), e["other"].alias("o")))
    rows = recs.select("item", "recs", (F.array_sort(key) == key).cast("int").alias("ordered"))
    return (rows.select("item", "ordered", F.explode("recs").alias("e"))
            .select("item", F.col("e.other").alias("other"), F.col("e.cnt").alias("cnt"), "ordered"))


def cooc_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 + P6: sorted distinct parts per order with more than one part."""
    b = baskets(order_part_views(spark, sf_dir), min_basket=2)
    return b.select(F.col("user").alias("order_key"),
                    F.array_join("basket", ",").alias("basket"), "n")


def _stage_text(df: DataFrame, spark: SparkSession, name: str) -> str:
    """Write one string column as text files under the shared scratch dir."""
    path = scratch_dir(spark, name)
    df.write.mode("overwrite").text(path)
    return path


def parse_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + P1: orders rendered as ``"<cust> <order> <status>"`` text lines,
    read back as a text source and parsed (extra field ignored)."""
    lines = table(spark, sf_dir, "orders").select(F.concat_ws(
        " ", F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string"),
        F.col("o_orderstatus")).alias("value"))
    path = _stage_text(lines, spark, "views-text")
    return views_from_text(spark, path)


def parse_edge_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 on every kind of odd line, malformed ones dropped: a doubled space
    (empty item), an extra field (ignored), a leading space (empty user) and
    a line of one field (dropped), by turns over the orders."""
    cust, order = F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string")
    kind = F.col("o_orderkey") % 5
    line = (F.when(kind == 0, F.concat(cust, F.lit("  "), order))
            .when(kind == 1, F.concat_ws(" ", cust, order, F.col("o_orderstatus"), F.lit("x")))
            .when(kind == 2, F.concat(F.lit(" "), cust, F.lit(" "), order))
            .when(kind == 4, cust)
            .otherwise(F.concat_ws(" ", cust, order)))
    return parse_view_line(table(spark, sf_dir, "orders").select(line.alias("value")),
                           on_malformed="drop")


def binary_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message values that arrive as bytes, cast and counted."""
    raw = table(spark, sf_dir, "events").select(F.encode("event_type", "UTF-8").alias("value"))
    return word_counts(raw.select(message_value("value").alias("value")), "value", "keep_all")


def merge_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's counts per event type, as a map of the even and one of
    the odd events, merged key by key."""
    ev = table(spark, sf_dir, "events").select("user_id", "event_type",
                                               (F.col("event_id") % 2).alias("half"))
    counts = ev.groupBy("user_id", "half", "event_type").agg(F.count(F.lit(1)).alias("n"))
    maps = counts.groupBy("user_id").agg(*[
        F.map_from_entries(F.collect_list(F.when(F.col("half") == h, F.struct("event_type", "n"))))
        .alias(name) for h, name in ((0, "even"), (1, "odd"))])
    return (maps.select("user_id", F.explode(merge_count_maps("even", "odd"))
                        .alias("event_type", "cnt")))


def cooc_text_recs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's batch job end to end: text file -> parse -> A5 -> K2.

    Lines are ``"<order> <supplier>"`` staged from lineitem.
    """
    lines = table(spark, sf_dir, "lineitem").select(F.concat_ws(
        " ", F.col("l_orderkey").cast("string"),
        F.col("l_suppkey").cast("string")).alias("value"))
    path = _stage_text(lines, spark, "views-lineitem")
    recs = cooccurrence(views_from_text(spark, path), min_support=2)
    return recs.select("item", recommendation_payload("item", "recs").alias("payload"))


def wc_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 + A4: word counts over whole document texts, keep-all split."""
    docs = table(spark, sf_dir, "documents").select(F.col("text").alias("value"))
    return word_counts(docs, "value", "keep_all")


def wc_drop_trailing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 + A4: drop-trailing split over padded document texts."""
    docs = table(spark, sf_dir, "documents").select(
        F.concat(F.lit(" "), F.col("text"), F.lit("  ")).alias("value"))
    return word_counts(docs, "value", "drop_trailing")


BATCH_QUERIES = {
    "cooc_pairs": cooc_pairs,
    "cooc_recs_flat": cooc_recs_flat,
    "cooc_recs_text": cooc_recs_text,
    "cooc_baskets": cooc_baskets,
    "cooc_pairs_pruned": cooc_pairs_pruned,
    "cooc_pairs_bucketed": cooc_pairs_bucketed,
    "cooc_customer_pairs": cooc_customer_pairs,
    "cooc_pairs_blocked": cooc_pairs_blocked,
    "cooc_top_recs": cooc_top_recs,
    "cooc_hot_baskets": cooc_hot_baskets,
    "cooc_recs_chunked": cooc_recs_chunked,
    "parse_views": parse_views,
    "parse_edge_lines": parse_edge_lines,
    "binary_values": binary_values,
    "merge_count_maps": merge_maps,
    "cooc_text_recs": cooc_text_recs,
    "wc_batch": wc_batch,
    "wc_drop_trailing": wc_drop_trailing,
}
