"""Batch co-occurrence recommender: golden output, edge cases, properties."""

import itertools
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from basketflow.functions.payload import recommendation_payload
from basketflow.operators.recommender import (
    baskets, cooccurrence, item_pairs, nest_recommendations, pair_support, placed_pair_support,
    recommendations_flat, top_neighbours,
)
from basketflow.functions.parse import parse_view_line
from basketflow.plans.batch import BATCH_QUERIES as QUERIES
from tests.conftest import SF


# An invented log: a hot user, a repeated view, a user of one item and two
# groups of items that never meet.
VIEW_LINES = [
    "mia 10", "mia 11", "mia 12", "mia 13", "mia 10", "lee 10", "lee 11",
    "pat 11", "pat 12", "pat 10", "kim 12", "kim 13", "sol 21", "sol 22",
    "zoe 22", "zoe 21", "ivy 30",
]


def golden(min_support=2):
    """Lists by brute force, sorted by count descending, then item."""
    pairs = brute_pairs([x.split(" ") for x in VIEW_LINES], min_support)
    out = {}
    for (a, b), n in pairs.items():
        out.setdefault(a, []).append((b, n))
        out.setdefault(b, []).append((a, n))
    return {k: sorted(v, key=lambda e: (-e[1], e[0])) for k, v in out.items()}


def lines_df(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def brute_pairs(views, min_support=1, min_basket=2):
    baskets_ = {}
    for u, i in views:
        baskets_.setdefault(u, set()).add(str(i))
    c = Counter()
    for items in baskets_.values():
        if len(items) < min_basket:
            continue
        for a, b in itertools.combinations(sorted(items), 2):
            c[(a, b)] += 1
    return {k: v for k, v in c.items() if v >= min_support}


def test_golden_batch(spark):
    views = parse_view_line(lines_df(spark, VIEW_LINES))
    recs = cooccurrence(views, min_support=2).collect()
    got = {r["item"]: [(e["other"], e["cnt"]) for e in r["recs"]] for r in recs}
    assert got == golden()
    assert got["12"] == [("10", 2), ("11", 2), ("13", 2)]


def test_golden_payload(spark):
    views = parse_view_line(lines_df(spark, VIEW_LINES))
    out = cooccurrence(views).select(recommendation_payload().alias("v")).collect()
    assert "(10,[(11,3), (12,2)])" in {r.v for r in out}


def test_stream_support_keeps_single_pairs(spark):
    views = parse_view_line(lines_df(spark, VIEW_LINES))
    pairs = {(r.a, r.b): r.cnt for r in pair_support(views, min_support=1).collect()}
    assert pairs[("10", "13")] == 1
    assert ("10", "13") not in {(r.a, r.b) for r in pair_support(views).collect()}


def test_lexicographic_order(spark):
    views = spark.createDataFrame([("u", 10), ("u", 9)], "user string, item long")
    b = baskets(views).collect()[0]
    assert list(b.basket) == ["10", "9"]
    p = item_pairs(views).collect()[0]
    assert (p.a, p.b) == ("10", "9")


def test_single_item_user_dropped(spark):
    views = spark.createDataFrame([("u", "1"), ("u", "1")], "user string, item string")
    assert baskets(views).count() == 0
    assert item_pairs(views).count() == 0


@pytest.mark.parametrize("block_size", [1, 2, 3, 7, 2048])
def test_blocked_pairs_equal_brute_force(spark, block_size):
    # one hot user holding most rows, plus many small baskets
    rows = [("hot", f"i{j}") for j in range(60)]
    rows += [(f"u{k}", f"i{(k * 7 + d) % 60}") for k in range(40) for d in range(4)]
    rows += [("hot", "i3"), ("u1", "i7")]
    views = spark.createDataFrame(rows, "user string, item string")
    got = {(r.a, r.b): r.cnt
           for r in pair_support(views, min_support=1, block_size=block_size).collect()}
    assert got == brute_pairs(rows)
    got2 = {(r.a, r.b): r.cnt
            for r in pair_support(views, min_support=2, block_size=block_size,
                                  prune=True).collect()}
    assert got2 == brute_pairs(rows, min_support=2)


def test_min_basket_parameter(spark):
    rows = [("a", "1"), ("a", "2"), ("b", "1"), ("b", "2"), ("b", "3"),
            ("c", "1"), ("c", "2"), ("c", "3")]
    views = spark.createDataFrame(rows, "user string, item string")
    got = {(r.a, r.b): r.cnt for r in pair_support(views, min_basket=3, min_support=1).collect()}
    assert got == brute_pairs(rows, min_basket=3)


def test_properties_on_lineitem(spark):
    from tests.conftest import SF
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    views = li.select(F.col("l_orderkey").alias("user"), F.col("l_suppkey").alias("item"))
    flat = recommendations_flat(views, min_support=1)
    rows = {(r.item, r.other): r.cnt for r in flat.collect()}
    # symmetry and no self pair
    assert all(rows[(b, a)] == n for (a, b), n in rows.items())
    assert all(a != b for a, b in rows)
    # count bounded by each item's basket count
    users = {r.item: r.n for r in views.select("user", F.col("item").cast("string"))
             .distinct().groupBy("item").agg(F.count("*").alias("n")).collect()}
    assert all(n <= min(users[a], users[b]) for (a, b), n in rows.items())
    brute = brute_pairs([(r.user, r.item) for r in views.collect()])
    assert {(a, b): n for (a, b), n in rows.items() if a < b} == brute


def test_top_neighbours_exact(spark):
    rows = [("x", f"o{j}", (j * 37) % 11) for j in range(200)] + [("y", "o1", 5)]
    flat = spark.createDataFrame(rows, "item string, other string, cnt long")
    got = top_neighbours(flat, 5, salt_buckets=8).collect()
    exp = sorted([r for r in rows if r[0] == "x"], key=lambda r: (-r[2], r[1]))[:5]
    assert sorted((r.item, r.other, r.cnt) for r in got if r.item == "x") == sorted(exp)
    assert [(r.other, r.cnt) for r in got if r.item == "y"] == [("o1", 5)]


def test_chunked_outputs_are_whole(spark):
    from basketflow.operators.recommender import nest_recommendations
    rows = [("hot", f"i{j:03d}") for j in range(50)] + [("u", "i001"), ("u", "i002")]
    views = spark.createDataFrame(rows, "user string, item string")
    parts = baskets(views, max_per_row=8).collect()
    hot = [r for r in parts if r.user == "hot"]
    assert len(hot) >= 7 and all(r.n == 50 for r in hot)
    assert sorted(i for r in hot for i in r.basket) == sorted(i for _, i in rows[:50])
    assert all(list(r.basket) == sorted(r.basket) for r in hot)
    flat = recommendations_flat(views, min_support=1)
    whole = {r.item: [(e.other, e.cnt) for e in r.recs]
             for r in nest_recommendations(flat).collect()}
    chunks = nest_recommendations(flat, max_per_row=5).collect()
    merged = {}
    for r in chunks:
        assert len(r.recs) <= 20
        merged.setdefault(r.item, []).extend((e.other, e.cnt) for e in r.recs)
    assert {k: sorted(v, key=lambda x: (-x[1], x[0])) for k, v in merged.items()} == whole


def test_hot_basket_at_default_block_size(spark):
    # one basket larger than a block (two blocks at the default 2048) and one
    # small basket sharing 60 of its items: with support >= 2 exactly the
    # pairs of the shared items survive, each seen twice
    hot = spark.range(3000).selectExpr("'hot' AS user", "CAST(id AS STRING) AS item")
    small = spark.range(0, 3000, 50).selectExpr("'small' AS user",
                                                "CAST(id AS STRING) AS item")
    got = pair_support(hot.unionByName(small), min_support=2)
    shared = sorted(str(i) for i in range(0, 3000, 50))
    expected = {(a, b) for a, b in itertools.combinations(shared, 2)}
    rows = got.collect()
    assert {(r.a, r.b) for r in rows} == expected
    assert all(r.cnt == 2 for r in rows)
    assert item_pairs(hot).count() == 3000 * 2999 // 2


def _hot(spark, n=6000):
    """One user with a third of the rows, all views distinct."""
    rows = spark.range(n).selectExpr("'hot' AS user", "concat('i', id) AS item")
    rest = spark.range(2 * n).selectExpr("concat('u', id % 500) AS user", "concat('i', id) AS item")
    return rows.union(rest)


@pytest.mark.parametrize("aqe", ["true", "false"])
def test_hot_user_is_spread_before_its_blocks(spark, aqe):
    """No partition of the sized views is far above the others."""
    from basketflow.operators.skew import with_large_size
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions",
                                          "spark.sql.autoBroadcastJoinThreshold",
                                          "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for k, v in zip(old, (aqe, "16", "-1", "false")):
            spark.conf.set(k, v)
        views = _hot(spark)
        sized = with_large_size(views, ["user"], "item", 1000, "n")
        per = [r["count"] for r in sized.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(per) == views.count()
        assert max(per) < 2 * sum(per) / 16
        assert {(r.user, r.n) for r in sized.where("n is not null").select("user", "n").distinct().collect()} == {("hot", 6000)}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_blocks_are_gathered_once(spark):
    """All branches of the pair plan read the same shuffled views."""
    plan = item_pairs(_hot(spark, 300), block_size=64)
    plan.count()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoop" not in text
    hot = pair_support(_hot(spark, 300), min_support=1, block_size=64)
    assert hot.count() == len(brute_pairs([(r.user, r.item) for r in _hot(spark, 300).collect()]))


def test_hot_baskets_query_is_multi_block(spark):
    from basketflow.operators.skew import with_large_size
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet").select(
        F.col("event_type").alias("user"), F.col("user_id").alias("item")).distinct()
    sized = with_large_size(ev, ["user"], "item", 32)
    assert sized.where("ceil(n / 32) > 1").select("user").distinct().count() == \
        ev.select("user").distinct().count()


def test_chunked_rows_hold_everything(spark):
    views = _hot(spark, 200)
    b = baskets(views, max_per_row=16).collect()
    whole = baskets(views).collect()
    assert max(len(r.basket) for r in b) < 48
    joined = {}
    for r in b:
        joined.setdefault((r.user, r.n), []).extend(r.basket)
    assert {k: sorted(v) for k, v in joined.items()} == {(r.user, r.n): list(r.basket) for r in whole}


def test_min_basket_counts_the_whole_basket_when_pruning(spark):
    rows = [("a", "1"), ("a", "2"), ("a", "3"), ("b", "1"), ("b", "2"), ("b", "9"), ("c", "1"), ("c", "2")]
    views = spark.createDataFrame(rows, "user string, item string")
    for size in (1, 2, 2048):
        got = {(r.a, r.b): r.cnt for r in pair_support(views, 3, 2, size, prune=True).collect()}
        assert got == brute_pairs(rows, min_support=2, min_basket=3) == {("1", "2"): 2}


def test_size_lookup_does_not_grow_with_partitions(spark):
    """The lookup stays below the views at any number of partitions; the
    groups that are broadcast are fewer than the partitions."""
    from basketflow.operators.skew import size_lookup, with_large_size
    views = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 300).alias("user"), F.col("id").alias("item"))
    want = {r.user: r["count"] for r in views.groupBy("user").count().collect()}
    for partitions in (1, 8, 10_000):
        hot, lookup = size_lookup(views, ["user"], 20, "n", partitions)
        assert len(want) <= lookup.count() <= 9 * 9000 // 20 and hot.count() <= partitions
        got = with_large_size(views, ["user"], "item", 20, "n", partitions)
        assert got.columns == ["user", "item", "n"]
        rows = got.collect()
        assert len(rows) == 9000 and all(r.n == want[r.user] for r in rows)
    assert [r.user for r in size_lookup(views, ["user"], 20, "n", 8)[0].collect()] == [-1]
    # A basket just above the block size is one row.
    basket = spark.range(2049).selectExpr("id % 1 AS user", "id AS item")
    others = spark.range(2_000_000).selectExpr("1 + id % 500000 AS user", "id AS item")
    assert size_lookup(basket.union(others), ["user"], 2048, "n", 200)[1].count() == 1
    assert size_lookup(basket.union(others), ["user"], 2048, "n", 10_000)[1].count() == 9
    assert size_lookup(views.limit(0), ["user"], 3, "n", 8)[1].count() == 0


def _placed_views(spark, item):
    """Small baskets, two large ones, an item in every basket, repeats and nulls."""
    rnd = random.Random(8)
    rows = [(f"u{rnd.randrange(40)}", rnd.randrange(95)) for _ in range(400)] + [(f"u{u}", 7) for u in range(40)]
    rows += [(f"hot{h}", i) for h in range(2) for i in range(60 + h)] * 2 + [(None, 3), ("u1", None)]
    return spark.createDataFrame(rows, "user string, item int").withColumn("item", F.col("item").cast(item))


@pytest.mark.parametrize("item", ["int", "string", "double"])
@pytest.mark.parametrize("block_size", [2, 8, 2048])
def test_placed_pairs_equal_shuffled_pairs(spark, item, block_size):
    views = _placed_views(spark, item)
    for kw in ({"min_support": 2}, {"min_support": 1, "min_basket": 9}):
        got = placed_pair_support(views, block_size=block_size, **kw)
        want = pair_support(views, **kw)
        assert got.schema == want.schema
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_placed_pairs_of_nothing(spark):
    assert placed_pair_support(_placed_views(spark, "int").where("false")).collect() == []


def _alike_views(spark, user, item):
    """Four large baskets whose items fall into few groups of alike ones, some
    small baskets, repeats and nulls."""
    rows = [(u, i) for i in range(150) for u in range(4) if (i % 6 + 5) >> u & 1] * 2
    rows += [(10 + i % 3, i) for i in range(140, 150)] + [(20, 3), (21, 500), (22, 500), (22, 501), (None, 3), (1, None)]
    views = spark.createDataFrame(rows, "user int, item int")
    return views.select(F.col("user").cast(user), F.col("item").cast(item))


@pytest.mark.parametrize("user,item,block_size", [
    ("string", "bigint", 1), ("string", "bigint", 8), ("int", "string", 32), ("double", "double", 8)])
def test_alike_items_are_paired_once(spark, user, item, block_size):
    """Their pairs come counted: not made per basket and then aggregated."""
    views = _alike_views(spark, user, item)
    for kw in ({"min_support": 2}, {"min_support": 1}, {"min_support": 3, "min_basket": 5}):
        got = placed_pair_support(views, block_size=block_size, **kw)
        want = pair_support(views, **kw)
        assert got.schema == want.schema
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        by_pair = re.search(r"keys=\[[^]]*\ba#\d+L?, b#", got._jdf.queryExecution().executedPlan().toString())
        assert bool(by_pair) == (block_size == 1)


def test_hot_baskets_query_pairs_once(spark):
    """Five baskets of the same users: no pair is made in each and then aggregated."""
    df = QUERIES["cooc_hot_baskets"](spark, "/root/testdata/sf0.01")
    assert not re.search(r"keys=\[[^]]*\ba#\d+L?, b#", df._jdf.queryExecution().executedPlan().toString())
    assert df.count() == 11175


@pytest.mark.parametrize("query", ["cooc_hot_baskets", "cooc_customer_pairs"])
def test_these_queries_shuffle_no_pairs(spark, query):
    df = QUERIES[query](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert keys and not [k for k in keys if re.search(r"\ba#", k) and re.search(r"\bb#", k)]


def test_chunked_lists_are_counted_once(spark):
    """The chunks' sizes come from written lists, not from a second count."""
    flat = recommendations_flat(_placed_views(spark, "int"))
    rows = nest_recommendations(flat, max_per_row=3)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(a#", plan)
    got = rows.select("item", F.explode("recs").alias("e")).select("item", "e.other", "e.cnt")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, flat.collect()))
