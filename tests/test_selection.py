"""Codes as a table, exact splits, the bucket filter, hits as VARIANT."""

import random

import pytest
from pyspark.sql import functions as F

from basketflow.ml.dictionary import apply_codes, fit_codes
from basketflow.ml.features import index_strings
from basketflow.ml.selection import exact_split, order_statistic
from basketflow.operators.recommender import (
    drop_rare_buckets, frequent_buckets, item_pairs, pair_support,
)
from basketflow.session import scratch_dir
from basketflow.sources.json import read_hit_arrays, variant_product_views


def test_codes_equal_string_indexer(spark):
    rng = random.Random(1)
    values = [rng.choice(["a", "B", "b", "é", "", "z z", "10", "9"]) for _ in range(300)] + [f"id{i:04d}" for i in range(700)]
    df = spark.createDataFrame([(i, v, "x") for i, v in enumerate(values)], "i long, v string, value string").repartition(7)
    codes = fit_codes(df, "v")
    got = apply_codes(df, "v", codes)
    assert got.columns == ["i", "v", "value", "v_idx"]
    want = index_strings(["v"]).fit(df).transform(df)
    assert sorted(map(tuple, got.select("i", "v_idx").collect())) == sorted(map(tuple, want.select("i", "v_idx").collect()))
    assert sorted(r.code for r in codes.collect()) == list(range(len(set(values))))


def test_codes_of_unseen_and_null(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "v string")
    codes = fit_codes(df, "v")
    new = spark.createDataFrame([("b",), ("c",), (None,), ("a",)], "v string")
    keep = apply_codes(new, "v", codes, "o", "keep").collect()
    assert sorted((str(r.v), r.o) for r in keep) == [("None", 2.0), ("a", 0.0), ("b", 1.0), ("c", 2.0)]
    assert apply_codes(new, "v", fit_codes(df.limit(0), "v"), "o", "keep").agg(F.max("o")).first()[0] == 0.0
    with pytest.raises(Exception, match="no code for v: "):
        apply_codes(new, "v", codes).collect()
    with pytest.raises(ValueError):
        apply_codes(new, "v", codes, handle_invalid="skip")


def test_order_statistic(spark):
    rng = random.Random(2)
    values = [rng.randrange(1 << 60) for _ in range(500)] + [7] * 300 + [(1 << 60) - 1] * 3 + [0]
    df = spark.createDataFrame([(v,) for v in values], "v long").union(spark.createDataFrame([(None,)], "v long"))
    order = sorted(values)
    for k in (1, 2, 150, 301, 302, 500, 801, 802, 804):
        for bins, few in ((4096, 2000), (4, 1), (2, 5)):
            v = order[k - 1]
            assert order_statistic(df, F.col("v"), k, bins, few) == (v, order.index(v))
    with pytest.raises(ValueError):
        order_statistic(df, F.col("v"), 805)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 10, 101])
def test_exact_sizes(spark, n):
    df = spark.range(n).selectExpr("id AS k", "'x' AS v")
    train, test = exact_split(df, "k")
    got = sorted(r.k for r in train.collect()), sorted(r.k for r in test.collect())
    assert len(got[0]) == int(0.7 * n + 0.5) and sorted(got[0] + got[1]) == list(range(n))
    again = exact_split(df.repartition(5), "k")[0]
    assert sorted(r.k for r in again.collect()) == got[0]


def test_exact_split_of_a_hot_key(spark):
    """One key has most rows, many of them equal: still exact."""
    rows = [("hot", i % 3) for i in range(900)] + [(f"k{i}", i) for i in range(80)] + [(None, 1)] * 20
    df = spark.createDataFrame(rows, "k string, v long")
    for fraction in (0.05, 0.5, 0.7, 0.99, 0.0, 1.0):
        train, test = exact_split(df, "k", fraction)
        a, b = [tuple(r) for r in train.collect()], [tuple(r) for r in test.collect()]
        assert len(a) == int(fraction * 1000 + 0.5)
        assert sorted(map(str, a + b)) == sorted(map(str, rows))
        assert sorted(map(str, a)) == sorted(map(str, map(tuple, exact_split(df.repartition(3), "k", fraction)[0].collect())))


def test_bucket_filter_is_exact_and_shuffles_less(spark):
    rng = random.Random(4)
    rows = [(f"u{i}", f"i{rng.randrange(400)}") for i in range(300) for _ in range(6)] + \
        [(f"v{i}", x) for i in range(40) for x in ("p", "q", "r")]
    views = spark.createDataFrame(rows, "user string, item string")
    pairs = item_pairs(views, min_support=2)
    n = pairs.select("a", "b").distinct().count()
    for support in (2, 5):
        want = sorted(map(tuple, pair_support(views, min_support=support).collect()))
        for buckets in (64, 1 << 12, 1 << 24):
            assert sorted(map(tuple, pair_support(views, min_support=support, buckets=buckets).collect())) == want
        kept = drop_rare_buckets(pairs, support, 1 << 20).select("a", "b").distinct().count()
        assert len(want) <= kept < n / 5
        assert frequent_buckets(pairs, support, 64).count() <= 1
    with pytest.raises(ValueError):
        drop_rare_buckets(pairs, 2, 1 << 40)
    assert pair_support(views.limit(0), min_support=2, buckets=64).count() == 0


def write_text(spark, name, text):
    path = scratch_dir(spark, name)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    return path


HIT_ARRAY = """[
  { "_id": "1", "_source": { "sessionId": "s", "product": { "id": "p1", "price": 12.30, "enabled": true,
      "date": "2024-02-29T23:59:59.000Z", "tags": ["a", "b"], "characteristic": [ {"name": "n", "value": "v"} ] } } },
  { "_id": "2", "_source": { "product": { "id": "p2", "price": 7, "enabled": false, "title": "t\\nx", "other": {"x": [1]} } } },
  { "_id": "3" }
]"""


def test_hit_arrays(spark):
    hits = read_hit_arrays(spark, write_text(spark, "hits", HIT_ARRAY))
    assert hits.count() == 3
    rows = sorted(variant_product_views(hits).collect(), key=lambda r: str(r.product_id))
    none, one, two = rows
    assert (str(one.price), one.enabled, one.viewed_at.isoformat(), one.tags) == ("12.30", True, "2024-02-29T23:59:59", ["a", "b"])
    assert [tuple(c) for c in one.characteristic] == [("n", "v")] and one.session_id == "s"
    assert (str(two.price), two.enabled, two.title, two.tags, two.viewed_at) == ("7.00", False, "t\nx", None, None)
    assert none.product_id is None and none.price is None
    assert read_hit_arrays(spark, write_text(spark, "no-hits", "[]")).where("hit is not null").count() == 0
    with pytest.raises(Exception, match="MALFORMED"):
        read_hit_arrays(spark, write_text(spark, "bad", "[{")).collect()
