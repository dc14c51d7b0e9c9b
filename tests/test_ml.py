"""Models: CSV by position, indexers, pipelines, AUROC, persistence, JSON."""

import json
import os

import pytest
from pyspark.sql import functions as F

from basketflow.ml.evaluation import auroc, auroc_exact
from basketflow.ml.features import hash_split, index_strings
from basketflow.ml.models import (
    churn_pipeline, load_model, product_pipeline, save_model,
)
from basketflow.session import scratch_dir
from basketflow.sources.csv import CHURN_SCHEMA, PRODUCT_SCHEMA, read_csv_by_position
from basketflow.sources.json import flatten_product_views, read_product_views

# The reference's churn sample (header names differ from the
# schema: column 5 is "international_plan" there, "intl_plan" in the schema).
CHURN_CSV = """state,account_length,area_code,phone_number,international_plan,voice_mail_plan,number_vmail_messages,total_day_minutes,total_day_calls,total_day_charge,total_eve_minutes,total_eve_calls,total_eve_charge,total_night_minutes,total_night_calls,total_night_charge,total_intl_minutes,total_intl_calls,total_intl_charge,number_customer_service_calls,churned
state-0,1.5,area-0,phone-0,no,yes,0.25,3.25,6.25,9.25,1.25,4.25,7.25,10.25,2.25,5.25,8.25,0.25,3.25,6.25,True
state-1,2.5,area-1,phone-1,yes,no,7.25,10.25,2.25,5.25,8.25,0.25,3.25,6.25,9.25,1.25,4.25,7.25,10.25,2.25,False
state-2,3.5,area-2,phone-2,no,no,3.25,6.25,9.25,1.25,4.25,7.25,10.25,2.25,5.25,8.25,0.25,3.25,6.25,9.25,True
state-3,4.5,area-0,phone-3,yes,yes,10.25,2.25,5.25,8.25,0.25,3.25,6.25,9.25,1.25,4.25,7.25,10.25,2.25,5.25,False
state-4,5.5,area-1,phone-4,no,no,6.25,9.25,1.25,4.25,7.25,10.25,2.25,5.25,8.25,0.25,3.25,6.25,9.25,1.25,True
state-5,6.5,area-2,phone-5,yes,no,2.25,5.25,8.25,0.25,3.25,6.25,9.25,1.25,4.25,7.25,10.25,2.25,5.25,8.25,False
"""


def write_text_file(spark, path, content):
    """One small fixture file, written through Spark (shared storage)."""
    spark.createDataFrame([(content.rstrip("\n"),)], "value string") \
        .coalesce(1).write.text(path)


@pytest.fixture(scope="module")
def churn(spark):
    path = scratch_dir(spark, "churn")
    write_text_file(spark, path, CHURN_CSV)
    return read_csv_by_position(spark, path, CHURN_SCHEMA)


def test_csv_by_position(churn):
    assert churn.count() == 6
    assert churn.columns[4] == "intl_plan"
    assert churn.where(F.col("intl_plan").isNull()).count() == 0
    assert churn.first().account_length == 1.5


def test_label_indexer_ties_and_unseen(spark, churn):
    model = index_strings(["churned"], ["label"], "error").fit(churn)
    assert list(model.labelsArray[0]) == ["False", "True"]
    unseen = spark.createDataFrame([("Maybe",)], "churned string")
    with pytest.raises(Exception):
        model.transform(unseen).collect()


def test_keep_indexer_unseen_and_null(spark):
    fit = spark.createDataFrame([("a",), ("a",), ("b",)], "c string")
    model = index_strings(["c"], ["i"], "keep").fit(fit)
    test = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "c string")
    assert [r.i for r in model.transform(test).collect()] == [0.0, 1.0, 2.0, 2.0]


@pytest.mark.parametrize("kind", ["rf", "dt", "gbt", "dtr"])
def test_churn_pipeline(churn, kind):
    model = churn_pipeline(kind, seed=1).fit(churn)
    out = model.transform(churn)
    assert out.count() == 6
    assert "prediction" in out.columns


def test_churn_auroc_and_reload(spark, churn):
    model = churn_pipeline("rf", seed=1).fit(churn)
    scored = model.transform(churn)
    value = auroc(scored)
    assert 0.0 <= value <= 1.0
    path = os.path.join(scratch_dir(spark, "model"), "m")
    save_model(model, path)
    again = load_model(path).transform(churn)
    assert [r.prediction for r in scored.orderBy("total_day_minutes", "account_length",
                                                  "total_day_calls").collect()] == \
        [r.prediction for r in again.orderBy("total_day_minutes", "account_length",
                                              "total_day_calls").collect()]


def test_auroc_exact_matches_evaluator(spark):
    import random
    rnd = random.Random(5)
    rows = [(rnd.random() < 0.4, round(rnd.random(), 2)) for _ in range(3000)]
    df = spark.createDataFrame([(float(y), s) for y, s in rows], "label double, score double")
    exact = auroc_exact(df, "label", "score", positive=1.0, buckets=16).first().auroc
    ev = auroc(df, "label", "score", num_bins=0)
    assert abs(exact - ev) < 1e-9
    pos = [s for y, s in rows if y]
    neg = [s for y, s in rows if not y]
    brute = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(exact - brute) < 1e-9


@pytest.mark.parametrize("rows, counts", [
    ([], (0, 0)), ([(1.0, None), (0.0, None)], (0, 0)), ([(1.0, 0.5)], (1, 0)), ([(0.0, 0.5), (0.0, 0.5)], (0, 2))])
def test_auroc_without_both_sides_is_null(spark, rows, counts):
    got = auroc_exact(spark.createDataFrame(rows, "label double, score double"), "label", "score", 1.0).first()
    assert got.auroc is None and (got.n_pos, got.n_neg) == counts


def test_hash_split_is_partition_independent(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a, _ = hash_split(df, "k")
    b, _ = hash_split(df.repartition(7), "k")
    assert sorted(r.k for r in a.collect()) == sorted(r.k for r in b.collect())


# Invented hits: one product with characteristics, one without.
HITS = [
    {"_index": "shop", "_id": "h1", "_score": 2, "_source": {
        "@timestamp": "2024-02-03T04:05:06.000Z", "sessionId": "s-17", "product": {
            "id": "lamp-3", "price": 45.5, "title": "Desk lamp", "enabled": True,
            "category": {"title": "lighting", "parent": None, "characteristics": [],
                         "description": ""},
            "characteristic": [{"name": "colour", "value": "green"}, {"name": "height", "value": None}],
            "tags": ["desk"]}}},
    {"_index": "shop", "_id": "h2", "_score": 1, "_source": {
        "@timestamp": "2024-02-03T04:06:00.000Z", "sessionId": "s-18", "product": {
            "id": "rug-9", "price": 120, "title": "Rug", "enabled": False,
            "category": {"title": "floors", "parent": None, "characteristics": [],
                         "description": ""},
            "characteristic": [], "tags": []}}},
]


def test_json_hits_flatten(spark):
    path = scratch_dir(spark, "hits")
    write_text_file(spark, path, json.dumps(HITS, indent=2))
    flat = flatten_product_views(read_product_views(spark, path)).orderBy("product_id")
    rows = flat.collect()
    assert [(r.session_id, r.category_title, r.price, r.characteristic_1, r.characteristic_2,
             r.characteristic_3) for r in rows] == [
        ("s-17", "lighting", 45.5, "green", None, None),
        ("s-18", "floors", 120.0, None, None, None)]


def _hit_with(spark, n):
    chars = ", ".join(f"named_struct('name', 'c{i}', 'value', 'v{i}')" for i in range(n))
    return spark.range(1).selectExpr(
        "named_struct('sessionId', 's', 'product', named_struct('id', 'p', 'price', 1.0, "
        f"'category', named_struct('title', 't'), 'characteristic', array({chars}))) AS _source")


def test_further_characteristics_are_kept_or_refused(spark):
    row = flatten_product_views(_hit_with(spark, 12), further="rest").first()
    assert row.characteristic_10 == "v9" and row.rest == ["v10", "v11"]
    assert flatten_product_views(_hit_with(spark, 10)).first().characteristic_10 == "v9"
    with pytest.raises(Exception, match="more than 10 characteristics"):
        flatten_product_views(_hit_with(spark, 11)).collect()


def test_product_pipeline(spark):
    rows = []
    for i in range(40):
        chars = [f"c{(i + j) % 3}" if j < 3 else None for j in range(10)]
        rows.append((f"cat{i % 4}", float(100 + i), *chars, "True" if i % 2 else "False"))
    df = spark.createDataFrame(rows, PRODUCT_SCHEMA)
    out = product_pipeline(seed=1).fit(df).transform(df)
    assert out.count() == 40
