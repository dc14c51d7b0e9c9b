"""Edge literals for parsing, the two split rules, payloads and map merge."""

import pytest
from pyspark.sql import functions as F

from basketflow.functions.maps import merge_count_maps
from basketflow.functions.parse import parse_view_line
from basketflow.functions.payload import word_count_payload
from basketflow.functions.tokens import split_drop_trailing, split_keep_all


def one(spark, value):
    return spark.createDataFrame([(value,)], "value string")


def test_parse_fields(spark):
    df = spark.createDataFrame([("u i x",), ("u  i",), ("u ",)], "value string")
    got = [(r.user, r.item) for r in parse_view_line(df).collect()]
    assert sorted(got) == sorted([("u", "i"), ("u", ""), ("u", "")])


def test_parse_malformed(spark):
    df = spark.createDataFrame([("u",), ("a b",)], "value string")
    assert [(r.user, r.item) for r in parse_view_line(df, on_malformed="drop").collect()] \
        == [("a", "b")]
    with pytest.raises(Exception):
        parse_view_line(df, on_malformed="fail").collect()
    with pytest.raises(ValueError):
        parse_view_line(df, on_malformed="ignore")


@pytest.mark.parametrize("text,expected", [
    ("a  b  ", ["a", "", "b", "", ""]),
    ("", [""]),
    ("  ", ["", "", ""]),
])
def test_split_keep_all(spark, text, expected):
    assert one(spark, text).select(split_keep_all("value").alias("t")).first().t == expected


@pytest.mark.parametrize("text,expected", [
    ("a  b  ", ["a", "", "b"]),
    (" a", ["", "a"]),
    ("", [""]),
    ("  ", []),
    ("a", ["a"]),
])
def test_split_drop_trailing(spark, text, expected):
    assert one(spark, text).select(split_drop_trailing("value").alias("t")).first().t \
        == expected


def test_word_count_payload(spark):
    df = spark.createDataFrame([("word", 3)], "word string, cnt long")
    assert df.select(word_count_payload().alias("p")).first().p == "(word,3)"


def test_merge_count_maps(spark):
    df = spark.sql("SELECT map('a', 1L, 'b', 2L) AS m1, map('b', 5L, 'c', 1L) AS m2")
    got = df.select(merge_count_maps("m1", "m2").alias("m")).first().m
    assert got == {"a": 1, "b": 7, "c": 1}
    got = df.select(merge_count_maps(F.lit(None).cast("map<string,bigint>"), "m2")
                    .alias("m")).first().m
    assert got == {"b": 5, "c": 1}
