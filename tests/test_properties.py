"""Property tests: random inputs against plain-Python models."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from basketflow.functions.tokens import split_drop_trailing, split_keep_all
from basketflow.operators.recommender import pair_support
from tests.test_recommender import brute_pairs

SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def keep_all_model(s):
    """Split on every single space, keeping all empty tokens."""
    return s.split(" ")


def drop_trailing_model(s):
    """Split on single spaces, then drop trailing empty tokens; an empty
    input gives one empty token."""
    if s == "":
        return [""]
    parts = s.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@SETTINGS
@given(st.lists(st.text(alphabet="ab ", max_size=8), min_size=1, max_size=30))
def test_split_rules_match_models(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    got = df.select("i", split_keep_all("value").alias("k"),
                    split_drop_trailing("value").alias("d")).orderBy("i").collect()
    assert [list(r.k) for r in got] == [keep_all_model(t) for t in texts]
    assert [list(r.d) for r in got] == [drop_trailing_model(t) for t in texts]


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 30)), min_size=1, max_size=80),
       st.sampled_from([1, 2, 3, 2048]), st.sampled_from([1, 2, 3]), st.booleans())
def test_pair_support_matches_brute_force(spark, views, block_size, min_support, prune):
    rows = [(f"u{u}", str(i)) for u, i in views]
    df = spark.createDataFrame(rows, "user string, item string")
    got = {(r.a, r.b): r.cnt for r in pair_support(df, min_support=min_support,
                                                   block_size=block_size,
                                                   prune=prune).collect()}
    assert got == brute_pairs(rows, min_support=min_support)
