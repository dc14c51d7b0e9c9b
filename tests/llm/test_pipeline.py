"""The pipeline and the registered queries: contracts, guard, brute force."""

import hashlib
import os
import subprocess
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from basketflow.llm.graph import written
from basketflow.llm.queries import LLM_ORACLES, LLM_QUERIES
from tests.conftest import SF
from tests.llm import brute
from tests.test_oracles import TABLES, _digest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield c
    c.close()


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_matches_its_sql(spark, con, name):
    df = LLM_QUERIES[name](spark, SF)
    res = con.execute(LLM_ORACLES[name])
    columns = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(columns)
    assert _digest([tuple(r) for r in df.collect()], df.columns) == _digest(res.fetchall(), columns)


def test_operators_and_the_pipeline_are_registered():
    names = {n.split("_")[0] for n in entry.queries() if n.startswith("op")}
    assert names == {f"op{i}" for i in range(1, 14)} and entry.queries()["pipeline"] is corpus_pipeline.run


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "stage")
        out.append((name, docs))
    return dict(out)


def test_stages_return_documents(stages, spark):
    assert list(stages) == ["toxicity", "near copies", "secrets", "mixing", "encoding"]
    source = spark.read.parquet(f"{SF}/documents.parquet")
    for name, df in list(stages.items())[:-1]:
        assert df.dtypes == source.dtypes, name


def test_near_copies_are_those_of_brute_force(stages):
    before = [(r.doc_id, r.text) for r in stages["toxicity"].collect()]
    left = {r.doc_id for r in stages["near copies"].collect()}
    assert left == {c for _, _, c in brute.jaccard_components(before, 5, 80)}


def test_secrets_stage_changes_nothing_else(stages):
    before = {r.doc_id: r for r in stages["near copies"].collect()}
    after = {r.doc_id: r for r in stages["secrets"].collect()}
    assert before.keys() == after.keys()
    for i, r in after.items():
        if r.text == before[i].text:
            assert r == before[i]
        else:
            assert "[SECRET]" in r.text and r.n_chars == len(r.text)
    assert all("[SECRET]" in after[i].text for i, b in before.items() if 'token = "' in b.text)


def test_mixing_and_encoding_stages(stages):
    import tiktoken
    import public_tokenizers
    from basketflow.llm.bpe import read_ranks
    plain = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, special_tokens={},
                              mergeable_ranks=read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    texts = {r.doc_id: r.text for r in stages["secrets"].collect()}
    mixed = [r.doc_id for r in stages["mixing"].collect()]
    encoded = stages["encoding"].collect()
    assert sorted(mixed) == sorted(r.doc_id for r in encoded) and set(mixed) <= set(texts)
    assert max(mixed.count(i) for i in set(mixed)) <= 2
    sizes = {i: len(brute.words(t)) for i, t in texts.items()}
    assert sum(sizes[i] for i in mixed) == pytest.approx(1.5 * sum(sizes.values()), rel=0.05)
    for r in encoded:
        assert list(r.ids) == plain.encode_ordinary(texts[r.doc_id])
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_run_is_the_stages_in_order(spark, stages):
    got = corpus_pipeline.run(spark, SF).select("doc_id", "ids_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, stages["encoding"].select("doc_id", "ids_sha256").collect()))


def test_stages_take_odd_rows(spark, stages):
    rows = [(None, None, None, None, None), (None, "no id token=abcdef123456", "en", "s", 24), (900001, "", "en", None, 0),
            (900001, "", "en", None, 0), (900002, None, None, "src0", None), (900003, "word " * 30_000, "en", "src0", 1)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = spark.read.parquet(f"{SF}/documents.parquet").union(odd).withColumn("score", F.lit(1.5)).withColumn("_row", F.lit("x"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = written(stage(spark, docs, SF), "odd")
        assert out.columns == docs.columns, name
        ids = [r.doc_id for r in out.select("doc_id").collect()]
        if name in ("toxicity", "secrets"):
            assert ids.count(None) == 2 and {900001, 900002} <= set(ids)
        if name == "near copies":
            assert ids.count(None) == 2 and ids.count(900001) == 1 and 900002 in ids
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, spark.createDataFrame([], odd.schema), SF).count() == 0, name


def test_the_rest_works_without_this_package(tmp_path):
    """The entry module registers the other queries if the package is gone."""
    for x in ("__spark_entry__.py", "basketflow"):
        os.symlink(os.path.join(ROOT, x), tmp_path / x) if x.endswith(".py") else None
    (tmp_path / "basketflow").mkdir()
    for x in os.listdir(os.path.join(ROOT, "basketflow")):
        if x not in ("llm", "__pycache__"):
            os.symlink(os.path.join(ROOT, "basketflow", x), tmp_path / "basketflow" / x)
    code = ("import importlib.util, sys; sys.path.insert(0, '.'); "
            "s = importlib.util.spec_from_file_location('e', '__spark_entry__.py'); e = importlib.util.module_from_spec(s); "
            "import os; os.path.abspath = lambda p: os.path.join(os.getcwd(), os.path.basename(p)); s.loader.exec_module(e); "
            "q = e.queries(); assert 'cooc_pairs' in q and not any(n.startswith('op') or n == 'pipeline' for n in q), q")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True)
