"""A corpus pipeline over ``documents``, built from the operators in
``basketflow.llm``: reject toxic documents, keep one document of each
near-duplicate group, mask secrets, mix the sources to their target weights,
and encode the texts.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; all but the last return the columns of ``documents``. Between stages the
documents are written as Parquet and read again, so a lost executor never
costs more than the running stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketflow.llm.bpe import encode_documents
from basketflow.llm.graph import written
from basketflow.llm.jaccard import jaccard_components
from basketflow.llm.mixing import mixed_documents
from basketflow.llm.secrets import candidates, redact_secrets, train_secret_filter, weak_labels
from basketflow.llm.toxicity import score_toxicity, train_toxicity
from basketflow.plans.tables import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the classifier's threshold; it learns from the
    labelled ones among them. Empty and null texts stay."""
    model = train_toxicity(docs, table(spark, sf_dir, "labels"))
    rows = docs.select("text", F.struct("*").alias("_row"))
    return score_toxicity(rows, model).where("predicted = 0 or coalesce(text, '') = ''").select("_row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles (similarity 0.8 or more), the
    one with the smallest id; one row of a repeated id. Documents without
    words link with nothing and stay, as do rows without an id."""
    kept = jaccard_components(docs, k=5, percent=80).where("component_id = doc_id").select("doc_id").distinct()
    rows = docs.select("doc_id", F.xxhash64("text", "source", "lang").alias("_h"), F.struct("*").alias("_row"))
    first = Window.partitionBy("doc_id").orderBy("_h")
    one = rows.where("doc_id is not null").join(kept, "doc_id", "left_semi") \
        .withColumn("_n", F.row_number().over(first)).where("_n = 1")
    return one.select("_row").union(rows.where("doc_id is null").select("_row")).select("_row.*")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with what the trained filter takes for secrets masked
    (and ``n_chars`` of those texts counted anew)."""
    found = written(candidates(docs), "pipeline-candidates")
    model = train_secret_filter(weak_labels(found), docs)
    masked = redact_secrets(docs.select("text", F.col("text").alias("_was"), F.struct("*").alias("_row")), model)
    n_chars = F.when(F.col("text") != F.col("_was"), F.length("text").cast("long")).otherwise(F.col("_row.n_chars"))
    return masked.select(F.col("_row").withField("text", F.col("text")).withField("n_chars", n_chars).alias("_row")) \
        .select("_row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every taken text, with the digests of ids and decoding."""
    return encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("near copies", drop_near_copies),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("encoding", encode),
]

#: Not expressible in SQL (learned models, balanced sampling, BPE): tested
#: against a brute-force version in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs, "pipeline")
    return docs
