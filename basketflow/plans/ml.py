"""Model queries: splitting, indexing, assembly, trees, AUROC, persistence,
declared-schema CSV and nested JSON sources."""

from __future__ import annotations

import os

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType, IntegerType, LongType, StringType, StructField, StructType,
)

from basketflow.functions.splits import hash_split_flag
from basketflow.ml.dictionary import apply_codes, fit_codes
from basketflow.ml.evaluation import auroc, auroc_exact
from basketflow.ml.features import (
    assemble, hash_split, index_strings, vector_column_to_array, with_sides,
)
from basketflow.ml.models import (
    feature_pipeline, load_model, product_pipeline, save_model,
)
from basketflow.ml.selection import exact_split
from basketflow.plans.tables import table
from basketflow.session import scratch_dir
from basketflow.sources.csv import read_csv_by_position
from basketflow.sources.json import (
    flatten_product_views, read_hit_arrays, read_product_views, variant_product_views,
)


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents joined to labels; label = quality as text (indexed later)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return (docs.join(labels, "doc_id")
            .select("doc_id", "lang", "source", F.col("n_chars").cast("double").alias("n_chars"),
                    F.col("quality").cast("string").alias("quality")))


def hash_split_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: deterministic 70/30 side per customer."""
    cust = table(spark, sf_dir, "customer").select("c_custkey")
    side = F.when(hash_split_flag("c_custkey", 0.7), F.lit("train")).otherwise(F.lit("test"))
    return cust.select("c_custkey", side.alias("side"))


def string_index_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: frequency-ordered index of ``source`` over labelled documents."""
    df = labelled_documents(spark, sf_dir)
    model = index_strings(["source"], ["source_idx"], "error").fit(df)
    return model.transform(df).select("source", "source_idx").distinct()


# Fixed value: the nation that the indexer's training side never sees.
UNSEEN_NATION = 7


def string_index_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: two-column indexer fitted on the train side without one nation,
    applied to every customer; that nation gets the extra index."""
    cust = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("string").alias("nation"), "c_mktsegment")
    train, _ = hash_split(cust.where(F.col("nation") != F.lit(str(UNSEEN_NATION))), "c_custkey")
    model = index_strings(["nation", "c_mktsegment"], ["nation_idx", "segment_idx"],
                          "keep").fit(train)
    return model.transform(cust).select("c_custkey", "nation_idx", "segment_idx")


def assemble_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: ``[n_chars, lang index, source index]`` per document."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", F.col("n_chars").cast("double").alias("n_chars"))
    pipe = Pipeline(stages=[index_strings(["lang", "source"], ["lang_idx", "source_idx"]),
                            assemble(["n_chars", "lang_idx", "source_idx"])])
    out = pipe.fit(docs).transform(docs)
    arr = vector_column_to_array("features")
    return out.select("doc_id", arr[0].alias("f0"), arr[1].alias("f1"), arr[2].alias("f2"))


def auroc_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M11 by the rank formula: BUILDING customers scored by balance."""
    cust = table(spark, sf_dir, "customer").select(
        (F.col("c_mktsegment") == "BUILDING").cast("int").alias("y"), "c_acctbal")
    res = auroc_exact(cust, "y", "c_acctbal")
    return res.select(F.round("auroc", 6).alias("auroc"), "n_pos", "n_neg")


def auroc_evaluator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M11 with Spark ML's evaluator (no down-sampling), same inputs."""
    cust = table(spark, sf_dir, "customer").select(
        (F.col("c_mktsegment") == "BUILDING").cast("double").alias("label"),
        F.col("c_acctbal").cast("double").alias("score"))
    value = auroc(cust, "label", "score", num_bins=0)
    return spark.createDataFrame([(round(value, 6),)], "auroc double")


def _doc_model_split(spark: SparkSession, sf_dir: str):
    df = labelled_documents(spark, sf_dir)
    return hash_split(df, "doc_id")


def _fit(pipe, train: DataFrame):
    """The training side is read by every indexer and tree pass, so it is
    kept (memory, spilling to disk) for the fit only."""
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return pipe.fit(train)
    finally:
        train.unpersist()


# Languages whose documents the learnable label marks.
FLAGGED_LANGUAGES = ("de", "es")


def _flagged_split(spark: SparkSession, sf_dir: str):
    """documents with a label that is a known function of a categorical
    feature (the language), split by document."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", F.col("n_chars").cast("double").alias("n_chars"))
    flag = F.col("lang").isin(*FLAGGED_LANGUAGES).cast("int").cast("string").alias("flag")
    return hash_split(docs.select("*", flag), "doc_id")


def _score_query(kind: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Fit on the train side, score both sides; one prediction per
        document, and whether its probabilities sum to 1 (the regressor's
        prediction is rounded)."""
        train, test = _flagged_split(spark, sf_dir)
        pipe = feature_pipeline(["lang", "source"], ["n_chars"], "flag", kind=kind,
                                seed=7, maxBins=32)
        scored = _fit(pipe, train).transform(with_sides(train, test))
        if kind == "dtr":
            pred, whole = F.round("prediction"), F.lit(1)
        else:
            total = F.aggregate(vector_column_to_array("probability"), F.lit(0.0),
                                lambda acc, x: acc + x)
            pred, whole = F.col("prediction"), (F.abs(total - 1.0) <= 1e-9).cast("int")
        # The indexer numbers the labels by frequency; back to the flag's own.
        labels = scored.select("doc_id", "side", "flag", "label", pred.alias("prediction"),
                               whole.alias("prob_ok"))
        flag_is_label = labels.where("flag = '1'").agg(F.max("label")).first()[0]
        flagged = (F.col("prediction") == F.lit(flag_is_label)).cast("int")
        return labels.select("doc_id", "side", flagged.alias("prediction"), "prob_ok")
    query.__name__ = f"{kind}_score"
    return query


def model_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: save the fitted forest pipeline, load it, score again; count rows
    whose prediction or probability changed."""
    train, test = _doc_model_split(spark, sf_dir)
    pipe = feature_pipeline(["lang", "source"], ["n_chars"], "quality", kind="rf", seed=7)
    model = _fit(pipe, train)
    path = os.path.join(scratch_dir(spark, "model"), "pipeline")
    save_model(model, path)
    again = load_model(path)
    a = model.transform(test).select("doc_id", "prediction",
                                     vector_column_to_array("probability").alias("p1"))
    b = again.transform(test).select("doc_id", F.col("prediction").alias("prediction2"),
                                     vector_column_to_array("probability").alias("p2"))
    diff = ((F.col("prediction") != F.col("prediction2")) | (F.col("p1") != F.col("p2")))
    return a.join(b, "doc_id").agg(F.count(F.lit(1)).alias("n_test"),
                                   F.sum(diff.cast("long")).cast("long").alias("n_diff"))


def rf_auroc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J5 end to end: forest on labelled documents, AUROC on the test side;
    the evaluator and the rank formula must agree."""
    train, test = _doc_model_split(spark, sf_dir)
    pipe = feature_pipeline(["lang", "source"], ["n_chars"], "quality", kind="rf", seed=7)
    scored = _fit(pipe, train).transform(test)
    ev = auroc(scored, "label", "rawPrediction", num_bins=0)
    p1 = vector_column_to_array("probability")[1]
    exact = auroc_exact(scored.select("label", p1.alias("p1")), "label", "p1", positive=1.0)
    agree = (F.abs(F.col("auroc") - F.lit(ev)) < 1e-9).cast("int")
    # The rarer quality has label 1.
    return exact.select("n_pos", "n_neg", agree.alias("agree"))


# The declared customer schema with renamed header fields.
CUSTOMER_SCHEMA = StructType([
    StructField("c_custkey", LongType()), StructField("c_name", StringType()),
    StructField("c_nationkey", IntegerType()), StructField("c_acctbal", DoubleType()),
    StructField("c_mktsegment", StringType()),
])


def csv_declared_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer written as CSV whose header names differ from the
    schema, read back binding columns by position."""
    cust = table(spark, sf_dir, "customer").select(*[f.name for f in CUSTOMER_SCHEMA.fields])
    renamed = cust.toDF(*[f"col_{i}" for i in range(len(CUSTOMER_SCHEMA.fields))])
    path = scratch_dir(spark, "csv")
    renamed.write.option("header", True).csv(path)
    return read_csv_by_position(spark, path, CUSTOMER_SCHEMA)


def _part_hits(spark: SparkSession, sf_dir: str) -> str:
    """Render parts as product-view hits (JSON lines) under scratch."""
    part = table(spark, sf_dir, "part")
    chars = F.array(
        F.struct(F.lit("brand").alias("name"), F.col("p_brand").alias("value")),
        F.struct(F.lit("size").alias("name"), F.col("p_size").cast("string").alias("value")))
    product = F.struct(
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_name").alias("title"),
        F.col("p_retailprice").alias("price"),
        F.struct(F.col("p_type").alias("title"), F.lit("").alias("description")).alias("category"),
        chars.alias("characteristic"),
        F.lit(True).alias("enabled"))
    hits = part.select(F.struct(
        F.concat(F.lit("s"), F.col("p_partkey").cast("string")).alias("sessionId"),
        product.alias("product")).alias("_source"))
    path = scratch_dir(spark, "json")
    hits.write.json(path)
    return path


def json_views_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 + M12: nested hits read back and flattened to training rows."""
    hits = read_product_views(spark, _part_hits(spark, sf_dir), multi_line=False)
    return flatten_product_views(hits)


def product_flag_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3 + M9 + M10 product job on flattened hits; the flag is a known
    function of the first characteristic. 11 ``keep`` indexers in one stage,
    forest with ``maxBins=600``; one prediction per product on both sides."""
    hits = read_product_views(spark, _part_hits(spark, sf_dir), multi_line=False)
    flat = flatten_product_views(hits).withColumn(
        "flag", F.when(F.col("characteristic_1").rlike("^Brand#[12]"), F.lit("True"))
        .otherwise(F.lit("False")))
    train, test = hash_split(flat, "product_id")
    scored = _fit(product_pipeline(max_bins=600, seed=7), train).transform(with_sides(train, test))
    yes = scored.where("flag = 'True'").agg(F.max("label")).first()[0]
    return scored.select("product_id", "side",
                         (F.col("prediction") == F.lit(yes)).cast("int").alias("prediction"))


def product_views_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M12 over every line of ``lineitem`` as a viewed product, with more
    characteristics than the training table's columns: the further ones are
    kept, in order, in one list column."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_extendedprice")
    product = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey")
    chars = F.transform(
        F.sequence(F.lit(1), F.lit(12)), lambda i: F.struct(
            F.concat(F.lit("c"), i.cast("string")).alias("name"),
            F.concat_ws("-", F.col("l_returnflag"), i.cast("string")).alias("value")))
    hits = lines.select(F.struct(
        F.col("l_orderkey").cast("string").alias("sessionId"),
        F.struct(product.alias("id"), F.col("l_extendedprice").alias("price"),
                 F.struct(F.col("l_returnflag").alias("title")).alias("category"),
                 chars.alias("characteristic")).alias("product")).alias("_source"))
    flat = flatten_product_views(hits, further="further")
    return flat.select("session_id", "product_id", "category_title", "price", "characteristic_1", "characteristic_10",
                       F.array_join("further", ",").alias("further"))


def string_index_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2 by a table of codes: an id column (customer names) and a column of a
    few frequent values, ties alphabetical."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    for col, out in (("c_name", "name_idx"), ("c_mktsegment", "segment_idx")):
        customers = apply_codes(customers, col, fit_codes(customers, col), out)
    return customers.select("c_custkey", "name_idx", "segment_idx")


def string_index_table_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3 by a table of codes fitted on the training side: parts that occur
    there get their rank, all others the number of codes."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    train, _ = hash_split(lines, "l_orderkey")
    return apply_codes(lines, "l_partkey", fit_codes(train, "l_partkey"), "part_idx", "keep") \
        .groupBy("l_partkey", "part_idx").agg(F.count("*").alias("n"))


def exact_split_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 with exact sizes: 70 % of the orders, to the row."""
    train, test = exact_split(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")
    return with_sides(train, test)


def hit_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits in the export's form, one array per file, read as VARIANT."""
    part = table(spark, sf_dir, "part")
    product = F.struct(
        F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("title"),
        F.format_string("2024-01-%02dT10:00:00.000Z", (F.col("p_size") % 28 + 1).cast("int")).alias("date"),
        F.round(F.col("p_retailprice").cast("decimal(18,4)"), 2).alias("price"),
        (F.col("p_size") % 2 == 0).alias("enabled"),
        F.array("p_brand", "p_type").alias("tags"),
        F.transform(F.sequence(F.lit(0), F.col("p_size") % 3), lambda i: F.struct(
            F.concat(F.lit("n"), i.cast("string")).alias("name"), F.concat_ws("/", F.col("p_brand"), i.cast("string")).alias("value")))
        .alias("characteristic"))
    hits = part.select(
        F.floor(F.col("p_partkey") / 500).alias("file"),
        F.struct(F.lit("product-views").alias("_index"), F.col("p_partkey").cast("string").alias("_id"),
                 F.struct(F.lit("s1").alias("sessionId"), product.alias("product")).alias("_source")).alias("hit"))
    # 500 hits a file, as one pretty-printed array.
    files = hits.groupBy("file").agg(F.to_json(F.collect_list("hit"), {"pretty": "true"}).alias("value"))
    path = scratch_dir(spark, "hit-arrays")
    files.write.partitionBy("file").text(path)
    views = variant_product_views(read_hit_arrays(spark, path))
    return views.select("product_id", "price", "enabled", F.date_format("viewed_at", "yyyy-MM-dd HH:mm:ss").alias("viewed_at"),
                        F.array_join("tags", ",").alias("tags"),
                        F.array_join(F.transform("characteristic", lambda c: F.concat_ws("=", c["name"], c["value"])), ",")
                        .alias("characteristics"))


ML_QUERIES = {
    "hash_split": hash_split_query,
    "string_index_error": string_index_error,
    "string_index_keep": string_index_keep,
    "assemble_features": assemble_features,
    "auroc_rank": auroc_rank,
    "auroc_evaluator": auroc_evaluator,
    "rf_score": _score_query("rf"),
    "dt_score": _score_query("dt"),
    "gbt_score": _score_query("gbt"),
    "dtr_score": _score_query("dtr"),
    "model_reload": model_reload,
    "rf_auroc": rf_auroc,
    "csv_declared_schema": csv_declared_schema,
    "json_views_flat": json_views_flat,
    "product_flag_score": product_flag_score,
    "product_views_wide": product_views_wide,
    "string_index_table": string_index_table,
    "string_index_table_keep": string_index_table_keep,
    "exact_split": exact_split_query,
    "hit_arrays": hit_arrays,
}
