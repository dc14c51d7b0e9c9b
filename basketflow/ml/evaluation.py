"""Area under the ROC curve.

:func:`auroc` is Spark ML's ``BinaryClassificationEvaluator`` (what the
reference prints). :func:`auroc_exact` computes the same number with the rank
(Mann-Whitney) formula, ties counted one half, as a plain DataFrame plan that
SQL can reproduce:

    AUC = sum over scores s of pos(s) * (neg(< s) + neg(s) / 2) / (P * N)

The cumulative ``neg(< s)`` is a prefix sum over the distinct scores. A
single global window would run in one task, so the scores are cut into
``buckets`` ranges (approximate quantiles, only ``buckets`` numbers reach the
driver): per-bucket totals give each bucket's offset (a ``buckets``-row table,
broadcast with that proven bound) and the running sum inside a bucket is a
window partitioned by bucket. The per-score table is checkpointed once, since
both the quantile job and the final plan read it.
"""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketflow.session import cut_lineage


def auroc(predictions: DataFrame, label: str = "label", raw: str = "rawPrediction",
          num_bins: int = 1000) -> float:
    """Spark ML's AUROC; ``num_bins=0`` disables down-sampling (exact)."""
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=raw,
                                       metricName="areaUnderROC", numBins=num_bins)
    return ev.evaluate(predictions)


def auroc_exact(df: DataFrame, label: str, score: str, positive=1,
                buckets: int | None = None) -> DataFrame:
    """One row ``(auroc, n_pos, n_neg)``; ``label == positive`` is positive.

    NULL without a positive or without a negative row (so also on empty or
    all-null input, with counts 0). ``buckets`` defaults to the shuffle
    partitions, so the prefix sum has as many tasks as any other stage.
    """
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    is_pos = (F.col(label) == F.lit(positive)).cast("long")
    per_score = (df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
                 .groupBy(F.col(score).cast("double").alias("s"))
                 .agg(F.sum(is_pos).alias("pos"), F.sum(1 - is_pos).alias("neg")))
    # Used by the quantile job and by the main plan: computed once and kept
    # in the shared checkpoint folder (survives executor loss).
    per_score = cut_lineage(per_score)
    probs = [i / buckets for i in range(1, buckets)]
    bounds = sorted(set(per_score.approxQuantile("s", probs, 0.001)))
    if bounds:
        splits = [float("-inf")] + bounds + [float("inf")]
        bucketed = Bucketizer(splits=splits, inputCol="s", outputCol="bucket",
                              handleInvalid="keep").transform(per_score)
    else:
        bucketed = per_score.withColumn("bucket", F.lit(0.0))
    totals = bucketed.groupBy("bucket").agg(F.sum("neg").alias("bucket_neg"))
    offsets = totals.select(
        "bucket",
        F.coalesce(F.sum("bucket_neg").over(
            Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0)).alias("offset"))
    running = Window.partitionBy("bucket").orderBy("s").rowsBetween(
        Window.unboundedPreceding, -1)
    ranked = (bucketed.join(F.broadcast(offsets), "bucket")
              .withColumn("neg_below", F.col("offset")
                          + F.coalesce(F.sum("neg").over(running), F.lit(0))))
    return ranked.agg(
        F.try_divide(F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0)),
                     F.sum("pos") * F.sum("neg")).alias("auroc"),
        F.coalesce(F.sum("pos"), F.lit(0)).alias("n_pos"),
        F.coalesce(F.sum("neg"), F.lit(0)).alias("n_neg"))
