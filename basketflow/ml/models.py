"""Tree estimators, the two reference pipelines, persistence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, RandomForestClassifier,
)
from pyspark.ml.regression import DecisionTreeRegressor

from basketflow.ml.features import assemble, index_strings

CLASSIFIERS = {
    "rf": RandomForestClassifier,
    "dt": DecisionTreeClassifier,
    "gbt": GBTClassifier,
    "dtr": DecisionTreeRegressor,
}

# The churn job's feature columns, in assembly order.
CHURN_NUMERIC = ["account_length", "number_vmail_messages", "total_day_calls",
                 "total_day_charge", "total_eve_calls", "total_eve_charge",
                 "total_night_calls", "total_intl_calls", "total_intl_charge"]
# The product job's categorical columns, in assembly order.
PRODUCT_CATEGORICAL = ["category_title", "characteristic_1", "characteristic_2",
                       "characteristic_3", "characteristic_4", "characteristic_5",
                       "characteristic_6", "characteristic_7", "characteristic_8",
                       "characteristic_9", "characteristic_10"]


def make_estimator(kind: str = "rf", label: str = "label", features: str = "features",
                   seed: int | None = 42, **params):
    """M5-M8: ``rf`` (default), ``dt``, ``gbt`` or the regressor ``dtr``.

    Spark's trees train from distributed histograms; ``maxBins`` must be at
    least the largest category arity.
    """
    cls = CLASSIFIERS[kind]
    est = cls(labelCol=label, featuresCol=features, **params)
    if seed is not None and est.hasParam("seed"):
        est = est.setSeed(seed)
    return est


def churn_pipeline(kind: str = "rf", seed: int | None = 42, **params) -> Pipeline:
    """M9, churn job: plan indexer -> label indexer -> assembler -> trees."""
    plan = index_strings(["intl_plan"], ["intl_plan_indexed"], "error")
    label = index_strings(["churned"], ["label"], "error")
    vec = assemble(["intl_plan_indexed"] + CHURN_NUMERIC)
    return Pipeline(stages=[plan, label, vec, make_estimator(kind, seed=seed, **params)])


def product_pipeline(max_bins: int = 600, seed: int | None = 42) -> Pipeline:
    """M9, product-flag job: 11 ``keep`` indexers (one multi-column stage),
    label indexer, assembler over price + indexes, forest with wide bins."""
    cats = index_strings(PRODUCT_CATEGORICAL, [f"{c}_int" for c in PRODUCT_CATEGORICAL],
                         "keep")
    label = index_strings(["flag"], ["label"], "error")
    vec = assemble(["price"] + [f"{c}_int" for c in PRODUCT_CATEGORICAL])
    forest = make_estimator("rf", seed=seed, maxBins=max_bins)
    return Pipeline(stages=[cats, label, vec, forest])


def feature_pipeline(categorical: Sequence[str], numeric: Sequence[str], label: str,
                     kind: str = "rf", seed: int | None = 42,
                     handle_invalid: str = "keep", **params) -> Pipeline:
    """Generic M9: index ``categorical`` + ``label``, assemble, train."""
    stages = []
    idx_cols = []
    if categorical:
        idx_cols = [f"{c}_idx" for c in categorical]
        stages.append(index_strings(categorical, idx_cols, handle_invalid))
    stages.append(index_strings([label], ["label"], "error"))
    stages.append(assemble(list(numeric) + idx_cols))
    stages.append(make_estimator(kind, seed=seed, **params))
    return Pipeline(stages=stages)


def save_model(model: PipelineModel, path: str) -> None:
    """K7: persist a fitted pipeline (overwrite)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """K7: load a fitted pipeline."""
    return PipelineModel.load(path)
