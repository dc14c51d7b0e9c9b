"""Tree classifiers over mixed categorical / numeric tables."""

from basketflow.ml.features import (
    assemble, hash_split, index_strings, random_split, vector_column_to_array,
)
from basketflow.ml.models import (
    CLASSIFIERS, churn_pipeline, load_model, make_estimator, product_pipeline, save_model,
)
from basketflow.ml.evaluation import auroc, auroc_exact

__all__ = [
    "assemble", "hash_split", "index_strings", "random_split", "vector_column_to_array",
    "CLASSIFIERS", "churn_pipeline", "load_model", "make_estimator", "product_pipeline",
    "save_model", "auroc", "auroc_exact",
]
