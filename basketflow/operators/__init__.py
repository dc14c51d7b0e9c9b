"""Batch operators: co-occurrence recommender and word counts."""

from basketflow.operators.recommender import (
    baskets, cooccurrence, distinct_views, item_pairs, nest_recommendations,
    pair_support, recommendations_flat, symmetric_pairs, top_neighbours,
)
from basketflow.operators.wordcount import tokens, word_counts

__all__ = [
    "baskets", "cooccurrence", "distinct_views", "item_pairs", "nest_recommendations",
    "pair_support", "recommendations_flat", "symmetric_pairs", "top_neighbours",
    "tokens", "word_counts",
]
