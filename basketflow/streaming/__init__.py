"""Structured Streaming jobs: running counts and the streaming recommender."""

from basketflow.streaming.counts import running_word_counts, seeded, start_counts
from basketflow.streaming.harness import SlicedFileStream, slice_ids
from basketflow.streaming.recommend import BatchScopedPairs, RunningRecommender
from basketflow.streaming.settings import stream_partitions
from basketflow.streaming.triggers import with_trigger
from basketflow.streaming.windows import closed_views, closing_row, start_windowed_pairs

__all__ = ["running_word_counts", "seeded", "start_counts", "SlicedFileStream",
           "slice_ids", "BatchScopedPairs", "RunningRecommender", "closed_views",
           "closing_row", "start_windowed_pairs", "stream_partitions", "with_trigger"]
