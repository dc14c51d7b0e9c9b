"""Column-expression building blocks (all JVM-side, no Python UDFs)."""

from basketflow.functions.parse import message_value, parse_view_line
from basketflow.functions.tokens import split_drop_trailing, split_keep_all
from basketflow.functions.payload import recommendation_payload, word_count_payload
from basketflow.functions.maps import merge_count_maps
from basketflow.functions.splits import hash_bucket, hash_split_flag

__all__ = [
    "message_value", "parse_view_line", "split_drop_trailing", "split_keep_all",
    "recommendation_payload", "word_count_payload", "merge_count_maps",
    "hash_bucket", "hash_split_flag",
]
