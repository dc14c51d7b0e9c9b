"""K1 / K2: the text payloads written to the output topics.

Formats are fixed by the job contract (tuple and list rendering):
  word count      -> ``(word,count)``
  recommendation  -> ``(item,[(other,n), (other,n)])``
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def word_count_payload(word: str = "word", cnt: str = "cnt") -> Column:
    """K1: ``(word,count)``."""
    return F.concat(F.lit("("), F.col(word), F.lit(","),
                    F.col(cnt).cast("string"), F.lit(")"))


def recommendation_payload(item: str = "item", recs: str = "recs") -> Column:
    """K2: ``(item,[(other,n), ...])`` from an ``array<struct<other,cnt>>``."""
    rendered = F.transform(
        F.col(recs),
        lambda r: F.concat(F.lit("("), r["other"], F.lit(","),
                           r["cnt"].cast("string"), F.lit(")")))
    return F.concat(F.lit("("), F.col(item).cast("string"), F.lit(",["),
                    F.array_join(rendered, ", "), F.lit("])"))
