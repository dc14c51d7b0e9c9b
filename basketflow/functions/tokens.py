"""The two whitespace-split rules used by the word counts.

Both split on a single space character and are plain Catalyst expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def split_keep_all(col: str | Column) -> Column:
    """Keep every token, including leading, inner and trailing empties.

    ``"a  b  "`` -> ``a, "", b, "", ""``; ``""`` -> ``""``; ``"  "`` -> three
    empty tokens.
    """
    return F.split(_c(col), " ", -1)


def split_drop_trailing(col: str | Column) -> Column:
    """Drop trailing empty tokens, keep leading and inner ones.

    ``"a  b  "`` -> ``a, "", b``; ``" a"`` -> ``"", a``; ``""`` -> ``""``; a
    line of spaces only -> no token at all.
    """
    c = _c(col)
    trimmed = F.rtrim(c)
    return (F.when((c != F.lit("")) & (trimmed == F.lit("")),
                   F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, " ", -1)))
