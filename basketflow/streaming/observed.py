"""What each micro-batch did, from Spark's own listener.

:func:`observed` counts the rows that leave a streaming DataFrame (an
``observe`` metric, computed with the batch itself); :class:`BatchLog` listens
to the session's queries and keeps, per batch, when it started, how long it
took and how many rows went in and out.
"""

from __future__ import annotations

import threading
from collections import deque
from collections.abc import Callable
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

METRIC = "basketflow_out"


class Batch(NamedTuple):
    query: str
    batch: int
    started: datetime
    seconds: float
    rows_in: int
    rows_out: int | None

    def line(self) -> str:
        out = "" if self.rows_out is None else f", {self.rows_out} rows out"
        return f"{self.query} batch {self.batch}: {self.rows_in} rows in{out}, {self.seconds:.1f} s"


def observed(df: DataFrame) -> DataFrame:
    """``df`` with its rows counted per micro-batch."""
    return df.observe(METRIC, F.count(F.lit(1)).alias("rows"))


class BatchLog(StreamingQueryListener):
    """Add it with ``spark.streams.addListener``; remove it when done. Keeps
    the latest ``keep`` batches; ``tell`` receives each one's line. Failed
    queries are kept in ``failures``."""

    def __init__(self, tell: Callable[[str], None] | None = None, keep: int = 10_000):
        self.tell = tell
        self._lock = threading.Lock()
        self._batches: deque[Batch] = deque(maxlen=keep)
        self.failures: dict[str, str] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802 - Spark's names
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        metric = (p.observedMetrics or {}).get(METRIC)
        batch = Batch(p.name or str(p.id), p.batchId, datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")),
                      p.batchDuration / 1000, p.numInputRows, None if metric is None else metric["rows"])
        with self._lock:
            self._batches.append(batch)
        if self.tell:
            self.tell(batch.line())

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        if event.exception:
            self.failures[str(event.id)] = event.exception

    def batches(self, query: str | None = None) -> list[Batch]:
        """The batches of a query (by name, or id if it has none), in order."""
        with self._lock:
            return [b for b in self._batches if query in (None, b.query)]

    def intervals(self, query: str) -> list[float]:
        """Seconds between the starts of a query's successive batches."""
        starts = [b.started for b in self.batches(query)]
        return [(b - a).total_seconds() for a, b in zip(starts, starts[1:])]
