"""The trigger settings of the reference jobs."""

from __future__ import annotations

from pyspark.sql.streaming import DataStreamWriter

# Trigger intervals of the reference jobs.
RECOMMENDER_INTERVAL = "30 seconds"
STATEFUL_WORD_COUNT_INTERVAL = "30 seconds"
STRUCTURED_WORD_COUNT_INTERVAL = "3 seconds"


def with_trigger(writer: DataStreamWriter, interval: str | None = None,
                 available_now: bool = False) -> DataStreamWriter:
    """A processing-time trigger, or ``availableNow`` (drain and stop)."""
    if available_now:
        return writer.trigger(availableNow=True)
    if interval:
        return writer.trigger(processingTime=interval)
    return writer
