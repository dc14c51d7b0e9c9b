"""basketflow: basket co-occurrence, running counts and tree classifiers as
Spark DataFrame / Structured Streaming operators."""

from basketflow.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
