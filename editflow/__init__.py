"""editflow: a Spark-native engine for streams of page-edit notices.

Every transformation is a ``DataFrame -> DataFrame`` function that is valid for batch and
Structured Streaming input alike. Only ``editflow.sources`` and ``editflow.streaming`` know
which of the two they are dealing with.
"""

from editflow.session import build_session, checkpoint_root, scratch_path

__all__ = ["build_session", "checkpoint_root", "scratch_path"]
