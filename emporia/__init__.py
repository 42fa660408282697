"""emporia: e-commerce analytics operators and named pipelines on Spark.

Every transform takes and returns a DataFrame and never starts a query;
the same transform runs on a batch table or a streaming DataFrame where
Spark allows it.
"""

from emporia.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]
