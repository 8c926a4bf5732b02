"""ledgerlens: transaction cleaning, review analytics and streaming regression on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
expressions, MLlib transformers or Structured Streaming queries.
"""

from ledgerlens.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
