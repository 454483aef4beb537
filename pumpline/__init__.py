"""pumpline: Spark-native monitoring analytics for equipment sensor readings.

Every operator is a ``DataFrame -> DataFrame`` function built from the
DataFrame/SQL API, MLlib and Structured Streaming.  Window and state
operators are keyed by device and split further by time bucket so that a
single chatty device never lands in one task.
"""

from pumpline.config import Params, DEFAULT_PARAMS

__all__ = ["Params", "DEFAULT_PARAMS"]
