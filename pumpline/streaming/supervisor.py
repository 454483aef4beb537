"""Keeps a streaming query running: what stops it becomes a status row, and it is started again after a pause."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pumpline.config import DEFAULT_PARAMS

STATUS_SCHEMA = "event_id long, device_id long, ts timestamp_ntz, source string, online boolean, detail string"


def status_rows(spark: SparkSession, path: str) -> DataFrame:
    """The feed's history in the shape of ``monitor.source_status`` and ``monitor.reconnect_count``."""
    return spark.read.schema(STATUS_SCHEMA).parquet(path)


def status_writer(spark: SparkSession, path: str, source: str) -> Callable[[bool, str | None], None]:
    """Appends one row for each change of the feed's status; numbers go on where the folder's end."""
    spark.createDataFrame([], STATUS_SCHEMA).write.mode("append").parquet(path)
    last = status_rows(spark, path).agg({"event_id": "max"}).first()[0]
    count = [0 if last is None else last + 1]

    def write(online: bool, detail: str | None) -> None:
        row = (count[0], None, datetime.now(UTC).replace(tzinfo=None), source, online, detail)
        spark.createDataFrame([row], STATUS_SCHEMA).coalesce(1).write.mode("append").parquet(path)
        count[0] += 1
    return write


def supervise(start: Callable[[], StreamingQuery], report: Callable[[bool, str | None], None],
              retries: int = 5, pause_s: float = DEFAULT_PARAMS.retry_s, look_s: float = 0.2) -> int:
    """Run ``start()``'s query until it ends by itself; returns how often it was started again.

    The feed is online from a run's first finished micro-batch and offline from its
    failure; only changes are reported.  The query resumes from its checkpoint, so
    a sink keyed by batch id gets no row twice.  ``retries`` failures in a row
    without a finished micro-batch are raised.  A query that is stopped is not
    started again.
    """
    online, failures, again = None, 0, 0
    while True:
        query, failed = start(), None
        while failed is None:
            try:
                ended = query.awaitTermination(look_s)
            except StreamingQueryException as e:
                ended, failed = True, e
            if online is not True and query.recentProgress:
                report(True, None)
                online, failures = True, 0
            if ended and failed is None:
                return again
        if online is not False:
            report(False, str(failed).splitlines()[0][:500])
        online, failures = False, failures + 1
        if failures > retries:
            raise failed
        time.sleep(pause_s)
        again += 1
