"""Counts of a session job: rows that arrived, left in sessions, wait in open ones, and came too late.

The state operator's own counter of dropped rows counts sessions already merged
inside a task, not rows.  Here the rows are counted where they arrive (before
the window) and where they leave (the counts of emitted sessions), as observed
metrics of each micro-batch, and those that wait are read from the state store:

    dropped = arrived - emitted - open

:class:`ProgressLog` writes each batch's two numbers under the batch's id, over
those of an earlier attempt, so a replayed batch counts once.  A driver that
dies after a batch's commit and before its entry leaves a gap; the report
refuses a log with gaps.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

ARRIVED, EMITTED = "session_rows_arrived", "session_rows_emitted"
LOG_DDL = "arrived bigint, emitted bigint, watermark string, batch_id bigint"


class ProgressLog(StreamingQueryListener):
    """Writes the counts of one query's batches to ``path``; use one log for each start of a query.

    ``with ProgressLog(spark, path) as log: ... log.follow(query)``; leaving the
    block waits until the query has ended and its batches are written.
    """

    def __init__(self, spark: SparkSession, path: str, timeout: float = 600):
        self._spark, self._path, self._timeout = spark, path.rstrip("/"), timeout
        self._run: str | None = None
        self._early: list = []
        self._errors: list[Exception] = []
        self._lock, self._ended = threading.Lock(), {}

    def __enter__(self) -> ProgressLog:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, kind, *_) -> None:
        try:
            if self._run is not None and kind is None:
                if not self._end(self._run).wait(self._timeout):
                    raise TimeoutError("the query did not end in time")
                if self._errors:
                    raise self._errors[0]
        finally:
            self._spark.streams.removeListener(self)

    def follow(self, query: StreamingQuery) -> StreamingQuery:
        """Write the batches of this query (others are not logged)."""
        with self._lock:
            self._run = str(query.runId)
            early, self._early = self._early, []
        for progress in early:
            self._write(progress)
        return query

    def _end(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self._lock:
            if self._run is None:
                self._early.append(event.progress)
                return
        self._write(event.progress)

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def _write(self, progress) -> None:
        if str(progress.runId) != self._run or ARRIVED not in progress.observedMetrics:
            return
        count = lambda name: int(getattr(progress.observedMetrics.get(name), "n", None) or 0)
        row = (count(ARRIVED), count(EMITTED), progress.eventTime.get("watermark"))
        try:
            (self._spark.createDataFrame([row], "arrived bigint, emitted bigint, watermark string").coalesce(1)
                 .write.mode("overwrite").parquet(f"{self._path}/batch_id={progress.batchId}"))
        except Exception as e:  # noqa: BLE001 - raised where the log is left; a listener's own errors are only logged
            self._errors.append(e)


def batch_counts(spark: SparkSession, path: str) -> DataFrame:
    """``arrived, emitted, watermark, batch_id`` of each logged batch."""
    return spark.read.schema(LOG_DDL).parquet(path)


def row_report(spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
    """One row: arrived, emitted, open_rows and dropped, up to the newest logged batch of the job with ``checkpoint``."""
    logged = batch_counts(spark, path)
    seen = logged.agg(F.count(F.lit(1)).alias("n"), F.max("batch_id").alias("last")).first()
    if seen["last"] is None:
        raise ValueError(f"{path} has no batch")
    if seen["n"] != seen["last"] + 1:
        raise ValueError(f"{path} lacks {seen['last'] + 1 - seen['n']} of the batches up to {seen['last']}")
    state = spark.read.format("statestore").option("batchId", seen["last"]).load(checkpoint)
    waiting = state.agg(F.coalesce(F.sum("value.count"), F.lit(0)).alias("open_rows"))
    sums = logged.agg(F.sum("arrived").alias("arrived"), F.sum("emitted").alias("emitted"))
    return sums.crossJoin(waiting).withColumn(       # one row each
        "dropped", F.col("arrived") - F.col("emitted") - F.col("open_rows"))
