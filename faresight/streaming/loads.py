"""Incremental load as a stream: landed files -> partitions of a target.

Each resource is a query of its own with its own checkpoint, which is the
state of the load: a landed file is loaded once, whatever is started again in
between.  ``availableNow`` takes what has landed and stops, a bounded number of
files to a micro-batch, so the size of a batch does not grow with the backlog.

A micro-batch overwrites the partition ``_load_id=<resource>-<batch>`` of the
target and the state folder of that name.  A batch that died anywhere is run
again by the checkpoint under the same number and replaces what it left, so
rows and state are exactly once; resources that share a target touch different
partitions and may run at the same time.

Cases: an empty arrival loads nothing; rows below ``initial_value`` are left
out; a row without a cursor fails the batch (nothing of it is kept) or is left
out with ``null_cursor="skip"``; a file with another type for a column fails.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from faresight.session import delete_path
from faresight.sinks import loads


def batch_load_id(resource: str, batch_id: int) -> str:
    return f"{resource}-{batch_id:08d}"


def batch_writer(target_path: str, state_path: str, resource: str, schema: StructType, cursor_col: str | None = None,
                 initial_value=None, null_cursor: str = "error") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that loads one micro-batch: first its rows, then its state."""
    if null_cursor not in ("error", "skip"):
        raise ValueError(f"null_cursor must be 'error' or 'skip', not {null_cursor!r}")
    if not re.fullmatch(r"[A-Za-z0-9_.]+", resource):
        raise ValueError(f"{resource!r} cannot name a folder; use letters, digits, '_' and '.'")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, load_id = batch.sparkSession, batch_load_id(resource, batch_id)
        part, rows, without = loads.partition_path(target_path, load_id), batch, 0
        if cursor_col is None:
            rows.write.mode("overwrite").parquet(part)
        else:
            c, seen = F.col(cursor_col), Observation()
            if initial_value is not None:
                rows = rows.filter(c.isNull() | (c >= F.lit(initial_value).cast(schema[cursor_col].dataType)))
            rows = rows.observe(seen, F.count_if(c.isNull()).alias("without"))
            rows.filter(c.isNotNull()).write.mode("overwrite").parquet(part)
            without = seen.get["without"]
        if without and null_cursor == "error":
            delete_path(spark, part)
            raise ValueError(f"{without} rows with a NULL {cursor_col} cannot be loaded incrementally")
        info = loads._told(spark, part, schema, load_id, resource, cursor_col, None)
        record(spark, state_path, info, target_path)

    return write


def record(spark: SparkSession, state_path: str, info: dict, target_path: str) -> None:
    """Write a batch's state row, over that of an earlier attempt."""
    row = loads._state_row(spark, info, target_path, "stream").drop("load_id")
    row.coalesce(1).write.mode("overwrite").parquet(f"{state_path.rstrip('/')}/load_id={info['load_id']}")


def stream_state(spark: SparkSession, state_path: str) -> DataFrame:
    """One row for each loaded batch of each resource."""
    return spark.read.schema(loads.STATE_DDL).parquet(state_path)


def resource_state(spark: SparkSession, state_path: str) -> DataFrame:
    """``resource, rows, cursor_value`` over all batches; the newest cursor of those that loaded rows."""
    return stream_state(spark, state_path).groupBy("resource").agg(
        F.sum("rows").alias("rows"), F.max("cursor_value").alias("cursor_value"))


def start_load(spark: SparkSession, landing: str, schema: StructType | str, target_path: str, state_path: str, resource: str,
               checkpoint_root: str, cursor_col: str | None = None, initial_value=None, null_cursor: str = "error",
               files_per_trigger: int = 64, file_format: str = "parquet", processing_time: str | None = None) -> StreamingQuery:
    """Start the load of ``landing``; the same call resumes it.

    The checkpoint is ``<checkpoint_root>/<resource>``.  Without
    ``processing_time`` the query takes the files that have landed and stops.
    """
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    stream = (spark.readStream.schema(kind).format(file_format).option("maxFilesPerTrigger", files_per_trigger).load(landing))
    writer = stream.writeStream.option("checkpointLocation", f"{checkpoint_root.rstrip('/')}/{resource}").foreachBatch(
        batch_writer(target_path, state_path, resource, kind, cursor_col, initial_value, null_cursor))
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
    return writer.start()
