"""Streaming session counts: messages -> event time + watermark ->
``session_window`` per key -> append-only sink.

Semantics follow the reference job: event time is the drop-off time by
default (X20), the watermark lags 5 seconds, sessions close after a
5-minute gap, rows later than the watermark are dropped, and closed
sessions are emitted once (append mode).  Unlike the reference sink, the
session bounds are emitted too (X19).

Delivery: the file sink is exactly-once by its commit log, as long as the
same checkpoint goes with it; a new checkpoint on a sink that already has a
log would count its batches from 0 again and write nothing, so that is
refused.  The JDBC writer promotes a staged batch and its ledger entry in one
transaction, so a batch that is replayed adds nothing.  A job's checkpoint lies beside its sink unless it is named, so a
restarted job resumes where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from faresight.session import path_exists
from faresight.streaming import audit
from faresight.streaming.jdbc import ledger_writer
from faresight.streaming.messages import parse_messages, publish, require_kafka

# Message schema of the reference's trip topic (green trips, 7 columns).
TRIP_MESSAGE_DDL = (
    "lpep_pickup_datetime timestamp_ntz, lpep_dropoff_datetime timestamp_ntz, "
    "PULocationID int, DOLocationID int, passenger_count int, trip_distance double, tip_amount double"
)


def message_stream(spark: SparkSession, schema_ddl: str, path: str | None = None,
                   topic: str | None = None, bootstrap_servers: str | None = None,
                   starting_offsets: str = "earliest", max_per_trigger: int | None = None) -> DataFrame:
    """Parsed messages from a Kafka topic (from the earliest offset), or from
    message files under ``path``.  A topic that cannot be read is an error."""
    if topic:
        require_kafka(spark, topic, bootstrap_servers)
        r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
                  .option("subscribe", topic).option("startingOffsets", starting_offsets))
        if max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", max_per_trigger)
        raw = r.load()
    else:
        r = spark.readStream.format("text")
        if max_per_trigger:
            r = r.option("maxFilesPerTrigger", max_per_trigger)
        raw = r.load(path)
    return parse_messages(raw, schema_ddl)


HEARTBEAT_DDL = "until timestamp_ntz"


def heartbeat_stream(spark: SparkSession, path: str) -> DataFrame:
    """Heartbeats, ``{"until": time}`` message files: no row before ``until`` is still to come.

    They come from whoever knows that (the producer, or the landing job after
    its last file), never from a clock: a backlog that is read later than it was
    written would be dropped as late.  The folder is made if it is not there.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    return message_stream(spark, HEARTBEAT_DDL, path=path)


def send_heartbeat(until: DataFrame, path: str) -> None:
    """Write the one time of ``until`` (its first column) as a heartbeat."""
    publish(until.select(F.col(until.columns[0]).cast("timestamp_ntz").alias("until")), path=path)


def session_aggregate(stream: DataFrame, keys: Sequence[str], event_time_col: str,
                      watermark: str = "5 seconds", gap: str = "5 minutes",
                      count_alias: str = "taxi_trips_streak", heartbeats: DataFrame | None = None,
                      audited: bool = False) -> DataFrame:
    """Event time + watermark + session window count per key.

    ``withWatermark`` needs a zone-aware TIMESTAMP, so zone-less input is
    cast (the session time zone should be UTC).  Output times are cast back
    to zone-less timestamps.

    ``heartbeats`` (see :func:`heartbeat_stream`) move the watermark like rows
    and are then left out, so idle keys' newest sessions close without a row
    that is made up.  ``audited`` adds the counts that ``streaming.audit`` logs.
    """
    ev = stream.withColumn("event_watermark", F.col(event_time_col).cast("timestamp")).select(*keys, "event_watermark")
    if heartbeats is not None:
        beats = heartbeats.select(F.col("until").cast("timestamp").alias("event_watermark"), F.lit(True).alias("_beat"))
        ev = ev.withColumn("_beat", F.lit(False)).unionByName(beats, allowMissingColumns=True)
    ev = ev.withWatermark("event_watermark", watermark)
    if heartbeats is not None:
        # The watermark must see the heartbeats: naming the event time keeps this filter above it, and the metric
        # keeps the optimizer from merging it with the window's own filter on the event time.
        ev = ev.filter(~(F.col("_beat") & F.col("event_watermark").isNotNull())).drop("_beat")
    if audited or heartbeats is not None:
        ev = ev.observe(audit.ARRIVED, F.count("event_watermark").alias("n"))
    agg = (ev.groupBy(*keys, F.session_window("event_watermark", gap).alias("_w"))
             .agg(F.count(F.lit(1)).alias(count_alias)))
    out = agg.select(*keys, F.col("_w.start").cast("timestamp_ntz").alias("session_start"),
                     F.col("_w.end").cast("timestamp_ntz").alias("session_end"), count_alias)
    return out.observe(audit.EMITTED, F.sum(count_alias).alias("n")) if audited else out


def start(agg: DataFrame, checkpoint: str, path: str | None = None,
          foreach_batch: Callable[[DataFrame, int], None] | None = None,
          processing_time: str | None = "10 seconds", available_now: bool = False,
          query_name: str | None = None, state_partitions: int | None = None) -> StreamingQuery:
    """Start the append-mode query into parquet files at ``path`` or a
    ``foreach_batch`` function (e.g. :func:`jdbc_batch_writer`).

    ``state_partitions`` sets the number of state-store partitions of the
    session aggregation.  It is fixed for the life of the checkpoint, so
    size it for the expected key volume; it is applied only while the query
    starts (the stream keeps its own copy of the session settings).  Rows of
    a key are merged into sessions within each task before the shuffle, so a
    hot key sends its sessions, not its rows.
    """
    spark = agg.sparkSession
    if path and path_exists(spark, f"{path.rstrip('/')}/_spark_metadata") and not path_exists(spark, checkpoint):
        raise ValueError(f"{path} already has a commit log; start the job with the checkpoint it was written with")
    wanted = {"spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true"}
    if state_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(state_partitions)
    old = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        return _started(agg, checkpoint, path, foreach_batch, processing_time, available_now, query_name)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def _started(agg, checkpoint, path, foreach_batch, processing_time, available_now, query_name) -> StreamingQuery:
    w = agg.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    if foreach_batch is not None:
        return w.foreachBatch(foreach_batch).start()
    return w.format("parquet").option("path", path).start()


def jdbc_batch_writer(url: str, table: str, properties: dict | None = None,
                      batch_col: str = "batch_id") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function writing each micro-batch to a JDBC table with
    its batch id in ``batch_col``, exactly once (see ``streaming.jdbc``)."""
    return ledger_writer(url, table, properties, batch_col)


def run_session_job(spark: SparkSession, schema_ddl: str, keys: Sequence[str], event_time_col: str,
                    source_path: str | None = None, topic: str | None = None,
                    bootstrap_servers: str | None = None, sink_path: str | None = None,
                    jdbc: tuple[str, str, dict] | None = None, checkpoint: str | None = None,
                    watermark: str = "5 seconds", gap: str = "5 minutes",
                    processing_time: str = "10 seconds", available_now: bool = False,
                    state_partitions: int | None = None, heartbeat_path: str | None = None,
                    log: audit.ProgressLog | None = None) -> StreamingQuery:
    """The whole job in one call: source (topic or message files) -> event
    time + watermark -> session counts per key -> parquet files or a JDBC
    table (``jdbc=(url, table, properties)``).  Unlike the reference job,
    start-up errors raise instead of being printed.  ``checkpoint`` defaults
    to ``<sink_path>_checkpoint``, the same on every start; a JDBC sink needs
    it named.  ``heartbeat_path`` names a folder of heartbeats, ``log`` takes
    the counts of every batch."""
    if jdbc is None and not sink_path:
        raise ValueError("a sink is required: sink_path or jdbc")
    if checkpoint is None:
        if not sink_path:
            raise ValueError("a JDBC sink needs a checkpoint folder that stays the same on every start")
        checkpoint = f"{sink_path.rstrip('/')}_checkpoint"
    stream = message_stream(spark, schema_ddl, path=source_path, topic=topic, bootstrap_servers=bootstrap_servers)
    beats = heartbeat_stream(spark, heartbeat_path) if heartbeat_path else None
    agg = session_aggregate(stream, keys, event_time_col, watermark, gap, heartbeats=beats, audited=log is not None)
    writer = jdbc_batch_writer(*jdbc) if jdbc else None
    query = start(agg, checkpoint, path=sink_path, foreach_batch=writer, processing_time=processing_time,
                  available_now=available_now, state_partitions=state_partitions)
    return log.follow(query) if log is not None else query
