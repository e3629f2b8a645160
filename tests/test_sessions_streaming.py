import datetime as dt
import os
import random
import uuid

from pyspark.sql import functions as F

from faresight.operators import sessions
from faresight.session import path_exists, scratch_path
from faresight.streaming import messages
from faresight.streaming import sessions as stream_sessions

T0 = dt.datetime(2024, 1, 1, 10, 0)
DDL = "pu int, do int, drop_ts timestamp_ntz"


def _rows(spark, rows):
    return spark.createDataFrame(rows, DDL)


def test_session_gap_exact_and_just_over(spark):
    # STR3: exactly 5:00 apart -> same session; 5:01 -> new session
    rows = [(1, 1, T0), (1, 1, T0 + dt.timedelta(minutes=5)),
            (1, 1, T0 + dt.timedelta(minutes=10, seconds=1)), (2, 2, T0)]
    out = sessions.session_counts(_rows(spark, rows), ["pu", "do"], "drop_ts", "5 minutes").collect()
    got = sorted((r.pu, r.session_start, r.session_end, r.taxi_trips_streak) for r in out)
    assert got == [(1, T0, T0 + dt.timedelta(minutes=10), 2),
                   (1, T0 + dt.timedelta(minutes=10, seconds=1), T0 + dt.timedelta(minutes=15, seconds=1), 1),
                   (2, T0, T0 + dt.timedelta(minutes=5), 1)]


def test_bucketed_sessions_equal_native_session_window(spark):
    rnd = random.Random(3)
    rows = []
    for k in range(4):
        t = T0
        for _ in range(300):
            t += dt.timedelta(seconds=rnd.choice([1, 30, 200, 299, 300, 301, 900, 3600]),
                              microseconds=rnd.randint(0, 999999))
            rows.append((k, k % 2, t))
    rnd.shuffle(rows)
    df = _rows(spark, rows)
    a = sessions.session_counts(df, ["pu", "do"], "drop_ts", "5 minutes")
    b = sessions.session_counts_native(df, ["pu", "do"], "drop_ts", "5 minutes")
    norm = lambda d: sorted((r.pu, r.do, r.session_start, r.session_end, r.taxi_trips_streak) for r in d.collect())
    assert norm(a) == norm(b)


def test_hot_key_is_pre_aggregated(spark):
    # one key with many rows: the plan aggregates (partial) before any window
    rows = [(1, 1, T0 + dt.timedelta(seconds=i)) for i in range(2000)]
    df = sessions.session_counts(_rows(spark, rows), ["pu", "do"], "drop_ts", "5 minutes")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_" in plan
    assert sum(r.taxi_trips_streak for r in df.collect()) == 2000


def test_longest_sessions_keeps_ties(spark):
    rows = [(1, 1, T0), (1, 1, T0 + dt.timedelta(minutes=1)), (2, 2, T0), (2, 2, T0 + dt.timedelta(minutes=1)),
            (3, 3, T0)]
    s = sessions.session_counts(_rows(spark, rows), ["pu", "do"], "drop_ts", "5 minutes")
    assert sorted(r.pu for r in sessions.longest_sessions(s).collect()) == [1, 2]


MSG_DDL = "pu int, do int, drop_ts timestamp_ntz"


def _publish(spark, path, rows):
    messages.publish(spark.createDataFrame(rows, MSG_DDL).coalesce(1), path=path)


def test_stream_equals_batch_with_flush_marker(spark):
    base = scratch_path(spark, "t-stream")
    rnd = random.Random(5)
    rows, t = [], T0
    for _ in range(400):
        t += dt.timedelta(seconds=rnd.choice([10, 100, 250, 400, 1000]))
        rows.append((rnd.randint(1, 3), rnd.randint(1, 2), t))
    _publish(spark, f"{base}/in", rows)
    _publish(spark, f"{base}/in", [(None, None, t + dt.timedelta(days=1))])  # flush marker
    stream = stream_sessions.message_stream(spark, MSG_DDL, path=f"{base}/in")
    agg = stream_sessions.session_aggregate(stream, ["pu", "do"], "drop_ts", "5 seconds", "5 minutes")
    q = stream_sessions.start(agg, f"{base}/ckpt", path=f"{base}/out", available_now=True)
    q.awaitTermination()
    got = spark.read.parquet(f"{base}/out").filter(F.col("pu").isNotNull())
    want = sessions.session_counts(spark.createDataFrame(rows, MSG_DDL), ["pu", "do"], "drop_ts", "5 minutes")
    norm = lambda d: sorted(tuple(r) for r in d.select("pu", "do", "session_start", "session_end",
                                                      "taxi_trips_streak").collect())
    assert norm(got) == norm(want)


def test_late_rows_are_dropped_after_watermark(spark):
    # STR6: a late row arriving two batches after the watermark moved past it is dropped
    base = scratch_path(spark, "t-late")
    ins = f"{base}/in"
    local_in = ins[len("file:"):] if ins.startswith("file:") else ins
    os.makedirs(local_in, exist_ok=True)

    def drop(rows):
        path = f"{local_in}/{uuid.uuid4().hex}.json"
        df = spark.createDataFrame(rows, MSG_DDL)
        lines = [r.value for r in messages.to_messages(df).collect()]
        with open(path, "w") as fh:
            fh.write("\n".join(lines) + "\n")

    stream = stream_sessions.message_stream(spark, MSG_DDL, path=ins, max_per_trigger=1)
    agg = stream_sessions.session_aggregate(stream, ["pu", "do"], "drop_ts", "5 seconds", "5 minutes")
    sink = f"{base}/out"
    q = stream_sessions.start(agg, f"{base}/ckpt", path=sink, processing_time=None)
    try:
        drop([(1, 1, T0)])
        q.processAllAvailable()
        drop([(1, 1, T0 + dt.timedelta(hours=1))])   # watermark jumps to ~T0+1h
        q.processAllAvailable()
        drop([(2, 2, T0 + dt.timedelta(hours=2))])   # one more batch in between
        q.processAllAvailable()
        drop([(1, 1, T0 + dt.timedelta(minutes=1))])  # late: far behind the watermark
        q.processAllAvailable()
        dropped = sum(p.get("stateOperators", [{}])[0].get("numRowsDroppedByWatermark", 0)
                      for p in q.recentProgress if p.get("stateOperators"))
    finally:
        q.stop()
    out = spark.read.parquet(sink)
    first = out.filter((F.col("pu") == 1) & (F.col("session_start") == T0)).collect()
    assert dropped >= 1
    assert len(first) == 1 and first[0].taxi_trips_streak == 1


def test_kafka_probe_without_connector(spark):
    # the image has no Kafka connector: a topic must be refused, not replaced by files
    import pytest
    assert messages.kafka_available(spark) is False
    base = scratch_path(spark, "t-topic")
    one = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(RuntimeError):
        messages.publish(one, topic="t", bootstrap_servers="localhost:9", path=base)
    with pytest.raises(ValueError):
        messages.publish(one, topic="t", path=base)
    with pytest.raises(ValueError):
        messages.publish(one)
    with pytest.raises(RuntimeError):
        stream_sessions.message_stream(spark, "a int", path=base, topic="t", bootstrap_servers="localhost:9")
    assert not path_exists(spark, base)


def test_corrupt_messages_fail_or_are_counted(spark):
    import pytest
    raw = spark.createDataFrame([('{"a": 1}',), ("{oops",), ('{"a": "x"}',), (None,)], "value string")
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        messages.parse_messages(raw, "a int").collect()
    loose = messages.parse_messages(raw, "a int", mode="PERMISSIVE").collect()
    assert [r.a for r in loose] == [1, None, None, None]
    assert sorted(r.value for r in messages.corrupt_messages(raw, "a int").collect()) == ['{"a": "x"}', "{oops"]


def test_a_second_start_on_the_same_sink_adds_its_sessions(spark):
    import pytest
    base = scratch_path(spark, "t-restart")

    def run():
        stream_sessions.run_session_job(spark, MSG_DDL, ["pu", "do"], "drop_ts", source_path=f"{base}/in",
                                        sink_path=f"{base}/out", available_now=True).awaitTermination()
        return sorted((r.pu, r.taxi_trips_streak) for r in spark.read.parquet(f"{base}/out").collect())

    _publish(spark, f"{base}/in", [(1, 1, T0), (1, 1, T0 + dt.timedelta(minutes=2)), (9, 9, T0 + dt.timedelta(hours=1))])
    assert run() == [(1, 2)]
    _publish(spark, f"{base}/in", [(9, 9, T0 + dt.timedelta(minutes=62)), (2, 2, T0 + dt.timedelta(hours=2))])
    assert run() == [(1, 2), (9, 2)]
    assert run() == [(1, 2), (9, 2)]
    stream = stream_sessions.message_stream(spark, MSG_DDL, path=f"{base}/in")
    agg = stream_sessions.session_aggregate(stream, ["pu", "do"], "drop_ts")
    with pytest.raises(ValueError, match="commit log"):
        stream_sessions.start(agg, f"{base}/other-checkpoint", path=f"{base}/out", available_now=True)
    with pytest.raises(ValueError, match="sink"):
        stream_sessions.run_session_job(spark, MSG_DDL, ["pu"], "drop_ts", source_path=f"{base}/in")


def test_rows_are_merged_to_sessions_before_the_shuffle(spark):
    base = scratch_path(spark, "t-local-merge")
    _publish(spark, f"{base}/in", [(1, 1, T0 + dt.timedelta(seconds=k)) for k in range(500)])
    stream = stream_sessions.message_stream(spark, MSG_DDL, path=f"{base}/in")
    q = stream_sessions.start(stream_sessions.session_aggregate(stream, ["pu", "do"], "drop_ts"), f"{base}/ckpt",
                              path=f"{base}/out", available_now=True)
    q.awaitTermination()
    plan = q._jsq.explainInternal(True)
    assert plan.count("MergingSessions") >= 2 or "UpdatingSessions" in plan


def test_run_session_job_to_parquet(spark):
    base = scratch_path(spark, "t-job")
    rows = [(1, 1, T0), (1, 1, T0 + dt.timedelta(minutes=2)), (None, None, T0 + dt.timedelta(days=1))]
    _publish(spark, f"{base}/in", rows)
    q = stream_sessions.run_session_job(spark, MSG_DDL, ["pu", "do"], "drop_ts", source_path=f"{base}/in",
                                        sink_path=f"{base}/out", available_now=True)
    q.awaitTermination()
    got = spark.read.parquet(f"{base}/out").filter(F.col("pu").isNotNull()).collect()
    assert [(r.pu, r.taxi_trips_streak) for r in got] == [(1, 2)]
