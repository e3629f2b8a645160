import datetime as dt
import random

import pytest

from faresight.operators import sessions
from faresight.session import scratch_path
from faresight.streaming import audit, messages
from faresight.streaming import sessions as streams

T0 = dt.datetime(2024, 1, 1, 10)
DDL = "pu int, do int, drop_ts timestamp_ntz"


def _publish(spark, base, rows):
    messages.publish(spark.createDataFrame(rows, DDL).coalesce(1), path=f"{base}/in")


def _beat(spark, base, until):
    streams.send_heartbeat(spark.createDataFrame([(until,)], "t timestamp_ntz"), f"{base}/beats")


def _run(spark, base, logged=True):
    with audit.ProgressLog(spark, f"{base}/log") as log:
        streams.run_session_job(spark, DDL, ["pu", "do"], "drop_ts", source_path=f"{base}/in", sink_path=f"{base}/out",
                                available_now=True, heartbeat_path=f"{base}/beats", state_partitions=3,
                                log=log if logged else None).awaitTermination()


def _report(spark, base):
    r = audit.row_report(spark, f"{base}/log", f"{base}/out_checkpoint").first()
    return r["arrived"], r["emitted"], r["open_rows"], r["dropped"]


def test_stream_equals_batch_without_a_marker(spark):
    base, rnd, rows, t = scratch_path(spark, "t-beat"), random.Random(5), [], T0
    for _ in range(300):
        t += dt.timedelta(seconds=rnd.choice([10, 100, 250, 400, 1000]))
        rows.append((rnd.randint(1, 3), rnd.choice([1, 2, None]), t))
    _publish(spark, base, rows[:200])
    _run(spark, base)
    _publish(spark, base, rows[200:])
    _beat(spark, base, t + dt.timedelta(minutes=6))
    _run(spark, base)
    want = sessions.session_counts(spark.createDataFrame(rows, DDL), ["pu", "do"], "drop_ts", "5 minutes")
    columns = ("pu", "do", "session_start", "session_end", "taxi_trips_streak")
    norm = lambda d: sorted(map(str, map(tuple, d.select(*columns).collect())))
    assert norm(spark.read.parquet(f"{base}/out")) == norm(want)
    assert _report(spark, base) == (300, 300, 0, 0)


def test_late_rows_are_counted_as_rows(spark):
    base, minute = scratch_path(spark, "t-late-count"), dt.timedelta(minutes=1)
    _publish(spark, base, [(1, 1, T0), (1, 1, T0), (1, 1, T0 + minute), (2, 2, T0 + 60 * minute), (3, 3, None)])
    _run(spark, base)
    assert _report(spark, base) == (4, 3, 1, 0)             # a row without a time is in no session and does not arrive
    # five late rows of one key, which a task merges into one session before the operator drops it; one that opens a session
    _publish(spark, base, [(1, 1, T0 + 2 * minute)] * 5 + [(4, 4, T0 + 61 * minute)])
    _run(spark, base)
    assert _report(spark, base) == (10, 3, 2, 5)
    _beat(spark, base, T0 + 600 * minute)
    _run(spark, base)
    assert _report(spark, base) == (10, 5, 0, 5)
    assert audit.batch_counts(spark, f"{base}/log").count() >= 3


@pytest.mark.parametrize("logged", [True, False])
def test_a_heartbeat_is_no_row_and_moves_the_watermark_only(spark, logged):
    base = scratch_path(spark, "t-beat-only")
    _beat(spark, base, T0 + dt.timedelta(days=1))
    _publish(spark, base, [(None, None, T0 + dt.timedelta(days=2))])
    _run(spark, base, logged)
    if logged:
        assert _report(spark, base) == (1, 0, 1, 0)
    assert spark.read.parquet(f"{base}/out").count() == 0
    _beat(spark, base, T0 + dt.timedelta(days=3))
    _run(spark, base, logged)
    got = spark.read.parquet(f"{base}/out").collect()
    assert [(r.pu, r.taxi_trips_streak) for r in got] == [(None, 1)]


def test_a_log_with_gaps_is_refused(spark):
    base = scratch_path(spark, "t-gap")
    _publish(spark, base, [(1, 1, T0)])
    _run(spark, base, logged=False)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        _report(spark, base)
    _publish(spark, base, [(1, 1, T0 + dt.timedelta(hours=1))])
    _run(spark, base)
    with pytest.raises(ValueError, match="lacks"):
        _report(spark, base)
