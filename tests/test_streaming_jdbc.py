"""Exactly-once batches in an in-memory embedded Derby (only this JVM sees it: no server, no port)."""

import uuid

import pytest

from faresight.session import scratch_path
from faresight.sources import files
from faresight.streaming import jdbc

PROPS = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
DDL = "ID int, NAME string"


@pytest.fixture()
def url(spark):
    try:
        spark._jvm.java.lang.Class.forName(PROPS["driver"])
    except Exception:  # noqa: BLE001
        pytest.skip("no embedded Derby driver on the classpath")
    return f"jdbc:derby:memory:ledger_{uuid.uuid4().hex[:8]};create=true"


def _table(spark, url, sql="SELECT * FROM T"):
    return sorted(tuple(r) for r in files.read_jdbc_query(spark, url, sql, properties=PROPS).collect())


def _batch(spark, *ids):
    return spark.createDataFrame([(i, f"n{i}") for i in ids], DDL)


def _stream(spark, url, base, checkpoint="ckpt", **more):
    stream = spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    stream.writeStream.option("checkpointLocation", f"{base}/{checkpoint}").trigger(availableNow=True).foreachBatch(
        jdbc.ledger_writer(url, "T", PROPS, **more)).start().awaitTermination()


def test_stop_between_staging_and_promotion(spark, url, monkeypatch):
    base = scratch_path(spark, "t-ledger")
    _batch(spark, 1, 2).coalesce(1).write.mode("append").parquet(f"{base}/in")
    _stream(spark, url, base)
    assert _table(spark, url) == [(1, "n1", 0), (2, "n2", 0)]
    _batch(spark, 3).coalesce(1).write.mode("append").parquet(f"{base}/in")
    promote = jdbc.promote

    def dies(*args):
        raise RuntimeError("lost driver")

    monkeypatch.setattr(jdbc, "promote", dies)
    for _ in range(2):
        with pytest.raises(Exception, match="lost driver"):
            _stream(spark, url, base)
        assert _table(spark, url) == [(1, "n1", 0), (2, "n2", 0)]       # readers see no part of the batch
    assert _table(spark, url, "SELECT count(*) AS N FROM T_staging") == [(1,)]
    monkeypatch.setattr(jdbc, "promote", promote)
    _stream(spark, url, base)
    assert _table(spark, url) == [(1, "n1", 0), (2, "n2", 0), (3, "n3", 1)]
    assert [r[1:] for r in _table(spark, url, "SELECT * FROM T_ledger")] == [(0, 2), (1, 1)]


def test_stop_after_promotion_adds_nothing_again(spark, url, monkeypatch):
    base = scratch_path(spark, "t-ledger-after")
    _batch(spark, 1).coalesce(1).write.mode("append").parquet(f"{base}/in")
    promote = jdbc.promote

    def dies(*args):
        promote(*args)
        raise RuntimeError("lost driver")

    monkeypatch.setattr(jdbc, "promote", dies)
    with pytest.raises(Exception, match="lost driver"):
        _stream(spark, url, base)
    assert _table(spark, url) == [(1, "n1", 0)]
    monkeypatch.setattr(jdbc, "promote", promote)
    _stream(spark, url, base)
    assert _table(spark, url) == [(1, "n1", 0)]


def test_promotion_is_one_transaction(spark, url):
    writer = jdbc.ledger_writer(url, "T", PROPS, job="j")
    writer(_batch(spark, 1), 0)
    jdbc.stage(_batch(spark, 2, 3).selectExpr("*", "cast(1 as bigint) AS batch_id"), url, "T_staging", PROPS)
    with pytest.raises(RuntimeError, match="2 of 5"):       # after the copy, before the ledger: both are rolled back
        jdbc.promote(spark, url, "T", "T_staging", PROPS, ["ID", "NAME", "batch_id"], "j", 1, 5)
    assert _table(spark, url) == [(1, "n1", 0)]
    writer(_batch(spark, 2, 3), 1)
    assert [r[0] for r in _table(spark, url)] == [1, 2, 3]


def test_rows_staged_twice_are_staged_again(spark, url, monkeypatch):
    append, calls = jdbc._append, []

    def lost_executor(df, *args):       # the first time, a repeated task's rows are there twice
        append(df, *args)
        calls.append(1)
        if len(calls) == 2:
            append(df, *args)

    monkeypatch.setattr(jdbc, "_append", lost_executor)
    jdbc.ledger_writer(url, "T", PROPS)(_batch(spark, 1, 2, 3).repartition(3), 0)
    assert [r[0] for r in _table(spark, url)] == [1, 2, 3] and len(calls) == 3


def test_a_new_checkpoint_is_another_job(spark, url):
    base = scratch_path(spark, "t-ledger-job")
    _batch(spark, 1).coalesce(1).write.mode("append").parquet(f"{base}/in")
    _stream(spark, url, base, "one")
    _stream(spark, url, base, "two")
    assert _table(spark, url) == [(1, "n1", 0), (1, "n1", 0)]
    _stream(spark, url, base, "two")
    assert len(_table(spark, url)) == 2
    assert len({r[0] for r in _table(spark, url, "SELECT * FROM T_ledger")}) == 2


def test_empty_batches(spark, url):
    writer = jdbc.ledger_writer(url, "T", PROPS)
    writer(_batch(spark, 1).limit(0), 0)
    writer(_batch(spark, 5), 1)
    assert _table(spark, url) == [(5, "n5", 1)]
