import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from faresight.session import path_exists, scratch_path
from faresight.sinks import loads
from faresight.streaming import loads as streams

DDL = "id int, c int"


def _rows(spark, rows, ddl=DDL):
    return spark.createDataFrame(rows, ddl)


def _run(spark, base, resource, rows, **more):
    return loads.load_incremental(spark, _rows(spark, rows), f"{base}/t", f"{base}/state", resource, "c",
                                  **{"initial_value": 0, **more})


def _ids(spark, base):
    return sorted(r.id for r in loads.read_target(spark, f"{base}/t", StructType.fromDDL(DDL)).collect())


def test_two_resources_share_a_target(spark):
    base = scratch_path(spark, "t-two")
    assert _run(spark, base, "a", [(1, 1), (2, 2)])["rows"] == 2
    assert _run(spark, base, "b", [(3, 1)])["rows"] == 1
    assert _ids(spark, base) == [1, 2, 3]
    assert _run(spark, base, "a", [(1, 1), (2, 2), (4, 2), (5, 9)])["rows"] == 2
    assert _run(spark, base, "b", [(3, 1), (2, 2)])["rows"] == 1      # another resource's equal row is not its own
    assert _ids(spark, base) == [1, 2, 2, 3, 4, 5]
    state = loads.load_state(spark, f"{base}/state")
    assert sorted((r.load_id, r.resource, r.rows) for r in state.collect()) == [
        ("00000001", "a", 2), ("00000002", "b", 1), ("00000003", "a", 2), ("00000004", "b", 1)]


def test_replace_resets_the_cursor(spark):
    base = scratch_path(spark, "t-replace")
    _run(spark, base, "a", [(1, 1), (2, 2)])
    loads.load(spark, _rows(spark, []), f"{base}/t", "replace", f"{base}/state", "a")
    assert _run(spark, base, "a", [(1, 1), (2, 2)])["rows"] == 2
    assert _ids(spark, base) == [1, 2]
    loads.load(spark, _rows(spark, [(9, 9)]), f"{base}/t", "replace")      # without telling the state
    assert _run(spark, base, "a", [(1, 1)])["rows"] == 1
    assert _ids(spark, base) == [1, 9]


def test_a_died_run_of_another_resource_is_replaced(spark):
    base = scratch_path(spark, "t-died-other")
    _run(spark, base, "a", [(1, 1)])
    _rows(spark, [(7, 9)]).write.parquet(loads.partition_path(f"{base}/t", "00000002"))    # b died before its state
    _run(spark, base, "a", [(1, 1), (2, 2)])
    assert _ids(spark, base) == [1, 2]


def test_rows_at_the_cursor_are_compared_with_their_own_loads_only(spark):
    base = scratch_path(spark, "t-at")
    for top in (1, 2, 3):
        _run(spark, base, "a", [(i, i) for i in range(1, top + 1)])
    _, last, ids = loads._read_state(spark, f"{base}/state", "a", f"{base}/t")
    assert (last, ids) == ("3", ["00000003"])


def test_null_cursor_leaves_nothing(spark):
    base = scratch_path(spark, "t-null-part")
    _run(spark, base, "a", [(1, 1)])
    with pytest.raises(ValueError, match="1 rows with a NULL c"):
        _run(spark, base, "a", [(1, None), (2, 2)])
    assert _ids(spark, base) == [1]


def test_schema_versions(spark):
    base = scratch_path(spark, "t-schema")
    state, target = f"{base}/state", f"{base}/t"
    loads.load(spark, _rows(spark, [(1, 1)]), target, "append", state)
    loads.load(spark, _rows(spark, [(2, 2, "x")], DDL + ", tag string"), target, "append", state)
    loads.load(spark, _rows(spark, [(3,)], "id int"), target, "append", state)
    got = loads.read_loaded(spark, target, state).drop(loads.LOAD_ID)
    assert sorted(map(tuple, got.collect())) == [(1, 1, None), (2, 2, "x"), (3, None, None)]
    history = loads.schema_history(spark, state).orderBy("version").collect()
    assert [r.version for r in history] == [1, 2]
    with pytest.raises(ValueError, match="column c is int in the target and string"):
        loads.load(spark, _rows(spark, [(4, "x")], "id int, c string"), target, "append", state)
    assert loads.read_loaded(spark, target, state).count() == 3
    loads.load(spark, _rows(spark, [(4, "x")], "id int, c string"), target, "replace", state)
    assert loads.target_schema(spark, state, target)[0] == 3
    assert [r.c for r in loads.read_loaded(spark, target, state).collect()] == ["x"]


def _land(spark, base, resource, rows):
    _rows(spark, rows).coalesce(1).write.mode("append").parquet(f"{base}/landing/{resource}")


def _stream(spark, base, resource, **more):
    q = streams.start_load(spark, f"{base}/landing/{resource}", DDL, f"{base}/t", f"{base}/state", resource,
                           f"{base}/checkpoints", "c", 0, files_per_trigger=1, **more)
    q.awaitTermination()


def test_stream_of_two_resources_and_restarts(spark):
    base = scratch_path(spark, "t-stream-load")
    for arrival in ([(1, 1), (2, -5)], [(3, 2)], []):
        for resource in ("a", "b"):
            _land(spark, base, resource, arrival)
            _stream(spark, base, resource)
            _stream(spark, base, resource)      # nothing new
    assert _ids(spark, base) == [1, 1, 3, 3]
    told = {r.resource: (r.rows, r.cursor_value) for r in streams.resource_state(spark, f"{base}/state").collect()}
    assert told == {"a": (2, "2"), "b": (2, "2")}


@pytest.mark.parametrize("when", ["before the state", "after the state"])
def test_stream_batch_that_died_is_run_again(spark, monkeypatch, when):
    base = scratch_path(spark, "t-stream-died")
    _land(spark, base, "a", [(1, 1)])
    _stream(spark, base, "a")
    _land(spark, base, "a", [(2, 2), (3, 3)])
    write = streams.record

    def dies(*args):
        if when == "after the state":
            write(*args)
        raise RuntimeError("lost driver")

    monkeypatch.setattr(streams, "record", dies)
    with pytest.raises(Exception, match="lost driver"):
        _stream(spark, base, "a")
    monkeypatch.setattr(streams, "record", write)
    _stream(spark, base, "a")
    assert _ids(spark, base) == [1, 2, 3]
    assert sorted(r.rows for r in streams.stream_state(spark, f"{base}/state").collect()) == [1, 2]


def test_stream_null_cursor(spark):
    base = scratch_path(spark, "t-stream-null")
    _land(spark, base, "a", [(1, None), (2, 2)])
    with pytest.raises(Exception, match="NULL c"):
        _stream(spark, base, "a")
    assert not path_exists(spark, loads.partition_path(f"{base}/t", streams.batch_load_id("a", 0)))
    _stream(spark, base, "a", null_cursor="skip")
    assert _ids(spark, base) == [2]
    with pytest.raises(ValueError, match="cannot name a folder"):
        streams.batch_writer("t", "s", "a/b", StructType())
    assert streams.stream_state(spark, f"{base}/state").select(F.sum("rows")).first()[0] == 1
