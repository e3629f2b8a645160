import datetime as dt
import json
import os

from pyspark.sql import functions as F

from faresight.operators import nested
from faresight.session import scratch_path
from faresight.sinks import loads, merge
from faresight.sources import files

YELLOW_CSV_DDL = ("VendorID string, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, "
                  "passenger_count int, trip_distance double, PULocationID string, DOLocationID string, "
                  "fare_amount double")
KEYS7 = ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID",
         "fare_amount", "trip_distance"]
KEYS5 = KEYS7[:5]


def _local(p):
    return p[len("file:"):] if p.startswith("file:") else p


def _write_csv(path, header, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(",".join(header) + "\n")
        for r in rows:
            fh.write(",".join("" if v is None else str(v) for v in r) + "\n")


HEADER = ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance",
          "PULocationID", "DOLocationID", "fare_amount"]


def test_merge_dups_and_idempotence(spark):
    # X10: a key duplicated inside the source is inserted twice; a key already in the target is skipped
    base = _local(scratch_path(spark, "t-merge"))
    _write_csv(f"{base}/yellow_tripdata_2020-01.csv", HEADER, [
        ("1", "2020-01-01 00:00:00", "2020-01-01 00:10:00", 1, 1.5, "1", "2", 7.5)])
    _write_csv(f"{base}/yellow_tripdata_2020-02.csv", HEADER, [
        ("1", "2020-01-01 00:00:00", "2020-01-01 00:10:00", 1, 1.5, "1", "2", 7.5),   # already in target
        ("2", "2020-02-01 00:00:00", "2020-02-01 00:10:00", 1, 2.5, "1", "2", 9.0),
        ("2", "2020-02-01 00:00:00", "2020-02-01 00:10:00", 1, 2.5, "1", "2", 9.0)])  # dup inside source
    jan = merge.stamp(files.read_csv(spark, f"{base}/yellow_tripdata_2020-01.csv", YELLOW_CSV_DDL), KEYS7)
    spark.sql("DROP TABLE IF EXISTS yellow_target")
    jan.limit(0).write.format("parquet").saveAsTable("yellow_target")
    merge.merge_insert_only(spark, jan, "yellow_target")
    feb = merge.stamp(files.read_csv(spark, f"{base}/yellow_tripdata_2020-02.csv", YELLOW_CSV_DDL), KEYS7)
    merge.merge_insert_only(spark, feb, "yellow_target")
    t = spark.table("yellow_target")
    assert t.count() == 3
    assert sorted(r.filename for r in t.collect()) == ["yellow_tripdata_2020-01.csv",
                                                      "yellow_tripdata_2020-02.csv", "yellow_tripdata_2020-02.csv"]
    # idempotent: the same file again adds nothing
    merge.merge_insert_only(spark, feb, "yellow_target")
    assert spark.table("yellow_target").count() == 3
    # dedupe_source keeps one copy of an in-batch duplicate
    new = merge.new_rows(feb, jan, dedupe_source=True)
    assert new.count() == 1


def test_key_sets_differ(spark):
    # X7: 7-column key separates trips the 5-column key merges
    rows = [("1", dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 1, 0, 10), 1, 1.5, "1", "2", 7.5),
            ("1", dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 1, 0, 10), 1, 2.5, "1", "2", 9.5)]
    df = spark.createDataFrame(rows, YELLOW_CSV_DDL)
    assert merge.stamp(df, KEYS7, "f").select("unique_row_id").distinct().count() == 2
    assert merge.stamp(df, KEYS5, "f").select("unique_row_id").distinct().count() == 1


def test_copy_in_selected_columns(spark):
    base = _local(scratch_path(spark, "t-copy"))
    _write_csv(f"{base}/g.csv", ["VendorID", "fare_amount"], [("1", 2.5)])
    df = files.read_csv_columns(spark, f"{base}/g.csv", "VendorID string, fare_amount double",
                                ["VendorID", "fare_amount", "ehail_fee"])
    r = df.first()
    assert (r.VendorID, r.fare_amount, r.ehail_fee) == ("1", 2.5, None)


def test_incremental_load_cursor_rules(spark):
    base = scratch_path(spark, "t-incr")
    ddl = "id int, Trip_Dropoff_DateTime timestamp_ntz"
    first = spark.createDataFrame([(1, dt.datetime(2009, 6, 14)), (2, dt.datetime(2009, 6, 15)),
                                   (3, dt.datetime(2009, 6, 16))], ddl)
    i1 = loads.load_incremental(spark, first, f"{base}/rides", f"{base}/state", "rides",
                                "Trip_Dropoff_DateTime", initial_value="2009-06-15")
    assert i1["rows"] == 2   # first run: cursor >= initial
    second = first.unionByName(spark.createDataFrame([(4, dt.datetime(2009, 6, 16)), (5, dt.datetime(2009, 6, 17))], ddl))
    i2 = loads.load_incremental(spark, second, f"{base}/rides", f"{base}/state", "rides",
                                "Trip_Dropoff_DateTime", initial_value="2009-06-15")
    assert i2["rows"] == 2   # later runs: cursor >= last, less what is loaded (row 4 has the stored cursor)
    i3 = loads.load_incremental(spark, second, f"{base}/rides", f"{base}/state", "rides",
                                "Trip_Dropoff_DateTime", initial_value="2009-06-15")
    assert i3["rows"] == 0
    assert sorted(r.id for r in spark.read.parquet(f"{base}/rides").collect()) == [2, 3, 4, 5]
    assert loads.load_state(spark, f"{base}/state").count() == 3


def _cursor_run(spark, base, rows, **more):
    df = spark.createDataFrame(rows, "id int, c int")
    return loads.load_incremental(spark, df, f"{base}/t", f"{base}/state", "rows", "c", initial_value=0, **more)


def _loaded(spark, base):
    return sorted(r.id for r in loads.read_target(spark, f"{base}/t", spark.createDataFrame([], "id int, c int").schema).collect())


def test_empty_runs_load_nothing(spark):
    base = scratch_path(spark, "t-empty")
    assert _cursor_run(spark, base, [])["rows"] == 0
    assert _cursor_run(spark, base, [(1, 5)])["rows"] == 1
    assert _cursor_run(spark, base, [])["rows"] == 0
    assert _cursor_run(spark, base, [(1, 5), (2, 5), (1, 5)])["rows"] == 2   # 2, and the second copy of 1
    assert _loaded(spark, base) == [1, 1, 2]
    assert loads.load(spark, spark.createDataFrame([], "id int"), f"{base}/r", "replace")["rows"] == 0


def test_null_cursor_is_an_error_or_skipped(spark):
    import pytest
    base = scratch_path(spark, "t-null")
    with pytest.raises(ValueError, match="NULL c"):
        _cursor_run(spark, base, [(1, None), (2, 3)])
    assert _cursor_run(spark, base, [(1, None), (2, 3)], null_cursor="skip")["rows"] == 1
    assert _cursor_run(spark, base, [(1, None), (2, 3)], null_cursor="skip")["rows"] == 0


def test_a_run_that_died_before_its_state_is_not_loaded_twice(spark):
    base = scratch_path(spark, "t-died")
    _cursor_run(spark, base, [(1, 1)])
    spark.createDataFrame([(7, 9)], "id int, c int").write.parquet(f"{base}/t/_load_id=00000002")  # no state row
    assert _cursor_run(spark, base, [(1, 1), (2, 2)])["rows"] == 1
    assert _loaded(spark, base) == [1, 2]


def test_unreadable_state_is_an_error(spark):
    import pytest
    base = _local(scratch_path(spark, "t-bad-state"))
    os.makedirs(f"{base}/state")
    with open(f"{base}/state/part-0.parquet", "w") as fh:
        fh.write("not parquet")
    with pytest.raises(Exception):  # noqa: B017
        _cursor_run(spark, base, [(1, 1)])


def test_replace_replaces_under_dynamic_overwrite(spark):
    base = scratch_path(spark, "t-dynamic")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for _ in range(2):
            loads.load(spark, spark.createDataFrame([(1,), (2,)], "id int"), f"{base}/t", "replace")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert spark.read.parquet(f"{base}/t").count() == 2


def test_group_mean_rounds_once(spark):
    from faresight.operators.adhoc import rounded_group_mean
    df = spark.createDataFrame([("a", "0.005"), ("a", "0.005"), ("a", "0")], "k string, v string")
    assert float(rounded_group_mean(df, "k", "v", "m").first().m) == 0.0


def test_replace_and_append(spark):
    base = scratch_path(spark, "t-load")
    df = spark.createDataFrame([(1,), (2,)], "id int")
    assert loads.load(spark, df, f"{base}/t", "replace")["rows"] == 2
    assert loads.load(spark, df, f"{base}/t", "append")["rows"] == 2
    assert spark.read.parquet(f"{base}/t").count() == 4
    loads.load(spark, df, f"{base}/t", "replace")
    assert spark.read.parquet(f"{base}/t").count() == 2


SAMPLE = {
    "vendor_name": "Blue Cabs", "record_hash": "ride-0001",
    "time": {"pickup": "2015-02-03 07:05:09", "dropoff": "2015-02-03 07:31:40"},
    "coordinates": {"start": {"lon": 8.54, "lat": 47.37}, "end": {"lon": 8.61, "lat": 47.44}},
    "passengers": [{"name": "Ana", "rating": 3.2}, {"name": "Ben", "rating": 4.4}],
}


def test_nested_rides_normalise(spark):
    # NST1/NST2 + SRC9: sample record, one with an empty list, one with a NULL struct; page 2 is []
    base = _local(scratch_path(spark, "t-pages"))
    os.makedirs(base, exist_ok=True)
    r2 = dict(SAMPLE, record_hash="h2", passengers=[])
    r3 = dict(SAMPLE, record_hash="h3", coordinates=None)
    with open(f"{base}/page_1.json", "w") as fh:
        json.dump([SAMPLE, r2, r3], fh)
    with open(f"{base}/page_2.json", "w") as fh:
        json.dump([], fh)
    df = files.read_json_pages(spark, base)
    tables = nested.normalise(df, "rides", key="record_hash")
    assert set(tables) == {"rides", "rides__passengers"}
    rides = tables["rides"]
    assert {"coordinates__start__lon", "time__pickup", "vendor_name", "_record_id"} <= set(rides.columns)
    assert rides.count() == 3
    all_kids = tables["rides__passengers"]
    assert all_kids.count() == 4  # 2 + 0 (empty list) + 2
    kids = all_kids.filter(F.col("_parent_id") == SAMPLE["record_hash"]).orderBy("_list_idx").collect()
    assert [(k._parent_id, k._list_idx, k.name) for k in kids] == [(SAMPLE["record_hash"], 0, "Ana"),
                                                                   (SAMPLE["record_hash"], 1, "Ben")]
    h3 = rides.filter(F.col("record_hash") == "h3").first()
    assert h3.coordinates__start__lon is None


def test_unwrap_products(spark):
    base = _local(scratch_path(spark, "t-products"))
    os.makedirs(base, exist_ok=True)
    with open(f"{base}/data.json", "w") as fh:
        json.dump({"products": [{"brand": "A", "price": 1.0}, {"price": 3.0}, {"brand": "A", "price": 2.0}]}, fh)
    from faresight.functions.columns import keep_keys
    from faresight.operators.adhoc import rounded_group_mean
    kept = keep_keys(nested.unwrap(files.read_json(spark, f"{base}/data.json"), "products"), ["brand", "price"])
    out = {r.brand: r.avg_price for r in rounded_group_mean(kept, "brand", "price", "avg_price").collect()}
    assert {k: float(v) for k, v in out.items()} == {"A": 1.5, "N/A": 3.0}


def test_in_memory_nested_records_and_grandchildren(spark):
    # SRC12 + NST1/NST2: the sample record as Python dicts; a list inside list elements -> grandchild table
    rec = dict(SAMPLE, passengers=[{"name": "Ana", "rating": 3.2, "tags": ["a", "b"]},
                                   {"name": "Ben", "rating": 4.4, "tags": []}])
    df = files.from_records(spark, [rec])
    tables = nested.normalise(df, "rides", key="record_hash")
    assert set(tables) == {"rides", "rides__passengers", "rides__passengers__tags"}
    assert "coordinates__end__lat" in tables["rides"].columns
    kids = tables["rides__passengers"].collect()
    tags = tables["rides__passengers__tags"].collect()
    ana = [k for k in kids if k.name == "Ana"][0]
    assert sorted((t._list_idx, t.value) for t in tags) == [(0, "a"), (1, "b")]
    assert {t._parent_id for t in tags} == {ana._record_id}
