import datetime as dt
import glob
import gzip
import os

import pytest
from pyspark.sql import functions as F

from faresight.session import scratch_path
from faresight.sinks import files as sink_files
from faresight.sinks import tables
from faresight.sources import catalog, files


def _local(p):
    return p[len("file:"):] if p.startswith("file:") else p


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_csv_inferred_fixed_and_gzip(spark):
    base = _local(scratch_path(spark, "t-csv"))
    os.makedirs(base, exist_ok=True)
    text = "LocationID,Borough,Zone\n1,EWR,Newark Airport\n2,Queens,Jamaica Bay\n"
    with open(f"{base}/zones.csv", "w") as fh:
        fh.write(text)
    with gzip.open(f"{base}/zones.csv.gz", "wt") as fh:
        fh.write(text)
    inferred = files.read_csv(spark, f"{base}/zones.csv")
    assert dict(inferred.dtypes)["LocationID"] == "int"
    fixed = files.read_csv(spark, f"{base}/zones.csv", schema="LocationID string, Borough string, Zone string")
    assert dict(fixed.dtypes)["LocationID"] == "string"
    gz = files.read_csv(spark, f"{base}/zones.csv.gz", repartition=2)
    assert gz.count() == 2 and gz.rdd.getNumPartitions() == 2
    ext = files.external_table(spark, "zones_ext", f"{base}/zones.csv", "LocationID int, Borough string, Zone string")
    assert spark.sql("SELECT count(*) FROM zones_ext").first()[0] == 2 and ext.count() == 2
    assert catalog.ddl_of(inferred).startswith("LocationID INT")


def test_repartition_write_and_glob_read(spark):
    out = scratch_path(spark, "t-parquet")
    df = spark.range(1000).withColumn("v", F.col("id") * 2)
    sink_files.write_parquet(df, out, partitions=4)
    parts = glob.glob(f"{_local(out)}/part-*.parquet")
    assert len(parts) == 4
    assert files.read_parquet(spark, f"{out}/*").count() == 1000


def test_json_write_and_read(spark):
    out = scratch_path(spark, "t-json")
    df = spark.createDataFrame([("A", 1.5, dt.datetime(2024, 1, 1, 0, 0, 0, 123456))],
                               "brand string, price double, ts timestamp_ntz")
    sink_files.write_json(df, out)
    back = files.read_json(spark, out, schema="brand string, price double, ts timestamp_ntz", multiline=False,
                           timestamp_format="yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    assert back.first().ts == dt.datetime(2024, 1, 1, 0, 0, 0, 123456)


def test_bucketed_target_avoids_shuffle_on_its_side(spark):
    spark.sql("DROP TABLE IF EXISTS bucketed_t")
    df = spark.range(2000).select(F.md5(F.col("id").cast("string")).alias("unique_row_id"), "id")
    tables.save_bucketed(df, "bucketed_t", "unique_row_id", 8)
    src = spark.range(1500, 2500).select(F.md5(F.col("id").cast("string")).alias("unique_row_id"), "id")
    from faresight.sinks.merge import new_rows
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = new_rows(src, spark.table("bucketed_t"))
        plan = _plan(j)
        assert j.count() == 500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # only the new batch is shuffled: one exchange, not two
    assert plan.count("Exchange hashpartitioning") == 1


def test_partitioned_clustered_table_prunes(spark):
    spark.sql("DROP TABLE IF EXISTS trips_part")
    rows = [(v, dt.datetime(2024, 3, d, 12)) for d in range(1, 21) for v in (1, 2)]
    df = spark.createDataFrame(rows, "VendorID int, tpep_dropoff_datetime timestamp_ntz")
    tables.save_partitioned_clustered(df, "trips_part", "tpep_dropoff_datetime", "VendorID", 2)
    q = spark.table("trips_part").filter(
        tables.date_partition_filter("tpep_dropoff_datetime", "2024-03-01", "2024-03-15")).select("VendorID").distinct()
    assert sorted(r[0] for r in q.collect()) == [1, 2]
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan


def test_ctas_truncate_drop_and_catalog(spark):
    tables.drop(spark, "copy_t")
    t = tables.materialize(spark, spark.range(5), "copy_t")
    assert t.count() == 5 and "copy_t" in catalog.list_tables(spark)
    assert catalog.describe(spark, "copy_t").count() >= 1
    tables.truncate(spark, "copy_t")
    assert spark.table("copy_t").count() == 0
    tables.create_table_if_absent(spark, "copy_t", "id bigint")  # no-op, exists
    tables.drop(spark, "copy_t")
    assert "copy_t" not in catalog.list_tables(spark)
    assert catalog.shape(spark.range(3)) == (3, 1)
    assert len(catalog.peek(spark.range(100), 5)) == 5


def _derby(spark):
    try:
        spark._jvm.java.lang.Class.forName("org.apache.derby.jdbc.EmbeddedDriver")
        return True
    except Exception:  # noqa: BLE001
        return False


def test_jdbc_roundtrip_in_process_derby(spark):
    # in-memory embedded Derby: a database only this JVM sees, no server or port
    if not _derby(spark):
        pytest.skip("no embedded Derby driver on the classpath")
    url = "jdbc:derby:memory:faresight;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    df = spark.createDataFrame([(1, "a"), (2, "b")], "ID int, NAME string")
    sink_files.append_jdbc(df, url, "T_ROWS", batch_size=1, properties=props)
    back = files.read_jdbc_query(spark, url, "SELECT ID, NAME FROM T_ROWS WHERE ID > 1", properties=props)
    assert [tuple(r) for r in back.collect()] == [(2, "b")]


def test_partitioned_jdbc_read(spark):
    if not _derby(spark):
        pytest.skip("no embedded Derby driver on the classpath")
    url = "jdbc:derby:memory:faresight_p;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    sink_files.append_jdbc(spark.range(100).selectExpr("CAST(id AS INT) AS ID"), url, "T_IDS", properties=props)
    df = files.read_jdbc_query(spark, url, "SELECT ID FROM T_IDS", properties=props, partition_column="ID",
                               lower=0, upper=100, num_partitions=4)
    assert df.rdd.getNumPartitions() == 4 and df.count() == 100


def test_stream_sessions_to_jdbc(spark):
    if not _derby(spark):
        pytest.skip("no embedded Derby driver on the classpath")
    from faresight.streaming import messages
    from faresight.streaming import sessions as ss
    url = "jdbc:derby:memory:faresight_s;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    base = scratch_path(spark, "t-stream-jdbc")
    t0 = dt.datetime(2024, 1, 1)
    rows = [(95, 95, t0), (95, 95, t0 + dt.timedelta(minutes=3)), (1, 2, t0),
            (None, None, t0 + dt.timedelta(days=1))]  # last row: flush marker
    ddl = "PULocationID int, DOLocationID int, lpep_dropoff_datetime timestamp_ntz"
    messages.publish(spark.createDataFrame(rows, ddl).coalesce(1), path=f"{base}/in")
    agg = ss.session_aggregate(ss.message_stream(spark, ddl, path=f"{base}/in"),
                               ["PULocationID", "DOLocationID"], "lpep_dropoff_datetime")
    q = ss.start(agg, f"{base}/ckpt", foreach_batch=ss.jdbc_batch_writer(url, "SESSIONS", props),
                 available_now=True)
    q.awaitTermination()
    back = files.read_jdbc_query(spark, url, "SELECT * FROM SESSIONS", properties=props)
    got = sorted((r.PULocationID, r.taxi_trips_streak) for r in back.collect())
    assert got == [(1, 1), (95, 2)]
    # a batch that is replayed after a failure replaces what it wrote before
    writer = ss.jdbc_batch_writer(url, "SESSIONS", props)
    batch = spark.createDataFrame(back.drop("batch_id").collect(), back.drop("batch_id").schema)
    for _ in range(2):
        writer(batch, 77)
    again = files.read_jdbc_query(spark, url, "SELECT * FROM SESSIONS", properties=props)
    assert again.filter("batch_id = 77").count() == 2 and again.count() == 4


def test_append_in_fixed_size_files(spark):
    out = scratch_path(spark, "t-batches")
    sink_files.append_parquet(spark.range(2500).coalesce(1), out, rows_per_file=1000)
    sink_files.append_parquet(spark.range(10).coalesce(1), out, rows_per_file=1000)
    parts = glob.glob(f"{_local(out)}/part-*.parquet")
    assert len(parts) == 4 and spark.read.parquet(out).count() == 2510
