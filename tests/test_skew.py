"""A key holding a third of all rows must not pin its rows to one task."""

import datetime as dt

from pyspark.sql import functions as F

from faresight.operators import models, staging

T = dt.datetime(2020, 3, 1)
TIGHT_AQE = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
             "spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.shuffle.partitions": "32"}


def _with_conf(spark, conf, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return fn()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _hot_fhv(spark, n=30000):
    hot = F.col("id") % 3 == 0
    return spark.range(n).select(
        F.lit("B1").alias("dispatching_base_num"), F.lit(T).cast("timestamp_ntz").alias("pickup_datetime"),
        F.timestamp_add("SECOND", F.col("id") % 997, F.lit(T).cast("timestamp_ntz")).alias("dropoff_datetime"),
        F.lit(2020).alias("year"), F.lit(3).alias("month"),
        F.when(hot, F.lit(1)).otherwise((F.col("id") % 500).cast("int")).alias("pulocationid"),
        F.lit("A").alias("pickup_borough"), F.lit("Z").alias("pickup_zone"),
        F.when(hot, F.lit(1)).otherwise((F.col("id") % 7).cast("int")).alias("dolocationid"),
        F.lit("A").alias("dropoff_borough"), F.lit("Z").alias("dropoff_zone"),
        F.lit(None).cast("int").alias("sr_flag"), F.lit("B1").alias("affiliated_base_number"))


def test_p90_join_back_splits_a_hot_group(spark):
    def run():
        df = models.fhv_travel_time_p90(_hot_fhv(spark))
        rows = df.collect()
        return rows, df._jdf.queryExecution().executedPlan().toString()
    rows, plan = _with_conf(spark, TIGHT_AQE, run)
    assert len(rows) == 30000
    assert "SortMergeJoin(skew=true)" in plan


def test_dedup_forwards_one_row_per_key_per_task(spark):
    # every row shares one (vendor, pickup): the partial limit keeps one row per map task
    df = spark.range(20000).repartition(8).select(
        F.when(F.col("id") >= 0, F.lit("1")).otherwise(F.lit("2")).alias("vendorid"),
        F.when(F.col("id") >= 0, F.lit(T).cast("timestamp_ntz")).alias("pickup_datetime"), F.col("id"))
    out = staging.dedupe_first(df, ["vendorid", "pickup_datetime"], [F.col("id")])
    assert [r.id for r in out.collect()] == [0]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_merge_anti_join_splits_a_hot_row_id(spark):
    from faresight.sinks.merge import new_rows

    def run():
        src = spark.range(30000).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.md5(F.col("id").cast("string"))).alias("unique_row_id"),
            F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))
        tgt = spark.range(0, 30000, 2).select(F.md5(F.col("id").cast("string")).alias("unique_row_id"), F.col("id"))
        df = new_rows(src, tgt)
        rows = df.collect()
        return rows, df._jdf.queryExecution().executedPlan().toString()
    rows, plan = _with_conf(spark, TIGHT_AQE, run)
    # hot id (10,000 in-batch duplicates, absent from the target) all kept; odd ids kept
    assert sum(1 for r in rows if r.unique_row_id == "hot") == 10000
    assert "SortMergeJoin(skew=true)" in plan


def test_a_merge_writes_one_file_for_each_bucket(spark):
    import glob

    from faresight.session import scratch_path
    from faresight.sinks import merge, tables

    base = scratch_path(spark, "t-bucket-files")
    spark.sql("DROP TABLE IF EXISTS bucket_files")
    tables.save_bucketed(spark.createDataFrame([], "unique_row_id string, v bigint"), "bucket_files", "unique_row_id", 4, path=base)

    def batch(lo, hi):
        return spark.range(lo, hi, 1, 8).selectExpr("md5(cast(id as string)) as unique_row_id", "id as v")

    for lo, hi, want in ((0, 2000, 2000), (1500, 3000, 1000), (0, 3000, 0)):
        before = len(glob.glob(f"{base.removeprefix('file:')}/part-*"))
        assert merge.merge_insert_only(spark, batch(lo, hi), "bucket_files") == want
        assert len(glob.glob(f"{base.removeprefix('file:')}/part-*")) - before <= 4
    assert spark.table("bucket_files").count() == 3000
    # a hot id of the batch is inserted as often as it occurs, in bounded files, and only once
    hot = spark.range(0, 4000, 1, 8).selectExpr("md5(if(id % 3 = 0, 'hot', cast(id + 9000 as string))) as unique_row_id", "id as v")
    assert merge.merge_insert_only(spark, hot, "bucket_files") == 4000
    assert merge.merge_insert_only(spark, hot, "bucket_files") == 0


def test_strict_csv_refuses_other_headers_and_values(spark):
    import os

    import pytest

    from faresight.session import scratch_path
    from faresight.sources import files

    base = scratch_path(spark, "t-strict").removeprefix("file:")
    os.makedirs(base)
    for name, text in (("good", "a,b\n1,2.5\n"), ("order", "b,a\n1,2\n"), ("value", "a,b\n1.0,2.5\n")):
        with open(f"{base}/{name}.csv", "w") as fh:
            fh.write(text)
    assert [tuple(r) for r in files.read_csv(spark, f"{base}/good.csv", "a int, b double").collect()] == [(1, 2.5)]
    for name in ("order", "value"):
        with pytest.raises(Exception):  # noqa: B017
            files.read_csv(spark, f"{base}/{name}.csv", "a int, b double").collect()
        with pytest.raises(Exception):  # noqa: B017
            files.external_table(spark, "t_strict", f"{base}/{name}.csv", "a int, b double").collect()
    both = files.read_csv_columns(spark, f"{base}/good.csv", "a int, b double", ["b", "c int"])
    assert both.dtypes == [("b", "double"), ("c", "int")] and both.first().c is None


def test_nested_lists_of_lists_and_identical_records(spark):
    from faresight.operators import nested

    df = spark.createDataFrame([([[1, 2], [3]], "x"), ([[1, 2], [3]], "x"), ([], "y")], "m array<array<int>>, k string")
    made = nested.normalise(df, "t")
    assert set(made) == {"t", "t__m", "t__m__value"}
    ids = [r._record_id for r in made["t"].collect()]
    assert len(set(ids)) == 3
    rows = made["t__m"].collect()
    assert len(rows) == 4 and len({r._parent_id for r in rows}) == 2
    assert sorted(r.value for r in made["t__m__value"].collect()) == [1, 1, 2, 2, 3, 3]
