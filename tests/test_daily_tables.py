import datetime as dt
import uuid

from pyspark.sql import functions as F

from faresight.operators import nested, quality
from faresight.sinks import tables

DAY = dt.datetime(2024, 3, 1)


def _trips(spark, n, days=3):
    return spark.range(n).select(
        (F.col("id") * 7919 % 1000).alias("vendor"),
        F.timestamp_add("DAY", (F.col("id") % days).cast("int"), F.lit(DAY).cast("timestamp_ntz")).alias("at"))


def _name():
    return f"daily_{uuid.uuid4().hex[:8]}"


def _days(spark, name):
    return {str(r.d): r.n for r in spark.table(name).groupBy("d").agg(F.count(F.lit(1)).alias("n")).collect()}


def test_only_the_days_of_a_batch_are_replaced(spark):
    name = _name()
    tables.save_daily(_trips(spark, 300), name, "at", "vendor")
    before = {r[0] for r in spark.table(name).filter("d <> '2024-03-02'").select("_metadata.file_path").distinct().collect()}
    batch = spark.createDataFrame([(1, DAY + dt.timedelta(days=1, hours=5)), (2, DAY + dt.timedelta(days=9))],
                                  "vendor bigint, at timestamp_ntz")
    for _ in range(2):      # again: the same rows
        tables.replace_days(spark, batch, name, "at", "vendor")
    assert _days(spark, name) == {"2024-03-01": 100, "2024-03-02": 1, "2024-03-03": 100, "2024-03-10": 1}
    after = {r[0] for r in spark.table(name).filter("d IN ('2024-03-01', '2024-03-03')")
             .select("_metadata.file_path").distinct().collect()}
    assert before == after
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def _rows_scanned(df):
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().collectLeaves().apply(0).metrics().apply("numOutputRows").value()


def test_row_groups_of_other_vendors_are_skipped(spark):
    # one hot day: its rows are cut into ranges of vendors, so statistics leave few row groups to read
    name, plain = _name(), _name()
    trips = _trips(spark, 200_000, days=1)
    tables.save_daily(trips, name, "at", "vendor", row_group_bytes=16_384)
    trips.withColumn("d", F.to_date("at")).write.option("parquet.block.size", 16_384).partitionBy("d").saveAsTable(plain)
    one = lambda t: spark.table(t).filter("d = '2024-03-01' AND vendor = 500").select("vendor")
    assert one(name).count() == one(plain).count() == 200
    clustered, scattered = _rows_scanned(one(name)), _rows_scanned(one(plain))
    assert scattered == 200_000 and clustered < 0.2 * scattered


def test_a_hot_day_is_written_by_several_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        name = _name()
        tables.save_daily(_trips(spark, 50_000, days=1), name, "at", "vendor")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert spark.table(name).select("_metadata.file_name").distinct().count() >= 4


def test_several_unique_columns_are_checked_in_one_scan(spark, tmp_dir):
    rows = [(1, "a", 5.0), (2, "a", None), (2, None, 5.0), (3, None, 6.0), (None, "b", 6.0), (None, "c", 6.0)]
    spark.createDataFrame(rows, "k int, s string, v double").write.parquet(f"{tmp_dir}/t")
    df = spark.read.parquet(f"{tmp_dir}/t")
    out = quality.run_checks(df, [quality.unique("k", "warn"), quality.unique("s", "warn"), quality.unique("v", "warn"),
                                  quality.not_null("s", "warn"), quality.unique("k", "error")])
    got = sorted((r.check_name, r.column_name, r.severity, r.failures) for r in out.collect())
    assert got == [("not_null", "s", "warn", 2), ("unique", "k", "error", 1), ("unique", "k", "warn", 1),
                   ("unique", "s", "warn", 1), ("unique", "v", "warn", 2)]
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1 and "Expand" in plan
    empty = quality.run_checks(df.limit(0), [quality.unique("k", "warn"), quality.unique("s", "warn"), quality.not_null("v", "warn")])
    assert [r.failures for r in empty.collect()] == [0, 0, 0]


def test_identical_records_are_named_by_place_without_a_shuffle(spark):
    same = spark.range(3000).select(F.lit("x").alias("k"), F.array(F.struct(F.lit(1).alias("a"))).alias("kids"))
    made = nested.normalise(same, "t")
    for df in made.values():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Window" not in plan
    assert made["t"].select("_record_id").distinct().count() == 3000
    linked = made["t"].select("_record_id").join(made["t__kids"].select("_parent_id"), F.col("_record_id") == F.col("_parent_id"))
    assert linked.count() == 3000 and made["t__kids"].select("_parent_id").distinct().count() == 3000
