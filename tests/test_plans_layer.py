import datetime as dt
import os

from pyspark.sql import functions as F

from faresight.functions import columns as C
from faresight.plans import ingest, model_layer, settings
from faresight.session import scratch_path
from tests.conftest import SF_SMALL


def _local(p):
    return p[len("file:"):] if p.startswith("file:") else p


def test_model_layer_materialises_fact_once(spark):
    built = model_layer.models_from_test_tables(spark, SF_SMALL)
    fact_plan = built["fact_trips"]._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in fact_plan          # marts read the written fact, not the sources
    p90_plan = built["fhv_travel_time_p90"]._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in p90_plan
    assert built["monthly_zone_revenue"].count() > 0
    checks = {(r.check_name, r.column_name): r for r in built["checks_stg_green"].collect()}
    assert checks[("relationships", "dropoff_locationid")].severity == "error"
    model_layer.register_models(built)
    assert spark.sql("SELECT count(*) FROM fact_trips").first()[0] == built["fact_trips"].count()
    paths = model_layer.write_models(built, scratch_path(spark, "t-models"), ["fact_trips", "monthly_zone_revenue"])
    assert spark.read.parquet(paths["fact_trips"]).count() == built["fact_trips"].count()
    assert {r.service_type for r in spark.read.parquet(paths["fact_trips"]).select("service_type").distinct().collect()} \
        == {"Green", "Yellow"}


YELLOW_HEADER = ("VendorID,tpep_pickup_datetime,tpep_dropoff_datetime,passenger_count,trip_distance,RatecodeID,"
                 "store_and_fwd_flag,PULocationID,DOLocationID,payment_type,fare_amount,extra,mta_tax,tip_amount,"
                 "tolls_amount,improvement_surcharge,total_amount,congestion_surcharge")


def _month(path, day, n):
    with open(path, "w") as fh:
        fh.write(YELLOW_HEADER + "\n")
        for i in range(n):
            fh.write(f"1,{day} 00:{i:02d}:00,{day} 00:{i:02d}:30,1,1.{i},1,N,1,2,1,5.0,0,0.5,1,0,0.3,6.8,2.5\n")


def test_ingest_month_idempotent_and_backfill(spark):
    land = _local(scratch_path(spark, "t-landing"))
    os.makedirs(land, exist_ok=True)
    _month(f"{land}/yellow_tripdata_2020-01.csv", "2020-01-05", 3)
    _month(f"{land}/yellow_tripdata_2020-02.csv", "2020-02-05", 4)
    spark.sql("DROP TABLE IF EXISTS yellow_dwh")
    assert ingest.ingest_month(spark, land, "yellow", 2020, 1, "yellow_dwh", buckets=4)["inserted"] == 3
    assert ingest.ingest_month(spark, land, "yellow", 2020, 1, "yellow_dwh", buckets=4)["inserted"] == 0
    assert not spark.catalog.tableExists("yellow_tripdata_staging")
    # backfill Jan+Feb in one read: only February is new; each row keeps its file name
    assert ingest.ingest_months(spark, land, "yellow", [(2020, 1), (2020, 2)], "yellow_dwh", buckets=4) == 4
    got = {r.filename: r.rows for r in ingest.rows_per_file(spark, "yellow_dwh", ["yellow_tripdata_2020-%"]).collect()}
    assert got == {"yellow_tripdata_2020-01.csv": 3, "yellow_tripdata_2020-02.csv": 4}
    assert ingest.monthly_file_name("green", 2020, 4) == "green_tripdata_2020-04.csv"


def test_relative_window_and_formatted_day(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 25),)], "t timestamp_ntz")
    assert df.filter(C.since_days("t", 30, as_of="2024-01-30")).count() == 2
    assert df.filter(C.since_days("t", 10, as_of="2024-01-30")).count() == 1
    assert df.filter(C.on_day_formatted("t", "2024-01-25")).count() == 1
    p = spark.createDataFrame([("2019-10-18 07:08:09",)], "s string").select(C.parse_timestamp("s").alias("t"))
    assert p.first().t == dt.datetime(2019, 10, 18, 7, 8, 9)


def test_var_precedence(monkeypatch):
    monkeypatch.delenv("DAYS_BACK", raising=False)
    assert settings.var("days_back", 30) == 30
    monkeypatch.setenv("DAYS_BACK", "7")
    assert settings.var("days_back", 30) == 7
    assert settings.var("days_back", 30, {"days_back": 3}) == 3
    monkeypatch.setenv("IS_TEST_RUN", "false")
    assert settings.var("is_test_run", True) is False
