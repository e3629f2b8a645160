import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from faresight.operators import models, staging
from tests.fixtures import T0, raw, trip, zones


def test_dedupe_ties_keeps_first_by_tiebreak_and_drops_null_vendor(spark):
    # X1 + FLT1: three trips share (vendor, pickup); NULL vendor is dropped
    rows = [trip(key=3, fare="30.00"), trip(key=1, fare="10.00"), trip(key=2, fare="20.00"),
            trip(vendor=None, key=9)]
    out = staging.stage_trips(raw(spark, rows), tiebreak=["src_orderkey"]).collect()
    assert len(out) == 1
    assert out[0].fare_amount == Decimal("10.00")


def test_stage_types_and_payment(spark):
    rows = [trip(key=1, pay=None), trip(key=2, pickup=T0 + dt.timedelta(hours=1), pay=2)]
    out = staging.stage_trips(raw(spark, rows), tiebreak=["src_orderkey"])
    types = dict(out.dtypes)
    assert types["fare_amount"] == "decimal(18,2)" and types["trip_distance"] == "decimal(18,2)"
    assert types["vendorid"] == "int" and types["pickup_datetime"] == "timestamp_ntz"
    got = {(r.payment_type, r.payment_type_description) for r in out.collect()}
    assert got == {(0, "EMPTY"), (2, "Cash")}


def test_yellow_is_street_hail(spark):
    out = staging.stage_trips(raw(spark, [trip(ttype="2")]), street_hail_only=True,
                              tiebreak=["src_orderkey"]).first()
    assert out.trip_type == 1 and out.ehail_fee == Decimal("0.00")


def test_without_a_tiebreak_all_columns_decide(spark):
    rows = [trip(key=9), trip(key=3), trip(key=5)]  # one vendor and pickup time
    for part in (1, 3):
        one = staging.stage_trips(raw(spark, rows).repartition(part)).collect()
        two = staging.stage_trips(raw(spark, rows[::-1]).repartition(part)).collect()
        assert len(one) == 1 and one == two


def test_dedupe_plan_has_partial_window_group_limit(spark):
    rows = [trip(key=i) for i in range(3)]
    plan = staging.stage_trips(raw(spark, rows), tiebreak=["src_orderkey"])._jdf.queryExecution() \
        .executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_fact_trips_drops_unknown_zones(spark):
    g = staging.stage_trips(raw(spark, [trip(key=1, pu="1", do="2"), trip(key=2, pu="1", do="264",
                                                                          pickup=T0 + dt.timedelta(hours=1))]),
                            tiebreak=["src_orderkey"])
    y = staging.stage_trips(raw(spark, [trip(key=3, pu="3", do="1", service="Yellow")]),
                            street_hail_only=True, tiebreak=["src_orderkey"])
    fact = models.fact_trips(g, y, zones(spark)).collect()
    assert sorted((r.service_type, r.pickup_zone, r.dropoff_zone) for r in fact) == \
        [("Green", "East Harlem North", "JFK Airport"), ("Yellow", "Park Slope", "East Harlem North")]


def test_dim_fhv_excludes_ids(spark):
    fhv = spark.createDataFrame(
        [("B1", T0, T0 + dt.timedelta(minutes=5), 1, 2, None, "B1"),
         ("B1", T0, T0 + dt.timedelta(minutes=5), 1, 265, None, "B1")],
        "dispatching_base_num string, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, "
        "pulocationid int, dolocationid int, sr_flag int, affiliated_base_number string")
    out = models.dim_fhv_trips(staging.stage_fhv(fhv), zones(spark)).collect()
    assert len(out) == 1 and out[0].year == 2020 and out[0].month == 3


def _fact(spark, rows):
    cols = "service_type string, pickup_datetime timestamp_ntz, total_amount decimal(18,2)"
    return spark.createDataFrame(rows, cols)


def test_growth_zero_and_missing_previous(spark):
    # WIN3: previous-year revenue 0 -> NULL growth; missing previous -> NULL lag
    rows = [("Green", dt.datetime(2019, 1, 5), Decimal("0.00")), ("Green", dt.datetime(2020, 1, 5), Decimal("5.00")),
            ("Green", dt.datetime(2019, 4, 5), Decimal("10.00")), ("Green", dt.datetime(2020, 4, 5), Decimal("15.00")),
            ("Green", dt.datetime(2020, 7, 5), Decimal("7.00"))]
    out = {(r.year, r.quarter): r for r in models.quarterly_revenue_growth(_fact(spark, rows)).collect()}
    assert out[(2020, 1)].lag_total_revenue == Decimal("0.00") and out[(2020, 1)].yoy_growth is None
    assert out[(2020, 2)].yoy_growth == 0.5
    assert out[(2020, 3)].lag_total_revenue is None and out[(2020, 3)].yoy_growth is None
    assert len(out) == 5  # X3: no truncation


def test_fare_percentiles_interpolate(spark):
    import numpy as np
    fares = [Decimal(x) for x in ("1.00", "2.00", "3.00", "4.00", "10.00")]
    rows = [("Green", T0, f, Decimal("1.00"), "Cash") for f in fares]
    df = spark.createDataFrame(rows, "service_type string, pickup_datetime timestamp_ntz, fare_amount decimal(18,2), "
                                     "trip_distance decimal(18,2), payment_type_description string")
    r = models.monthly_fare_percentiles(df).first()
    arr = np.array([float(f) for f in fares])
    assert r.p97 == round(float(np.percentile(arr, 97)), 4)
    assert r.p90 == round(float(np.percentile(arr, 90)), 4)


def test_p90_join_back_equals_window(spark):
    rows = []
    for i in range(40):
        rows.append(("B1", T0, T0 + dt.timedelta(seconds=60 * (i % 7) + i), 2020, 3, i % 2, "A", "Z", 1, "A", "Z",
                     None, "B1"))
    dim = spark.createDataFrame(rows, "dispatching_base_num string, pickup_datetime timestamp_ntz, "
                                      "dropoff_datetime timestamp_ntz, year int, month int, pulocationid int, "
                                      "pickup_borough string, pickup_zone string, dolocationid int, "
                                      "dropoff_borough string, dropoff_zone string, sr_flag int, "
                                      "affiliated_base_number string")
    from pyspark.sql import Window
    got = models.fhv_travel_time_p90(dim)
    t = models.with_trip_duration(dim)
    want = t.withColumn("trip_duration_p90", F.round(F.percentile("trip_duration", 0.9).over(
        Window.partitionBy("year", "month", "pulocationid", "dolocationid")), 4))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_single_pass_staging_equals_per_service_union(spark):
    rows = [trip(key=1), trip(key=2), trip(key=3, service="Yellow", ttype="2"),
            trip(key=4, service="Yellow", pickup=T0 + dt.timedelta(hours=1), pay=None),
            trip(key=5, service="Green", vendor="2", pu="3", do="264")]
    r = raw(spark, rows)
    green = staging.stage_trips(r.filter("service_type = 'Green'"), tiebreak=["src_orderkey"])
    yellow = staging.stage_trips(r.filter("service_type = 'Yellow'"), street_hail_only=True, tiebreak=["src_orderkey"])
    a = models.fact_trips(green, yellow, zones(spark))
    b = models.fact_trips_staged(staging.stage_services(r, tiebreak=["src_orderkey"]), zones(spark))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert a.count() == 3
