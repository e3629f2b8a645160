import datetime as dt
from decimal import Decimal

import pytest

from faresight.operators import adhoc, quality
from tests.fixtures import T0, raw, trip, zones


def test_tip_tie_keeps_all_max_rows(spark):
    # FLT12: two trips share the maximum tip; both drop-off zones are returned
    rows = [trip(key=1, pu="1", do="2", tip="9.00"), trip(key=2, pu="1", do="3", tip="9.00"),
            trip(key=3, pu="1", do="1", tip="1.00"), trip(key=4, pu="2", do="1", tip="99.00")]
    out = adhoc.largest_tip_dropoff(raw(spark, rows), zones(spark), "East Harlem North").collect()
    assert sorted(r.dropoff_zone for r in out) == ["JFK Airport", "Park Slope"]


def test_distance_bands_boundaries(spark):
    rows = [trip(key=i, dist=d) for i, d in enumerate([0.5, 1.0, 1.01, 3.0, 7.0, 10.0, 10.5])]
    r = adhoc.distance_bands(raw(spark, rows)).first().asDict()
    assert r == {"trips_upto_1": 2, "trips_1_to_3": 2, "trips_3_to_7": 1, "trips_7_to_10": 1, "trips_over_10": 1}


def test_distance_bands_date_range(spark):
    rows = [trip(key=1, pickup=dt.datetime(2019, 10, 1)), trip(key=2, pickup=dt.datetime(2019, 11, 1))]
    r = adhoc.distance_bands(raw(spark, rows), start="2019-10-01", end="2019-11-01").first()
    assert r.trips_upto_1 == 1


def test_longest_trip_day_of_month_vs_date(spark):
    # X11: day-of-month merges the 5th of two months
    rows = [trip(key=1, pickup=dt.datetime(2019, 10, 5), dist=5.0), trip(key=2, pickup=dt.datetime(2019, 11, 5), dist=7.0),
            trip(key=3, pickup=dt.datetime(2019, 10, 6), dist=6.0)]
    r = adhoc.longest_trip_day(raw(spark, rows), by="dayofmonth").first()
    assert (r.day, r.longest_trip) == (5, 7.0)
    r = adhoc.longest_trip_day(raw(spark, rows), by="date").first()
    assert (r.day, r.longest_trip) == (dt.date(2019, 11, 5), 7.0)


def test_top_pickup_zones_having_and_k(spark):
    day = dt.datetime(2019, 10, 18, 9)
    rows = [trip(key=1, pickup=day, pu="1", fare="500.00"), trip(key=2, pickup=day, pu="2", fare="300.00"),
            trip(key=3, pickup=day, pu="3", fare="50.00"), trip(key=4, pickup=day + dt.timedelta(days=1), pu="3",
                                                              fare="900.00")]
    out = adhoc.top_pickup_zones(raw(spark, rows), zones(spark), "2019-10-18", 100, k=3).collect()
    assert [r.zone for r in out] == ["East Harlem North", "JFK Airport"]


def test_trips_on_day_forms(spark):
    rows = [trip(key=1, pickup=dt.datetime(2024, 10, 15, 23, 59, 59, 500000)), trip(key=2, pickup=dt.datetime(2024, 10, 15))]
    df = raw(spark, rows)
    assert adhoc.trips_on_day(df, "2024-10-15").first().trips == 2
    assert adhoc.trips_on_day_bounds(df, "2024-10-15").first().trips == 1


def test_zone_frequency_rarest_first(spark):
    rows = [trip(key=i, pu="1") for i in range(3)] + [trip(key=9, pu="2")]
    out = adhoc.zone_frequency(raw(spark, rows), zones(spark)).collect()
    assert [(r.zone, r.frequency) for r in out] == [("JFK Airport", 1), ("East Harlem North", 3)]


def test_rows_by_file_names(spark):
    rows = [trip(key=1, service="Yellow", pickup=dt.datetime(2020, 12, 3)), trip(key=2, pickup=dt.datetime(2020, 4, 1))]
    got = {(r.filename, r.rows) for r in adhoc.rows_by_file(raw(spark, rows)).collect()}
    assert got == {("yellow_tripdata_2020-12.csv", 1), ("green_tripdata_2020-04.csv", 1)}


def test_avg_trip_minutes_semantics(spark):
    rows = [trip(key=1, pickup=dt.datetime(2024, 1, 1, 0, 0, 59), minutes=1)]
    base = raw(spark, rows)
    df = base.withColumn("dropoff_datetime", base.pickup_datetime + dt.timedelta(seconds=62))
    assert adhoc.avg_trip_minutes(df, "boundaries").first()[0] == Decimal("2.0000")
    assert adhoc.avg_trip_minutes(df, "elapsed").first()[0] == Decimal("1.0000")


def _dq_bad(spark):
    # DQ1-DQ4: duplicate key, NULL key, orphan zone, code 9
    rows = [("a", 1, 1), ("a", 2, 2), (None, 3, 9), ("b", 99, None)]
    return spark.createDataFrame(rows, "tripid string, pickup_locationid int, payment_type int")


def test_checks_find_failures(spark):
    checks = [quality.unique("tripid", "warn"), quality.not_null("tripid", "warn"),
              quality.relationships("pickup_locationid", zones(spark), "locationid", "warn"),
              quality.accepted_values("payment_type", [1, 2, 3, 4, 5, 6], "warn")]
    got = {(r.check_name, r.failures) for r in quality.run_checks(_dq_bad(spark), checks).collect()}
    assert got == {("unique", 1), ("not_null", 1), ("relationships", 1), ("accepted_values", 1)}
    # warn-only checks never raise
    quality.enforce(quality.run_checks(_dq_bad(spark), checks))


def test_checks_clean_and_error_severity(spark):
    clean = spark.createDataFrame([("a", 1, 1), ("b", 2, 6)], "tripid string, pickup_locationid int, payment_type int")
    checks = [quality.unique("tripid"), quality.not_null("tripid"),
              quality.relationships("pickup_locationid", zones(spark), "locationid"),
              quality.accepted_values("payment_type", [1, 2, 3, 4, 5, 6])]
    assert all(r.failures == 0 for r in quality.run_checks(clean, checks).collect())
    with pytest.raises(quality.CheckFailed):
        quality.enforce(quality.run_checks(_dq_bad(spark), [quality.unique("tripid", "error")]))


def test_count_equal_and_distinct(spark):
    rows = [trip(key=1, fare="0.00", pu="1"), trip(key=2, pu="2"), trip(key=3, pu="2")]
    df = raw(spark, rows)
    assert adhoc.count_equal(df, "fare_amount", 0).first()[0] == 1
    assert adhoc.distinct_count(df, "pulocationid").first()[0] == 2


def test_two_unique_checks_and_single_pass(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2), (None, 3), (None, 3)], "k1 string, k2 int")
    out = {(r.column_name, r.failures) for r in quality.run_checks(
        df, [quality.unique("k1"), quality.unique("k2"), quality.not_null("k1")]).collect()}
    assert out == {("k1", 1), ("k2", 2), ("k1", 2)} or out == {("k1", 1), ("k2", 2), ("k1", 2)}
    rows = quality.run_checks(df, [quality.unique("k1"), quality.not_null("k1")]).collect()
    assert sorted((r.check_name, r.failures) for r in rows) == [("not_null", 2), ("unique", 1)]


def test_top_k_is_bounded_and_ordered(spark):
    rows = [trip(key=i, tip=f"{i}.00") for i in range(20)]
    df = adhoc.top_k(raw(spark, rows), 3, "tip_amount", ["src_orderkey"])
    assert [int(r.tip_amount) for r in df.collect()] == [19, 18, 17]
    assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()
