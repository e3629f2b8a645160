"""Physical-plan properties that matter at scale."""

from faresight.plans import queries as Q
from tests.conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_day_filter_reaches_the_scan(spark):
    p = plan(Q.trips_on_day(spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in p  # pickup is computed: only its columns are read


def test_ranges_reach_the_lineitem_scan(spark):
    def scan(df):  # the unabridged description of the lineitem scan
        text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        return next(part for part in text.split("\n\n") if "lineitem.parquet" in part)

    assert "LessThan(l_shipdate,1998-03-16" in scan(Q.vendors_in_range(spark, SF_SMALL))
    assert "GreaterThanOrEqual(l_shipdate," in scan(Q.top_pickup_zones(spark, SF_SMALL))
    assert "GreaterThanOrEqual(l_shipdate," in scan(Q.fhv_nth_longest_p90(spark, SF_SMALL))
    assert "GreaterThanOrEqual(l_shipdate," in scan(Q.rows_per_service_month(spark, SF_SMALL))


def test_only_the_joins_that_a_question_needs(spark):
    p = plan(Q.zero_fare_count(spark, SF_SMALL))
    assert "Join" not in p and "hashpartitioning" not in p
    p = plan(Q.longest_trip_day(spark, SF_SMALL))
    assert p.count("Join") == 1 and "supplier" not in p and "customer" not in p
    assert "supplier" not in plan(Q.zone_frequency(spark, SF_SMALL))


def test_largest_tip_and_longest_streak_read_their_input_once(spark):
    p = plan(Q.largest_tip_dropoff(spark, SF_SMALL))
    assert p.count("lineitem.parquet") == 1 and "WindowGroupLimit" in p
    p = plan(Q.longest_streak(spark, SF_SMALL))
    assert p.count("events.parquet") == 1 and "WindowGroupLimit" in p


def test_column_pruning_on_lineitem(spark):
    p = plan(Q.zone_frequency(spark, SF_SMALL))
    scan = [line for line in p.splitlines() if "lineitem.parquet" in line][0]
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linestatus:string>" in scan


def test_fact_side_not_broadcast_and_zones_broadcast(spark):
    p = plan(Q.fact_trips(spark, SF_SMALL))
    assert "SortMergeJoin [l_orderkey" in p
    assert "BroadcastHashJoin [pickup_locationid" in p and "BroadcastHashJoin [dropoff_locationid" in p


def test_service_filter_pushed_to_lineitem(spark):
    p = plan(Q.stg_green(spark, SF_SMALL))
    scan = [line for line in p.splitlines() if "lineitem.parquet" in line][0]
    assert "EqualTo(l_linestatus,O)" in scan


def test_dedup_limits_rows_before_shuffle(spark):
    p = plan(Q.stg_green(spark, SF_SMALL))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(Q.top_pickup_zones(spark, SF_SMALL))


def test_percentiles_of_one_group_are_spread(spark):
    from faresight.operators.models import exact_percentiles
    n = 40_000
    one = spark.range(n).selectExpr("'g' as k", "cast((id * 7919) % 1000003 as double) as v")
    got = exact_percentiles(one, ["k"], "v", [0.9, 0.5, 0.0, 1.0], ["p90", "p50", "p0", "p100"])
    values = sorted((i * 7919) % 1000003 for i in range(n))
    r = got.first()
    for p, name in ((0.9, "p90"), (0.5, "p50"), (0.0, "p0"), (1.0, "p100")):
        pos = p * (n - 1)
        lo = int(pos)
        hi = min(lo + 1, n - 1)
        assert abs(r[name] - (values[lo] + (pos - lo) * (values[hi] - values[lo]))) < 1e-6


def test_percentiles_come_from_a_distributed_histogram(spark):
    p = plan(Q.monthly_fare_percentiles(spark, SF_SMALL))
    # counts per (group, value) are a partial hash aggregate shuffled on (group, value) ...
    assert "partial_count" in p
    # ... the running count is over one bucket of a group, and only sketches are merged per group
    assert "percentile(" not in p and "partial_percentile_approx" in p
    assert any("Window" in line and "_b#" in line for line in p.splitlines())
