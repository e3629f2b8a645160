"""Every registered query equals its DuckDB oracle on the smallest tables."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from faresight.plans.oracle import SQL
from faresight.plans.queries import QUERIES
from faresight.sources.tables import TABLES
from tests.conftest import SF_SMALL
from tools.check_oracle import rows_of


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF_SMALL)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(SQL[key])
    want = rows_of(rel.columns, rel.fetchall())
    assert sorted(df.columns) == sorted(rel.columns)
    assert Counter(got) == Counter(want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "revenue_monthly_total_amount" in df.columns


@pytest.mark.parametrize("key", ["trips_on_day", "avg_trip_minutes", "session_streaks", "monthly_zone_revenue",
                                 "vendors_in_range", "load_incremental"])
def test_results_do_not_depend_on_session_time_zone(spark, con, key):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = QUERIES[key](spark, SF_SMALL)
        got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    rel = con.sql(SQL[key])
    assert Counter(got) == Counter(rows_of(rel.columns, rel.fetchall()))


def test_session_oracle_is_stable_under_tied_timestamps(spark):
    # many rows share a timestamp: every tied row must land in the same session
    import datetime as dt

    from faresight.operators import sessions
    from faresight.plans.oracle import sessions_cte, with_ctes
    t0 = dt.datetime(2000, 1, 1)
    rows = [(1, t0)] + [(1, t0 + dt.timedelta(days=9))] * 5 + [(1, t0 + dt.timedelta(days=9, minutes=4))]
    c = duckdb.connect()
    c.execute("CREATE TABLE rides (k INTEGER, dropoff_datetime TIMESTAMP)")
    c.executemany("INSERT INTO rides VALUES (?, ?)", rows)
    sql = with_ctes(sessions_cte("s", "k", 300_000_000, "5 minutes"), body="SELECT * FROM s")
    want = sorted((r[1], r[3]) for r in c.execute(sql).fetchall())
    df = spark.createDataFrame(rows, "k int, dropoff_datetime timestamp_ntz")
    got = sorted((r.session_start, r.taxi_trips_streak)
                 for r in sessions.session_counts(df, ["k"], "dropoff_datetime", "5 minutes").collect())
    assert got == want == [(t0, 1), (t0 + dt.timedelta(days=9), 6)]
