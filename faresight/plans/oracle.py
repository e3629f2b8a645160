"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The driver registers the test tables as views; every statement first
rebuilds the taxi adapter views (same mapping as
``faresight.sources.taxi_adapter``) as CTEs and then answers the question.
Output column names and types are aligned with the Spark results.
"""

from __future__ import annotations

from faresight.functions.columns import PAYMENT_TYPE_DESCRIPTIONS, PAYMENT_TYPE_OTHER
from faresight.plans import params as P

# ---- adapter views ---------------------------------------------------------

RAW_TRIPS = """
raw_lines AS (
  SELECT l.*, o.o_orderdate, c.c_nationkey, s.s_nationkey,
         CAST(round(_fare * CAST(l.l_discount AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS _tip,
         CAST(round(_fare * CAST(l.l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS _tax
  FROM (SELECT *, CAST(CASE WHEN l_partkey % 89 = 1 THEN 0 ELSE l_extendedprice END AS DECIMAL(18,2)) AS _fare
        FROM lineitem) l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
raw_trips AS (
  SELECT CASE WHEN l_partkey % 97 <> 0 THEN CAST(l_suppkey AS VARCHAR) END AS vendorid,
         l_orderkey AS src_orderkey, l_linenumber AS src_linenumber, l_partkey AS src_partkey,
         CASE WHEN l_linestatus = 'O' THEN 'Green' ELSE 'Yellow' END AS service_type,
         least(o_orderdate, l_shipdate) AS pickup_datetime,
         greatest(o_orderdate, l_shipdate) AS dropoff_datetime,
         l_returnflag AS store_and_fwd_flag,
         CAST(l_linenumber AS VARCHAR) AS ratecodeid,
         CASE WHEN l_partkey % 83 = 2 THEN '999' ELSE CAST(c_nationkey AS VARCHAR) END AS pulocationid,
         CAST(s_nationkey AS VARCHAR) AS dolocationid,
         nullif(l_linenumber, 1) AS passenger_count,
         l_quantity AS trip_distance,
         _fare AS fare_amount,
         CAST(0 AS DECIMAL(18,2)) AS extra,
         _tax AS mta_tax,
         _tip AS tip_amount,
         CAST(0 AS DECIMAL(18,2)) AS tolls_amount,
         CAST(0 AS DECIMAL(18,2)) AS ehail_fee,
         CAST(0 AS DECIMAL(18,2)) AS improvement_surcharge,
         CAST(_fare + _tip + _tax AS DECIMAL(18,2)) AS total_amount,
         CAST(0 AS DECIMAL(18,2)) AS congestion_surcharge,
         nullif(l_linenumber, 7) AS payment_type,
         CASE WHEN l_returnflag = 'R' THEN '2' ELSE '1' END AS trip_type
  FROM raw_lines
)"""

ZONES = """
zones AS (
  SELECT n_nationkey AS locationid, r_name AS borough, n_name AS zone,
         CASE WHEN n_regionkey = 1 THEN 'Yellow Zone' ELSE 'Boro Zone' END AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

RAW_FHV = """
raw_fhv AS (
  SELECT CASE WHEN l.l_partkey % 79 <> 3 THEN 'B' || lpad(CAST(l.l_suppkey AS VARCHAR), 5, '0') END
           AS dispatching_base_num,
         least(o.o_orderdate, l.l_shipdate) AS pickup_datetime,
         greatest(o.o_orderdate, l.l_shipdate) AS dropoff_datetime,
         c.c_nationkey AS pulocationid,
         s.s_nationkey AS dolocationid,
         CASE WHEN l.l_returnflag = 'R' THEN 1 END AS sr_flag,
         'B' || lpad(CAST(l.l_suppkey AS VARCHAR), 5, '0') AS affiliated_base_number
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
)"""

RIDES = """
rides AS (
  SELECT event_id, user_id, event_type, pickup_datetime,
         pickup_datetime + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) AS dropoff_datetime,
         CASE WHEN event_id % 11 <> 0 THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS passenger_count,
         value AS tip_amount
  FROM (SELECT *, CASE WHEN event_id % 50 = 7 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) + to_microseconds(86399500000)
                       ELSE ts END AS pickup_datetime FROM events)
)"""


def payment_case(expr: str) -> str:
    cases = " ".join(f"WHEN {code} THEN '{label}'" for code, label in PAYMENT_TYPE_DESCRIPTIONS.items())
    return f"CASE {expr} {cases} ELSE '{PAYMENT_TYPE_OTHER}' END"


def stg_sql(name: str, service: str, street_hail_only: bool) -> str:
    trip_type = "1" if street_hail_only else "TRY_CAST(trip_type AS INTEGER)"
    ehail = "CAST(0 AS DECIMAL(18,2))" if street_hail_only else "CAST(ehail_fee AS DECIMAL(18,2))"
    pay = "coalesce(TRY_CAST(payment_type AS INTEGER), 0)"
    return f"""
{name} AS (
  SELECT md5(concat_ws('-', coalesce(CAST(vendorid AS VARCHAR), ''), coalesce(CAST(pickup_datetime AS VARCHAR), ''))) AS tripid,
         TRY_CAST(vendorid AS INTEGER) AS vendorid,
         TRY_CAST(ratecodeid AS INTEGER) AS ratecodeid,
         TRY_CAST(pulocationid AS INTEGER) AS pickup_locationid,
         TRY_CAST(dolocationid AS INTEGER) AS dropoff_locationid,
         pickup_datetime, dropoff_datetime, store_and_fwd_flag,
         TRY_CAST(passenger_count AS INTEGER) AS passenger_count,
         CAST(trip_distance AS DECIMAL(18,2)) AS trip_distance,
         CAST({trip_type} AS INTEGER) AS trip_type,
         CAST(fare_amount AS DECIMAL(18,2)) AS fare_amount,
         CAST(extra AS DECIMAL(18,2)) AS extra,
         CAST(mta_tax AS DECIMAL(18,2)) AS mta_tax,
         CAST(tip_amount AS DECIMAL(18,2)) AS tip_amount,
         CAST(tolls_amount AS DECIMAL(18,2)) AS tolls_amount,
         {ehail} AS ehail_fee,
         CAST(improvement_surcharge AS DECIMAL(18,2)) AS improvement_surcharge,
         CAST(total_amount AS DECIMAL(18,2)) AS total_amount,
         {pay} AS payment_type,
         {payment_case(pay)} AS payment_type_description
  FROM (
    SELECT *, row_number() OVER (PARTITION BY vendorid, pickup_datetime
                                 ORDER BY src_orderkey, src_linenumber, src_partkey) AS _rn
    FROM raw_trips WHERE service_type = '{service}' AND vendorid IS NOT NULL
  ) WHERE _rn = 1
)"""


STG_GREEN = stg_sql("stg_green", "Green", False)
STG_YELLOW = stg_sql("stg_yellow", "Yellow", True)

STG_FHV = """
stg_fhv AS (
  SELECT dispatching_base_num, pickup_datetime, dropoff_datetime, pulocationid, dolocationid,
         sr_flag, affiliated_base_number
  FROM raw_fhv WHERE dispatching_base_num IS NOT NULL
)"""

FACT_COLUMNS = """tripid, vendorid, service_type, ratecodeid, pickup_locationid,
    pz.borough AS pickup_borough, pz.zone AS pickup_zone, dropoff_locationid,
    dz.borough AS dropoff_borough, dz.zone AS dropoff_zone, pickup_datetime, dropoff_datetime,
    store_and_fwd_flag, passenger_count, trip_distance, trip_type, fare_amount, extra, mta_tax,
    tip_amount, tolls_amount, ehail_fee, improvement_surcharge, total_amount, payment_type,
    payment_type_description"""

FACT = f"""
named_zones AS (SELECT locationid, borough, zone FROM zones WHERE borough != 'MIDDLE EAST'),
both_services AS (
  FROM stg_yellow SELECT 'Yellow' AS service_type, *
  UNION ALL BY NAME
  FROM stg_green SELECT 'Green' AS service_type, *
),
fact_trips AS (
  SELECT {FACT_COLUMNS}
  FROM both_services, named_zones pz, named_zones dz
  WHERE pz.locationid = pickup_locationid AND dz.locationid = dropoff_locationid
)"""

DIM_FHV = f"""
fhv_zones AS (SELECT * FROM zones WHERE locationid NOT IN (23, 24)),
dim_fhv_trips AS (
  SELECT dispatching_base_num, pickup_datetime, dropoff_datetime,
         CAST(year(pickup_datetime) AS INTEGER) AS year, CAST(month(pickup_datetime) AS INTEGER) AS month,
         pulocationid, pz.borough AS pickup_borough, pz.zone AS pickup_zone,
         dolocationid, dz.borough AS dropoff_borough, dz.zone AS dropoff_zone,
         sr_flag, affiliated_base_number
  FROM stg_fhv
  JOIN fhv_zones pz ON stg_fhv.pulocationid = pz.locationid
  JOIN fhv_zones dz ON stg_fhv.dolocationid = dz.locationid
),
fhv_durations AS (
  SELECT *, CAST(date_diff('second', pickup_datetime, dropoff_datetime) AS BIGINT) AS trip_duration
  FROM dim_fhv_trips
)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


def exact_mean_sql(expr: str, in_scale: int, out_scale: int) -> str:
    """Same arithmetic as ``faresight.functions.exact_mean``."""
    a = max(out_scale - in_scale, 0)
    b = max(in_scale - out_scale, 0)
    s = f"sum(CAST(({expr}) * {10 ** in_scale} AS HUGEINT))"
    n = f"count({expr})"
    num = f"(abs({s}) * {2 * 10 ** a} + {n} * {10 ** b})"
    den = f"({n} * {2 * 10 ** b})"
    q = f"({num} // {den})"
    signed = f"(CASE WHEN {s} < 0 THEN -{q} ELSE {q} END)"
    unit = "0." + "0" * (out_scale - 1) + "1" if out_scale > 0 else "1"
    return (f"CASE WHEN {n} > 0 THEN CAST(CAST({signed} AS DECIMAL(38,0)) * "
            f"CAST('{unit}' AS DECIMAL({out_scale + 1},{out_scale})) AS DECIMAL(18,{out_scale})) END")


TRIPS = (RAW_TRIPS, ZONES, STG_GREEN, STG_YELLOW)
FHV = (RAW_FHV, ZONES, STG_FHV, DIM_FHV)

SQL: dict[str, str] = {}

SQL["stg_green"] = with_ctes(RAW_TRIPS, STG_GREEN, body="SELECT * FROM stg_green")
SQL["stg_yellow"] = with_ctes(RAW_TRIPS, STG_YELLOW, body="SELECT * FROM stg_yellow")
SQL["stg_fhv"] = with_ctes(RAW_FHV, STG_FHV, body="SELECT * FROM stg_fhv")
SQL["stg_zones"] = with_ctes(ZONES, body="SELECT locationid, borough, zone, service_zone FROM zones")
SQL["fact_trips"] = with_ctes(*TRIPS, FACT, body="SELECT * FROM fact_trips")
SQL["dim_fhv_trips"] = with_ctes(*FHV, body="SELECT * FROM dim_fhv_trips")

SQL["monthly_zone_revenue"] = with_ctes(*TRIPS, FACT, body=f"""
SELECT pickup_zone AS revenue_zone,
       date_trunc('month', pickup_datetime) AS revenue_month,
       service_type,
       CAST(sum(fare_amount) AS DECIMAL(38,2)) AS revenue_monthly_fare,
       CAST(sum(extra) AS DECIMAL(38,2)) AS revenue_monthly_extra,
       CAST(sum(mta_tax) AS DECIMAL(38,2)) AS revenue_monthly_mta_tax,
       CAST(sum(tip_amount) AS DECIMAL(38,2)) AS revenue_monthly_tip_amount,
       CAST(sum(tolls_amount) AS DECIMAL(38,2)) AS revenue_monthly_tolls_amount,
       CAST(sum(ehail_fee) AS DECIMAL(38,2)) AS revenue_monthly_ehail_fee,
       CAST(sum(improvement_surcharge) AS DECIMAL(38,2)) AS revenue_monthly_improvement_surcharge,
       CAST(sum(total_amount) AS DECIMAL(38,2)) AS revenue_monthly_total_amount,
       count(tripid) AS total_monthly_trips,
       {exact_mean_sql('passenger_count', 0, 4)} AS avg_monthly_passenger_count,
       {exact_mean_sql('trip_distance', 2, 4)} AS avg_monthly_trip_distance
FROM fact_trips
GROUP BY 1, 2, 3""")

SQL["quarterly_revenue_growth"] = with_ctes(*TRIPS, FACT, body=f"""
SELECT *,
       round(CAST(revenue - lag_total_revenue AS DOUBLE) / CAST(nullif(lag_total_revenue, 0) AS DOUBLE), 6) AS yoy_growth
FROM (
  SELECT *, lag(revenue) OVER (PARTITION BY service_type, quarter ORDER BY year) AS lag_total_revenue
  FROM (
    SELECT service_type, CAST(year(pickup_datetime) AS INTEGER) AS year,
           CAST(quarter(pickup_datetime) AS INTEGER) AS quarter,
           CAST(sum(total_amount) AS DECIMAL(38,2)) AS revenue
    FROM fact_trips
    WHERE year(pickup_datetime) IN {P.GROWTH_YEARS}
    GROUP BY 1, 2, 3
  )
)""")

SQL["monthly_fare_percentiles"] = with_ctes(*TRIPS, FACT, body="""
SELECT service_type, CAST(year(pickup_datetime) AS INTEGER) AS year,
       CAST(month(pickup_datetime) AS INTEGER) AS month,
       round(quantile_cont(CAST(fare_amount AS DOUBLE), 0.97), 4) AS p97,
       round(quantile_cont(CAST(fare_amount AS DOUBLE), 0.95), 4) AS p95,
       round(quantile_cont(CAST(fare_amount AS DOUBLE), 0.90), 4) AS p90
FROM fact_trips
WHERE fare_amount > 0 AND trip_distance > 0 AND payment_type_description IN ('Cash', 'Credit card')
GROUP BY 1, 2, 3""")

SQL["monthly_fare_percentiles_kept"] = SQL["monthly_fare_percentiles"]
SQL["fhv_travel_time_p90"] = with_ctes(*FHV, body="""
SELECT *, round(quantile_cont(trip_duration, 0.90) OVER (PARTITION BY year, month, pulocationid, dolocationid), 4)
          AS trip_duration_p90
FROM fhv_durations""")

SQL["fhv_nth_longest_p90"] = with_ctes(*FHV, body=f"""
SELECT pickup_zone, dropoff_zone, trip_duration_p90 FROM (
  SELECT *, dense_rank() OVER (PARTITION BY pulocationid ORDER BY trip_duration_p90 DESC) AS _rank
  FROM (
    SELECT pulocationid, pickup_zone, dolocationid, dropoff_zone,
           round(quantile_cont(trip_duration, 0.90), 4) AS trip_duration_p90
    FROM fhv_durations
    WHERE year = {P.P90_YEAR} AND month = {P.P90_MONTH}
    GROUP BY year, month, pulocationid, pickup_zone, dolocationid, dropoff_zone
  )
) WHERE _rank = {P.P90_RANK}""")

# ---- ad-hoc questions --------------------------------------------------------

GREEN = "raw_green AS (SELECT * FROM raw_trips WHERE service_type = 'Green')"
YELLOW = "raw_yellow AS (SELECT * FROM raw_trips WHERE service_type = 'Yellow')"

SQL["distance_bands"] = with_ctes(RAW_TRIPS, GREEN, body="""
SELECT count(*) FILTER (WHERE trip_distance <= 1) AS trips_upto_1,
       count(*) FILTER (WHERE trip_distance > 1 AND trip_distance <= 3) AS trips_1_to_3,
       count(*) FILTER (WHERE trip_distance > 3 AND trip_distance <= 7) AS trips_3_to_7,
       count(*) FILTER (WHERE trip_distance > 7 AND trip_distance <= 10) AS trips_7_to_10,
       count(*) FILTER (WHERE trip_distance > 10) AS trips_over_10
FROM raw_green""")

SQL["longest_trip_day"] = with_ctes(RAW_TRIPS, GREEN, body="""
SELECT CAST(extract(day FROM pickup_datetime) AS INTEGER) AS day, max(trip_distance) AS longest_trip
FROM raw_green GROUP BY 1 ORDER BY longest_trip DESC, day ASC LIMIT 1""")

SQL["longest_trip_date"] = with_ctes(RAW_TRIPS, GREEN, body="""
SELECT CAST(pickup_datetime AS DATE) AS day, max(trip_distance) AS longest_trip
FROM raw_green GROUP BY 1 ORDER BY longest_trip DESC, day ASC LIMIT 1""")

SQL["top_pickup_zones"] = with_ctes(RAW_TRIPS, ZONES, GREEN, f"""
takings AS (
  SELECT named.zone, named.locationid, CAST(sum(trip.total_amount) AS DECIMAL(38,2)) AS total_amount
  FROM zones AS named, raw_green AS trip
  WHERE named.locationid = CAST(trip.pulocationid AS INTEGER)
    AND trip.pickup_datetime >= DATE '{P.TOP_ZONES_DAY}' AND trip.pickup_datetime < DATE '{P.TOP_ZONES_DAY}' + INTERVAL 1 DAY
  GROUP BY ALL
)""", body=f"""
SELECT zone, total_amount FROM takings WHERE total_amount > {P.TOP_ZONES_MIN_TOTAL}
QUALIFY row_number() OVER (ORDER BY total_amount DESC, zone) <= {P.TOP_ZONES_K}""")

SQL["largest_tip_dropoff"] = with_ctes(RAW_TRIPS, ZONES, GREEN, f"""
ranked AS (
  SELECT dolocationid, tip_amount, rank() OVER (ORDER BY tip_amount DESC) AS place
  FROM raw_green
  WHERE pulocationid IN (SELECT CAST(locationid AS VARCHAR) FROM zones WHERE zone = '{P.TIP_PICKUP_ZONE}')
)""", body="""
SELECT zone AS dropoff_zone, tip_amount
FROM ranked, zones WHERE place = 1 AND dolocationid = CAST(locationid AS VARCHAR)""")

SQL["distinct_pickups"] = with_ctes(RAW_TRIPS, YELLOW, body="""
SELECT count(DISTINCT pulocationid) AS distinct_pickups FROM raw_yellow""")

SQL["zero_fare_count"] = with_ctes(RAW_TRIPS, YELLOW, body="""
SELECT count(*) AS zero_fare_trips FROM raw_yellow WHERE fare_amount = 0""")

SQL["zero_tip_count"] = with_ctes(RAW_TRIPS, YELLOW, body="""
SELECT count(*) AS zero_tip_trips FROM raw_yellow WHERE tip_amount = 0""")

SQL["vendors_in_range"] = with_ctes(RAW_TRIPS, YELLOW, body=f"""
SELECT DISTINCT vendorid FROM raw_yellow
WHERE CAST(dropoff_datetime AS DATE) BETWEEN DATE '{P.VENDOR_RANGE[0]}' AND DATE '{P.VENDOR_RANGE[1]}'""")

SQL["trips_on_day"] = with_ctes(RIDES, body=f"""
SELECT count(*) AS trips FROM rides WHERE CAST(pickup_datetime AS DATE) = DATE '{P.EVENT_DAY}'""")

SQL["trips_on_day_bounds"] = with_ctes(RIDES, body=f"""
SELECT count(*) AS trips FROM rides
WHERE pickup_datetime >= TIMESTAMP '{P.EVENT_DAY} 00:00:00' AND pickup_datetime <= TIMESTAMP '{P.EVENT_DAY} 23:59:59'""")

SQL["longest_trip_hours"] = with_ctes(RAW_TRIPS, YELLOW, body="""
SELECT max(date_sub('hour', pickup_datetime, dropoff_datetime)) AS max_trip_hours FROM raw_yellow""")

SQL["zone_frequency"] = with_ctes(RAW_TRIPS, ZONES, YELLOW, body="""
SELECT zone, count(*) AS frequency
FROM zones INNER JOIN raw_yellow ON CAST(locationid AS VARCHAR) = pulocationid
GROUP BY zone ORDER BY 2""")

SQL["zone_frequency_sql"] = SQL["zone_frequency"]

SQL["avg_trip_minutes"] = with_ctes(RIDES, body=f"""
SELECT {exact_mean_sql("date_diff('minute', pickup_datetime, dropoff_datetime)", 0, 4)} AS avg_trip_minutes
FROM rides""")

SQL["avg_trip_minutes_elapsed"] = with_ctes(RIDES, body=f"""
SELECT {exact_mean_sql("date_sub('minute', pickup_datetime, dropoff_datetime)", 0, 4)} AS avg_trip_minutes
FROM rides""")

SQL["rows_by_file"] = with_ctes(RAW_TRIPS, body="""
SELECT lower(service_type) || '_tripdata_' || strftime(pickup_datetime, '%Y-%m') || '.csv' AS filename,
       service_type, CAST(year(pickup_datetime) AS INTEGER) AS year,
       CAST(month(pickup_datetime) AS INTEGER) AS month, count(*) AS rows
FROM raw_trips GROUP BY 1, 2, 3, 4""")

SQL["rows_per_service_year"] = with_ctes(RAW_TRIPS, body=f"""
SELECT service_type, count(*) AS rows FROM raw_trips
WHERE year(pickup_datetime) = {P.ROWS_YEAR} GROUP BY service_type""")

SQL["rows_per_service_month"] = with_ctes(RAW_TRIPS, body=f"""
SELECT service_type, count(*) AS rows FROM raw_trips
WHERE year(pickup_datetime) = {P.ROWS_MONTH[0]} AND month(pickup_datetime) = {P.ROWS_MONTH[1]}
GROUP BY service_type""")

# ---- data-quality checks -----------------------------------------------------


def dq_sql(stg: str, dropoff_severity: str) -> str:
    return f"""
SELECT 'not_null' AS check_name, 'tripid' AS column_name, 'warn' AS severity,
       count(*) FILTER (WHERE tripid IS NULL) AS failures FROM {stg}
UNION ALL
SELECT 'relationships', 'pickup_locationid', 'warn',
       count(*) FILTER (WHERE pickup_locationid IS NOT NULL
                        AND NOT EXISTS (SELECT 1 FROM zones z WHERE z.locationid = s.pickup_locationid))
FROM {stg} s
UNION ALL
SELECT 'relationships', 'dropoff_locationid', '{dropoff_severity}',
       count(*) FILTER (WHERE dropoff_locationid IS NOT NULL
                        AND NOT EXISTS (SELECT 1 FROM zones z WHERE z.locationid = s.dropoff_locationid))
FROM {stg} s
UNION ALL
SELECT 'accepted_values', 'payment_type', 'warn',
       count(*) FILTER (WHERE payment_type IS NOT NULL AND payment_type NOT IN (1, 2, 3, 4, 5, 6)) FROM {stg}
UNION ALL
SELECT 'unique', 'tripid', 'warn', count(*) FROM (
  SELECT tripid FROM {stg} WHERE tripid IS NOT NULL GROUP BY tripid HAVING count(*) > 1
)"""


SQL["dq_orders_unique"] = " UNION ALL ".join([
    f"SELECT 'unique' AS check_name, '{c}' AS column_name, '{level}' AS severity, count(*) AS failures "
    f"FROM (SELECT {c} FROM orders WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"
    for c, level in (("o_orderkey", "error"), ("o_custkey", "warn"), ("o_orderdate", "warn"))] + [
    "SELECT 'not_null', 'o_totalprice', 'error', count(*) FILTER (WHERE o_totalprice IS NULL) FROM orders",
    "SELECT 'accepted_values', 'o_orderstatus', 'warn', count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) FROM orders",
    "SELECT 'relationships', 'o_custkey', 'warn', count(*) FILTER (WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)) FROM orders"])
SQL["dq_raw_trips"] = with_ctes(RAW_TRIPS, ZONES, """
t AS (
  SELECT md5(concat_ws('-', coalesce(vendorid, ''), coalesce(CAST(pickup_datetime AS VARCHAR), ''))) AS tripid,
         vendorid, CAST(pulocationid AS INTEGER) AS zone
  FROM raw_trips
)""", body="""
SELECT 'not_null' AS check_name, 'vendorid' AS column_name, 'warn' AS severity,
       count(*) FILTER (WHERE vendorid IS NULL) AS failures FROM t
UNION ALL
SELECT 'relationships', 'pulocationid', 'warn',
       count(*) FILTER (WHERE zone NOT IN (SELECT locationid FROM zones)) FROM t
UNION ALL
SELECT 'unique', 'tripid', 'warn', count(*) FROM (SELECT tripid FROM t GROUP BY tripid HAVING count(*) > 1)""")
SQL["dq_stg_green"] = with_ctes(RAW_TRIPS, ZONES, STG_GREEN, body=dq_sql("stg_green", "error"))
SQL["dq_stg_yellow"] = with_ctes(RAW_TRIPS, ZONES, STG_YELLOW, body=dq_sql("stg_yellow", "warn"))

# ---- sessions ----------------------------------------------------------------


def sessions_cte(name: str, keys: str, gap_micros: int, gap_literal: str) -> str:
    return f"""
{name}_lagged AS (
  SELECT {keys}, dropoff_datetime AS t,
         lag(dropoff_datetime) OVER (PARTITION BY {keys} ORDER BY dropoff_datetime) AS prev
  FROM rides WHERE dropoff_datetime IS NOT NULL
),
{name}_flagged AS (
  -- RANGE frame: rows with equal timestamps get the same running count (at most one of them
  -- starts a session), so the result does not depend on how ties are ordered
  SELECT *, sum(CASE WHEN prev IS NULL OR epoch_us(t) - epoch_us(prev) > {gap_micros} THEN 1 ELSE 0 END)
            OVER (PARTITION BY {keys} ORDER BY t RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
  FROM {name}_lagged
),
{name} AS (
  SELECT {keys}, min(t) AS session_start, max(t) + INTERVAL '{gap_literal}' AS session_end,
         count(*) AS taxi_trips_streak
  FROM {name}_flagged GROUP BY {keys}, sid
)"""


SQL["session_streaks"] = with_ctes(RIDES, sessions_cte("s5", "user_id, event_type", 300_000_000, "5 minutes"),
                                   body="SELECT * FROM s5")
SQL["session_streaks_6h"] = with_ctes(RIDES, sessions_cte("s6", "user_id", 21_600_000_000, "6 hours"),
                                      body="SELECT * FROM s6")
SQL["session_streaks_stream"] = SQL["session_streaks"]
SQL["longest_streak"] = with_ctes(RIDES, sessions_cte("s6", "user_id", 21_600_000_000, "6 hours"), body="""
SELECT * FROM s6 WHERE taxi_trips_streak = (SELECT max(taxi_trips_streak) FROM s6)""")

TRIP_EVENTS = """
rides AS (
  SELECT CAST(pulocationid AS INTEGER) AS pulocationid, CAST(dolocationid AS INTEGER) AS dolocationid,
         dropoff_datetime
  FROM raw_trips WHERE service_type = 'Green'
)"""
SQL["trip_session_streaks"] = with_ctes(RAW_TRIPS, TRIP_EVENTS,
                                        sessions_cte("st", "pulocationid, dolocationid", 300_000_000, "5 minutes"),
                                        body="SELECT * FROM st")
SQL["longest_trip_streak"] = with_ctes(RAW_TRIPS, TRIP_EVENTS,
                                       sessions_cte("st", "pulocationid, dolocationid", 300_000_000, "5 minutes"),
                                       body="SELECT * FROM st WHERE taxi_trips_streak = (SELECT max(taxi_trips_streak) FROM st)")

# ---- ingest, loads, messages -------------------------------------------------

LANDED_COLUMNS = ("vendorid, pickup_datetime, dropoff_datetime, passenger_count, trip_distance, ratecodeid, "
                  "store_and_fwd_flag, pulocationid, dolocationid, payment_type, fare_amount, extra, mta_tax, "
                  "tip_amount, tolls_amount, improvement_surcharge, total_amount, congestion_surcharge")


def merge_sql(service: str, key_columns) -> str:
    hashed = " || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in key_columns)
    stamped = (f"md5({hashed}) AS unique_row_id, lower(service_type) || '_tripdata_' || "
               f"strftime(pickup_datetime, '%Y-%m') || '.csv' AS filename, {LANDED_COLUMNS}")
    return with_ctes(RAW_TRIPS, f"""
files AS (SELECT * FROM raw_trips WHERE service_type = '{service}'),
batch AS (
  SELECT * FROM files WHERE pickup_datetime >= TIMESTAMP '{P.MERGE_SOURCE_FROM}'
  UNION ALL
  SELECT * REPLACE (CAST(fare_amount + 1 AS DECIMAL(18,2)) AS fare_amount) FROM files
  WHERE pickup_datetime >= TIMESTAMP '{P.MERGE_SOURCE_FROM}' AND ratecodeid = '{P.REVISED_RATECODE}'
),
target AS (SELECT {stamped} FROM files WHERE pickup_datetime < TIMESTAMP '{P.MERGE_TARGET_BEFORE}'),
source AS (SELECT {stamped} FROM batch)""", body="""
SELECT * FROM target
UNION ALL
SELECT * FROM source s WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.unique_row_id = s.unique_row_id)""")


SQL["ingest_merge"] = merge_sql("Yellow", P.ROW_ID_COLUMNS_ON_PREMISE)
SQL["ingest_merge_cloud"] = merge_sql("Green", P.ROW_ID_COLUMNS_CLOUD)

SQL["merge_small_batch"] = f"""
WITH o AS (SELECT year(o_orderdate) AS y, o_orderkey % {P.SMALL_BATCH_EVERY} = 0 AS new FROM orders),
per_year AS (SELECT y, count(*) + count(*) FILTER (WHERE new) AS rows FROM o GROUP BY y)
SELECT target, CAST(y AS INTEGER) AS y, CAST(rows AS BIGINT) AS rows, (SELECT 2 * count(*) FROM o WHERE new) AS inserted,
       CAST(0 AS BIGINT) AS inserted_again
FROM per_year, (VALUES ('bucketed'), ('plain')) AS t(target)"""

SQL["publish_trips"] = with_ctes(RIDES, body="""
SELECT event_id, user_id, event_type, pickup_datetime, dropoff_datetime,
       coalesce(passenger_count, 0) AS passenger_count, coalesce(tip_amount, 0.0) AS tip_amount
FROM rides""")

SQL["load_incremental"] = with_ctes(RIDES, f"""
r AS (SELECT event_id, user_id, event_type, pickup_datetime, dropoff_datetime, passenger_count, tip_amount
      FROM rides),
run1 AS (SELECT * FROM r WHERE pickup_datetime < TIMESTAMP '{P.INCREMENTAL_SPLIT}'
                          AND dropoff_datetime >= TIMESTAMP '{P.INCREMENTAL_INITIAL}')""", body="""
SELECT *, 1 AS _load_id FROM run1
UNION ALL
SELECT *, 2 AS _load_id FROM r WHERE dropoff_datetime >= (SELECT max(dropoff_datetime) FROM run1)
                               AND event_id NOT IN (SELECT event_id FROM run1)""")

SQL["load_nested_parents"] = """
SELECT conv_id, turn, md5(CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR)) AS record_hash,
       role AS message__role, text AS message__text
FROM conversations"""

SQL["load_nested_children"] = """
SELECT md5(CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR)) AS _parent_id,
       CAST(idx - 1 AS INTEGER) AS _list_idx, word, CAST(length(word) AS INTEGER) AS length
FROM (
  SELECT conv_id, turn, unnest(string_split(text, ' ')) AS word,
         generate_subscripts(string_split(text, ' '), 1) AS idx
  FROM conversations
)"""

SQL["load_nested_by_place"] = """
SELECT conv_id, turn, coalesce(len(string_split(text, ' ')), 0)::BIGINT AS words
FROM (SELECT * FROM conversations UNION ALL SELECT * FROM conversations)"""

SQL["brand_avg_price"] = f"""
SELECT p_brand AS brand, {exact_mean_sql('CAST(p_retailprice AS DECIMAL(20,9))', 9, 2)} AS avg_price
FROM part GROUP BY p_brand ORDER BY avg_price DESC"""


# ---- readers, writers, loads, catalog -------------------------------------------

SQL["csv_inferred"] = "SELECT * FROM part"
SQL["csv_gzip"] = "SELECT * FROM customer"
SQL["csv_external"] = "SELECT * FROM orders"
SQL["bulk_load_columns"] = "SELECT s_suppkey, s_acctbal, CAST(NULL AS INTEGER) AS s_rating FROM supplier"
SQL["parquet_glob"] = "SELECT * FROM orders WHERE year(o_orderdate) IN (1996, 1997)"
SQL["repartition_parquet"] = "SELECT CAST(4 AS BIGINT) AS files, count(*) AS rows FROM events"
SQL["append_batches"] = """
SELECT c_custkey, c_nationkey FROM customer UNION ALL SELECT s_suppkey, s_nationkey FROM supplier"""
SQL["json_lines"] = "SELECT * FROM events"
SQL["json_pages"] = "SELECT conv_id, turn, role, text FROM conversations"
SQL["numbered_pages"] = f"""
WITH p AS (SELECT p_partkey, p_name, p_partkey // {P.PAGE_ROWS} + 1 AS page FROM part),
ends AS (SELECT least(CAST({P.EMPTY_PAGE} AS BIGINT), max(page) + 1) AS empty, max(page) AS last FROM p)
SELECT p_partkey, p_name, page, CASE WHEN page < empty THEN 1 ELSE 2 END AS run FROM p, ends WHERE page <> empty"""
SQL["parse_timestamps"] = "SELECT o_orderkey, date_trunc('minute', o_orderdate) AS ordered_at FROM orders"
SQL["external_parquet_table"] = "SELECT * FROM customer"
SQL["bucketed_table"] = "SELECT o_custkey, count(*) AS orders FROM orders GROUP BY o_custkey"
SQL["partitioned_vendors"] = SQL["vendors_in_range"]
SQL["reload_days"] = with_ctes(RAW_TRIPS, f"""
t AS (SELECT vendorid, CAST(dropoff_datetime AS DATE) AS day FROM raw_trips WHERE service_type = 'Yellow'),
fixed AS (SELECT * FROM t WHERE day = DATE '{P.VENDOR_RANGE[0]}' AND vendorid IS NOT NULL),
loaded AS (
  SELECT * FROM t WHERE day IS DISTINCT FROM DATE '{P.VENDOR_RANGE[0]}' OR NOT EXISTS (SELECT 1 FROM fixed)
  UNION ALL SELECT * FROM fixed UNION ALL SELECT * FROM fixed
  UNION ALL SELECT vendorid, DATE '{P.NEW_DAY}' FROM fixed
)""", body="""
SELECT day, count(*) AS rows, count(DISTINCT vendorid) AS vendors, CAST(0 AS BIGINT) AS misplaced FROM loaded GROUP BY day""")
SQL["native_copy_reload"] = """
SELECT o_orderpriority, count(*) AS orders, false AS dropped_table_exists
FROM orders WHERE year(o_orderdate) = 1997 GROUP BY o_orderpriority"""
SQL["table_catalog"] = """
SELECT column_name, (SELECT count(*) FROM lineitem) AS rows, count(*) OVER () AS columns
FROM (DESCRIBE SELECT * FROM lineitem)"""
SQL["replace_append_loads"] = """
SELECT event_type, count(*) AS rows, CAST(4 AS BIGINT) AS loads,
       (SELECT count(*) FROM events WHERE event_type IN ('click', 'view', 'purchase', 'error')) AS loaded_rows
FROM events WHERE event_type IN ('purchase', 'error') GROUP BY event_type"""
_RESOURCES = ", ".join(f"'{k}'" for k in P.LOAD_RESOURCES)
SQL["load_incremental_resources"] = with_ctes(RIDES, f"""
r AS (SELECT event_id, event_type, dropoff_datetime, pickup_datetime,
             CASE event_type {" ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(P.LOAD_RESOURCES, 1))} END AS place
      FROM rides WHERE event_type IN ({_RESOURCES}) AND dropoff_datetime >= TIMESTAMP '{P.INCREMENTAL_INITIAL}'),
run1 AS (SELECT * FROM r WHERE pickup_datetime < TIMESTAMP '{P.INCREMENTAL_SPLIT}'),
last AS (SELECT event_type, max(dropoff_datetime) AS newest FROM run1 GROUP BY event_type)""", body=f"""
SELECT event_id, event_type, dropoff_datetime, CAST(place AS INTEGER) AS _load_id FROM run1
UNION ALL
SELECT event_id, event_type, dropoff_datetime, CAST(place + {len(P.LOAD_RESOURCES)} AS INTEGER) FROM r
LEFT JOIN last USING (event_type)
WHERE (newest IS NULL OR dropoff_datetime >= newest) AND event_id NOT IN (SELECT event_id FROM run1)""")
SQL["incremental_stream"] = with_ctes(RIDES, body=f"""
SELECT event_id, event_type, dropoff_datetime, event_type AS resource, count(*) OVER (PARTITION BY event_type) AS loaded_rows,
       CAST(max(dropoff_datetime) OVER (PARTITION BY event_type) AS VARCHAR) AS cursor_value
FROM rides WHERE event_type IN ({_RESOURCES}) AND dropoff_datetime >= TIMESTAMP '{P.INCREMENTAL_INITIAL}'""")
SQL["load_new_column"] = """
SELECT o_orderkey, o_totalprice, CASE WHEN year(o_orderdate) >= 1997 THEN o_orderpriority END AS o_orderpriority,
       2 AS schema_version
FROM orders"""
SQL["ingest_monthly"] = with_ctes(RAW_TRIPS, body=f"""
SELECT 'yellow_tripdata_' || strftime(pickup_datetime, '%Y-%m') || '.csv' AS filename, count(*) AS rows
FROM raw_trips
WHERE service_type = 'Yellow' AND strftime(pickup_datetime, '%Y-%m') IN ({", ".join(f"'{y}-{m:02d}'" for y, m in P.INGEST_MONTHS)})
GROUP BY 1""")
SQL["trips_on_day_formatted"] = SQL["trips_on_day"]
SQL["recent_rides"] = with_ctes(RIDES, body=f"""
SELECT count(*) FILTER (WHERE pickup_datetime >= DATE '{P.AS_OF}' - INTERVAL {P.DAYS_BACK} DAY) AS before_day,
       count(*) FILTER (WHERE pickup_datetime >= current_date - INTERVAL 36500 DAY) AS last_century
FROM rides""")
SQL["top_tips"] = with_ctes(RIDES, body=f"""
SELECT event_id, tip_amount FROM rides ORDER BY tip_amount DESC NULLS LAST, event_id LIMIT {P.TOP_TIPS}""")
SQL["late_rides_dropped"] = with_ctes(RIDES, body=f"""
SELECT CAST(count(*) FILTER (WHERE dropoff_datetime >= TIMESTAMP '{P.LATE_BEFORE}') AS BIGINT) AS rides,
       min(dropoff_datetime) FILTER (WHERE dropoff_datetime >= TIMESTAMP '{P.LATE_BEFORE}') AS first_session,
       count(dropoff_datetime) AS arrived, CAST(0 AS BIGINT) AS open_rows,
       count(*) FILTER (WHERE dropoff_datetime < TIMESTAMP '{P.LATE_BEFORE}') AS dropped
FROM rides""")
