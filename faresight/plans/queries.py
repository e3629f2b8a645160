"""Registered queries: one callable ``(spark, data_dir) -> DataFrame`` per
operator or composite output.  Each reads the given tables (through the taxi
adapter) in full and returns a lazy DataFrame; nothing is collected here.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faresight.functions.columns import MONEY, keep_keys, surrogate_key
from faresight.operators import adhoc, models, nested, quality, sessions, staging
from faresight.plans import io_queries
from faresight.plans import params as P
from faresight.sinks import loads, merge, tables
from faresight.sinks.files import write_json
from faresight.sources import taxi_adapter as A
from faresight.sources.files import read_json
from faresight.sources.tables import table
from faresight.session import scratch_path
from faresight.streaming import messages
from faresight.streaming import sessions as stream_sessions

Query = Callable[[SparkSession, str], DataFrame]


# -- staging ---------------------------------------------------------------

def stg_green(spark, d):
    return staging.stage_trips(A.raw_service_trips(spark, d, "Green"), tiebreak=A.TRIP_TIEBREAK)


def stg_yellow(spark, d):
    return staging.stage_trips(A.raw_service_trips(spark, d, "Yellow"), street_hail_only=True,
                               tiebreak=A.TRIP_TIEBREAK)


def stg_fhv(spark, d):
    return staging.stage_fhv(A.raw_fhv_trips(spark, d))


def stg_zones(spark, d):
    return staging.stage_zones(A.zones(spark, d))


# -- core models and marts ---------------------------------------------------

def fact_trips(spark, d):
    # both services live in one source here: stage them in one pass
    staged = staging.stage_services(A.raw_trips(spark, d), tiebreak=A.TRIP_TIEBREAK)
    return models.fact_trips_staged(staged, stg_zones(spark, d), unknown_borough=A.UNKNOWN_BOROUGH)


def dim_fhv_trips(spark, d):
    return models.dim_fhv_trips(stg_fhv(spark, d), stg_zones(spark, d), excluded_ids=A.UNKNOWN_ZONE_IDS)


def monthly_zone_revenue(spark, d):
    return models.monthly_zone_revenue(fact_trips(spark, d))


def quarterly_revenue_growth(spark, d):
    return models.quarterly_revenue_growth(fact_trips(spark, d), years=P.GROWTH_YEARS)


def monthly_fare_percentiles(spark, d):
    return models.monthly_fare_percentiles(fact_trips(spark, d))


def monthly_fare_percentiles_kept(spark, d):
    """The same percentiles from kept counts of fares: one table of the old years, one of the newest,
    merged without reading the old trips again."""
    fares = models.valid_paid_fares(fact_trips(spark, d)).select(
        "service_type", F.year("pickup_datetime").alias("year"), F.month("pickup_datetime").alias("month"), "fare_amount")
    keys, shares = ["service_type", "year", "month"], (0.97, 0.95, 0.90)
    old, new = F.col("year") < P.KEPT_BEFORE, F.col("year") >= P.KEPT_BEFORE
    kept = [_written(spark, models.value_counts(fares.filter(part), keys, "fare_amount"), "fare-counts") for part in (old, new)]
    names = [f"p{round(x * 100):02d}" for x in shares]
    found = models.percentiles_of_counts(models.merge_value_counts(*kept), keys, shares, names)
    return found.select(*keys, *[F.round(n, 4).alias(n) for n in names])


def _written(spark, df, name):
    """``df`` written once, for a question that reads it twice."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fhv_travel_time_p90(spark, d):
    return models.fhv_travel_time_p90(_written(spark, dim_fhv_trips(spark, d), "dim-fhv-trips"))


def fhv_nth_longest_p90(spark, d):
    fhv = staging.stage_fhv(A.raw_fhv_trips(spark, d, pickup_from=dt.date(P.P90_YEAR, P.P90_MONTH, 1)))
    dim = models.dim_fhv_trips(fhv, stg_zones(spark, d), excluded_ids=A.UNKNOWN_ZONE_IDS)
    return models.fhv_nth_longest_p90(dim, P.P90_YEAR, P.P90_MONTH, P.P90_RANK)


# -- ad-hoc questions ---------------------------------------------------------

def _green(spark, d, *columns, **implied):
    return A.raw_service_trips(spark, d, "Green", columns, **implied)


def _yellow(spark, d, *columns, **implied):
    return A.raw_service_trips(spark, d, "Yellow", columns, **implied)


def distance_bands(spark, d):
    return adhoc.distance_bands(_green(spark, d, "trip_distance"))


def longest_trip_day(spark, d):
    return adhoc.longest_trip_day(_green(spark, d, "trip_distance", "pickup_datetime"), by="dayofmonth")


def longest_trip_date(spark, d):
    return adhoc.longest_trip_day(_green(spark, d, "trip_distance", "pickup_datetime"), by="date")


def top_pickup_zones(spark, d):
    day = dt.date.fromisoformat(str(P.TOP_ZONES_DAY))
    trips = _green(spark, d, "pulocationid", "pickup_datetime", "total_amount", pickup_from=day)
    return adhoc.top_pickup_zones(trips, A.zones(spark, d), P.TOP_ZONES_DAY, P.TOP_ZONES_MIN_TOTAL, P.TOP_ZONES_K)


def largest_tip_dropoff(spark, d):
    return adhoc.largest_tip_dropoff(_green(spark, d, "pulocationid", "dolocationid", "tip_amount"),
                                     A.zones(spark, d), P.TIP_PICKUP_ZONE)


def distinct_pickups(spark, d):
    return adhoc.distinct_count(_yellow(spark, d, "pulocationid"), "pulocationid", "distinct_pickups")


def zero_fare_count(spark, d):
    return adhoc.count_equal(_yellow(spark, d, "fare_amount"), "fare_amount", 0, "zero_fare_trips")


def zero_tip_count(spark, d):
    return adhoc.count_equal(_yellow(spark, d, "tip_amount"), "tip_amount", 0, "zero_tip_trips")


def vendors_in_range(spark, d):
    after = dt.date.fromisoformat(str(P.VENDOR_RANGE[1])) + dt.timedelta(days=1)
    trips = _yellow(spark, d, "vendorid", "dropoff_datetime", dropoff_before=after)
    return adhoc.distinct_in_range(trips, "vendorid", "dropoff_datetime", *P.VENDOR_RANGE)


def trips_on_day(spark, d):
    return adhoc.trips_on_day(A.ride_events(spark, d), P.EVENT_DAY)


def trips_on_day_bounds(spark, d):
    return adhoc.trips_on_day_bounds(A.ride_events(spark, d), P.EVENT_DAY)


def longest_trip_hours(spark, d):
    return adhoc.longest_trip_hours(_yellow(spark, d, "pickup_datetime", "dropoff_datetime"))


def zone_frequency(spark, d):
    return adhoc.zone_frequency(_yellow(spark, d, "pulocationid"), A.zones(spark, d))


def zone_frequency_sql(spark, d):
    """The same question as a SQL statement with an ordinal ``GROUP BY``; the
    DataFrames are bound to it by name, so no session-wide view is left behind."""
    return spark.sql("""
        WITH pickups AS (SELECT try_cast(pulocationid AS INT) AS id FROM {trips})
        SELECT named.zone, count(*) AS frequency
        FROM {zones} AS named INNER JOIN pickups ON pickups.id = named.locationid
        GROUP BY 1 ORDER BY 2, 1""", trips=_yellow(spark, d, "pulocationid"), zones=A.zones(spark, d))


def avg_trip_minutes(spark, d):
    return adhoc.avg_trip_minutes(A.ride_events(spark, d), "boundaries")


def avg_trip_minutes_elapsed(spark, d):
    return adhoc.avg_trip_minutes(A.ride_events(spark, d), "elapsed")


def rows_by_file(spark, d):
    return adhoc.rows_by_file(A.raw_trips(spark, d, columns=("service_type", "pickup_datetime")))


def _from(spark, d, year, month=1):
    return A.raw_trips(spark, d, columns=("service_type", "pickup_datetime"), pickup_from=dt.date(year, month, 1))


def rows_per_service_year(spark, d):
    return adhoc.rows_per_service_period(_from(spark, d, P.ROWS_YEAR), P.ROWS_YEAR)


def rows_per_service_month(spark, d):
    return adhoc.rows_per_service_period(_from(spark, d, *P.ROWS_MONTH), *P.ROWS_MONTH)


# -- data-quality checks -------------------------------------------------------

def _staging_checks(zones, dropoff_severity: str):
    return [
        quality.unique("tripid", "warn"),
        quality.not_null("tripid", "warn"),
        quality.relationships("pickup_locationid", zones, "locationid", "warn"),
        quality.relationships("dropoff_locationid", zones, "locationid", dropoff_severity),
        quality.accepted_values("payment_type", [1, 2, 3, 4, 5, 6], "warn"),
    ]


def dq_stg_green(spark, d):
    # X17: the green drop-off relationship test carries no severity -> error
    return quality.run_checks(stg_green(spark, d), _staging_checks(stg_zones(spark, d), "error"))


def dq_stg_yellow(spark, d):
    return quality.run_checks(stg_yellow(spark, d), _staging_checks(stg_zones(spark, d), "warn"))


def dq_raw_trips(spark, d):
    """Checks on the files as landed, before the staging drops and deduplicates rows."""
    raw = A.raw_trips(spark, d, columns=("vendorid", "pickup_datetime", "pulocationid")).select(
        surrogate_key(["vendorid", "pickup_datetime"]).alias("tripid"), "vendorid",
        F.col("pulocationid").cast("int").alias("pulocationid"))
    return quality.run_checks(raw, [quality.unique("tripid", "warn"), quality.not_null("vendorid", "warn"),
                                    quality.relationships("pulocationid", stg_zones(spark, d), "locationid", "warn")])


def dq_orders_unique(spark, d):
    """Three columns checked for repeated values in one pass over the orders."""
    return quality.run_checks(table(spark, d, "orders"), [
        quality.unique("o_orderkey", "error"), quality.unique("o_custkey", "warn"), quality.unique("o_orderdate", "warn"),
        quality.not_null("o_totalprice", "error"), quality.accepted_values("o_orderstatus", ["F", "O"], "warn"),
        quality.relationships("o_custkey", table(spark, d, "customer"), "c_custkey", "warn")])


# -- sessions -----------------------------------------------------------------

def session_streaks(spark, d):
    return sessions.session_counts(A.ride_events(spark, d), ["user_id", "event_type"],
                                   "dropoff_datetime", P.SESSION_GAP)


def session_streaks_6h(spark, d):
    return sessions.session_counts(A.ride_events(spark, d), ["user_id"], "dropoff_datetime",
                                   P.SESSION_GAP_LONG)


def longest_streak(spark, d):
    return sessions.longest_sessions(session_streaks_6h(spark, d))


def trip_session_streaks(spark, d):
    """The reference job's shape on trips: sessions per (pickup zone,
    drop-off zone) on drop-off time with a 5-minute gap."""
    g = _green(spark, d, "pulocationid", "dolocationid", "dropoff_datetime").select(
        F.col("pulocationid").cast("int").alias("pulocationid"),
        F.col("dolocationid").cast("int").alias("dolocationid"), "dropoff_datetime")
    return sessions.session_counts(g, ["pulocationid", "dolocationid"], "dropoff_datetime", P.SESSION_GAP)


def longest_trip_streak(spark, d):
    return sessions.longest_sessions(trip_session_streaks(spark, d))


def session_streaks_stream(spark, d):
    """The streaming job end to end, restarted for every slice of the rides:
    message files read as a stream, watermarked on drop-off time (5 s), counted
    per (user, event type) session (5 min gap), appended to a parquet sink.

    Rides arrive in ``P.STREAM_SLICES`` slices of drop-off time, each published
    and then processed by a new start of the job on the same checkpoint, so no
    micro-batch holds all of them and none comes too late.  A heartbeat after
    the last slice lets the watermark pass every session.
    """
    base = scratch_path(spark, "session-stream")
    rides = A.ride_events(spark, d).select(*_RIDE_COLUMNS)
    shares = [i / P.STREAM_SLICES for i in range(1, P.STREAM_SLICES)]
    at = F.unix_micros(F.col("dropoff_datetime").cast("timestamp"))
    bounds = sorted(set(rides.agg(F.percentile_approx(at, shares)).first()[0] or []))
    slices = [rides.filter((at >= lo) & (at < hi))
              for lo, hi in zip([-(1 << 62), *bounds], [*bounds, 1 << 62])]
    end = rides.agg(F.timestamp_add("DAY", F.lit(1), F.max("dropoff_datetime")).alias("until"))
    for i, part in enumerate(slices, 1):
        messages.publish(part, path=f"{base}/messages")
        if i == len(slices):
            stream_sessions.send_heartbeat(end, f"{base}/heartbeats")
        stream_sessions.run_session_job(
            spark, _RIDE_DDL, ["user_id", "event_type"], "dropoff_datetime",
            source_path=f"{base}/messages", sink_path=f"{base}/sessions", gap=P.SESSION_GAP, available_now=True,
            state_partitions=spark.sparkContext.defaultParallelism,
            heartbeat_path=f"{base}/heartbeats").awaitTermination()
    return spark.read.schema("user_id bigint, event_type string, session_start timestamp_ntz, session_end timestamp_ntz, "
                             "taxi_trips_streak bigint").parquet(f"{base}/sessions")


# -- ingest, loads, messages ---------------------------------------------------

_LANDED = ("vendorid", "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance",
           "ratecodeid", "store_and_fwd_flag", "pulocationid", "dolocationid", "payment_type",
           "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
           "total_amount", "congestion_surcharge")


def _landed(raw):
    return merge.stamp(raw.select("service_type", *_LANDED), P.ROW_ID_COLUMNS_ON_PREMISE,
                       adhoc.file_name()).drop("service_type")


def _batch(raw):
    """The new files: rides from mid-1997 on, some of them again with a revised fare."""
    revised = F.when(F.col("ratecodeid") == P.REVISED_RATECODE, (F.col("fare_amount") + 1).cast(MONEY))
    return (raw.filter(F.col("pickup_datetime") >= F.lit(P.MERGE_SOURCE_FROM).cast("timestamp_ntz"))
               .withColumn("fare_amount", F.explode(F.array_compact(F.array("fare_amount", revised)))))


def ingest_merge(spark, d):
    """Yellow target (files before 1998) merged with an overlapping new batch
    (files from mid-1997 on): target rows plus the batch rows not yet there.
    A revised fare is part of the row id, so such rides are new rows."""
    y = _written(spark, _yellow(spark, d), "landed-yellow")  # both roles come from one read
    target = _landed(y.filter(F.col("pickup_datetime") < F.lit(P.MERGE_TARGET_BEFORE).cast("timestamp_ntz")))
    return merge.merged(_landed(_batch(y)), target)


def ingest_merge_cloud(spark, d):
    """Same merge on green trips with the 5-column row id of the cloud flow (X7),
    for which a ride with a revised fare is the same row."""
    g = _written(spark, _green(spark, d), "landed-green")
    st = lambda df: merge.stamp(df.select("service_type", *_LANDED), P.ROW_ID_COLUMNS_CLOUD,
                                adhoc.file_name()).drop("service_type")
    target = st(g.filter(F.col("pickup_datetime") < F.lit(P.MERGE_TARGET_BEFORE).cast("timestamp_ntz")))
    return merge.merged(st(_batch(g)), target)


def merge_small_batch(spark, d):
    """A small batch of orders, some of them twice, merged into a bucketed and into a plain table of the older ones:
    rows of each target by year."""
    base = table(spark, d, "orders").select(F.md5(F.col("o_orderkey").cast("string")).alias(merge.ROW_ID), "o_orderkey",
                                            F.year("o_orderdate").alias("y"))
    old = base.filter(F.col("o_orderkey") % P.SMALL_BATCH_EVERY != 0)
    batch = base.filter(F.col("o_orderkey") % P.SMALL_BATCH_EVERY < 2)
    out = []
    for kind in ("bucketed", "plain"):
        name = f"orders_{kind}_{uuid.uuid4().hex[:10]}"
        if kind == "bucketed":
            tables.save_bucketed(old, name, merge.ROW_ID, 16)
        else:
            old.write.format("parquet").saveAsTable(name)
        inserted = [merge.merge_insert_only(spark, batch.unionAll(batch), name) for _ in range(2)]
        out.append(spark.table(name).groupBy("y").agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(kind).alias("target"), "y", "rows", F.lit(inserted[0]).cast("bigint").alias("inserted"),
            F.lit(inserted[1]).cast("bigint").alias("inserted_again")))
    return out[0].unionAll(out[1])


_RIDE_COLUMNS = ("event_id", "user_id", "event_type", "pickup_datetime", "dropoff_datetime",
                 "passenger_count", "tip_amount")
_RIDE_DDL = ("event_id bigint, user_id bigint, event_type string, pickup_datetime timestamp_ntz, "
             "dropoff_datetime timestamp_ntz, passenger_count int, tip_amount double")


def publish_trips(spark, d):
    """Rides published as JSON message files (NULLs filled), read and parsed back."""
    path = scratch_path(spark, "publish-trips")
    messages.publish(A.ride_events(spark, d), path=path, columns=_RIDE_COLUMNS,
                     fill={"passenger_count": 0, "tip_amount": 0.0})
    return messages.parse_messages(spark.read.text(path), _RIDE_DDL)


def load_incremental(spark, d):
    """Two incremental runs over rides with the drop-off time as cursor:
    run 1 sees the rides picked up before the split day (cursor >= initial),
    run 2 sees all rides and loads those from run 1's largest cursor on that
    run 1 did not load."""
    base = scratch_path(spark, "load-incremental")
    rides = A.ride_events(spark, d).select(*_RIDE_COLUMNS)
    early = rides.filter(F.col("pickup_datetime") < F.lit(P.INCREMENTAL_SPLIT).cast("timestamp_ntz"))
    for source in (early, rides):
        loads.load_incremental(spark, source, f"{base}/rides", f"{base}/state", "rides", "dropoff_datetime",
                               initial_value=P.INCREMENTAL_INITIAL)
    return loads.read_target(spark, f"{base}/rides", rides.schema).withColumn(
        loads.LOAD_ID, F.col(loads.LOAD_ID).cast("int"))


def _nested_turns(spark, d):
    """Conversation turns as nested JSON records (struct + list of structs),
    round-tripped through JSON text like landed API pages."""
    c = table(spark, d, "conversations")
    words = F.transform(F.split(F.col("text"), " "),
                        lambda w: F.struct(w.alias("word"), F.length(w).alias("length")))
    rec = c.select(
        F.col("conv_id"), F.col("turn"),
        F.md5(F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))).alias("record_hash"),
        F.struct(F.col("role").alias("Role"), F.col("text").alias("Text")).alias("Message"),
        words.alias("Words"))
    ddl = ("conv_id bigint, turn bigint, record_hash string, Message struct<Role: string, Text: string>, "
           "Words array<struct<word: string, length: int>>")
    return messages.parse_messages(messages.to_messages(rec), ddl)


def load_nested_parents(spark, d):
    return nested.normalise(_nested_turns(spark, d), "turns", key="record_hash")["turns"].drop(nested.RECORD_ID)


def load_nested_children(spark, d):
    child = nested.normalise(_nested_turns(spark, d), "turns", key="record_hash")["turns__words"]
    return child.select(nested.PARENT_ID, nested.LIST_IDX, "word", "length")


def load_nested_by_place(spark, d):
    """Nested records without a key, each one twice: children joined to the record that they came from."""
    turns = _nested_turns(spark, d).drop("record_hash")
    made = nested.normalise(turns.unionAll(turns), "turns")
    records = made["turns"].select("conv_id", "turn", nested.RECORD_ID)
    words = made["turns__words"].groupBy(nested.PARENT_ID).agg(F.count(F.lit(1)).alias("words"))
    return records.join(words, F.col(nested.RECORD_ID) == F.col(nested.PARENT_ID), "left").select(
        "conv_id", "turn", F.coalesce("words", F.lit(0)).cast("bigint").alias("words"))


def brand_avg_price(spark, d):
    """Products as files of JSON documents ``{"products": [...]}``, read,
    unwrapped, reduced to the kept keys (missing -> 'N/A') and averaged per brand."""
    p = table(spark, d, "part")
    docs = p.select(F.array(F.struct(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category"), F.col("p_retailprice").alias("price"))).alias("products"))
    path = scratch_path(spark, "products")
    write_json(docs, path)
    parsed = read_json(spark, path, multiline=False, schema=(
        "products array<struct<id: bigint, title: string, brand: string, category: string, price: double>>"))
    kept = keep_keys(nested.unwrap(parsed, "products"), P.PRODUCT_KEYS)
    return adhoc.rounded_group_mean(kept, "brand", "price", "avg_price", scale=2)


QUERIES: dict[str, Query] = {
    "stg_green": stg_green,
    "stg_yellow": stg_yellow,
    "stg_fhv": stg_fhv,
    "stg_zones": stg_zones,
    "fact_trips": fact_trips,
    "dim_fhv_trips": dim_fhv_trips,
    "monthly_zone_revenue": monthly_zone_revenue,
    "quarterly_revenue_growth": quarterly_revenue_growth,
    "monthly_fare_percentiles": monthly_fare_percentiles,
    "monthly_fare_percentiles_kept": monthly_fare_percentiles_kept,
    "fhv_travel_time_p90": fhv_travel_time_p90,
    "fhv_nth_longest_p90": fhv_nth_longest_p90,
    "distance_bands": distance_bands,
    "longest_trip_day": longest_trip_day,
    "longest_trip_date": longest_trip_date,
    "top_pickup_zones": top_pickup_zones,
    "largest_tip_dropoff": largest_tip_dropoff,
    "distinct_pickups": distinct_pickups,
    "zero_fare_count": zero_fare_count,
    "zero_tip_count": zero_tip_count,
    "vendors_in_range": vendors_in_range,
    "trips_on_day": trips_on_day,
    "trips_on_day_bounds": trips_on_day_bounds,
    "longest_trip_hours": longest_trip_hours,
    "zone_frequency": zone_frequency,
    "zone_frequency_sql": zone_frequency_sql,
    "avg_trip_minutes": avg_trip_minutes,
    "avg_trip_minutes_elapsed": avg_trip_minutes_elapsed,
    "rows_by_file": rows_by_file,
    "rows_per_service_year": rows_per_service_year,
    "rows_per_service_month": rows_per_service_month,
    "dq_raw_trips": dq_raw_trips,
    "dq_stg_green": dq_stg_green,
    "dq_stg_yellow": dq_stg_yellow,
    "dq_orders_unique": dq_orders_unique,
    "session_streaks": session_streaks,
    "session_streaks_6h": session_streaks_6h,
    "longest_streak": longest_streak,
    "trip_session_streaks": trip_session_streaks,
    "longest_trip_streak": longest_trip_streak,
    "session_streaks_stream": session_streaks_stream,
    "ingest_merge": ingest_merge,
    "ingest_merge_cloud": ingest_merge_cloud,
    "merge_small_batch": merge_small_batch,
    "publish_trips": publish_trips,
    "load_incremental": load_incremental,
    "load_nested_parents": load_nested_parents,
    "load_nested_children": load_nested_children,
    "load_nested_by_place": load_nested_by_place,
    "brand_avg_price": brand_avg_price,
    **io_queries.QUERIES,
}
