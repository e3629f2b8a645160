"""Ad-hoc trip questions: distance bands, longest trips, busiest zones,
largest tips, day counts, duration maxima and zone frequencies.

Every result is a distributed aggregate; ``limit`` appears only where the
question is a top-k, always after a total order (``TakeOrderedAndProject``).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faresight.functions.columns import boundaries, day_range, elapsed, exact_mean, ntz_literal


def _ts(value) -> F.Column:
    return ntz_literal(value if isinstance(value, _dt.datetime) else _dt.datetime.fromisoformat(str(value)))


def filter_time(df: DataFrame, ts_col: str, start=None, end=None) -> DataFrame:
    """Optional half-open ``[start, end)`` on a timestamp column (X12)."""
    if start is not None:
        df = df.filter(F.col(ts_col) >= _ts(start))
    if end is not None:
        df = df.filter(F.col(ts_col) < _ts(end))
    return df


def band_label(lo, hi) -> str:
    if lo is None:
        return f"trips_upto_{hi}"
    if hi is None:
        return f"trips_over_{lo}"
    return f"trips_{lo}_to_{hi}"


def distance_bands(trips: DataFrame, edges: Sequence[float] = (1, 3, 7, 10),
                   distance_col: str = "trip_distance", ts_col: str = "pickup_datetime",
                   start=None, end=None) -> DataFrame:
    """Counts of trips per distance band ``(lo, hi]`` in ONE pass (one row,
    one column per band), instead of one scan per band."""
    t = filter_time(trips, ts_col, start, end)
    d = F.col(distance_col)
    bounds = [None, *edges, None]
    aggs = []
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (d > lo)
        if hi is not None:
            cond = cond & (d <= hi)
        aggs.append(F.count_if(cond).alias(band_label(lo, hi)))
    return t.agg(*aggs)


def longest_trip_day(trips: DataFrame, by: str = "dayofmonth", distance_col: str = "trip_distance",
                     ts_col: str = "pickup_datetime", k: int = 1) -> DataFrame:
    """Day with the longest trip.

    ``by='dayofmonth'`` groups by day of month (parity with the reference,
    X11); ``by='date'`` groups by calendar date.  Ties on the maximum are
    broken by the earlier day.
    """
    day = F.dayofmonth(ts_col) if by == "dayofmonth" else F.to_date(ts_col)
    g = trips.groupBy(day.alias("day")).agg(F.max(distance_col).alias("longest_trip"))
    return g.orderBy(F.col("longest_trip").desc(), F.col("day").asc()).limit(k)


def top_pickup_zones(trips: DataFrame, zones: DataFrame, day, min_total: float, k: int = 3,
                     ts_col: str = "pickup_datetime", zone_key: str = "pulocationid",
                     amount_col: str = "total_amount") -> DataFrame:
    """Zones with the largest pickup revenue on one day, above ``min_total``.

    Filter (half-open day range, pushable), aggregate per zone id, apply the
    HAVING bound, and only then join names (aggregate before join).
    """
    per_zone = (trips.filter(day_range(ts_col, day))
                     .groupBy(F.col(zone_key).cast("int").alias("_zone_id"))
                     .agg(F.sum(amount_col).cast("decimal(38,2)").alias("total_amount"))
                     .filter(F.col("total_amount") > F.lit(min_total)))
    named = per_zone.join(zones, per_zone["_zone_id"] == zones["locationid"]) \
                    .select("zone", "total_amount")
    return named.orderBy(F.col("total_amount").desc(), F.col("zone")).limit(k)


def largest_tip_dropoff(trips: DataFrame, zones: DataFrame, pickup_zone: str,
                        pickup_key: str = "pulocationid", dropoff_key: str = "dolocationid",
                        tip_col: str = "tip_amount") -> DataFrame:
    """Drop-off zone(s) of the trip(s) with the largest tip among trips
    picked up in ``pickup_zone``.  All trips tied at the maximum are kept.

    One pass: ``rank() = 1`` keeps ties, and Spark limits each task's rows by
    that rank before they meet, so only tied rows travel.
    """
    pz = zones.filter(F.col("zone") == pickup_zone).select(F.col("locationid").alias("_pu"))
    from_zone = trips.join(pz, F.col(pickup_key).cast("int") == pz["_pu"]).drop("_pu")
    best = first_ranked(from_zone.filter(F.col(tip_col).isNotNull()), tip_col)
    dz = zones.select(F.col("locationid").alias("_do"), F.col("zone").alias("dropoff_zone"))
    return (best.join(dz, F.col(dropoff_key).cast("int") == dz["_do"])
                .select("dropoff_zone", F.col(tip_col).alias("tip_amount")))


def first_ranked(df: DataFrame, col: str) -> DataFrame:
    """All rows with the largest ``col`` (a partial rank limit per task, then one task over their survivors)."""
    ranked = df.withColumn("_rank", F.rank().over(Window.orderBy(F.col(col).desc())))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def distinct_count(df: DataFrame, col: str, alias: str | None = None) -> DataFrame:
    return df.agg(F.count_distinct(col).alias(alias or f"distinct_{col}"))


def count_equal(df: DataFrame, col: str, value, alias: str = "rows") -> DataFrame:
    return df.filter(F.col(col) == value).agg(F.count(F.lit(1)).alias(alias))


def distinct_in_range(df: DataFrame, col: str, ts_col: str, first_day, last_day) -> DataFrame:
    """Distinct ``col`` values with ``ts_col`` on days ``first_day..last_day``
    inclusive (half-open on the timestamp, so the filter reaches the scan)."""
    lo = _dt.date.fromisoformat(str(first_day))
    hi = _dt.date.fromisoformat(str(last_day)) + _dt.timedelta(days=1)
    return filter_time(df, ts_col, _dt.datetime.combine(lo, _dt.time()),
                       _dt.datetime.combine(hi, _dt.time())).select(col).distinct()


def trips_on_day(df: DataFrame, day, ts_col: str = "pickup_datetime") -> DataFrame:
    """Rows on one calendar day: ``[day, day+1)`` (equals ``DATE(ts) = day``)."""
    return df.filter(day_range(ts_col, day)).agg(F.count(F.lit(1)).alias("trips"))


def trips_on_day_bounds(df: DataFrame, day, ts_col: str = "pickup_datetime") -> DataFrame:
    """Parity form: ``ts BETWEEN 'day 00:00:00' AND 'day 23:59:59'``.  Misses
    rows in the last fractional second of the day (X13)."""
    d = _dt.date.fromisoformat(str(day))
    lo = _dt.datetime.combine(d, _dt.time(0, 0, 0))
    hi = _dt.datetime.combine(d, _dt.time(23, 59, 59))
    return df.filter(F.col(ts_col).between(_ts(lo), _ts(hi))).agg(F.count(F.lit(1)).alias("trips"))


def longest_trip_hours(df: DataFrame, start_col: str = "pickup_datetime",
                       end_col: str = "dropoff_datetime") -> DataFrame:
    """Maximum whole hours elapsed between pickup and drop-off."""
    return df.agg(F.max(elapsed("hour", start_col, end_col)).alias("max_trip_hours"))


def zone_frequency(trips: DataFrame, zones: DataFrame, zone_key: str = "pulocationid") -> DataFrame:
    """Trips per pickup zone name, rarest first.

    Counts per zone id first (partial aggregate on the fact side), then joins
    the few result rows to names and re-aggregates by name (names need not
    be unique).
    """
    per_id = trips.groupBy(F.col(zone_key).cast("int").alias("_zone_id")).agg(F.count(F.lit(1)).alias("_n"))
    named = per_id.join(zones, per_id["_zone_id"] == zones["locationid"])
    return (named.groupBy("zone").agg(F.sum("_n").alias("frequency"))
                 .orderBy(F.col("frequency").asc(), F.col("zone")))


def avg_trip_minutes(rides: DataFrame, semantics: str = "boundaries",
                     start_col: str = "pickup_datetime", end_col: str = "dropoff_datetime") -> DataFrame:
    """Average trip length in minutes.

    ``semantics='boundaries'`` counts minute boundaries crossed (the
    workshop's ``date_diff('minute', ...)``); ``'elapsed'`` counts whole
    minutes elapsed.  The mean is exact, rounded to 4 decimals.
    """
    fn = boundaries if semantics == "boundaries" else elapsed
    minutes = fn("minute", start_col, end_col)
    return rides.agg(exact_mean(minutes, 0, 4).alias("avg_trip_minutes"))


def file_name(service_col: str = "service_type", ts_col: str = "pickup_datetime"):
    """``{service}_tripdata_{yyyy}-{MM}.csv`` for the month a row belongs to."""
    return F.concat(F.lower(F.col(service_col)), F.lit("_tripdata_"),
                    F.date_format(F.col(ts_col), "yyyy-MM"), F.lit(".csv"))


def rows_by_file(trips: DataFrame, service_col: str = "service_type",
                 ts_col: str = "pickup_datetime") -> DataFrame:
    """Rows per monthly source file, with service, year and month."""
    return (trips.groupBy(file_name(service_col, ts_col).alias("filename"),
                          F.col(service_col).alias("service_type"),
                          F.year(ts_col).alias("year"), F.month(ts_col).alias("month"))
                 .agg(F.count(F.lit(1)).alias("rows")))


def rows_per_service_period(trips: DataFrame, year: int, month: int | None = None,
                            service_col: str = "service_type", ts_col: str = "pickup_datetime") -> DataFrame:
    """Row count per service for one year (or one month of it)."""
    first = _dt.date(year, month or 1, 1)
    after = _dt.date(year + (month is None or month == 12), 1 if month is None else month % 12 + 1, 1)
    t = trips.filter((F.col(ts_col) >= _ts(first)) & (F.col(ts_col) < _ts(after)))
    return t.groupBy(service_col).agg(F.count(F.lit(1)).alias("rows"))


def rounded_group_mean(df: DataFrame, key: str, value: str, alias: str, scale: int = 2,
                       in_scale: int = 9) -> DataFrame:
    """``round(avg(value), scale)`` per key, exact, highest first.

    Values are averaged as they are and rounded once at the end; they are
    taken to ``in_scale`` decimals so that the sum does not depend on order."""
    v = F.col(value).try_cast("double").cast(f"decimal(20,{in_scale})")
    return (df.groupBy(key).agg(exact_mean(v, in_scale, scale).alias(alias))
              .orderBy(F.col(alias).desc_nulls_last(), F.col(key)))


def top_k(df: DataFrame, k: int, order_col: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The ``k`` rows with the largest ``order_col`` (a global rank without an
    unpartitioned window: ``TakeOrderedAndProject`` keeps k rows per task and
    merges them, so no task ever holds more than k rows per input partition)."""
    return df.orderBy(F.col(order_col).desc_nulls_last(), *[F.col(c) for c in tiebreak]).limit(k)
