"""Staging models: typed, deduplicated trip views and the zone lookup.

Dedup keeps one row per (vendor, pickup time) with ``row_number() = 1``.
The reference orders only by the partition key, which leaves the kept row
arbitrary; here the caller passes a total tie-break order (X1).  Catalyst
plans this as a *partial* ``WindowGroupLimit`` before the shuffle, so every
map task forwards at most one row per key: a hot key cannot flood one
reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faresight.functions.columns import MONEY, money, payment_description, safe_cast, surrogate_key

MONEY_COLUMNS = ("fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
                 "ehail_fee", "improvement_surcharge", "total_amount")

STAGED_COLUMNS = (
    "tripid", "vendorid", "ratecodeid", "pickup_locationid", "dropoff_locationid",
    "pickup_datetime", "dropoff_datetime", "store_and_fwd_flag", "passenger_count",
    "trip_distance", "trip_type", *MONEY_COLUMNS, "payment_type", "payment_type_description",
)


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """Keep the first row per ``keys`` under the total order ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def _typed_columns(pickup_col: str, dropoff_col: str, trip_type, ehail_fee) -> list:
    """The staged column list (types, safe casts, payment description)."""
    payment = F.coalesce(safe_cast("payment_type", "int"), F.lit(0))
    return [
        surrogate_key(["vendorid", pickup_col]).alias("tripid"),
        safe_cast("vendorid", "int").alias("vendorid"),
        safe_cast("ratecodeid", "int").alias("ratecodeid"),
        safe_cast("pulocationid", "int").alias("pickup_locationid"),
        safe_cast("dolocationid", "int").alias("dropoff_locationid"),
        F.col(pickup_col).cast("timestamp_ntz").alias("pickup_datetime"),
        F.col(dropoff_col).cast("timestamp_ntz").alias("dropoff_datetime"),
        F.col("store_and_fwd_flag"),
        safe_cast("passenger_count", "int").alias("passenger_count"),
        money("trip_distance").alias("trip_distance"),
        trip_type.cast("int").alias("trip_type"),
        money("fare_amount").alias("fare_amount"),
        money("extra").alias("extra"),
        money("mta_tax").alias("mta_tax"),
        money("tip_amount").alias("tip_amount"),
        money("tolls_amount").alias("tolls_amount"),
        ehail_fee.alias("ehail_fee"),
        money("improvement_surcharge").alias("improvement_surcharge"),
        money("total_amount").alias("total_amount"),
        payment.alias("payment_type"),
        # X6: the description comes from the same safe-cast value (NULL -> 0 -> EMPTY)
        payment_description(payment).alias("payment_type_description"),
    ]


def stage_trips(raw: DataFrame, street_hail_only: bool = False,
                pickup_col: str = "pickup_datetime", dropoff_col: str = "dropoff_datetime",
                tiebreak: Sequence[str] = ()) -> DataFrame:
    """Green/yellow staging model.

    ``street_hail_only`` (yellow): trip type is the constant 1 and there is no
    e-hail fee.  Of rows with the same vendor and pickup time the first by
    ``tiebreak`` (default: all columns) stays.  A development row limit is
    the caller's ``.limit(n)`` on the result.
    """
    t = raw.filter(F.col("vendorid").isNotNull())
    t = dedupe_first(t, ["vendorid", pickup_col], [F.col(c) for c in tiebreak or raw.columns])
    trip_type = F.lit(1) if street_hail_only else safe_cast("trip_type", "int")
    ehail = F.lit(0).cast(MONEY) if street_hail_only else money("ehail_fee")
    return t.select(*_typed_columns(pickup_col, dropoff_col, trip_type, ehail))


def stage_services(raw: DataFrame, service_col: str = "service_type",
                   street_hail_services: Sequence[str] = ("Yellow",),
                   pickup_col: str = "pickup_datetime", dropoff_col: str = "dropoff_datetime",
                   tiebreak: Sequence[str] = ()) -> DataFrame:
    """Stage several services from ONE raw input in one pass.

    Row for row the same as :func:`stage_trips` per service followed by a
    union with the service name: the dedup key gains the service column and
    the street-hail rules apply per row.  When the services share one source
    this reads and joins it once instead of once per service, with a single
    shuffle for the dedup.
    """
    t = raw.filter(F.col("vendorid").isNotNull())
    t = dedupe_first(t, [service_col, "vendorid", pickup_col],
                     [F.col(c) for c in tiebreak or raw.columns])
    hail = F.col(service_col).isin(list(street_hail_services))
    trip_type = F.when(hail, F.lit(1)).otherwise(safe_cast("trip_type", "int"))
    ehail = F.when(hail, F.lit(0).cast(MONEY)).otherwise(money("ehail_fee"))
    return t.select(*_typed_columns(pickup_col, dropoff_col, trip_type, ehail),
                    F.col(service_col).alias("service_type"))


def stage_fhv(raw: DataFrame) -> DataFrame:
    """FHV staging: drop rows without a dispatching base, type the times."""
    return raw.filter(F.col("dispatching_base_num").isNotNull()).select(
        "dispatching_base_num",
        F.col("pickup_datetime").cast("timestamp_ntz").alias("pickup_datetime"),
        F.col("dropoff_datetime").cast("timestamp_ntz").alias("dropoff_datetime"),
        "pulocationid", "dolocationid", "sr_flag", "affiliated_base_number",
    )


def stage_zones(zones: DataFrame) -> DataFrame:
    return zones.select("locationid", "borough", "zone", "service_zone")
