"""Taxi-shaped views over the star-schema test tables.

The driver's tables are order/lineitem data, not taxi trips.  These functions
re-express them with the taxi trip, zone, FHV and ride-event columns the
operators expect.  The DuckDB text of the same views lives in
``faresight.plans.oracle`` and must stay equivalent.

Mapping (one trip per lineitem row):

* vendor = supplier key; service = Green when ``l_linestatus = 'O'`` else Yellow
* pickup / dropoff zone = customer nation / supplier nation
* pickup / dropoff time = earlier / later of order date and ship date
* payment type = line number, 7 -> NULL; passenger count = line number, 1 -> NULL
* distance = quantity; fare = extended price; tip = fare x discount;
  MTA tax = fare x tax (money is exact DECIMAL(18,2))
* zones = nation joined to region (borough = region name)

One lineitem row is always one trip: the other tables are joined with left
joins, and only those that the wanted columns need.  A caller names the columns
it uses; a question about fares then reads lineitem alone.

Join order is written out on purpose: orders is joined to customer first
(orders is a quarter of lineitem), so the large lineitem side is shuffled
once, on the order key.  That join is pinned to a sort-merge join: both
sides grow with the data, and a compressed-file size estimate under the
broadcast threshold (it happens at small scale factors) would otherwise
broadcast a growing table.  A sort-merge join spills instead of failing and
lets AQE split skewed order keys.  Customer and supplier joins are left to
Spark's size-checked broadcast (``autoBroadcastJoinThreshold``, re-checked by
AQE on actual shuffle sizes), with a sort-merge join beyond the threshold.

Time ranges: pickup is the earlier and drop-off the later of two columns, which
hides a filter on them from the scan.  ``pickup_from`` and ``dropoff_before``
state what such a range implies for the ship date (an earlier date that is
not before t leaves none before t), and that reaches the lineitem scan; the
caller still filters exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faresight.functions.columns import MONEY, money, ntz_literal
from faresight.sources.tables import table

# Tie-break columns that make (vendor, pickup) dedup deterministic (X1).
TRIP_TIEBREAK = ("src_orderkey", "src_linenumber", "src_partkey")

# Fixed values standing in for the reference's "Unknown" zones.
UNKNOWN_BOROUGH = "MIDDLE EAST"      # zones excluded by borough in fact_trips
UNKNOWN_ZONE_IDS = (23, 24)          # zones excluded by id in dim_fhv_trips


def _service_predicate(service: str):
    """The service as a predicate on the raw column, so it reaches the scan."""
    if service == "Green":
        return F.col("l_linestatus") == "O"
    if service == "Yellow":
        return ~F.col("l_linestatus").eqNullSafe("O")
    raise ValueError(f"unknown service {service!r}")


_ORDER_COLUMNS = {"pickup_datetime", "dropoff_datetime", "pulocationid"}


def _implied(pickup_from=None, dropoff_before=None):
    """What a range of pickup or drop-off times implies for the ship date."""
    ship, out = F.col("l_shipdate"), F.lit(True)
    if pickup_from is not None:
        out = out & (ship.isNull() | (ship >= ntz_literal(pickup_from)))
    if dropoff_before is not None:
        out = out & (ship.isNull() | (ship < ntz_literal(dropoff_before)))
    return out


def _joined_lines(spark: SparkSession, data_dir: str, service: str | None, columns, **implied) -> DataFrame:
    """lineitem with the tables that ``columns`` need; absent columns are NULL."""
    li = table(spark, data_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    if service is not None:
        li = li.filter(_service_predicate(service))
    li = li.filter(_implied(**implied))
    if _ORDER_COLUMNS & set(columns):
        orders = table(spark, data_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
        if "pulocationid" in columns:
            cust = table(spark, data_dir, "customer").select("c_custkey", "c_nationkey")
            orders = orders.join(cust, orders.o_custkey == cust.c_custkey, "left")
        li = li.join(orders.hint("merge"), li.l_orderkey == orders.o_orderkey, "left")
    if "dolocationid" in columns:
        supp = table(spark, data_dir, "supplier").select("s_suppkey", "s_nationkey")
        li = li.join(supp, li.l_suppkey == supp.s_suppkey, "left")
    return li


# Fixed rules that give the data what taxi files have and the given tables
# lack; the same rules are in ``faresight.plans.oracle``.
NO_VENDOR_EVERY = 97        # l_partkey divisible by it: vendor is NULL
ZERO_FARE_EVERY, ZERO_FARE_AT = 89, 1
ORPHAN_ZONE_EVERY, ORPHAN_ZONE_AT, ORPHAN_ZONE = 83, 2, "999"
NO_BASE_EVERY, NO_BASE_AT = 79, 3
LAST_SECOND_EVERY, LAST_SECOND_AT = 50, 7    # event_id: picked up at 23:59:59.5 of its day
NO_PASSENGERS_EVERY = 11    # event_id


def _trip_columns() -> dict:
    part = F.col("l_partkey")
    fare = F.when(part % ZERO_FARE_EVERY == ZERO_FARE_AT, F.lit(0).cast(MONEY)).otherwise(money("l_extendedprice"))
    tip = F.round(fare * F.col("l_discount").cast("decimal(4,2)"), 2).cast(MONEY)
    tax = F.round(fare * F.col("l_tax").cast("decimal(4,2)"), 2).cast(MONEY)
    zero = F.lit(0).cast(MONEY)
    return {
        "vendorid": F.when(part % NO_VENDOR_EVERY != 0, F.col("l_suppkey").cast("string")),
        "src_orderkey": F.col("l_orderkey"),
        "src_linenumber": F.col("l_linenumber"),
        "src_partkey": F.col("l_partkey"),
        "service_type": F.when(F.col("l_linestatus") == "O", F.lit("Green")).otherwise(F.lit("Yellow")),
        "pickup_datetime": F.least("o_orderdate", "l_shipdate"),
        "dropoff_datetime": F.greatest("o_orderdate", "l_shipdate"),
        "store_and_fwd_flag": F.col("l_returnflag"),
        "ratecodeid": F.col("l_linenumber").cast("string"),
        "pulocationid": F.when(part % ORPHAN_ZONE_EVERY == ORPHAN_ZONE_AT, F.lit(ORPHAN_ZONE))
        .otherwise(F.col("c_nationkey").cast("string")),
        "dolocationid": F.col("s_nationkey").cast("string"),
        "passenger_count": F.nullif(F.col("l_linenumber"), F.lit(1)),
        "trip_distance": F.col("l_quantity"),
        "fare_amount": fare,
        "extra": zero,
        "mta_tax": tax,
        "tip_amount": tip,
        "tolls_amount": zero,
        "ehail_fee": zero,
        "improvement_surcharge": zero,
        "total_amount": (fare + tip + tax).cast(MONEY),
        "congestion_surcharge": zero,
        "payment_type": F.nullif(F.col("l_linenumber"), F.lit(7)),
        "trip_type": F.when(F.col("l_returnflag") == "R", F.lit("2")).otherwise(F.lit("1")),
    }


def raw_trips(spark: SparkSession, data_dir: str, service: str | None = None, columns=None, **implied) -> DataFrame:
    """Raw trips as landed from the monthly files (one service's file when
    ``service`` is given, both otherwise): all columns, or those named."""
    made = _trip_columns()
    columns = list(columns or made)
    t = _joined_lines(spark, data_dir, service, columns, **implied)
    return t.select(*[made[c].alias(c) for c in columns])


def raw_service_trips(spark: SparkSession, data_dir: str, service: str, columns=None, **implied) -> DataFrame:
    """One service's raw file (``'Green'`` or ``'Yellow'``)."""
    return raw_trips(spark, data_dir, service, columns, **implied)


def zones(spark: SparkSession, data_dir: str) -> DataFrame:
    """Zone lookup: locationid, borough, zone, service_zone."""
    n = table(spark, data_dir, "nation")
    r = table(spark, data_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").alias("locationid"),
        F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone"),
        F.when(F.col("n_regionkey") == 1, F.lit("Yellow Zone")).otherwise(F.lit("Boro Zone")).alias("service_zone"),
    )


def raw_fhv_trips(spark: SparkSession, data_dir: str, **implied) -> DataFrame:
    """For-hire-vehicle trips: every trip row, dispatched by its vendor's base."""
    t = _joined_lines(spark, data_dir, None, {"pulocationid", "dolocationid", "pickup_datetime"}, **implied)
    base = F.concat(F.lit("B"), F.lpad(F.col("l_suppkey").cast("string"), 5, "0"))
    return t.select(
        F.when(F.col("l_partkey") % NO_BASE_EVERY != NO_BASE_AT, base).alias("dispatching_base_num"),
        F.least("o_orderdate", "l_shipdate").alias("pickup_datetime"),
        F.greatest("o_orderdate", "l_shipdate").alias("dropoff_datetime"),
        F.col("c_nationkey").alias("pulocationid"),
        F.col("s_nationkey").alias("dolocationid"),
        F.when(F.col("l_returnflag") == "R", F.lit(1)).alias("sr_flag"),
        base.alias("affiliated_base_number"),
    )


def ride_events(spark: SparkSession, data_dir: str) -> DataFrame:
    """Ride events: pickup at ``ts`` (some in the last half second of its day),
    drop-off ``value`` seconds later."""
    e = table(spark, data_dir, "events")
    last = F.timestamp_add("MICROSECOND", F.lit(86_399_500_000), F.to_date("ts").cast("timestamp_ntz"))
    pickup = F.when(F.col("event_id") % LAST_SECOND_EVERY == LAST_SECOND_AT, last).otherwise(F.col("ts"))
    micros = F.round(F.col("value") * F.lit(1_000_000)).cast("bigint")
    return e.select(
        "event_id", "user_id", "event_type",
        pickup.alias("pickup_datetime"),
        F.timestamp_add("MICROSECOND", micros, pickup).alias("dropoff_datetime"),
        F.when(F.col("event_id") % NO_PASSENGERS_EVERY != 0, F.get_json_object("props", "$.k").cast("int"))
        .alias("passenger_count"),
        F.col("value").alias("tip_amount"),
    )
