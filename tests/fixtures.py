"""Hand-written unit fixtures (a few rows each)."""

import datetime as dt
from decimal import Decimal

RAW_DDL = (
    "vendorid string, src_orderkey bigint, src_linenumber int, src_partkey bigint, service_type string, "
    "pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, store_and_fwd_flag string, "
    "ratecodeid string, pulocationid string, dolocationid string, passenger_count int, trip_distance double, "
    "fare_amount decimal(18,2), extra decimal(18,2), mta_tax decimal(18,2), tip_amount decimal(18,2), "
    "tolls_amount decimal(18,2), ehail_fee decimal(18,2), improvement_surcharge decimal(18,2), "
    "total_amount decimal(18,2), congestion_surcharge decimal(18,2), payment_type int, trip_type string"
)

ZONES_DDL = "locationid int, borough string, zone string, service_zone string"

T0 = dt.datetime(2020, 3, 1, 8, 0)


def trip(vendor="1", key=1, line=1, part=1, service="Green", pickup=T0, minutes=10, pu="1", do="2",
         pax=1, dist=1.0, fare="10.00", tip="1.00", pay=1, ttype="1"):
    m = lambda x: Decimal(x)
    fare_d, tip_d = m(fare), m(tip)
    return (vendor, key, line, part, service, pickup, pickup + dt.timedelta(minutes=minutes), "N", "1", pu, do,
            pax, dist, fare_d, m("0"), m("0.50"), tip_d, m("0"), m("0"), m("0.30"),
            fare_d + tip_d + m("0.80"), m("0"), pay, ttype)


def zones(spark):
    rows = [(1, "Manhattan", "East Harlem North", "Boro Zone"), (2, "Queens", "JFK Airport", "Airports"),
            (3, "Brooklyn", "Park Slope", "Boro Zone"), (264, "Unknown", "NV", "N/A"),
            (265, "Unknown", None, "N/A")]
    return spark.createDataFrame(rows, ZONES_DDL)


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW_DDL)
