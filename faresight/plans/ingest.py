"""Monthly taxi-file ingest: land CSV -> stamp row id + file name ->
insert-only merge into a hash-bucketed target -> drop the staging view.

One month per call (``ingest_month``) or many months in one read
(``ingest_months``: a glob read stamps each row with its own file name and
runs ONE merge, instead of one job per file).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from faresight.functions.columns import postgres_text
from faresight.sinks import merge, tables
from faresight.sources import files

# ---------------------------------------------------------------------------
# Column order of the monthly CSV files per service, and the
# row-id key columns of the on-premise (7 columns) and cloud (5) flows.
CSV_SCHEMAS = {
    "yellow": ("VendorID string, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
               "passenger_count int, trip_distance double, RatecodeID string, store_and_fwd_flag string, "
               "PULocationID string, DOLocationID string, payment_type int, fare_amount double, extra double, "
               "mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double, "
               "total_amount double, congestion_surcharge double"),
    "green": ("VendorID string, lpep_pickup_datetime timestamp_ntz, lpep_dropoff_datetime timestamp_ntz, "
              "store_and_fwd_flag string, RatecodeID string, PULocationID string, DOLocationID string, "
              "passenger_count int, trip_distance double, fare_amount double, extra double, mta_tax double, "
              "tip_amount double, tolls_amount double, ehail_fee double, improvement_surcharge double, "
              "total_amount double, payment_type int, trip_type string, congestion_surcharge double"),
}
ROW_ID_KEYS = {
    ("yellow", "on_premise"): ("VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID",
                               "DOLocationID", "fare_amount", "trip_distance"),
    ("green", "on_premise"): ("VendorID", "lpep_pickup_datetime", "lpep_dropoff_datetime", "PULocationID",
                              "DOLocationID", "fare_amount", "trip_distance"),
    ("yellow", "cloud"): ("VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID",
                          "DOLocationID"),
    ("green", "cloud"): ("VendorID", "lpep_pickup_datetime", "lpep_dropoff_datetime", "PULocationID",
                         "DOLocationID"),
}
# ---------------------------------------------------------------------------

# Key columns of type double, written in the row id as the database writes them.
DOUBLE_KEYS = {c: postgres_text for c in ("fare_amount", "trip_distance")}


def monthly_file_name(service: str, year: int, month: int) -> str:
    """``green_tripdata_2020-04.csv``"""
    return f"{service}_tripdata_{year}-{month:02d}.csv"


def ensure_target(spark: SparkSession, service: str, target_table: str, buckets: int) -> None:
    """Create the (empty) target if absent: row id + file name + file columns,
    bucketed on the row id so merges do not shuffle the target."""
    if spark.catalog.tableExists(target_table):
        return
    empty = spark.createDataFrame([], f"unique_row_id string, filename string, {CSV_SCHEMAS[service]}")
    tables.save_bucketed(empty, target_table, merge.ROW_ID, buckets, mode="ignore")


def ingest_month(spark: SparkSession, landing_dir: str, service: str, year: int, month: int,
                 target_table: str, key_set: str = "on_premise", buckets: int = 64) -> dict:
    """Ingest one monthly file; returns ``{"file", "inserted"}``.  Re-running
    the same month inserts nothing (rows are matched on the row id)."""
    fname = monthly_file_name(service, year, month)
    staging_name = f"{service}_tripdata_staging"
    ensure_target(spark, service, target_table, buckets)
    staged = files.external_table(spark, staging_name, f"{landing_dir.rstrip('/')}/{fname}", CSV_SCHEMAS[service])
    stamped = merge.stamp(staged, ROW_ID_KEYS[(service, key_set)], fname, text_form=DOUBLE_KEYS)
    inserted = merge.merge_insert_only(spark, stamped, target_table)
    tables.drop(spark, staging_name, view=True)  # X21: drop the staging view
    return {"file": fname, "inserted": inserted}


def ingest_months(spark: SparkSession, landing_dir: str, service: str, months: Iterable[tuple[int, int]],
                  target_table: str, key_set: str = "on_premise", buckets: int = 64,
                  named_by_folder: bool = False) -> int:
    """Backfill several months in one read and one merge; each row keeps the
    name of the file it came from (``named_by_folder``: a month is a folder of
    that name with part files)."""
    ensure_target(spark, service, target_table, buckets)
    paths = [f"{landing_dir.rstrip('/')}/{monthly_file_name(service, y, m)}" for y, m in months]
    staged = files.read_csv(spark, paths[0] if len(paths) == 1 else paths, schema=CSV_SCHEMAS[service])
    name = F.element_at(F.split("_metadata.file_path", "/"), -2) if named_by_folder else None
    stamped = merge.stamp(staged, ROW_ID_KEYS[(service, key_set)], name, text_form=DOUBLE_KEYS)
    return merge.merge_insert_only(spark, stamped, target_table)


def rows_per_file(spark: SparkSession, target_table: str, files_like: Sequence[str] | None = None):
    """Row counts per stamped file name (optionally only names matching a LIKE pattern)."""
    t = spark.table(target_table)
    if files_like:
        cond = None
        for pat in files_like:
            c = F.col("filename").like(pat)
            cond = c if cond is None else cond | c
        t = t.filter(cond)
    return t.groupBy("filename").agg(F.count(F.lit(1)).alias("rows"))


def main(argv: Sequence[str] | None = None) -> int:
    """``python -m faresight.plans.ingest --service yellow --year 2020 --month 12
    --landing DIR --target TABLE``: the parameterised monthly ingest."""
    import argparse

    from faresight.session import get_session

    ap = argparse.ArgumentParser(description="Ingest one monthly taxi file (insert-only merge).")
    ap.add_argument("--service", choices=sorted(CSV_SCHEMAS), required=True)
    ap.add_argument("--year", type=int, required=True)
    ap.add_argument("--month", type=int, required=True)
    ap.add_argument("--landing", required=True, help="folder holding <service>_tripdata_<yyyy>-<mm>.csv")
    ap.add_argument("--target", required=True, help="catalog table to merge into")
    ap.add_argument("--key-set", choices=["on_premise", "cloud"], default="on_premise")
    ap.add_argument("--buckets", type=int, default=64)
    a = ap.parse_args(argv)
    spark = get_session()
    info = ingest_month(spark, a.landing, a.service, a.year, a.month, a.target, a.key_set, a.buckets)
    print(info)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
