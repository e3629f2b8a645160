"""Registered queries of the readers, writers, loads and catalog operators.

Each writes a given table through the operator under the scratch path (or as
a catalog table of a fresh name), reads it back with the matching reader and
returns what came back, so that the DuckDB text over the original table must
give the same rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faresight.functions.columns import on_day_formatted, parse_timestamp, since_days
from faresight.operators import adhoc
from faresight.plans import ingest
from faresight.plans import params as P
from faresight.plans.settings import var
from faresight.session import scratch_path
from faresight.sinks import files as out
from faresight.sinks import loads, tables
from faresight.sources import catalog, files
from faresight.sources import taxi_adapter as A
from faresight.sources.tables import table
from faresight.streaming import audit
from faresight.streaming import loads as stream_loads
from faresight.streaming import messages
from faresight.streaming import sessions as stream_sessions

CUSTOMER_DDL = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
SUPPLIER_DDL = "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"
ORDERS_DDL = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string")


def _name(word: str) -> str:
    return f"{word}_{uuid.uuid4().hex[:10]}"


def _as(df: DataFrame, like: DataFrame) -> DataFrame:
    """Columns of ``df`` in the types of ``like``."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in like.schema])


# -- files ---------------------------------------------------------------------

def csv_inferred(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "part")
    path = scratch_path(spark, "csv-inferred")
    out.write_csv(parts, path)
    return _as(files.read_csv(spark, path), parts)


def csv_gzip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "csv-gzip")
    table(spark, d, "customer").write.option("header", True).option("compression", "gzip").csv(path)
    return files.read_csv(spark, path, CUSTOMER_DDL, repartition=4)


def csv_external(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "csv-external")
    stamp = "yyyy-MM-dd HH:mm:ss"
    table(spark, d, "orders").withColumn("o_orderdate", F.date_format("o_orderdate", stamp)) \
        .write.option("header", True).csv(path)
    name = _name("orders_external")
    return files.external_table(spark, name, path, ORDERS_DDL)


def bulk_load_columns(spark: SparkSession, d: str) -> DataFrame:
    """Chosen columns of a file, one of which the file lacks."""
    path = scratch_path(spark, "bulk-load")
    out.write_csv(table(spark, d, "supplier"), path)
    return files.read_csv_columns(spark, path, SUPPLIER_DDL, ["s_suppkey", "s_acctbal", "s_rating int"])


def parquet_glob(spark: SparkSession, d: str) -> DataFrame:
    """Yearly folders of orders, two of them read through a glob."""
    base = scratch_path(spark, "parquet-glob")
    orders = table(spark, d, "orders")
    out.write_parquet(orders.withColumn("y", F.year("o_orderdate")), base, partition_by=["y"])
    found = files.read_parquet(spark, f"{base}/y=199[67]")
    return found.select(*orders.columns)


def repartition_parquet(spark: SparkSession, d: str) -> DataFrame:
    """Four files, and all rows in them."""
    path = scratch_path(spark, "repartition")
    out.write_parquet(table(spark, d, "events"), path, partitions=4)
    return files.read_parquet(spark, path).agg(
        F.count_distinct("_metadata.file_name").alias("files"), F.count(F.lit(1)).alias("rows"))


def append_batches(spark: SparkSession, d: str) -> DataFrame:
    """Customers appended in files of bounded size, then the suppliers' nations as a small table."""
    path = scratch_path(spark, "append")
    customers = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    out.append_parquet(customers, path, rows_per_file=500)
    small = table(spark, d, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_nationkey").alias("c_nationkey"))
    out.append_parquet(small, path)
    return files.read_parquet(spark, path)


def json_lines(spark: SparkSession, d: str) -> DataFrame:
    """Events written as JSON records and read with an inferred schema."""
    path = scratch_path(spark, "json-lines")
    events = table(spark, d, "events")
    out.write_json(events, path)
    back = files.read_json(spark, path, multiline=False)
    return _as(back.withColumn("ts", parse_timestamp("ts")), events)


def _page_name() -> Column:
    return F.concat(F.lit("page_"), F.coalesce(F.col("page").cast("string"), F.lit("none"))).alias("name")


def json_pages(spark: SparkSession, d: str) -> DataFrame:
    """Conversation turns as numbered pages, each one JSON array, and an empty page."""
    base = scratch_path(spark, "json-pages")
    turns = table(spark, d, "conversations")
    # up to fifty turns each of ten conversations: a page stays small however long a conversation is
    page = (F.floor(F.col("conv_id") / 10) * 100_000 + F.floor(F.col("turn") / 50)).alias("page")
    arrays = turns.groupBy(page).agg(F.to_json(F.collect_list(F.struct(*turns.columns))).alias("value"))
    empty = spark.range(1).select(F.lit("page_empty").alias("name"), F.lit("[]").alias("value"))
    out.write_pages(arrays.select(_page_name(), "value").unionAll(empty), base)
    ddl = "conv_id bigint, turn bigint, role string, text string"
    return files.read_json_pages(spark, base, schema=ddl)


def numbered_pages(spark: SparkSession, d: str) -> DataFrame:
    """Parts as numbered pages with an empty one in the middle: read up to it, and resumed behind it."""
    base = scratch_path(spark, "numbered-pages")
    parts = table(spark, d, "part").select("p_partkey", "p_name", (F.floor(F.col("p_partkey") / P.PAGE_ROWS) + 1).alias("page"))
    record = F.struct("p_partkey", "p_name")
    pages = parts.groupBy("page").agg(F.to_json(F.collect_list(record)).alias("value"))     # PAGE_ROWS records at most
    value = F.when(F.col("page") == P.EMPTY_PAGE, "[]").otherwise(F.col("value")).alias("value")
    out.write_pages(pages.select(_page_name(), value), base)
    ddl = "p_partkey bigint, p_name string"
    first = files.read_numbered_pages(spark, base, ddl, 1)
    _, end = files.page_bounds(spark, base, 1)
    second = files.read_numbered_pages(spark, base, ddl, end + 1)
    return first.withColumn("run", F.lit(1)).unionByName(second.withColumn("run", F.lit(2)))


def parse_timestamps(spark: SparkSession, d: str) -> DataFrame:
    """Order dates from text in a fixed format."""
    text = F.date_format("o_orderdate", "dd/MM/yyyy HH:mm")
    return table(spark, d, "orders").select("o_orderkey", parse_timestamp(text, "dd/MM/yyyy HH:mm").alias("ordered_at"))


# -- catalog tables -------------------------------------------------------------

def external_parquet_table(spark: SparkSession, d: str) -> DataFrame:
    """A table over Parquet files that stay where they are."""
    path, name = scratch_path(spark, "external"), _name("customer_external")
    out.write_parquet(table(spark, d, "customer"), path)
    tables.create_table_if_absent(spark, name, CUSTOMER_DDL, location=path)
    tables.create_table_if_absent(spark, name, CUSTOMER_DDL, location=path)  # nothing to do
    return spark.table(name)


def bucketed_table(spark: SparkSession, d: str) -> DataFrame:
    """Orders per customer from a hash-distributed table."""
    name = _name("orders_bucketed")
    tables.save_bucketed(table(spark, d, "orders"), name, "o_custkey", 8)
    return spark.table(name).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"))


def partitioned_vendors(spark: SparkSession, d: str) -> DataFrame:
    """Vendors of a range of days from a table partitioned by day and clustered by vendor."""
    name = _name("yellow_by_day")
    trips = A.raw_service_trips(spark, d, "Yellow", ("vendorid", "dropoff_datetime"))
    tables.save_partitioned_clustered(trips, name, "dropoff_datetime", "vendorid", 1)
    days = tables.date_partition_filter("dropoff_datetime", *P.VENDOR_RANGE)
    return spark.table(name).filter(days).select("vendorid").distinct()


def reload_days(spark: SparkSession, d: str) -> DataFrame:
    """A table by day whose one day is replaced by a corrected batch, and another batch brings a new day:
    rows and vendors of each day."""
    name = _name("yellow_daily")
    trips = A.raw_service_trips(spark, d, "Yellow", ("vendorid", "dropoff_datetime")).select("vendorid", "dropoff_datetime")
    day, new = (F.lit(t).cast("date") for t in (P.VENDOR_RANGE[0], P.NEW_DAY))
    tables.save_daily(trips, name, "dropoff_datetime", "vendorid")
    corrected = trips.filter((F.to_date("dropoff_datetime") == day) & F.col("vendorid").isNotNull())
    added = corrected.withColumn("dropoff_datetime", F.lit(f"{P.NEW_DAY} 12:00:00").cast("timestamp_ntz"))
    for batch in (corrected.unionAll(corrected), added):
        tables.replace_days(spark, batch, name, "dropoff_datetime", "vendorid")
    return spark.table(name).groupBy(F.col("d").alias("day")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("vendorid").alias("vendors"),
        F.count_if(F.to_date("dropoff_datetime") != F.col("d")).alias("misplaced"))


def native_copy_reload(spark: SparkSession, d: str) -> DataFrame:
    """A native copy, emptied and loaded with another year; a dropped table is gone."""
    orders, name = table(spark, d, "orders"), _name("orders_copy")
    tables.materialize(spark, orders.filter(F.year("o_orderdate") == 1996), name)
    tables.truncate(spark, name)
    orders.filter(F.year("o_orderdate") == 1997).write.insertInto(name)
    gone = _name("orders_gone")
    tables.materialize(spark, orders.limit(1), gone)
    tables.drop(spark, gone)
    left = F.lit(spark.catalog.tableExists(gone))
    return spark.table(name).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("orders")) \
        .withColumn("dropped_table_exists", left)


def table_catalog(spark: SparkSession, d: str) -> DataFrame:
    """Columns of a table made from derived DDL, with its numbers of rows and columns."""
    lines, name = table(spark, d, "lineitem"), _name("lineitem_ddl")
    spark.sql(catalog.create_table_ddl(lines, name))
    if name not in catalog.list_tables(spark):
        raise RuntimeError(f"{name} is not listed")
    rows, columns = catalog.shape(lines)
    return catalog.describe(spark, name).select(
        F.col("col_name").alias("column_name"), F.lit(rows).cast("bigint").alias("rows"),
        F.lit(columns).cast("bigint").alias("columns"))


# -- loads -----------------------------------------------------------------------

def replace_append_loads(spark: SparkSession, d: str) -> DataFrame:
    """A replace load, an append, a replace again and an append: two loads' rows are left."""
    base = scratch_path(spark, "loads")
    rides = A.ride_events(spark, d).select("event_id", "event_type")
    for kind, how in (("click", "replace"), ("view", "append"), ("purchase", "replace"), ("error", "append")):
        loads.load(spark, rides.filter(F.col("event_type") == kind), f"{base}/rides", how, f"{base}/state")
    left = loads.read_target(spark, f"{base}/rides", rides.schema).groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"))
    state = loads.load_state(spark, f"{base}/state").agg(
        F.count(F.lit(1)).alias("loads"), F.sum("rows").alias("loaded_rows"))
    return left.crossJoin(state)  # one row of state


def ingest_monthly(spark: SparkSession, d: str) -> DataFrame:
    """Yellow trips as monthly CSV files, ingested into a bucketed target; the last month twice."""
    base, target = scratch_path(spark, "landing"), _name("yellow_tripdata")
    trips = A.raw_service_trips(spark, d, "Yellow")
    fields = [f.split() for f in ingest.CSV_SCHEMAS["yellow"].split(", ")]
    names = {"VendorID": "vendorid", "tpep_pickup_datetime": "pickup_datetime", "tpep_dropoff_datetime": "dropoff_datetime"}
    landed = trips.select(*[F.col(names.get(c, c.lower())).cast(kind).alias(c) for c, kind in fields],
                          F.date_format("pickup_datetime", "yyyy-MM").alias("month"))
    for stamp in ("tpep_pickup_datetime", "tpep_dropoff_datetime"):
        landed = landed.withColumn(stamp, F.date_format(stamp, "yyyy-MM-dd HH:mm:ss"))
    chosen = [f"{y}-{m:02d}" for y, m in P.INGEST_MONTHS]
    for month in chosen:
        landed.filter(F.col("month") == month).drop("month").write.option("header", True).csv(
            f"{base}/yellow_tripdata_{month}.csv")
    ingest.ingest_months(spark, base, "yellow", P.INGEST_MONTHS[:-1], target, buckets=4, named_by_folder=True)
    for _ in range(2):
        ingest.ingest_month(spark, base, "yellow", *P.INGEST_MONTHS[-1], target, buckets=4)
    return ingest.rows_per_file(spark, target)


def load_incremental_resources(spark: SparkSession, d: str) -> DataFrame:
    """Two resources loaded in turn into one target, each by its own cursor, twice."""
    base = scratch_path(spark, "load-resources")
    rides = A.ride_events(spark, d).select("event_id", "event_type", "dropoff_datetime", "pickup_datetime")
    early = rides.filter(F.col("pickup_datetime") < F.lit(P.INCREMENTAL_SPLIT).cast("timestamp_ntz"))
    for source in (early, rides):
        for kind in P.LOAD_RESOURCES:
            loads.load_incremental(spark, source.filter(F.col("event_type") == kind).drop("pickup_datetime"), f"{base}/rides",
                                   f"{base}/state", kind, "dropoff_datetime", initial_value=P.INCREMENTAL_INITIAL)
    kept = rides.drop("pickup_datetime").schema
    return loads.read_target(spark, f"{base}/rides", kept).withColumn(loads.LOAD_ID, F.col(loads.LOAD_ID).cast("int"))


def incremental_stream(spark: SparkSession, d: str) -> DataFrame:
    """Three arrivals of files, each loaded by a new start of two resources' streams into one target;
    every row with its resource's loaded rows and cursor."""
    base = scratch_path(spark, "load-stream")
    rides = A.ride_events(spark, d).select("event_id", "event_type", "dropoff_datetime")
    lo, hi = (F.lit(t).cast("timestamp_ntz") for t in P.ARRIVALS)
    at = F.col("dropoff_datetime")
    for arrived in (at < lo, (at >= lo) & (at < hi), at >= hi):
        for kind in P.LOAD_RESOURCES:
            rides.filter(arrived & (F.col("event_type") == kind)).write.mode("append").parquet(f"{base}/landing/{kind}")
        running = [stream_loads.start_load(
            spark, f"{base}/landing/{kind}", rides.schema, f"{base}/rides", f"{base}/state", kind, f"{base}/checkpoints",
            "dropoff_datetime", P.INCREMENTAL_INITIAL, files_per_trigger=4) for kind in P.LOAD_RESOURCES]
        for query in running:
            query.awaitTermination()
    loaded = loads.read_target(spark, f"{base}/rides", rides.schema).withColumn(
        "resource", F.substring_index(loads.LOAD_ID, "-", 1)).drop(loads.LOAD_ID)
    told = stream_loads.resource_state(spark, f"{base}/state").select(
        "resource", F.col("rows").alias("loaded_rows"), "cursor_value")
    return loaded.join(told, "resource")


def load_new_column(spark: SparkSession, d: str) -> DataFrame:
    """A load that lacks a column, then one that adds it: rows of both under the newest schema, with its version."""
    base = scratch_path(spark, "load-schema")
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", F.year("o_orderdate").alias("y"))
    loads.load(spark, orders.filter("y < 1997").drop("y", "o_orderpriority"), f"{base}/orders", "append", f"{base}/state")
    loads.load(spark, orders.filter("y >= 1997").drop("y"), f"{base}/orders", "append", f"{base}/state")
    version, _ = loads.target_schema(spark, f"{base}/state", f"{base}/orders")
    return loads.read_loaded(spark, f"{base}/orders", f"{base}/state").drop(loads.LOAD_ID).withColumn(
        "schema_version", F.lit(version))


# -- time and rank -----------------------------------------------------------------

def trips_on_day_formatted(spark: SparkSession, d: str) -> DataFrame:
    rides = A.ride_events(spark, d)
    return rides.filter(on_day_formatted("pickup_datetime", P.EVENT_DAY)).agg(F.count(F.lit(1)).alias("trips"))


def recent_rides(spark: SparkSession, d: str) -> DataFrame:
    """Rides of the last days before a given day, and those that the current date would still reach."""
    rides = A.ride_events(spark, d)
    days = var("days_back", P.DAYS_BACK)    # a run may name another number: --vars, or $DAYS_BACK
    return rides.agg(F.count_if(since_days("pickup_datetime", days, P.AS_OF)).alias("before_day"),
                     F.count_if(since_days("pickup_datetime", 100 * 365)).alias("last_century"))


def top_tips(spark: SparkSession, d: str) -> DataFrame:
    """The rides with the largest tips over all, by a global rank."""
    rides = A.ride_events(spark, d).select("event_id", "tip_amount")
    return adhoc.top_k(rides, P.TOP_TIPS, "tip_amount", ["event_id"])


# -- streams ------------------------------------------------------------------------

def late_rides_dropped(spark: SparkSession, d: str) -> DataFrame:
    """Rides of the first half arrive after a heartbeat has closed the second half's sessions: all are dropped, and counted."""
    base = scratch_path(spark, "late-rides")
    rides = A.ride_events(spark, d).select("user_id", "dropoff_datetime")
    half = F.lit(P.LATE_BEFORE).cast("timestamp_ntz")
    early, late = rides.filter(F.col("dropoff_datetime") >= half), rides.filter(F.col("dropoff_datetime") < half)
    end = rides.agg(F.timestamp_add("DAY", F.lit(1), F.max("dropoff_datetime")).alias("until"))
    arrivals = [lambda: messages.publish(early, path=f"{base}/in"),
                lambda: stream_sessions.send_heartbeat(end, f"{base}/heartbeats"),
                lambda: messages.publish(late, path=f"{base}/in")]
    for arrive in arrivals:
        arrive()
        with audit.ProgressLog(spark, f"{base}/log") as log:
            stream_sessions.run_session_job(
                spark, "user_id bigint, dropoff_datetime timestamp_ntz", ["user_id"], "dropoff_datetime",
                source_path=f"{base}/in", sink_path=f"{base}/out", gap=P.SESSION_GAP, available_now=True,
                state_partitions=spark.sparkContext.defaultParallelism, heartbeat_path=f"{base}/heartbeats",
                log=log).awaitTermination()
    told = audit.row_report(spark, f"{base}/log", f"{base}/out_checkpoint").select("arrived", "open_rows", "dropped")
    return spark.read.parquet(f"{base}/out").agg(
        F.sum("taxi_trips_streak").alias("rides"), F.min("session_start").alias("first_session")).crossJoin(told)  # one row each


QUERIES = {f.__name__: f for f in (
    csv_inferred, csv_gzip, csv_external, bulk_load_columns, parquet_glob, repartition_parquet, append_batches, json_lines,
    json_pages, numbered_pages, parse_timestamps, external_parquet_table, bucketed_table, partitioned_vendors, reload_days,
    native_copy_reload,
    table_catalog, replace_append_loads, load_incremental_resources, incremental_stream, load_new_column, ingest_monthly, trips_on_day_formatted, recent_rides, top_tips,
    late_rides_dropped)}
