"""Catalog tables: create-if-absent, hash-bucketed and date-partitioned
layouts, CTAS copies, truncate/drop and temp views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def create_table_if_absent(spark: SparkSession, name: str, ddl: str, using: str = "parquet",
                           location: str | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS name (ddl) USING parquet``."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING {using}{loc}")


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, mode: str = "overwrite",
                  sort_by: Sequence[str] | None = None, path: str | None = None) -> None:
    """Hash-distributed table: ``bucketBy(buckets, key)``.

    Later joins/aggregations on ``key`` against a table bucketed the same way
    read co-partitioned data and skip the shuffle on this side (the
    insert-only merge uses this for the target's row id).
    """
    w = df.write.mode(mode).format("parquet").bucketBy(buckets, key)
    w = w.sortBy(*(sort_by or [key]))
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def save_partitioned_clustered(df: DataFrame, name: str, ts_col: str, cluster_col: str, buckets: int,
                               date_col: str = "d", mode: str = "overwrite", path: str | None = None) -> None:
    """Partition by the calendar date of ``ts_col`` and cluster (bucket +
    sort) by ``cluster_col``.  Filters must name ``date_col`` to prune
    partitions (see :func:`date_partition_filter`)."""
    out = _by_day(df.withColumn(date_col, F.to_date(ts_col)), date_col, cluster_col)
    w = (out.write.mode(mode).format("parquet").partitionBy(date_col)
            .bucketBy(buckets, cluster_col).sortBy(cluster_col))
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def _by_day(df: DataFrame, date_col: str, cluster_col: str) -> DataFrame:
    """Rows in ranges of (day, cluster value), sorted: small days share a task, a hot day is cut into
    ranges of the cluster column.

    The number of ranges is that of the shuffle partitions.  It is given, as AQE would merge small ones
    by their bytes, and the time to write many small days is that of their files, not of their bytes.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(ranges, date_col, cluster_col).sortWithinPartitions(date_col, cluster_col)


def save_daily(df: DataFrame, name: str, ts_col: str, cluster_col: str, date_col: str = "d", path: str | None = None,
               row_group_bytes: int | None = None) -> None:
    """A table partitioned by day whose files are sorted by ``cluster_col``.

    Its row groups hold narrow ranges of the cluster column, so their
    statistics let a scan for a few of its values skip the rest; days can be
    replaced one by one (:func:`replace_days`).
    """
    out = _by_day(df.withColumn(date_col, F.to_date(ts_col)), date_col, cluster_col)
    w = out.write.mode("overwrite").format("parquet").partitionBy(date_col)
    if row_group_bytes:
        w = w.option("parquet.block.size", row_group_bytes)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def replace_days(spark: SparkSession, df: DataFrame, name: str, ts_col: str, cluster_col: str, date_col: str = "d",
                 row_group_bytes: int | None = None) -> None:
    """Replace the days that ``df`` has rows of, whole; the table's other days stay as they are.

    The partition overwrite mode is set on this write, whatever the session's
    is.  A day whose rows are all gone has to be dropped by its partition.
    """
    where = [r for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect() if r["col_name"] == "Location"]
    target = spark.table(name)
    dated = df.withColumn(date_col, F.to_date(ts_col)).select(*target.columns)
    days = [str(r[0]) for r in dated.select(date_col).filter(F.col(date_col).isNotNull()).distinct().collect()]
    out = _by_day(dated, date_col, cluster_col)
    w = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date_col)
    if row_group_bytes:
        w = w.option("parquet.block.size", row_group_bytes)
    w.parquet(where[0]["data_type"])
    if days:    # the catalog learns of days that the table did not have
        parts = " ".join(f"PARTITION ({date_col} = DATE '{day}')" for day in days)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
    spark.catalog.refreshTable(name)


def date_partition_filter(ts_col: str, first_day: str, last_day: str, date_col: str = "d"):
    """Inclusive day range written on BOTH the partition column (so the scan
    prunes partitions) and the timestamp itself (exact rows)."""
    import datetime as dt

    from faresight.functions.columns import ntz_literal

    lo = dt.date.fromisoformat(first_day)
    hi = dt.date.fromisoformat(last_day)
    return (F.col(date_col).between(F.lit(lo.isoformat()).cast("date"), F.lit(hi.isoformat()).cast("date"))
            & (F.col(ts_col) >= ntz_literal(lo))
            & (F.col(ts_col) < ntz_literal(hi + dt.timedelta(days=1))))


def materialize(spark: SparkSession, df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``CREATE TABLE name AS SELECT`` (native copy of an external table)."""
    w = df.write.mode("overwrite").format("parquet")
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return spark.table(name)


def truncate(spark: SparkSession, name: str) -> None:
    spark.sql(f"TRUNCATE TABLE {name}")


def drop(spark: SparkSession, name: str, view: bool = False) -> None:
    spark.sql(f"DROP {'VIEW' if view else 'TABLE'} IF EXISTS {name}")


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Materialisation ``view``: a named, lazily evaluated plan."""
    df.createOrReplaceTempView(name)
    return df
