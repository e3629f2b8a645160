"""Exactly-once micro-batches in a database: staging table, ledger, one transaction.

Tasks append a batch to a staging table, each over a connection of its own, as
Spark's writer does; a failed batch leaves nothing but staged rows.  When the
staging table is complete, one transaction copies its rows to the target and
enters the batch in the ledger ``(job, batch_id, row_count)``.  Readers of the
target see a batch wholly or not at all, and a batch that is replayed after a
failure finds its ledger entry and does nothing, or starts again at staging.

A job is named by the stream's query id, which its checkpoint keeps, so a job
with a new checkpoint does not take another one's batches for its own.

A task that is repeated after its executor was lost may have committed its rows
before; every staged row carries its number in the batch, and a staging table
that holds a number twice, or too few rows, is emptied and written again.

One job at a time uses a staging table (``<table>_staging`` unless named).
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

ROW = "staged_row"
ATTEMPTS = 3


def ledger_table(table: str) -> str:
    return f"{table}_ledger"


@contextmanager
def connection(spark: SparkSession, url: str, properties: dict, transaction: bool = False):
    """A JDBC connection of the driver; in a ``transaction`` all statements are committed together or not at all."""
    jvm = spark._jvm
    if properties.get("driver"):
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(properties["driver"])
    given = jvm.java.util.Properties()
    for k, v in properties.items():
        given.setProperty(k, str(v))
    conn = jvm.java.sql.DriverManager.getConnection(url, given)
    try:
        if transaction:
            conn.setAutoCommit(False)
        yield conn
        if transaction:
            conn.commit()
    except BaseException:
        if transaction:
            conn.rollback()
        raise
    finally:
        conn.close()


def _run(conn, sql: str, *values) -> int:
    statement = conn.prepareStatement(sql)
    try:
        for i, v in enumerate(values, 1):
            statement.setLong(i, v) if isinstance(v, int) else statement.setString(i, v)
        return statement.executeUpdate()
    finally:
        statement.close()


def _one(conn, sql: str, *values) -> tuple[int, ...]:
    """The first row of a query that returns whole numbers; () if there is none."""
    statement = conn.prepareStatement(sql)
    try:
        for i, v in enumerate(values, 1):
            statement.setLong(i, v) if isinstance(v, int) else statement.setString(i, v)
        found = statement.executeQuery()
        return tuple(found.getLong(i + 1) for i in range(found.getMetaData().getColumnCount())) if found.next() else ()
    finally:
        statement.close()


def table_exists(conn, table: str) -> bool:
    name = table.split(".")[-1]
    return any(conn.getMetaData().getTables(None, None, n, None).next() for n in {name, name.upper(), name.lower()})


def _append(df: DataFrame, url: str, table: str, properties: dict) -> None:
    (df.write.format("jdbc").mode("append").option("url", url).option("dbtable", table).options(**properties).save())


def stage(batch: DataFrame, url: str, staging: str, properties: dict) -> int:
    """Write a batch's rows to the staging table, each exactly once; returns their number."""
    spark = batch.sparkSession
    numbered = batch.withColumn(ROW, F.monotonically_increasing_id())
    for _ in range(ATTEMPTS):
        with connection(spark, url, properties) as conn:
            if table_exists(conn, staging):
                _run(conn, f"DELETE FROM {staging}")
        seen = Observation()
        _append(numbered.observe(seen, F.count(F.lit(1)).alias("n")), url, staging, properties)
        with connection(spark, url, properties) as conn:
            q = conn.getMetaData().getIdentifierQuoteString().strip()
            found = _one(conn, f"SELECT count(*), count(DISTINCT {q}{ROW}{q}) FROM {staging}")
        if found == (seen.get["n"], seen.get["n"]):
            return seen.get["n"]
    raise RuntimeError(f"{staging} did not hold each row of the batch once after {ATTEMPTS} attempts")


def promote(spark: SparkSession, url: str, table: str, staging: str, properties: dict, columns: list[str], job: str,
            batch_id: int, rows: int) -> None:
    """Copy the staged rows to the target and enter the batch in the ledger, in one transaction."""
    with connection(spark, url, properties, transaction=True) as conn:
        q = conn.getMetaData().getIdentifierQuoteString().strip()
        names = ", ".join(f"{q}{c}{q}" for c in columns)
        copied = _run(conn, f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging}")
        if copied != rows:
            raise RuntimeError(f"{copied} of {rows} staged rows were copied to {table}")
        _run(conn, f"INSERT INTO {ledger_table(table)} (job, batch_id, row_count) VALUES (?, ?, ?)", job, batch_id, rows)


def ledger_writer(url: str, table: str, properties: dict | None = None, batch_col: str = "batch_id",
                  staging: str | None = None, job: str | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that adds each micro-batch to ``table`` exactly once, its id in ``batch_col``.

    ``job`` names the job in the ledger (default: the stream's query id).
    """
    props, held = dict(properties or {}), staging or f"{table}_staging"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = job or spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batches"
        with connection(spark, url, props) as conn:
            if not table_exists(conn, ledger_table(table)):
                _run(conn, f"CREATE TABLE {ledger_table(table)} (job VARCHAR(200) NOT NULL, batch_id BIGINT NOT NULL, "
                           "row_count BIGINT NOT NULL, PRIMARY KEY (job, batch_id))")
            if _one(conn, f"SELECT row_count FROM {ledger_table(table)} WHERE job = ? AND batch_id = ?", name, batch_id):
                return      # an earlier attempt was promoted
            known = table_exists(conn, table)
        rows = batch.withColumn(batch_col, F.lit(batch_id).cast("bigint"))
        if not known:
            _append(rows.limit(0), url, table, props)
        count = stage(rows, url, held, props)
        promote(spark, url, table, held, props, rows.columns, name, batch_id, count)
        with connection(spark, url, props) as conn:
            _run(conn, f"DELETE FROM {held}")

    return write
