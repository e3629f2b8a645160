"""Catalog inspection: list tables, describe, derive DDL, peek."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.name.startswith("_"))


def describe(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {name}")


def ddl_of(df: DataFrame) -> str:
    """DDL column list of a (possibly inferred) schema, reusable as a fixed schema."""
    return df.schema.toDDL()


def create_table_ddl(df: DataFrame, name: str, using: str = "parquet") -> str:
    return f"CREATE TABLE IF NOT EXISTS {name} ({ddl_of(df)}) USING {using}"


def shape(df: DataFrame) -> tuple[int, int]:
    """(rows, columns); the row count is a distributed count."""
    return df.count(), len(df.columns)


def peek(df: DataFrame, n: int = 5) -> list:
    """First ``n`` rows (a bounded ``limit``, no full scan needed)."""
    return df.limit(n).collect()
