"""Access to the parquet tables of a data directory.

Reads are lazy; Catalyst prunes columns and pushes filters into each scan,
so callers select only what they use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, data_dir: str, names=TABLES) -> None:
    """Register every table as a temp view of the same name (for ``spark.sql``)."""
    for n in names:
        table(spark, data_dir, n).createOrReplaceTempView(n)
