"""Rows <-> JSON messages (the producer side and the parser).

Messages are one JSON object per row, in a ``value`` column.  Timestamps are
written and parsed with microseconds (``to_json`` keeps only milliseconds
by default, which would move events across session boundaries).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
JSON_OPTIONS = {"timestampFormat": TS_FORMAT, "timestampNTZFormat": TS_FORMAT}


def kafka_available(spark: SparkSession) -> bool:
    """True when the Kafka data source can be resolved (connector on the
    classpath).  Resolving a batch relation does not contact any broker."""
    try:
        (spark.read.format("kafka").option("kafka.bootstrap.servers", "localhost:9")
              .option("subscribe", "faresight-probe").load())
        return True
    except Exception as e:  # noqa: BLE001
        msg = str(e)
        return not ("DATA_SOURCE_NOT_FOUND" in msg or "Failed to find data source" in msg)


def require_kafka(spark: SparkSession, topic: str, bootstrap_servers: str | None) -> None:
    """Raise unless ``topic`` can be reached: servers given, connector present."""
    if not bootstrap_servers:
        raise ValueError(f"topic {topic!r} needs bootstrap_servers")
    if not kafka_available(spark):
        raise RuntimeError(f"topic {topic!r} needs the Kafka connector on the classpath")


def to_messages(df: DataFrame, columns: Sequence[str] | None = None, fill: dict | None = None,
                key_col: str | None = None) -> DataFrame:
    """Select ``columns``, fill NULLs per column (``fill``), serialise each
    row to JSON in ``value`` (and ``key`` when ``key_col`` is given)."""
    out = df.select(*(columns or df.columns))
    if fill:
        out = out.na.fill(fill)
    cols = [F.to_json(F.struct(*[F.col(f"`{c}`") for c in out.columns]), JSON_OPTIONS).alias("value")]
    if key_col:
        cols.insert(0, F.col(key_col).cast("string").alias("key"))
    return out.select(*cols)


def parse_messages(df: DataFrame, schema_ddl: str, value_col: str = "value", mode: str = "FAILFAST") -> DataFrame:
    """JSON text -> typed columns (``from_json``).  A message that is not valid
    JSON for the schema is an error; ``mode="PERMISSIVE"`` makes its fields
    NULL instead (count them with :func:`corrupt_messages`)."""
    return df.select(F.from_json(F.col(value_col).cast("string"), schema_ddl, {**JSON_OPTIONS, "mode": mode}).alias("_m")) \
             .select("_m.*")


def corrupt_messages(df: DataFrame, schema_ddl: str, value_col: str = "value") -> DataFrame:
    """The messages that ``parse_messages`` cannot parse, as their text."""
    options = {**JSON_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = F.from_json(F.col(value_col).cast("string"), f"{schema_ddl}, _corrupt string", options)
    return df.select(parsed["_corrupt"].alias(value_col)).filter(F.col(value_col).isNotNull())


def publish(df: DataFrame, topic: str | None = None, bootstrap_servers: str | None = None,
            path: str | None = None, columns: Sequence[str] | None = None, fill: dict | None = None) -> None:
    """Send rows as JSON messages to a Kafka topic, or as text files (one
    message per line) under ``path``, which the file stream source reads the
    same way.  A topic is never replaced by files: without servers or
    connector it is an error."""
    msgs = to_messages(df, columns, fill)
    if topic:
        require_kafka(df.sparkSession, topic, bootstrap_servers)
        (msgs.write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
             .option("topic", topic).save())
        return
    if not path:
        raise ValueError("a topic or a path for message files is required")
    msgs.select("value").write.mode("append").text(path)
