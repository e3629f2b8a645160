"""Batch session windows (gap-based) per key, skew-tolerant.

A session is a maximal run of events of one key in which each event is at
most ``gap`` after the previous one; it spans ``[first, last + gap)``
(Spark's ``session_window``: two events exactly ``gap`` apart share a
session).

Plan, instead of one window over all rows of a key:

1. cut time into buckets of width ``gap``.  All events of one key inside one
   bucket are less than ``gap`` apart, so they always belong to one session:
   a plain grouped aggregate (min, max, count) with map-side partial
   aggregation collapses them.  A hot key is pre-aggregated before the
   shuffle, however many rows it has.
2. stitch consecutive pieces of a key: a new session starts where a piece
   begins more than ``gap`` after the previous piece ends.  This window runs
   over pieces, at most one per key and bucket, bounded by the key's time
   span / gap rather than by its row count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faresight.functions.columns import floor_div, wall_micros
from faresight.operators.adhoc import first_ranked


def _gap_micros(gap: str) -> int:
    n, unit = gap.split()
    n = float(n)
    unit = unit.lower().rstrip("s")
    scale = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000,
             "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000}[unit]
    return int(n * scale)


def session_counts(df: DataFrame, keys: Sequence[str], ts_col: str, gap: str = "5 minutes",
                   count_alias: str = "taxi_trips_streak") -> DataFrame:
    """One row per (keys, session): ``session_start``, ``session_end``, count."""
    g = _gap_micros(gap)
    keys = list(keys)
    t = df.select(*keys, F.col(ts_col).alias("_ts")).filter(F.col("_ts").isNotNull())
    pieces = (t.groupBy(*keys, floor_div(wall_micros("_ts"), g).alias("_bucket"))
               .agg(F.min("_ts").alias("_lo"), F.max("_ts").alias("_hi"), F.count(F.lit(1)).alias("_n")))
    w = Window.partitionBy(*keys).orderBy("_bucket")
    prev_hi = F.lag("_hi").over(w)
    gap_exceeded = F.timestamp_diff("MICROSECOND", prev_hi, F.col("_lo")) > F.lit(g)
    starts = pieces.withColumn("_new", F.when(prev_hi.isNull() | gap_exceeded, 1).otherwise(0))
    sid = starts.withColumn("_sid", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    out = (sid.groupBy(*keys, "_sid")
              .agg(F.min("_lo").alias("session_start"), F.max("_hi").alias("_last"),
                   F.sum("_n").alias(count_alias)))
    return out.select(*keys, "session_start",
                      F.timestamp_add("MICROSECOND", F.lit(g), F.col("_last")).alias("session_end"),
                      count_alias)


def session_counts_native(df: DataFrame, keys: Sequence[str], ts_col: str, gap: str = "5 minutes",
                          count_alias: str = "taxi_trips_streak") -> DataFrame:
    """Same result through Spark's ``session_window`` (used by the stream and
    as a cross-check; one sort per key instead of the bucketed pre-aggregate)."""
    s = (df.groupBy(*keys, F.session_window(F.col(ts_col), gap).alias("_w"))
           .agg(F.count(F.lit(1)).alias(count_alias)))
    return s.select(*keys, F.col("_w.start").alias("session_start"),
                    F.col("_w.end").alias("session_end"), count_alias)


def longest_sessions(sessions: DataFrame, count_col: str = "taxi_trips_streak") -> DataFrame:
    """Sessions whose count equals the maximum (ties kept), in one pass over the sessions."""
    return first_ranked(sessions.filter(F.col(count_col).isNotNull()), count_col)
