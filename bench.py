"""Benchmark: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (the whole plan runs,
nothing is collected to the driver).  Before timing, every query is run once
on smaller tables ($BENCH_WARMUP_DIR, default sf0.01): that loads and
JIT-compiles the JVM paths and fills the codegen cache (same plan shapes),
so the timed pass measures data work rather than first-run compilation.  Also measures message-publish throughput
(rows -> JSON messages -> files), the reference's only throughput figure.
Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time
from urllib.parse import unquote, urlparse

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARMUP_DIR = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.01")


def _sf(path: str) -> float | str:
    tail = os.path.basename(path.rstrip("/"))
    try:
        return float(tail.replace("sf", ""))
    except ValueError:
        return tail


def _local_bytes(path: str) -> int:
    root = path[len("file:"):] if path.startswith("file:") else path
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet"))


def _scanned_bytes(df) -> int:
    """Bytes of the files that the optimised plan of ``df`` is left to read."""
    return sum(os.path.getsize(unquote(urlparse(f).path)) for f in df.inputFiles())


def _pruning(spark, sf_dir: str) -> dict:
    """Distinct vendors dropping off 1998-03-01..15 on a plain parquet table
    vs a catalog table partitioned by drop-off date and clustered by vendor
    (the shape of the reference's 310 MB -> 26.84 MB figure): bytes the scan
    must read and seconds.  The catalog prunes partitions before listing."""
    from faresight.operators.adhoc import distinct_in_range
    from faresight.session import scratch_path
    from faresight.sinks.files import write_parquet
    from faresight.sinks.tables import date_partition_filter, save_partitioned_clustered
    from faresight.sources import taxi_adapter as A

    y = A.raw_service_trips(spark, sf_dir, "Yellow")
    plain, part = scratch_path(spark, "bench-plain"), scratch_path(spark, "bench-part")
    t0 = time.perf_counter()
    four = scratch_path(spark, "bench-four")
    write_parquet(y, four, partitions=4)
    t_four = time.perf_counter() - t0
    n_four = len([f for f in os.listdir(four[len("file:"):] if four.startswith("file:") else four)
                  if f.endswith(".parquet")])
    write_parquet(y, plain)
    t0 = time.perf_counter()
    spark.sql("DROP TABLE IF EXISTS bench_yellow_by_day")
    save_partitioned_clustered(y, "bench_yellow_by_day", "dropoff_datetime", "vendorid", 1, path=part)
    t_write = time.perf_counter() - t0
    unpruned = distinct_in_range(spark.read.parquet(plain), "vendorid", "dropoff_datetime", "1998-03-01", "1998-03-15")
    t0 = time.perf_counter()
    n1 = unpruned.count()
    t1 = time.perf_counter()
    q = spark.table("bench_yellow_by_day").filter(
        date_partition_filter("dropoff_datetime", "1998-03-01", "1998-03-15")).select("vendorid").distinct()
    n2 = q.count()
    t2 = time.perf_counter()
    assert n1 == n2
    b_plain, b_part = _scanned_bytes(unpruned), _scanned_bytes(q)
    return {"vendors": n1, "bytes_unpartitioned": b_plain, "bytes_partitioned_scan": b_part,
            "bytes_ratio": round(b_plain / b_part, 1) if b_part else None,
            "sec_unpartitioned": round(t1 - t0, 3), "sec_partitioned": round(t2 - t1, 3),
            "sec_write_partitioned": round(t_write, 3), "partitions": len(spark.sql(
                "SHOW PARTITIONS bench_yellow_by_day").collect()),
            "repartition4_files": n_four, "repartition4_bytes": _local_bytes(four),
            "repartition4_sec": round(t_four, 3)}


def main() -> None:
    from faresight.plans.queries import QUERIES, _RIDE_COLUMNS
    from faresight.session import get_session, scratch_path
    from faresight.sources import taxi_adapter as A
    from faresight.streaming import messages

    extra = {}
    if os.environ.get("BENCH_DRIVER_MEMORY"):
        extra["spark.driver.memory"] = os.environ["BENCH_DRIVER_MEMORY"]
    import tempfile

    extra.setdefault("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="faresight-bench-wh-"))
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", int(CPUS) * 2))
    spark = get_session(f"local[{CPUS}]", parts, extra=extra)
    only = [a for a in sys.argv[1:] if a in QUERIES]
    keys = only or list(QUERIES)

    warm = WARMUP_DIR if os.path.isdir(WARMUP_DIR) else SF_DIR
    t_warm = time.perf_counter()
    for k in keys:
        QUERIES[k](spark, warm).write.format("noop").mode("overwrite").save()
    t_warm = time.perf_counter() - t_warm

    times: dict[str, float] = {}
    for k in keys:
        t0 = time.perf_counter()
        QUERIES[k](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        times[k] = round(time.perf_counter() - t0, 3)

    # publish throughput: every ride -> one JSON message -> message files
    rides = A.ride_events(spark, SF_DIR).select(*_RIDE_COLUMNS)
    n = rides.count()
    t0 = time.perf_counter()
    messages.publish(rides, path=scratch_path(spark, "bench-publish"),
                     fill={"passenger_count": 0, "tip_amount": 0.0})
    pub = time.perf_counter() - t0

    pruning = _pruning(spark, SF_DIR) if os.environ.get("BENCH_PRUNING", "1") != "0" else None

    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": _sf(SF_DIR),
        "cpus": int(CPUS),
        "warmup": f"each query once on {warm} ({t_warm:.1f}s, untimed)",
        "publish_messages": n,
        "publish_seconds": round(pub, 3),
        "publish_messages_per_sec": round(n / pub, 1) if pub > 0 else None,
        "pruning": pruning,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
