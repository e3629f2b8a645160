"""The model layer as one plan: staging views -> fact / dimension -> marts.

The fact table feeds three marts, so it is written once to the shared
checkpoint folder and read back (``materialize=True``): the marts then scan
compact parquet instead of re-running the staging joins and dedup three
times, and a lost executor recomputes from those files, not from the raw
sources.  The FHV dimension is written too: the p90 mart reads it twice
(aggregate, then join back).  Views stay lazy.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from faresight.operators import models, quality, staging
from faresight.session import scratch_path


def materialize_parquet(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under ``spark.checkpoint.dir`` and return the re-read table."""
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def build_models(spark: SparkSession, raw_green: DataFrame, raw_yellow: DataFrame, raw_fhv: DataFrame,
                 zones: DataFrame, *, tiebreak: Sequence[str] = (), years: Sequence[int] = (2019, 2020),
                 unknown_borough: str = "Unknown", excluded_zone_ids: Sequence[int] = (264, 265),
                 payment_values: Sequence[int] = (1, 2, 3, 4, 5, 6),
                 materialize: bool = True) -> dict[str, DataFrame]:
    """Return every model by name (all lazy except the materialised fact)."""
    out: dict[str, DataFrame] = {}
    out["stg_green"] = staging.stage_trips(raw_green, tiebreak=tiebreak)
    out["stg_yellow"] = staging.stage_trips(raw_yellow, street_hail_only=True, tiebreak=tiebreak)
    out["stg_fhv"] = staging.stage_fhv(raw_fhv)
    out["stg_zones"] = staging.stage_zones(zones)
    fact = models.fact_trips(out["stg_green"], out["stg_yellow"], out["stg_zones"], unknown_borough=unknown_borough)
    out["fact_trips"] = materialize_parquet(spark, fact, "fact_trips") if materialize else fact
    dim = models.dim_fhv_trips(out["stg_fhv"], out["stg_zones"], excluded_ids=excluded_zone_ids)
    out["dim_fhv_trips"] = materialize_parquet(spark, dim, "dim_fhv_trips") if materialize else dim
    out["monthly_zone_revenue"] = models.monthly_zone_revenue(out["fact_trips"])
    out["quarterly_revenue_growth"] = models.quarterly_revenue_growth(out["fact_trips"], years=years)
    out["monthly_fare_percentiles"] = models.monthly_fare_percentiles(out["fact_trips"])
    out["fhv_travel_time_p90"] = models.fhv_travel_time_p90(out["dim_fhv_trips"])
    for svc in ("green", "yellow"):
        # X17: the green drop-off relationship test has no severity -> error
        sev = "error" if svc == "green" else "warn"
        out[f"checks_stg_{svc}"] = quality.run_checks(out[f"stg_{svc}"], [
            quality.unique("tripid", "warn"), quality.not_null("tripid", "warn"),
            quality.relationships("pickup_locationid", out["stg_zones"], "locationid", "warn"),
            quality.relationships("dropoff_locationid", out["stg_zones"], "locationid", sev),
            quality.accepted_values("payment_type", list(payment_values), "warn"),
        ])
    return out


def register_models(built: dict[str, DataFrame]) -> None:
    """Expose every model as a temp view of the same name (for ``spark.sql``)."""
    for name, df in built.items():
        df.createOrReplaceTempView(name)


def models_from_test_tables(spark: SparkSession, data_dir: str, materialize: bool = True) -> dict[str, DataFrame]:
    """The model layer over the star-schema test tables (taxi adapter)."""
    from faresight.plans import params as P
    from faresight.sources import taxi_adapter as A

    return build_models(spark, A.raw_service_trips(spark, data_dir, "Green"),
                        A.raw_service_trips(spark, data_dir, "Yellow"), A.raw_fhv_trips(spark, data_dir),
                        A.zones(spark, data_dir), tiebreak=A.TRIP_TIEBREAK, years=P.GROWTH_YEARS,
                        unknown_borough=A.UNKNOWN_BOROUGH, excluded_zone_ids=A.UNKNOWN_ZONE_IDS,
                        materialize=materialize)


def write_models(built: dict[str, DataFrame], base_path: str, names: Sequence[str] | None = None,
                 partition_by: dict[str, list[str]] | None = None) -> dict[str, str]:
    """Materialise models as parquet tables under ``base_path/<name>`` (the
    ``table`` materialisation); returns name -> path.  Partitioned writes
    rebalance on the partition columns first (see ``sinks.files``)."""
    from faresight.sinks.files import write_parquet

    parts = partition_by or {"fact_trips": ["service_type"]}
    out = {}
    for name in names or [n for n in built if not n.startswith("checks_")]:
        path = f"{base_path.rstrip('/')}/{name}"
        write_parquet(built[name], path, partition_by=parts.get(name))
        out[name] = path
    return out
