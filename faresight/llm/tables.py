"""Intermediate tables in the shared checkpoint folder, and connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from faresight.session import scratch_path


# A query's shuffle files go as soon as it has ended, not when the driver next collects its garbage.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint folder and read back.

    This cuts the lineage at files that every executor sees, and gives the
    planner the table's true size when it chooses between join strategies.
    The table is all that stays on disk: the shuffle files behind it are removed.
    """
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEAN_UP, None)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEAN_UP) if before is None else spark.conf.set(_CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def contracted(spark: SparkSession, links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id, component`` (smallest reachable id) of every id in ``links`` that is not its component's smallest.

    Alternating star contraction: large-star hangs a node's larger neighbours
    on its smallest neighbour, small-star the smaller ones, until a round moves
    nothing (a number of rounds logarithmic in practice).  Either half is one
    shuffle of the links by node and a window over each node's links, which
    Spark spills if they are many; each round is a written table.  Rows with a
    null end and self-links add nothing; an empty table gives an empty result.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") > F.col("v")))
    node = Window.partitionBy("u")
    while True:
        seen = Observation()
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.withColumn("m", F.least("u", F.min("v").over(node))).filter("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v"), F.expr("m < u").alias("moved"))
        small = large.select("u", "v", "moved", F.first("v").over(node.orderBy("v")).alias("m"),
                             F.lag("v").over(node.orderBy("v")).alias("_before"))
        small = small.observe(seen, F.count_if(F.expr("moved or v > m")).alias("n"))
        # equal links of a node are neighbours here; one of them goes on
        edges = materialise(spark, small.filter("_before is null or _before < v").select(
            F.expr("if(v > m, v, u)").alias("u"), F.col("m").alias("v")), "components")
        if not seen.get["n"]:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))


def connected_components(spark: SparkSession, links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id, component`` (smallest reachable id) of every id that occurs in ``links``; see ``contracted``."""
    found = contracted(spark, links, a, b)
    return found.unionAll(found.select(F.col("component").alias("id"), "component").distinct())
