"""Stamp staged rows with a row id and file name, then insert-only merge.

The merge is ``MERGE ... WHEN NOT MATCHED THEN INSERT``: rows whose id is
already in the target are skipped, everything else is appended.  On Spark
that is a left-anti join of the source against the target's id column
(only that column is read from the target), then an append.

Scale notes: :func:`merge_insert_only` writes the stamped batch once and asks
for each *distinct* id of it whether the target has it, so the question never
holds a hot id twice; then the batch drops the ids that were found, a join
whose two sides AQE may split.  Of the target it reads the id column only, and
of that

* for a target bucketed on the row id (``sinks.tables.save_bucketed``) the
  files of those buckets alone that the batch's ids hash to, without a shuffle;
* for another target the ids that pass a one-hash Bloom filter of the batch
  (at most ``POSITIONS`` positions, so it is broadcast), before the shuffle.

Plain parquet has no transactions, so only one merge may run against a target
at a time (the reference's flow has the same single-execution limit).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from faresight.functions.columns import row_hash
from faresight.operators.staging import dedupe_first
from faresight.session import scratch_path

ROW_ID = "unique_row_id"
FILE_NAME = "filename"


def stamp(df: DataFrame, key_columns: Sequence[str], filename: str | Column | None = None,
          sep: str = "", id_col: str = ROW_ID, text_form: dict | None = None) -> DataFrame:
    """Prepend ``unique_row_id`` (MD5 of the key columns' text) and
    ``filename``.  ``filename=None`` takes the name of the file each row was
    read from (``_metadata.file_name``; file sources only).  ``text_form``
    overrides the text of chosen key columns (see ``row_hash``)."""
    if filename is None:
        fn = F.col("_metadata.file_name")
    elif isinstance(filename, str):
        fn = F.lit(filename)
    else:
        fn = filename
    rest = [F.col(f"`{c}`") for c in df.columns if c not in (id_col, FILE_NAME)]
    return df.select(row_hash(list(key_columns), sep, text_form).alias(id_col), fn.alias(FILE_NAME), *rest)


def new_rows(source: DataFrame, target: DataFrame, key: str = ROW_ID, dedupe_source: bool = False,
             order: Sequence[str] | None = None) -> DataFrame:
    """Source rows whose key is absent from the target.

    Duplicates inside the source are all kept (as the reference's MERGE
    does) unless ``dedupe_source``; then the first row per key under
    ``order`` (default: all columns) is kept.
    """
    src = source
    if dedupe_source:
        src = dedupe_first(src, [key], [F.col(c) for c in (order or [c for c in src.columns if c != key])])
    return src.join(target.select(key), key, "left_anti")


def merged(source: DataFrame, target: DataFrame, key: str = ROW_ID, dedupe_source: bool = False) -> DataFrame:
    """The target as it is after the merge (lazy: target + new source rows)."""
    return target.unionByName(new_rows(source, target, key, dedupe_source))


POSITIONS = 1 << 20     # of the Bloom filter: at most so many numbers are broadcast


def bucket_files(target: DataFrame, buckets: Sequence[int]) -> DataFrame:
    """The rows of a bucketed table's files of these buckets; the others are not listed for the scan."""
    number = F.regexp_extract(F.col("_metadata.file_name"), r"_(\d+)(?:\..*)?$", 1).cast("int")
    return target.filter(number.isin(list(buckets)))


def passing(target: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Target rows whose id may be among ``ids``, by a one-hash Bloom filter."""
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(POSITIONS)).cast("int")
    taken = ids.select(place(key).alias("_place")).distinct()
    return target.join(F.broadcast(taken), place(key) == taken["_place"], "left_semi")


def matched_ids(spark: SparkSession, ids: DataFrame, target_table: str, key: str = ROW_ID) -> DataFrame:
    """The ids (distinct, non-null) that a catalog table holds, read as sparingly as its layout allows."""
    target = spark.table(target_table)
    buckets = _buckets(spark, target_table, key)
    if buckets:
        used = ids.select(F.pmod(F.hash(key), F.lit(buckets)).alias("b")).distinct().collect()  # at most ``buckets`` numbers
        target = bucket_files(target, [r["b"] for r in used])
    else:
        target = passing(target, ids, key)
    return ids.join(target.select(key), key, "left_semi")


def merge_insert_only(spark: SparkSession, source: DataFrame, target_table: str, key: str = ROW_ID,
                      dedupe_source: bool = False) -> int:
    """Append the new rows of ``source`` to catalog table ``target_table``;
    returns the number of rows inserted.

    The batch and the ids found in the target are written under the scratch
    path first, so a lost task computes the same rows again and nothing reads
    what the append writes.  For a target bucketed on ``key`` the rows of a
    bucket are first brought together (one file for each bucket); a bucket that
    one hot id makes too large is split over several tasks.
    """
    target = spark.table(target_table)
    batch = _written(spark, source.select(*target.columns), "merge-batch")
    ids = batch.select(key).filter(F.col(key).isNotNull()).distinct()
    found = _written(spark, matched_ids(spark, ids, target_table, key), "merge-matched")
    new = new_rows(batch, found, key, dedupe_source).select(*target.columns)
    buckets = _buckets(spark, target_table, key)
    if buckets:
        dealt = new.withColumn("_bucket", F.pmod(F.hash(key), F.lit(buckets)))  # the expression of bucketBy
        new = dealt.hint("rebalance", "_bucket").drop("_bucket")
    written = Observation()
    new.observe(written, F.count(F.lit(1)).alias("n")).write.insertInto(target_table)
    return written.get["n"]


def _written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _buckets(spark: SparkSession, table: str, key: str) -> int:
    """Number of buckets if the table is bucketed on ``key`` alone, else 0."""
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    return int(told["Num Buckets"]) if told.get("Bucket Columns") == f"[`{key}`]" else 0
